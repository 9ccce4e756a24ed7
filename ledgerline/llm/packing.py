"""Online packing by the sum-of-squares rule.

Each task encodes its documents in order and places them one at a time into windows of
``window`` tokens. ``level[f]`` counts the open windows that hold f tokens. A piece of s tokens
goes to the fill level f (0 is a new window) for which the sum of squared counts after the
placement, sum over f of level[f]^2, is least (Csirik et al.); equal costs take the fullest window.

Documents may be cut, so the rest is exact: a document longer than a window gives whole windows and
a remainder; when more than ``max_open`` windows are open, the next piece is cut to fill the
fullest ones, which bounds a task's memory; and at the end of a task the open windows are
filled up from the emptiest ones. The at most one window left is cut at powers of two, lengths
that need no padding. A sequence id is the task's partition number and a counter, so a task that
runs again after a lost executor gives the same rows. Nothing is shuffled or grouped by a key.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import id_text
from .tokens import default_paths, encoder

WINDOW = 2048
MAX_OPEN = 2048
END_ID = 1
_ROWS = 20_000          # pieces in one Arrow batch


class Piece:
    __slots__ = ("doc_id", "start", "ids", "doc_tokens")

    def __init__(self, doc_id, start: int, ids: np.ndarray, doc_tokens: int):
        self.doc_id, self.start, self.ids, self.doc_tokens = doc_id, start, ids, doc_tokens

    def cut(self, at: int) -> tuple["Piece", "Piece"]:
        """Copies, so that an open window keeps its own ids alive and not their document's."""
        return (Piece(self.doc_id, self.start, self.ids[:at].copy(), self.doc_tokens),
                Piece(self.doc_id, self.start + at, self.ids[at:].copy(), self.doc_tokens))


class Packer:
    """One task's windows. ``add`` and ``finish`` yield (sequence number, pieces) of closed windows."""

    def __init__(self, window: int = WINDOW, max_open: int = MAX_OPEN):
        self.window, self.max_open = window, max_open
        self.level = np.zeros(window + 1, np.int64)
        self.open: dict[int, list[list[Piece]]] = defaultdict(list)
        self.n_open = self.number = 0

    def _close(self, pieces: list[Piece]) -> tuple[int, list[Piece]]:
        self.number += 1
        return self.number - 1, pieces

    def best_level(self, size: int) -> int:
        """The fill level with the least change of the sum of squares."""
        fills = np.flatnonzero(self.level[: self.window - size + 1])
        fills = fills[fills > 0]
        after = fills + size
        change = 1 - 2 * self.level[fills] + np.where(after < self.window, 2 * self.level[after] + 1, 0)
        new = 2 * self.level[size] + 1 if size < self.window else 0
        if len(fills) and change.min() <= new:
            return int(fills[len(fills) - 1 - int(np.argmin(change[::-1]))])
        return 0

    def _take(self, fill: int) -> list[Piece]:
        self.level[fill] -= 1
        self.n_open -= 1
        return self.open[fill].pop()

    def _put(self, fill: int, pieces: list[Piece]) -> None:
        self.level[fill] += 1
        self.n_open += 1
        self.open[fill].append(pieces)

    def add(self, piece: Piece) -> Iterator[tuple[int, list[Piece]]]:
        whole = len(piece.ids) // self.window * self.window
        for at in range(0, whole, self.window):
            yield self._close([Piece(piece.doc_id, piece.start + at, piece.ids[at:at + self.window].copy(), piece.doc_tokens)])
        if whole:
            piece = piece.cut(whole)[1]
        while len(piece.ids) and self.n_open >= self.max_open:
            fill = int(np.flatnonzero(self.level)[-1])
            room = self.window - fill
            pieces = self._take(fill)
            if len(piece.ids) < room:
                self._put(fill + len(piece.ids), [*pieces, piece])
                return
            head, piece = piece.cut(room)
            yield self._close([*pieces, head])
        size = len(piece.ids)
        if not size:
            return
        fill = self.best_level(size)
        pieces = [*(self._take(fill) if fill else []), piece]
        if fill + size == self.window:
            yield self._close(pieces)
        else:
            self._put(fill + size, pieces)

    def finish(self) -> Iterator[tuple[int, list[Piece]]]:
        """Fill the fullest windows with pieces of the emptiest; cut the last at powers of two."""
        windows = [w for fill in np.flatnonzero(self.level)[::-1] for w in self.open[int(fill)]]
        spare: list[Piece] = []
        while windows:
            target = windows.pop(0)
            room = self.window - sum(len(p.ids) for p in target)
            while room and (spare or windows):
                if not spare:
                    spare = windows.pop()
                piece = spare.pop()
                if len(piece.ids) > room:
                    piece, rest = piece.cut(room)
                    spare.append(rest)
                target.append(piece)
                room -= len(piece.ids)
            if not windows and spare:
                windows, spare = [spare], []
            if not room:
                yield self._close(target)
                continue
            part, size = [], 1 << (self.window - room).bit_length() - 1
            left = self.window - room
            for piece in target:
                while len(piece.ids):
                    head, piece = piece.cut(min(len(piece.ids), size))
                    part.append(head)
                    size -= len(head.ids)
                    left -= len(head.ids)
                    if not size:
                        yield self._close(part)
                        part, size = [], 1 << left.bit_length() - 1 if left else 0


def pack(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
         paths: tuple[str, str] | None = None, end_id: int = END_ID, max_open: int = MAX_OPEN,
         with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and
    the ids themselves (``with_ids``).

    A null or empty text is a document of the end id alone. Null ids and repeated rows are packed
    like any other; an empty table gives no rows; a text of any length is encoded whole.
    """
    source = id_text(docs, id_col, text_col)
    paths = paths or default_paths()
    schema = T.StructType([T.StructField("doc_id", source.schema["doc_id"].dataType)] + [
        T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
        + ([T.StructField("ids", T.BinaryType())] if with_ids else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        encode, _ = encoder(*paths)
        base = TaskContext.get().partitionId() << 36
        arrow = to_arrow_schema(schema)
        packer = Packer(window, max_open)
        rows: list[list] = [[] for _ in schema]
        end = np.array([end_id], np.uint32)

        def out(closed) -> None:
            for number, pieces in closed:
                offset = 0
                for p in pieces:
                    raw = p.ids.astype("<u4", copy=False).tobytes()
                    got = [p.doc_id, p.start, len(p.ids), zlib.crc32(raw), p.doc_tokens, base + number, offset, raw]
                    for column, value in zip(rows, got, strict=False):
                        column.append(value)
                    offset += len(p.ids)

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, arrow, strict=True)], schema=arrow)
            for column in rows:
                column.clear()
            return batch

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.concatenate([encode(text), end])
                out(packer.add(Piece(doc_id, 0, ids, len(ids))))
                if len(rows[0]) >= _ROWS:
                    yield flush()
        out(packer.finish())
        yield flush()

    return source.mapInArrow(run, schema)
