"""Alignment of two tokenizers' ids over a corpus, by external spill counting.

Each text is encoded by a byte-level BPE (side A) and a piece BPE (side B). Byte offsets where tokens of
both sides end cut the text into groups, and the two tokens that end at such an offset are a link.

* **Radix-partitioned zstd runs.** A task gathers the pair-document records of a block of documents (at most
  ``block_links`` links), sorts them by (radix, B id, A id, document), where the radix is the B id modulo ``RADIXES``,
  and writes one zstd run a radix: a directory of pairs with their counts, and the postings (document, occurrences) behind them. The
  runs are a written table in the shared folder, so a task's memory holds one block, whatever the corpus.
* **K-way heap merge.** The directories of a radix are merged, ``FAN`` runs at a time, in as many levels as the number of
  blocks needs: a heap names the run whose chunk ends first, all runs give up their entries to that bound, and
  equal pairs are added. A pair occurs once in a block's directory however many documents hold it, so the most
  frequent pair costs no more than any other.
* **Side-major order.** All pairs of a B id follow one another in the last merge, which yields the id's highest count
  beside the counts.
* **Streaming back.** Runs meet their radix's counts in slices of blocks (so that no radix is gathered whole), add
  count and best links to their documents' sums, and the sums of a block's runs are added up.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage_table
from .common import id_text

RADIXES = 32
FAN = 32                    # runs in one merge, and blocks in one slice of the way back
BLOCK_LINKS = 1 << 20
BLOCK_DOCS = 4096
_CHUNK = 1 << 16            # entries of a run that the merge takes at a time
_B_SHIFT = 32               # a pair's code: B id above, A id below


# ------------------------------------------------------------------ one text

class Side:
    """Ids and bytes of one tokenizer: ``encode(text) -> ids`` and the bytes and decimal text of each id."""

    def __init__(self, encode, token_bytes: list[bytes], between: bytes, after: bytes):
        self.encode, self.token_bytes = encode, token_bytes
        self.lengths = np.array([len(t) for t in token_bytes], np.int64)
        # 2 * id, and 2 * id + 1 for the last token of a group
        self.texts = np.array([b"%d%s" % (i, sep) for i in range(len(token_bytes)) for sep in (between, after)], object)


@functools.lru_cache(maxsize=2)
def sides(ranks_path: str, piece_path: str) -> tuple[Side, Side]:
    """Both tokenizers, loaded once per Python worker."""
    import base64

    import public_tokenizers
    import sentencepiece
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    a_bytes = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        a_bytes[rank] = token
    bpe = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    pieces = sentencepiece.SentencePieceProcessor(model_file=piece_path)
    b_bytes = [bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode()
               for i, p in enumerate(pieces.id_to_piece(list(range(pieces.get_piece_size()))))]
    # the space in front of A's text is the one that B puts there itself
    return (Side(lambda text: bpe.encode_to_numpy(" " + text).astype(np.int64), a_bytes, b",", b"|"),
            Side(lambda text: np.array(pieces.encode(text, num_threads=1), np.int64), b_bytes, b",", b";"))


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model")


NO_TOKENS = (0, 0, 0, "", np.empty(0, np.int64))


def align_text(text: str, a: Side, b: Side) -> tuple[int, int, int, str, np.ndarray]:
    """(tokens of A, tokens of B, groups, digest of the groups, codes of the linked pairs in order)."""
    if not text:
        return NO_TOKENS
    raw = (" " + text).encode()
    ids = []
    for side in (a, b):
        got = side.encode(text)
        table = side.token_bytes
        if b"".join([table[i] for i in got.tolist()]) != raw:
            return NO_TOKENS
        ids.append(got)
    ends = [np.cumsum(side.lengths[got]) for side, got in zip((a, b), ids, strict=True)]
    _, last_a, last_b = np.intersect1d(*ends, assume_unique=True, return_indices=True)
    groups = len(last_a)
    out = np.empty(len(ids[0]) + len(ids[1]), object)
    for side, got, last, other, before in ((a, ids[0], last_a, last_b, 1), (b, ids[1], last_b, last_a, 0)):
        is_last = np.zeros(len(got), np.int64)
        is_last[last] = 1
        group = np.cumsum(is_last) - is_last                    # number of groups that end before the token
        ended = np.concatenate([[0], other + 1])                # tokens of the other side in the first k groups
        out[np.arange(len(got)) + ended[group + (0 if before else 1)]] = side.texts[2 * got + is_last]
    digest = hashlib.sha256(b"".join(out.tolist())[:-1]).hexdigest()
    return len(ids[0]), len(ids[1]), groups, digest, (ids[1][last_b] << _B_SHIFT) | ids[0][last_a]


# ------------------------------------------------------------------ zstd runs

def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of integers as one zstd frame: dtype character and length of each, then their bytes."""
    import zstandard

    head = "".join(f"{x.dtype.str}:{len(x)};" for x in arrays).encode()
    return zstandard.ZstdCompressor(level=1).compress(len(head).to_bytes(4, "little") + head + b"".join(x.tobytes() for x in arrays))


def unpack(frame: bytes) -> list[np.ndarray]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(frame)
    at = 4 + int.from_bytes(raw[:4], "little")
    out = []
    for part in raw[4:at].decode().split(";")[:-1]:
        dtype, length = part.split(":")
        out.append(np.frombuffer(raw, dtype, int(length), at))
        at += out[-1].nbytes
    return out


def _narrow(x: np.ndarray) -> np.ndarray:
    return x.astype(np.min_scalar_type(int(x.max()))) if len(x) else x.astype(np.uint8)


def pack_directory(codes: np.ndarray, counts: np.ndarray) -> bytes:
    return pack(_narrow(np.diff(codes, prepend=0)), _narrow(counts))


def unpack_directory(frame: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps, counts = unpack(frame)
    return np.cumsum(steps, dtype=np.int64), counts.astype(np.int64)


def _starts(sorted_values: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]])) if len(sorted_values) else np.empty(0, np.int64)


def build_runs(codes: np.ndarray, docs: np.ndarray, radixes: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(radix, directory, postings) of a block's links, in which ``docs`` ascends."""
    radix = (codes >> _B_SHIFT) % radixes
    order = np.lexsort((codes, radix))                          # stable, so documents ascend within a pair
    codes, docs, radix = codes[order], docs[order], radix[order]
    edges = np.searchsorted(radix, np.arange(radixes + 1))
    for r in range(radixes):
        c, d = codes[edges[r]:edges[r + 1]], docs[edges[r]:edges[r + 1]]
        if not len(c):
            continue
        pair = _starts(c)
        record = np.flatnonzero(np.concatenate([[True], (c[1:] != c[:-1]) | (d[1:] != d[:-1])]))
        occurrences = np.diff(record, append=len(c))
        documents = np.diff(np.searchsorted(record, pair), append=len(record))
        yield r, pack_directory(c[pair], np.diff(pair, append=len(c))), pack(*map(_narrow, (documents, d[record], occurrences)))


def merge_directories(frames: list[bytes], chunk: int = _CHUNK) -> tuple[np.ndarray, np.ndarray]:
    """The sum of several directories, by a k-way merge: the heap names the run whose current chunk ends first, and all
    entries up to that end leave their runs together."""
    runs = [unpack_directory(f) for f in frames]
    at = [0] * len(runs)
    heap = [(int(codes[min(chunk, len(codes)) - 1]), i) for i, (codes, _) in enumerate(runs) if len(codes)]
    heapq.heapify(heap)
    out_codes, out_counts = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    while heap:
        bound, i = heapq.heappop(heap)
        taken_codes, taken_counts = [], []
        for k, (codes, counts) in enumerate(runs):
            if at[k] < len(codes) and codes[at[k]] <= bound:
                stop = at[k] + int(np.searchsorted(codes[at[k]:], bound, side="right"))
                taken_codes.append(codes[at[k]:stop])
                taken_counts.append(counts[at[k]:stop])
                at[k] = stop
        if taken_codes:
            codes, counts = np.concatenate(taken_codes), np.concatenate(taken_counts)
            order = np.argsort(codes, kind="stable")
            codes, counts = codes[order], counts[order]
            first = _starts(codes)
            out_codes.append(codes[first])
            out_counts.append(np.add.reduceat(counts, first))
        codes = runs[i][0]
        if at[i] < len(codes):
            heapq.heappush(heap, (int(codes[min(at[i] + chunk, len(codes)) - 1]), i))
    return np.concatenate(out_codes), np.concatenate(out_counts)


def best_of_side(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """1 where a pair's count is the highest of its B id; a B id's pairs are neighbours."""
    first = _starts(codes >> _B_SHIFT)
    highest = np.maximum.reduceat(counts, first) if len(first) else counts
    return (counts == np.repeat(highest, np.diff(first, append=len(codes)))).astype(np.int64)


# ------------------------------------------------------------------ on Spark

def write_blocks(docs: DataFrame, paths: tuple[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text",
                 radixes: int = RADIXES, block_links: int = BLOCK_LINKS, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """The written table of blocks: one row a run (block, radix, directory, postings), and one row a block with
    radix -1 and its documents in order."""
    source = id_text(docs, id_col, text_col)
    paths = paths or default_paths()
    doc = T.StructType([T.StructField("doc_id", source.schema["doc_id"].dataType), *[
        T.StructField(n, T.LongType()) for n in ("n_a", "n_b", "n_groups", "n_links")], T.StructField("groups_sha256", T.StringType())])
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("radix", T.IntegerType()),
                           T.StructField("directory", T.BinaryType()), T.StructField("postings", T.BinaryType()),
                           T.StructField("docs", T.ArrayType(doc))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        a, b = sides(*paths)
        arrow = to_arrow_schema(schema)
        block = TaskContext.get().partitionId() << 32
        held: list[dict] = []
        codes: list[np.ndarray] = []
        links = 0

        def flush() -> pa.RecordBatch:
            runs = list(build_runs(np.concatenate(codes), np.repeat(np.arange(len(codes)), [len(c) for c in codes]), radixes))
            rows = [[block] * (len(runs) + 1), [*[r for r, _, _ in runs], -1], [*[d for _, d, _ in runs], None],
                    [*[p for _, _, p in runs], None], [*[None] * len(runs), held]]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, arrow, strict=True)], schema=arrow)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                n_a, n_b, groups, digest, pairs = align_text(text.as_py(), a, b)
                held.append({"doc_id": doc_id, "n_a": n_a, "n_b": n_b, "n_groups": groups, "n_links": len(pairs), "groups_sha256": digest})
                codes.append(pairs)
                links += len(pairs)
                if links >= block_links or len(held) >= block_docs:
                    yield flush()
                    block, held, codes, links = block + 1, [], [], 0
        if held:
            yield flush()

    return stage_table(source.mapInArrow(run, schema), "alignment-blocks")


def count_pairs(blocks: DataFrame, n_blocks: int, fan: int = FAN) -> DataFrame:
    """One row a radix: all its pairs (``codes``), their counts and best marks, each a zstd frame; written."""

    def merged(last: bool):
        def merge(pdf: pd.DataFrame) -> pd.DataFrame:
            codes, counts = merge_directories(pdf["directory"].tolist())
            best = [pack(best_of_side(codes, counts).astype(np.uint8))] if last else [None]
            return pd.DataFrame({"radix": pdf["radix"].iloc[:1], "part": pdf["part"].iloc[:1], "directory": [pack_directory(codes, counts)], "best": best})
        return merge

    level = blocks.where("radix >= 0").select("radix", F.xxhash64("block").alias("part"), "directory")
    parts = max(n_blocks, 1)
    while True:
        parts = math.ceil(parts / fan)
        level = (level.select("radix", F.pmod("part", F.lit(parts)).alias("part"), "directory").groupBy("radix", "part")
                 .applyInPandas(merged(parts == 1), "radix int, part bigint, directory binary, best binary"))
        if parts == 1:
            return stage_table(level.select("radix", "directory", "best"), "alignment-counts")


def stream_back(blocks: DataFrame, counts: DataFrame, n_blocks: int, fan: int = FAN) -> DataFrame:
    """block, and for its documents in order ``count_sum`` and ``n_best`` (arrays)."""
    slices = math.ceil(max(n_blocks, 1) / fan)
    runs = blocks.where("radix >= 0").select("block", "radix", "directory", "postings",
                                             F.pmod(F.xxhash64("block"), F.lit(slices)).alias("slice"))
    known = counts.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))))

    def contribute(pdf: pd.DataFrame, top: pd.DataFrame) -> pd.DataFrame:
        codes, totals = unpack_directory(top["directory"].iloc[0])
        best = unpack(top["best"].iloc[0])[0].astype(np.int64)
        out = []
        for directory, postings in zip(pdf["directory"], pdf["postings"], strict=True):
            at = np.searchsorted(codes, unpack_directory(directory)[0])
            documents, doc, occurrences = unpack(postings)
            at, doc, n = np.repeat(at, documents), doc.astype(np.int64), occurrences.astype(np.int64)
            sums = np.zeros((2, int(doc.max()) + 1), np.int64)
            np.add.at(sums[0], doc, totals[at] * n)
            np.add.at(sums[1], doc, best[at] * n)
            out.append(pack(*sums))
        return pd.DataFrame({"block": pdf["block"], "sums": out})

    def add_up(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [unpack(f) for f in pdf["sums"]]
        total = np.zeros((2, max(len(p[0]) for p in parts)), np.int64)
        for part in parts:
            for k in range(2):
                total[k, :len(part[k])] += part[k]
        return pd.DataFrame({"block": pdf["block"].iloc[:1], "count_sum": [total[0]], "n_best": [total[1]]})

    return (runs.groupBy("radix", "slice").cogroup(known.groupBy("radix", "slice")).applyInPandas(contribute, "block bigint, sums binary")
            .groupBy("block").applyInPandas(add_up, "block bigint, count_sum array<bigint>, n_best array<bigint>"))


def align(docs: DataFrame, paths: tuple[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text",
          radixes: int = RADIXES, fan: int = FAN, block_links: int = BLOCK_LINKS, block_docs: int = BLOCK_DOCS) -> tuple[DataFrame, DataFrame]:
    """(one row per row of ``docs``, one row per linked id pair).

    Documents: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256. Pairs: b_id, a_id, links, best.
    Defined cases: a text that is null or empty, or that either tokenizer doesn't give back byte for byte (B folds some
    white space and characters), has no tokens: zeros and an empty digest. Rows that repeat an id or a text
    count each; null ids stay; texts of any length are encoded whole; an empty table gives no rows;
    other columns are ignored. Counts equal in number are all best.
    """
    blocks = write_blocks(docs, paths, id_col, text_col, radixes, block_links, block_docs)
    heads = blocks.where("radix = -1")
    n_blocks = heads.count()
    counts = count_pairs(blocks, n_blocks, fan)
    back = stream_back(blocks, counts, n_blocks, fan)
    # the two arrays end at the last document with a link, and a block without links has none
    numbers = [F.coalesce(n, F.array().cast("array<bigint>")).alias(n) for n in ("count_sum", "n_best")]
    rows = heads.select("block", "docs").join(back, "block", "left").select("docs", *numbers) \
                .select(F.explode(F.arrays_zip("docs", "count_sum", "n_best")).alias("z"))
    zero = F.lit(0).cast("long")
    per_doc = rows.select("z.docs.doc_id", "z.docs.n_a", "z.docs.n_b", "z.docs.n_groups", "z.docs.n_links", F.coalesce("z.n_best", zero).alias("n_best"),
                          F.coalesce("z.count_sum", zero).alias("count_sum"), "z.docs.groups_sha256")
    return per_doc, pair_table(counts)


def pair_table(counts: DataFrame) -> DataFrame:
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("b_id", "a_id", "links")] + [T.StructField("best", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for directory, best in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                codes, links = unpack_directory(directory)
                yield pa.RecordBatch.from_arrays([pa.array(codes >> _B_SHIFT), pa.array(codes & ((1 << _B_SHIFT) - 1)), pa.array(links),
                                                  pa.array(unpack(best)[0].astype(bool))], names=schema.names)

    return counts.select("directory", "best").mapInArrow(run, schema)
