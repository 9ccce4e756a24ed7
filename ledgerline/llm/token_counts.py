"""Token counts by section, attributed by the offsets of whole-document encodings.

A document is encoded once, as a whole. The byte length of each id gives the tokens' spans
(byte-level BPE covers the text without gaps); the spans are interval-joined, inside the task, to
the document's sections by binary search on their borders. Sections are the values of the given
fields in their order, and within each field its lines (a line owns its line break).

A token that crosses a border is allocated by an explicit rule:
``start``: to the section of its first byte; ``majority``: to the section with most of its
bytes, the earliest of equals; ``split``: to each section by its share of bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tokens import default_paths, encoder

RULES = ("start", "majority", "split")
_ROWS = 50_000


def section_ends(fields: list[bytes]) -> tuple[list[int], list[int]]:
    """(end offset, field number) of each non-empty section of the fields put together."""
    ends, owner, at = [], [], 0
    for number, value in enumerate(fields):
        for line in value.split(b"\n")[:-1]:
            at += len(line) + 1
            ends.append(at)
            owner.append(number)
        tail = len(value) - value.rfind(b"\n") - 1
        if tail:
            at += tail
            ends.append(at)
            owner.append(number)
    return ends, owner


def attribute(lengths: np.ndarray, ends: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(tokens by section, tokens that cross the section's end) for tokens of these byte lengths."""
    stop = np.cumsum(lengths)
    start = stop - lengths
    first = np.searchsorted(ends, start, side="right")
    last = np.searchsorted(ends, stop - 1, side="right")
    n = len(ends)
    crossing = np.flatnonzero(last > first)
    counts = np.bincount(first, minlength=n).astype(float)
    crossed = np.bincount(first[crossing], minlength=n)
    if rule != "start":
        for t in crossing:
            parts = np.arange(first[t], last[t] + 1)
            borders = np.concatenate([[start[t]], ends[parts[:-1]], [stop[t]]])
            share = np.diff(borders) / lengths[t]
            counts[first[t]] -= 1
            if rule == "split":
                counts[parts] += share
            else:
                counts[parts[int(np.argmax(share))]] += 1
    return counts, crossed


def token_counts(docs: DataFrame, fields: tuple[str, ...] = ("text",), id_col: str = "doc_id", rule: str = "start",
                 paths: tuple[str, str] | None = None) -> DataFrame:
    """One row per section: doc_id, field, section (from 0 in its document), n_bytes, n_tokens
    (double: ``split`` gives shares), n_crossing, doc_tokens.

    A null field is empty; a document without any text gives one row with section null and no
    tokens; null ids and repeated rows are counted like any other, each for itself.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    paths = paths or default_paths()
    names = list(fields)
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"),
                         *[F.coalesce(F.col(f"`{f}`").cast("string"), F.lit("")).alias(f"_f{i}") for i, f in enumerate(names)])
    schema = T.StructType([T.StructField("doc_id", source.schema["doc_id"].dataType), T.StructField("field", T.StringType()),
                           T.StructField("section", T.LongType()), T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.DoubleType()), T.StructField("n_crossing", T.LongType()),
                           T.StructField("doc_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        encode, byte_lengths = encoder(*paths)
        arrow = to_arrow_schema(schema)
        rows: list[list] = [[] for _ in arrow]

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, arrow, strict=True)], schema=arrow)
            for column in rows:
                column.clear()
            return batch

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for doc_id, *values in zip(*columns, strict=True):
                text = "".join(values)
                ids = encode(text)
                ends, owner = section_ends([v.encode() for v in values])
                if not ends:
                    got = [[doc_id], [None], [None], [0], [0.0], [0], [0]]
                else:
                    borders = np.asarray(ends, np.int64)
                    counts, crossed = attribute(byte_lengths[ids], borders, rule)
                    n = len(ends)
                    got = [[doc_id] * n, [names[o] for o in owner], list(range(n)),
                           np.diff(borders, prepend=0).tolist(), counts.tolist(), crossed.tolist(), [len(ids)] * n]
                for column, value in zip(rows, got, strict=True):
                    column.extend(value)
                if len(rows[0]) >= _ROWS:
                    yield flush()
        yield flush()

    return source.mapInArrow(run, schema)
