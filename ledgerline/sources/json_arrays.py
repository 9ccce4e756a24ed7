"""JSON array documents read by many tasks.

Spark's ``multiLine`` reader parses a file in one task. Here the file is read as text cut at every comma, which Spark
splits by byte ranges like any line format; a comma is one byte in UTF-8, so no character is torn. Two passes follow:

1. each split reports, for the case that it starts outside a string and the case that it starts inside one, how its brackets
   change the depth, and whether it holds an odd number of quotes. A running sum over the splits of a file (one row a split)
   gives every split its true start;
2. with its start known, each split cuts its text at the commas and brackets of the array's own level. Elements that
   lie inside a split leave it at once; the two pieces at its ends are joined with those of its neighbours.

Only the splits' starts reach the driver and the tasks: some 100 bytes a split, a millionth of the text, as the
list of splits does that Spark's own scheduler holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
_QUOTE, _ESCAPE, _COMMA = 34, 92, 44
_BLANK = b" \t\n\x0b\x0c\r,"


def comma_text(spark: SparkSession, path: str) -> DataFrame:
    """The files at ``path`` as text between commas, with the split that each piece starts in."""
    return spark.read.option("lineSep", ",").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bytes]]:
    """(file, block, text) for runs of pieces of one split, in order. The comma behind each piece is put back, also behind
    a file's last piece, which had none; there it stands outside the array."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        value, file, block = batch.columns
        other = pc.or_(pc.not_equal(file.slice(1), file.slice(0, n - 1)), pc.not_equal(block.slice(1), block.slice(0, n - 1)))
        borders = [0, *(np.flatnonzero(other.to_numpy(zero_copy_only=False)) + 1).tolist(), n]
        runs = pa.ListArray.from_arrays(pa.array(borders, pa.int32()), value)
        for at, text in zip(borders, pc.binary_join(runs, pa.scalar(",", value.type)), strict=False):
            yield file[at].as_py(), block[at].as_py(), text.as_buffer().to_pybytes() + b","


def _quoted(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which bytes are quotes that open or close a string, which lie inside one), for a start outside strings; for a start
    inside one the second is the opposite. A quote after an odd run of backslashes doesn't end a string."""
    quote = raw == _QUOTE
    escape = raw == _ESCAPE
    if escape.any():
        at = np.arange(len(raw))
        other = np.maximum.accumulate(np.where(~escape, at, -1))    # the last byte that is no backslash
        run = np.concatenate([[0], (at - other)[:-1]])              # backslashes right before each byte
        quote &= run % 2 == 0
    return quote, np.logical_xor.accumulate(quote)


def _outside(raw: np.ndarray, inside: bool) -> tuple[np.ndarray, bool]:
    """(which bytes lie outside strings, whether the text ends inside one), for a start inside one or not."""
    quote, within = _quoted(raw)
    within ^= inside
    return ~within & ~quote, bool(within[-1]) if len(raw) else inside


_STEP = np.zeros(256, np.int8)
_STEP[[ord("["), ord("{")]], _STEP[[ord("]"), ord("}")]] = 1, -1
_MARK = _STEP != 0
_MARK[_COMMA] = True


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First pass: one row a split and Arrow batch, with ``part`` their order."""
    part = 0
    for file, block, text in _chunks(batches):
        raw = np.frombuffer(text, np.uint8)
        within = _quoted(raw)[1]
        marks = np.flatnonzero(_STEP[raw])
        step, quoted = _STEP[raw[marks]], within[marks]
        start = text.lstrip()[:1]
        yield pa.RecordBatch.from_pydict({
            "file": [file], "block": [block], "part": [part], "odd": [bool(within[-1])], "from_out": [int(step[~quoted].sum())],
            "from_in": [int(step[quoted].sum())], "first": [start.decode("latin-1")]})
        part += 1


_SURVEY = "file string, block long, part long, odd boolean, from_out long, from_in long, first string"


def split_starts(tokens: DataFrame) -> dict[tuple[str, int], tuple[bool, int, int]]:
    """(file, block) -> (starts inside a string, depth, level of the elements), from one row a split."""
    parts = tokens.mapInArrow(_survey, _SURVEY)
    before = Window.partitionBy("file").orderBy("block", "part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file").orderBy("block", "part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    inside = F.coalesce(F.sum(F.col("odd").cast("int")).over(before), F.lit(0)) % 2 == 1
    known = parts.withColumn("inside", inside).withColumn("step", F.when(F.col("inside"), F.col("from_in")).otherwise(F.col("from_out")))
    known = known.withColumns({"depth": F.coalesce(F.sum("step").over(before), F.lit(0)),
                               "kind": F.first(F.when(F.col("first") != "", F.col("first")), ignorenulls=True).over(whole)})
    firsts = known.groupBy("file", "block").agg(F.min_by(F.struct("inside", "depth", "kind"), "part").alias("s")).select("file", "block", "s.*")
    # an array's elements lie one level down; a document of one object is an element itself
    return {(r.file, r.block): (r.inside, r.depth, int(r.kind == "[")) for r in firsts.collect()}


def elements(tokens: DataFrame) -> DataFrame:
    """The elements of the arrays (or the one value of a file that holds no array), each as JSON text in ``value``."""
    starts = tokens.sparkSession.sparkContext.broadcast(split_starts(tokens))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], int, bytes, list[bytes]]]:
        """For runs of a split ``key``, in order: (key, place, piece, elements): the elements that end in the run, and where it
        is known the piece at the split's start (place 0) or end (1); else place -1."""
        key, inside, depth, level, held, closed = None, False, 0, 1, [], False
        for file, block, text in _chunks(batches):
            if key != (file, block):
                if key is not None:
                    yield key, int(closed), b"".join(held), []
                key, held, closed = (file, block), [], False
                inside, depth, level = starts.value[key]
            raw = np.frombuffer(text, np.uint8)
            outside, inside = _outside(raw, inside)
            marks = np.flatnonzero(_MARK[raw] & outside)
            mark = raw[marks]
            step = _STEP[mark]
            after = depth + np.cumsum(step, dtype=np.int64)
            # what parts elements: commas of their level, and the array's own brackets
            parts = ((mark == _COMMA) & (after == level)) | ((step > 0) & (after == level) & (level == 1)) | ((step < 0) & (after == level - 1))
            at, found, head = 0, [], None
            for border in marks[parts].tolist():
                piece = text[at:border]
                if held:
                    piece, held = b"".join([*held, piece]), []
                if closed:
                    found.append(piece)
                else:                                   # the first piece may belong to an element that began before the split
                    head, closed = piece, True
                at = border + 1
            held.append(text[at:])
            depth = int(after[-1]) if len(after) else depth
            yield key, -1 if head is None else 0, head or b"", found
        if key is not None:
            yield key, int(closed), b"".join(held), []

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, _, found in cut(batches):
            texts = [t for t in (piece.strip(_BLANK) for piece in found) if t]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()).cast(pa.string())], names=["value"])

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (file, block), place, piece, _ in cut(batches):
            if place >= 0:
                yield pa.RecordBatch.from_pydict({"file": [file], "block": [block], "place": pa.array([place], pa.int32()), "value": [piece.decode()]})

    # a split has at most one piece at its start (0) and one at its end (1); an end opens an element, and what follows up to
    # the next end belongs to it
    order = Window.partitionBy("file").orderBy("block", "place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pieces = tokens.mapInArrow(ends, "file string, block long, place int, value string")
    torn = pieces.withColumn("element", F.sum("place").over(order))
    joined = (torn.groupBy("file", "element").agg(F.sort_array(F.collect_list(F.struct("block", "place", "value"))).alias("p"))
              .select(F.concat_ws("", F.transform("p", lambda p: p["value"])).alias("value")))
    # the comma that was put back behind a file's last piece, and the blanks around an array, are no elements
    text = F.regexp_replace("value", r"^[\s,]+|[\s,]+$", "")
    return tokens.mapInArrow(whole, "value string").unionByName(joined.select(text.alias("value")).where("value != ''"))


def parse(texts: DataFrame, schema: T.StructType, corrupt: str = CORRUPT) -> DataFrame:
    """``texts`` (value) -> the columns of ``schema`` and ``corrupt``, the text of what is no such object (else NULL)."""
    full = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    parsed = texts.select("value", F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}).alias("r"))
    is_object = F.col("value").startswith("{")
    bad = F.when(~is_object | F.col("r").isNull(), F.col("value")).otherwise(F.col(f"r.{corrupt}")).alias(corrupt)
    return parsed.select(*[F.when(is_object, F.col(f"r.`{f.name}`")).alias(f.name) for f in schema.fields], bad)


def read_json_arrays(spark: SparkSession, path: str, schema: T.StructType, corrupt: str = CORRUPT) -> DataFrame:
    """The elements of the JSON array files at ``path`` by many tasks a file, with the columns of ``schema``.

    Files may be indented or not, and may hold one object in place of an array. What is no object of the schema, such as a
    number in the array or a field of the wrong type, has its text in ``corrupt``.
    """
    return parse(elements(comma_text(spark, path)), schema, corrupt)
