"""Exact dedup of an incoming batch against an immutable snapshot.

Two texts are equal when they are identical after lower-casing A-Z (null counts as empty).

* The snapshot's distinct SHA-256 digests are dealt into hash buckets of a bounded number of
  keys. Each bucket gets one static binary-fuse filter (three 8-bit cells a key, Graf and Lemire
  2022), built once and written beside the bucket's exact rows; the snapshot never changes, so the
  filter needs no updates.
* Duplicates inside the incoming batch are grouped on their own, by digest, before any lookup.
* The batch's distinct digests meet their bucket's filter in a cogroup. A digest that the filter
  refuses is certainly new and skips the lookup; the positives join the snapshot's exact rows,
  where the filter's false positives (about 0.4 %) fall out.
* Byte check: for every digest with two rows or more, the smallest and the largest text must be
  the same bytes. A digest that fails (a collision) is split by text.

A hot text (a third of all rows) is combined in each map task before any shuffle, buckets are
dealt by the hash of distinct digests, and the last join from rows to classes is an equi-join
that Spark splits when skewed. No group of rows is ever gathered in one task.

``exact_dedup`` answers for a snapshot and a batch at once. ``keep_snapshot`` writes a snapshot that lasts (exact texts in
one folder a bucket, filters beside them), and ``dedup_batch`` screens a batch against any number of kept snapshots.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_tables, stage_table
from .common import ascii_lower, id_text, numbered, without_rows

BUCKET_KEYS = 200_000          # distinct digests in one filter, on average
SALTS = 16
LISTED_BUCKETS = 1000          # buckets that a partition filter lists; with more positives all buckets are read
_FILTER = "bucket int, seed bigint, seg_len int, seg_count int, cells binary"


def sha256_key(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


# ------------------------------------------------------------------ binary-fuse filter (numpy)

def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    h = keys + np.uint64(seed)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(33))


def _cells_of(h: np.ndarray, seg_len: int, seg_count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The three cells of each key: one in each of three neighbouring segments."""
    start = ((h >> np.uint64(32)) * np.uint64(seg_len * seg_count)) >> np.uint64(32)
    mask = np.uint64(seg_len - 1)
    a = start.astype(np.int64)
    b = (start + np.uint64(seg_len)).astype(np.int64) ^ ((h >> np.uint64(18)) & mask).astype(np.int64)
    c = (start + np.uint64(2 * seg_len)).astype(np.int64) ^ (h & mask).astype(np.int64)
    return a, b, c


def _print_of(h: np.ndarray) -> np.ndarray:
    return (h ^ (h >> np.uint64(32))).astype(np.uint8)


def build_filter(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """(seed, segment length, segment count, cells) for 64-bit keys (repeats are ignored)."""
    keys = np.unique(keys.astype(np.uint64))
    n = max(len(keys), 2)
    seg_len = 1 << min(18, max(2, int(math.floor(math.log(n) / math.log(3.33) + 2.25))))
    factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(n))
    seg_count = max(1, math.ceil(n * factor / seg_len) - 2)
    size = (seg_count + 2) * seg_len
    for seed in range(1, 1000):
        h = _mix(keys, seed)
        cells = np.stack(_cells_of(h, seg_len, seg_count), axis=1)
        count = np.bincount(cells.ravel(), minlength=size)
        owner = np.zeros(size, np.int64)               # XOR of the keys still in a cell
        np.bitwise_xor.at(owner, cells.ravel(), np.repeat(np.arange(len(keys)), 3))
        rounds, left = [], len(keys)
        single = np.flatnonzero(count == 1)
        while len(single):
            who, first = np.unique(owner[single], return_index=True)
            rounds.append((who, single[first]))
            left -= len(who)
            touched = cells[who].ravel()
            np.subtract.at(count, touched, 1)
            np.bitwise_xor.at(owner, touched, np.repeat(who, 3))
            touched = np.unique(touched)
            single = touched[count[touched] == 1]
        if left:
            continue                                    # not peelable with this seed: next one
        table = np.zeros(size, np.uint8)
        prints = _print_of(h)
        for who, cell in reversed(rounds):
            c = cells[who]
            table[cell] = prints[who] ^ table[c[:, 0]] ^ table[c[:, 1]] ^ table[c[:, 2]]
        return seed, seg_len, seg_count, table.tobytes()
    raise RuntimeError("binary-fuse construction did not succeed")


def probe_filter(keys: np.ndarray, seed: int, seg_len: int, seg_count: int, cells: bytes) -> np.ndarray:
    """True for every key of the filter, and for about one in 256 others."""
    h = _mix(keys.astype(np.uint64), seed)
    table = np.frombuffer(cells, np.uint8)
    a, b, c = _cells_of(h, seg_len, seg_count)
    return (table[a] ^ table[b] ^ table[c]) == _print_of(h)


# ------------------------------------------------------------------ the operator

def _bucketed(classes: DataFrame, buckets: int) -> DataFrame:
    return classes.withColumn("bucket", F.pmod(F.hash("digest"), F.lit(buckets))) \
                  .withColumn("key", F.xxhash64("digest"))


def build_snapshot(classes: DataFrame, buckets: int) -> tuple[DataFrame, DataFrame]:
    """(exact rows by bucket, one filter row per bucket), both written once."""
    exact = stage_table(_bucketed(classes, buckets), "snapshot")

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        seed, seg_len, seg_count, cells = build_filter(pdf["key"].to_numpy(np.int64).view(np.uint64))
        return pd.DataFrame({"bucket": [pdf["bucket"].iloc[0]], "seed": [seed], "seg_len": [seg_len],
                             "seg_count": [seg_count], "cells": [cells]})

    filters = stage_table(exact.select("bucket", "key").groupBy("bucket").applyInPandas(build, _FILTER), "filters")
    return exact, filters


def screen(incoming: DataFrame, filters: DataFrame) -> DataFrame:
    """The rows (bucket, digest, key) of ``incoming`` that their bucket's filter lets through."""

    def probe(rows: pd.DataFrame, filt: pd.DataFrame) -> pd.DataFrame:
        if not len(filt) or not len(rows):
            return rows.iloc[:0][["digest"]]
        f = filt.iloc[0]
        hit = probe_filter(rows["key"].to_numpy(np.int64).view(np.uint64), int(f.seed), int(f.seg_len),
                           int(f.seg_count), f.cells)
        return rows.loc[hit, ["digest"]]

    return (incoming.select("bucket", "digest", "key").groupBy("bucket")
            .cogroup(filters.groupBy("bucket")).applyInPandas(probe, "digest string"))


def _classes(keyed: DataFrame) -> DataFrame:
    return keyed.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))


def exact_dedup(snapshot: DataFrame, incoming: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                digest=sha256_key, bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """One row per row of both inputs: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the largest id stays. Defined cases: a null text equals the empty text; a null
    id ranks below every other id, and in a group of null ids only all rows are ``kept`` (nothing
    tells them apart); rows that repeat an id and a text count as rows and share ``kept``; an empty
    input gives no rows; other columns are ignored. ``digest`` may be any column function: a
    weak one only makes the byte check split more classes.
    """
    texts = id_text(snapshot, id_col, text_col).withColumn("batch", F.lit(0)).unionByName(
        id_text(incoming, id_col, text_col).withColumn("batch", F.lit(1)))
    normal = texts.select("doc_id", "batch", ascii_lower(F.col("text")).alias("normal"))
    keyed = stage_table(normal.select("doc_id", "batch", digest(F.col("normal")).alias("digest"),
                                      sha256_key(F.col("normal")).alias("text_sha256")), "digests")

    old = _classes(keyed.where("batch = 0"))
    new = stage_table(_classes(keyed.where("batch = 1")), "incoming-classes")
    keys = max(old.count(), new.count())
    buckets = max(int(snapshot.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(keys / bucket_keys))
    exact, filters = build_snapshot(old, buckets)

    positives = stage_table(screen(_bucketed(new, buckets), filters), "positives")
    old_rows = exact.select("digest", F.col("keep_id").alias("_k"), F.col("group_size").alias("_n"))
    merged = (new.join(old_rows.join(positives, "digest"), "digest", "left")   # the filter's false positives end here
              .select("digest", F.greatest("keep_id", "_k").alias("keep_id"),
                      (F.col("group_size") + F.coalesce("_n", F.lit(0))).alias("group_size")))
    classes = stage_table(merged.unionByName(exact.join(positives, "digest", "left_anti")
                                             .select("digest", "keep_id", "group_size")), "classes")

    # byte check over every class of two rows or more
    repeated = classes.where("group_size > 1").select("digest")
    # salted, so that a hot text's rows meet in many tasks and only their extremes in one
    salted = repeated.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    texts_of = normal.select(digest(F.col("normal")).alias("digest"), "doc_id", "normal",
                             F.pmod(F.hash("doc_id", "batch"), F.lit(SALTS)).alias("salt")).join(salted, ["digest", "salt"], "left_semi")
    collided = stage_table(texts_of.groupBy("digest").agg(F.min("normal").alias("a"), F.max("normal").alias("b"))
                           .where("a != b").select("digest"), "collided")
    rows = keyed.select("doc_id", "digest", "text_sha256")
    if not collided.isEmpty():
        # such digests are told apart by the text itself; all others keep their class
        split = texts_of.join(collided, "digest", "left_semi").select(
            "doc_id", F.concat_ws(":", "digest", "normal").alias("digest"), sha256_key(F.col("normal")).alias("text_sha256"))
        rows = rows.join(collided, "digest", "left_anti").unionByName(split)
        classes = classes.join(collided, "digest", "left_anti").unionByName(_classes(split))
    classes = classes.withColumnRenamed("digest", "_digest")
    return (rows.join(classes, rows["digest"] == classes["_digest"])
            .select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                    "text_sha256"))


# ------------------------------------------------------------------ kept snapshots

def _texts(docs: DataFrame, id_col: str, text_col: str, digest) -> DataFrame:
    normal = id_text(docs, id_col, text_col).select("doc_id", ascii_lower(F.col("text")).alias("normal"))
    return normal.withColumn("digest", digest(F.col("normal")))


def _distinct_texts(texts: DataFrame) -> DataFrame:
    return texts.groupBy("digest", "normal").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))


def keep_snapshot(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", digest=sha256_key,
                  bucket_keys: int = BUCKET_KEYS) -> None:
    """Write the snapshot of ``docs`` to ``path``, a new folder in shared storage; it is never changed afterwards.

    ``exact/bucket=<n>`` has one row per distinct text: digest, normal, keep_id (the largest id), group_size.
    ``filters`` has one binary-fuse filter per bucket, and the number of buckets. Null and empty texts are
    one text; an empty table gives a snapshot that finds nothing; an existing folder is an error.
    """
    with scratch_tables(docs.sparkSession) as stage:
        classes = stage(_distinct_texts(_texts(docs, id_col, text_col, digest)), "snapshot-texts")
        buckets = max(1, math.ceil(classes.count() / bucket_keys))
        (_bucketed(classes, buckets).drop("key").hint("rebalance", F.col("bucket"))
         .write.partitionBy("bucket").parquet(f"{path}/exact"))
        _, filters = build_snapshot(classes.select("digest"), buckets)
        filters.withColumn("buckets", F.lit(buckets)).write.parquet(f"{path}/filters")


def _in_snapshot(classes: DataFrame, count: int, path: str, bucket_keys: int) -> DataFrame:
    """(class_id, snapshot_id) of the texts in ``classes`` that the snapshot at ``path`` has, byte for byte."""
    spark = classes.sparkSession
    filters = spark.read.parquet(f"{path}/filters")
    buckets = filters.agg(F.max("buckets")).first()[0]
    if buckets is None:                                          # an empty snapshot
        return classes.select("class_id", F.lit(None).cast(classes.schema["keep_id"].dataType).alias("snapshot_id")).where("false")
    # a batch far larger than the snapshot is dealt over several copies of each filter
    parts = max(1, math.ceil(count / (buckets * bucket_keys)))
    keyed = _bucketed(classes, buckets)
    dealt = keyed.select((F.col("bucket") * parts + F.pmod(F.hash("key"), F.lit(parts))).alias("bucket"), "digest", "key")
    copies = filters.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).select(
        (F.col("bucket") * parts + F.col("part")).cast("int").alias("bucket"), "seed", "seg_len", "seg_count", "cells")
    positives = stage_table(keyed.join(screen(dealt, copies).distinct(), "digest", "left_semi"), "batch-positives")
    touched = [r[0] for r in positives.select("bucket").distinct().limit(LISTED_BUCKETS + 1).collect()]
    exact = spark.read.schema(f"digest string, normal string, keep_id {classes.schema['keep_id'].dataType.simpleString()}, group_size bigint, bucket int") \
        .parquet(f"{path}/exact")
    if len(touched) <= LISTED_BUCKETS:
        exact = exact.where(F.col("bucket").isin(touched))
    old = exact.select(F.col("bucket").alias("_b"), F.col("digest").alias("_d"), F.col("normal").alias("_t"), F.col("keep_id").alias("snapshot_id"))
    same = (positives["bucket"] == old["_b"]) & (positives["digest"] == old["_d"]) & (positives["normal"] == old["_t"])
    return positives.join(old, same).select("class_id", "snapshot_id")


def dedup_batch(snapshots: list[str], docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=sha256_key,
                bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """One row per row of the batch ``docs``: doc_id, in_snapshot, snapshot_id, keep_id, group_size, kept, text_sha256.

    ``in_snapshot``: a kept snapshot has the same text, and ``snapshot_id`` is the largest id there; such rows go,
    whatever their ids. Of the other equal texts of the batch the largest id stays; ``keep_id`` and
    ``group_size`` are the batch's own. ``digest`` must be the one the snapshots were built with. Nulls, repeated rows
    and other columns count as in ``exact_dedup``; without snapshots the batch is deduplicated by itself.
    """
    texts = _texts(docs, id_col, text_col, digest)
    rows = stage_table(texts.select("doc_id", "digest", sha256_key(F.col("normal")).alias("text_sha256")), "batch-digests")
    classes = stage_table(_distinct_texts(texts).withColumn("class_id", F.monotonically_increasing_id()), "batch-texts")
    count = classes.count()
    found = classes.select("class_id", F.col("keep_id").alias("snapshot_id")).where("false")
    for path in snapshots:
        found = found.unionByName(_in_snapshot(classes, count, path, bucket_keys))
    found = found.groupBy("class_id").agg(F.max("snapshot_id").alias("snapshot_id"), F.lit(True).alias("hit"))
    judged = classes.select("class_id", F.col("digest").alias("_d"), "normal", "keep_id", "group_size").join(found, "class_id", "left")

    # a digest of two texts (a collision) leads from rows to classes by the text itself
    collided = stage_table(classes.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest"), "batch-collided")
    one = rows.join(collided, "digest", "left_anti").join(judged.drop("normal"), F.col("digest") == F.col("_d"))
    several = (texts.withColumnRenamed("normal", "_t").withColumn("text_sha256", sha256_key(F.col("_t"))).join(collided, "digest", "left_semi")
               .join(judged, (F.col("digest") == F.col("_d")) & (F.col("_t") == F.col("normal"))))
    out = ["doc_id", F.coalesce("hit", F.lit(False)).alias("in_snapshot"), "snapshot_id", "keep_id", "group_size",
           (F.col("hit").isNull() & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"), "text_sha256"]
    return one.select(*out).unionByName(several.select(*out))


def two_batches(docs: DataFrame, id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """A table without a batch column, as a snapshot and an incoming batch of about equal size."""
    late = F.pmod(F.xxhash64(F.col(id_col)), F.lit(2)) == 1
    return docs.where(~late), docs.where(late)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with all its columns, one row of each group of equal texts: the one with the largest id.

    Decided row by row: of rows that repeat the largest id the last in the table's order stays, a null id ranks below
    every other, and among null ids only the last row stays. A row with a text of its own always stays.
    """
    rows, key = numbered(docs, "exact")
    who = "_who" if "_who" != text_col else "_who_"
    named = rows.select(F.struct(F.col(f"`{id_col}`").alias("id"), F.col(key).alias("row")).alias(who), F.col(f"`{text_col}`").alias(text_col))
    decided = exact_dedup(*two_batches(named, who), id_col=who, text_col=text_col)
    return without_rows(rows, key, decided.where("not kept").select("doc_id.row"))
