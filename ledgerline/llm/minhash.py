"""Near-duplicate documents by min-max hashing.

Every text becomes its set of distinct word shingles (64-bit hashes). Under each of 40 random
permutations both the minimum and the maximum of the set are kept (Ji et al. 2013): 80 values from
40 hash evaluations, each equal between two sets with probability J, and with a lower variance
than 80 minima. Bands of four values put sets into buckets: at J = 0.8 a pair shares none of the
20 bands with probability (1 - 0.8^4)^20 = 0.000026.

Within a bucket no list of all pairs is made. First every member is compared with the bucket's most
central one (the member whose buckets hold the most sets), so a group of n near copies costs about n
comparisons. What is left are buckets whose members lie in different components. In those of at most
``SMALL`` members, members of different components are compared directly. The members of larger ones
are joined exactly by prefix filtering: a pair similar enough shares one of the rarest fifth of its
shingles, at positions that still leave room for the overlap; per shingle only the members outside
its main component are paired with the others. So members of one component never meet, and no link
between components is lost. A comparison is made on the full sets: 100 * intersection >= 80 * union.

Equal sets are merged before anything else, so copies cost nothing further. Hot keys (a set shared
by a third of all rows, a bucket of thousands) meet only in aggregates with map-side partials and
in equi-joins that Spark splits when skewed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage_table
from .common import id_text, numbered, without_rows
from .components import components

SHINGLE = 5
SIMILARITY = 80                 # per cent
PERMUTATIONS, ROWS = 40, 4      # 2 * 40 values in bands of 4
SMALL = 32                      # members of a bucket that are compared directly; beyond: prefix filtering
_BLOCK = 32_768                 # shingles hashed at once
_MEMO = 500_000


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _MEMO:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _scramble(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def shingle_set(raw: bytes, k: int, memo: dict) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles of a text; of the whole sequence when it has
    fewer words; empty without words."""
    words = raw.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    size = min(k, len(words))
    out = np.full(len(words) - size + 1, size if size < k else 0, np.uint64)
    for i in range(size):
        out = _scramble(out + h[i: len(h) - size + 1 + i])
    return np.unique(out)


def permutations(n: int, seed: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and offsets: x -> a x + b is one-to-one on 64-bit numbers."""
    rng = np.random.default_rng(seed)
    return rng.integers(0, 2**63, n, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, n, np.uint64)


def min_max(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The minima, then the maxima, under each permutation."""
    low, high = np.full(len(a), 2**64 - 1, np.uint64), np.zeros(len(a), np.uint64)
    for at in range(0, len(shingles), _BLOCK):
        x = a[:, None] * shingles[None, at: at + _BLOCK] + b[:, None]
        low, high = np.minimum(low, x.min(axis=1)), np.maximum(high, x.max(axis=1))
    return np.concatenate([low, high])


def signatures(docs: DataFrame, shingle: int, permutation_count: int = PERMUTATIONS, rows: int = ROWS) -> DataFrame:
    """``docs`` (doc_id, text_key, text bytes) to doc_id, text_key, n_shingles, set_key, bands."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("text_key", T.LongType()), T.StructField("n_shingles", T.LongType()),
                           T.StructField("set_key", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _WordHashes()
        a, b = permutations(permutation_count)
        n_bands = 2 * permutation_count // rows
        salts = np.arange(1, n_bands + 1, dtype=np.uint64)
        for batch in batches:
            sizes, keys, bands = [], [], []
            for raw in batch.column(2).to_pylist():
                s = shingle_set(raw, shingle, memo)
                sizes.append(len(s))
                if not len(s):
                    keys.append(None)
                    bands.append(None)
                    continue
                keys.append(xxhash.xxh3_128_digest(s.tobytes()))
                values = min_max(s, a, b)[: n_bands * rows].reshape(n_bands, rows)
                h = salts
                for column in values.T:
                    h = _scramble(h + column)
                bands.append(h.view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                                              pa.array(bands, pa.list_(pa.int64()))], names=schema.names)

    return docs.select("doc_id", "text_key", "text").mapInArrow(run, schema)


def full_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """``docs`` (set_key, text bytes) to (set_key, shingles): the set as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _WordHashes()
        for batch in batches:
            sets = [shingle_set(raw, shingle, memo).tobytes() for raw in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["set_key", "shingles"])

    return docs.select("set_key", "text").mapInArrow(run, "set_key binary, shingles binary")


def confirm(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    joined = (pairs.join(sets.select(F.col("set_key").alias("a"), F.col("shingles").alias("sa")), "a")
              .join(sets.select(F.col("set_key").alias("b"), F.col("shingles").alias("sb")), "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                same = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                keep.append(100 * same >= similarity * (len(x) + len(y) - same))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return joined.select("a", "b", "sa", "sb").mapInArrow(run, "u binary, v binary")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _alike(na: str, nb: str, similarity: int):
    return F.least(na, nb) * 100 >= F.greatest(na, nb) * similarity


def central_buckets(sets: DataFrame) -> DataFrame:
    """(band, set_key, n, size, central, pivot, pivot_n) of every bucket with two sets or more."""
    rows = sets.select("set_key", "n", F.explode("bands").alias("band"))
    shared = rows.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    rows = stage_table(rows.join(shared, "band"), "shared-bands")
    rows = rows.join(rows.groupBy("set_key").agg(F.sum("size").alias("central")), "set_key")
    top = rows.groupBy("band").agg(F.max(F.struct("central", "set_key", "n")).alias("top"))
    return stage_table(rows.join(top, "band").select("band", "set_key", "n", "size", "central", F.col("top.set_key").alias("pivot"),
                                                     F.col("top.n").alias("pivot_n")), "buckets")


def direct_pairs(rows: DataFrame, similarity: int) -> DataFrame:
    """Members of different components in buckets of at most ``SMALL``."""
    a = rows.select("band", F.col("set_key").alias("a"), F.col("n").alias("na"), F.col("component").alias("ca"))
    b = rows.select("band", F.col("set_key").alias("b"), F.col("n").alias("nb"), F.col("component").alias("cb"))
    return a.join(b, "band").where((F.col("b") > F.col("a")) & (F.col("ca") != F.col("cb")) & _alike("na", "nb", similarity)).select("a", "b")


def prefix_pairs(members: DataFrame, full: DataFrame, similarity: int) -> DataFrame:
    """Pairs of ``members`` (set_key, n, central, component) in different components that can be similar
    enough by their rarest shingles. Exact: the rarest common shingle of such a pair lies in both
    prefixes, and what follows it in either set is at least as long as the overlap must be."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.frombuffer(x, np.int64) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["set_key", "tokens"])

    held = full.join(members.select("set_key"), "set_key").select("set_key", "shingles").mapInArrow(run, "set_key binary, tokens array<bigint>")
    tokens = stage_table(held.select("set_key", F.explode("tokens").alias("token")), "open-shingles")
    often = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    # one set's shingles, the rarest first: the first fifth and one more, with their places
    ranked = tokens.join(often, "token").groupBy("set_key").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("t"))
    size = F.size("t")
    prefix = ranked.select("set_key", F.posexplode(F.slice("t", F.lit(1), size - F.ceil(size * similarity / 100).cast("int") + 1)).alias("at", "x"))
    rows = prefix.where("x.df > 1").select("set_key", F.col("x.token").alias("token"), "at").join(members, "set_key")
    main = rows.groupBy("token").agg(F.max(F.struct("central", "set_key", "component")).alias("top"), F.min("component").alias("x"),
                                     F.max("component").alias("y")).where("x != y").select("token", F.col("top.component").alias("main"))
    rows = stage_table(rows.join(main, "token"), "open-prefixes")
    a = rows.select("token", F.col("set_key").alias("a"), F.col("n").alias("na"), F.col("at").alias("pa"), F.col("component").alias("ca"))
    b = rows.where("component != main").select("token", F.col("set_key").alias("b"), F.col("n").alias("nb"), F.col("at").alias("pb"),
                                               F.col("component").alias("cb"))
    room = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb")) * (100 + similarity) >= (F.col("na") + F.col("nb")) * similarity
    return a.join(b, "token").where((F.col("ca") != F.col("cb")) & _alike("na", "nb", similarity) & room).select("a", "b")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, similarity: int = SIMILARITY, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (least id of the component),
    kept (doc_id = component_id).

    A text without words, or null, has an empty set and is linked with nothing: its component is its own
    id. A null id is ignored when the least id is taken, and its row is ``kept`` only in a component
    without any id; rows that repeat an id are linked by their texts like others; no rows give no rows.
    """
    source = id_text(docs, id_col, text_col, binary=True).withColumn("text_key", F.xxhash64("text"))
    sigs = stage_table(signatures(source, shingle), "signatures")
    named = sigs.where("set_key is not null")
    sets = stage_table(named.groupBy("set_key").agg(F.min(F.struct("doc_id", "text_key")).alias("first"), F.min("doc_id").alias("least_id"),
                                                    F.max(F.struct("n_shingles", "bands")).alias("x"))
                       .select("set_key", "first", "least_id", F.col("x.n_shingles").alias("n"), F.col("x.bands").alias("bands")), "sets")

    buckets = central_buckets(sets)
    label = None
    if not buckets.isEmpty():
        wanted = sets.join(buckets.select("set_key").distinct(), "set_key", "left_semi").select(
            "set_key", F.col("first.doc_id").alias("_id"), F.col("first.text_key").alias("_key"))
        texts = source.join(wanted, source["doc_id"].eqNullSafe(wanted["_id"]) & (source["text_key"] == wanted["_key"])).select("set_key", "text")
        full = stage_table(full_sets(texts, shingle).dropDuplicates(["set_key"]), "full-sets")

        first = _ordered(buckets.where((F.col("set_key") != F.col("pivot")) & _alike("n", "pivot_n", similarity))
                         .select(F.col("set_key").alias("a"), F.col("pivot").alias("b")))
        merged = components(confirm(first, full, similarity))
        moved = merged.select(F.col("node").alias("set_key"), F.col("component").alias("to"))
        label = stage_table(sets.select("set_key").join(moved, "set_key", "left").select("set_key", F.coalesce("to", "set_key").alias("component")), "labels")

        # buckets with members beside the pivot that lie in different components
        rest = buckets.where((F.col("size") > 2) & (F.col("set_key") != F.col("pivot"))).join(label, "set_key")
        mixed = rest.groupBy("band").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x != y").select("band")
        rest = stage_table(rest.join(mixed, "band", "left_semi"), "open-buckets")
        members = rest.where(F.col("size") > SMALL).select("set_key", "n", "central", "component").distinct()
        more = direct_pairs(rest.where(F.col("size") <= SMALL), similarity)
        if not members.isEmpty():
            more = more.unionByName(prefix_pairs(stage_table(members, "open-members"), full, similarity))
        links = (confirm(_ordered(more), full, similarity)
                 .join(label.select(F.col("set_key").alias("u"), F.col("component").alias("cu")), "u")
                 .join(label.select(F.col("set_key").alias("v"), F.col("component").alias("cv")), "v"))
        merged = components(links.select(F.col("cu").alias("u"), F.col("cv").alias("v")))
        moved = merged.select(F.col("node").alias("component"), F.col("component").alias("to"))
        label = stage_table(label.join(moved, "component", "left").select("set_key", F.coalesce("to", "component").alias("component")), "labels")

    owner = sets.select("set_key", "least_id")
    if label is not None:
        owner = owner.join(label, "set_key")
        least = owner.groupBy("component").agg(F.min("least_id").alias("component_id"))
        owner = owner.join(least, "component").select("set_key", "component_id")
    else:
        owner = owner.withColumnRenamed("least_id", "component_id")
    owner = owner.withColumnRenamed("set_key", "_k")
    out = named.join(owner, named["set_key"] == owner["_k"]).select("doc_id", "n_shingles", "component_id")
    alone = sigs.where("set_key is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, similarity: int = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with all its columns, one row of each group of near-duplicates: the one with the least id.

    Decided row by row: of rows that repeat the least id the first in the table's order stays, a null id comes after every
    other, and a row without words stays.
    """
    rows, key = numbered(docs, "minhash")
    who = "_who" if text_col != "_who" else "_who_"
    order = F.struct(F.col(f"`{id_col}`").isNull().alias("none"), F.col(f"`{id_col}`").alias("id"), F.col(key).alias("row"))
    named = rows.select(order.alias(who), F.col(f"`{text_col}`").alias(text_col))
    dropped = near_duplicates(named, shingle, similarity, id_col=who, text_col=text_col).where("not kept").select("doc_id.row")
    return without_rows(rows, key, dropped)
