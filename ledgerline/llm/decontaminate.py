"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions only.

Words are runs of letters and digits, lower-cased. A document overlaps a benchmark item where
``WINDOW`` = 13 aligned words in a row agree but for at most ``SUBSTITUTIONS`` = 2 of them; an item
of 8 to 12 words must occur as a whole, word for word; shorter items are no evidence.

The fixed mask 11010011 hashes five of eight neighbouring words and ignores the other three.
Tried over all 91 ways to place at most two substitutions in 13 words, some placement of the mask
always avoids them, so the seeds lose no overlap. Hashes of the training texts are first screened
by a bit array of the benchmark's hashes, so only hits leave their row; hits join the benchmark's
hashes, and each is verified on the words around it. The array's size follows the hashes' count up
to ``MAX_BITS``; a benchmark beyond that fills it more, so more chance hits reach the join, which
drops them: the result is the same.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage_table
from .bits import bits_for, build_words, probe
from .common import free_name, id_text, without_rows

MASKS = ("11010011",)
WINDOW = 13
SUBSTITUTIONS = 2
BITS_PER_KEY, PROBES = 64, 2
MAX_BITS = 1 << 27              # 16 MB: the most that a task holds of the benchmark


def word_hashes(text: Column) -> Column:
    words = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    return F.transform(words, lambda w: F.xxhash64(w))


def _seed_hash(hashes: Column, at: Column, mask: str, number: int) -> Column:
    kept = [i for i, c in enumerate(mask) if c == "1"]
    return F.xxhash64(F.lit(number), *[F.get(hashes, at + F.lit(i)) for i in kept])


def _seed_of(mask: str, number: int):
    return lambda i: _seed_hash(F.col("h"), i, mask, number)


def _starts(n: Column, span: int) -> Column:
    """0 .. n - span, or no start at all for a shorter text."""
    return F.when(n >= span, F.sequence(F.lit(0), n - span)).otherwise(F.array().cast("array<int>"))


def _around(hashes: Column, at: Column, window: int) -> Column:
    """Up to ``window`` - 1 words before the position, and ``window`` + more from it on."""
    back = F.least(at, F.lit(window - 1))
    return F.slice(hashes, at - back + 1, back + window)


def item_seeds(benchmark: DataFrame, id_col: str, text_col: str, masks, window: int) -> DataFrame:
    b = id_text(benchmark, id_col, text_col).select(F.col("doc_id").alias("item_id"), word_hashes(F.col("text")).alias("h"))
    b = b.withColumn("item_words", F.size("h")).where(F.col("item_id").isNotNull())
    out = []
    for number, mask in enumerate(masks):
        at = b.withColumn("item_at", F.explode(_starts(F.col("item_words"), len(mask))))
        out.append(at.select("item_id", "item_words", "item_at",
                             _seed_hash(F.col("h"), F.col("item_at"), mask, number).alias("seed"),
                             _around(F.col("h"), F.col("item_at"), window).alias("item_near")))
    return reduce(DataFrame.unionByName, out)


def find_overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text", masks=MASKS,
                  window: int = WINDOW, substitutions: int = SUBSTITUTIONS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per overlapping (doc_id, item_id): first_word (of the document, from 0),
    matched_words (most agreeing words of one window), hits (verified seeds).

    Null and empty texts overlap nothing; a null id of either table gives no pair; rows that
    repeat an id are one document; every pair is listed, whatever their number; an empty
    benchmark gives no rows.
    """
    items = stage_table(item_seeds(benchmark, item_id_col, item_text_col, masks, window), "bench-seeds")
    n_bits = min(bits_for(items.count(), BITS_PER_KEY), max_bits)
    screen = stage_table(build_words(items.select("seed").distinct(), "seed", n_bits, PROBES, 9), "bench-bits")

    words = screen.scalar()
    d = (id_text(docs, id_col, text_col).where(F.col("doc_id").isNotNull())
         .select("doc_id", word_hashes(F.col("text")).alias("h")).withColumn("n", F.size("h")))
    hits = []
    for number, mask in enumerate(masks):
        seeds = F.transform(_starts(F.col("n"), len(mask)), _seed_of(mask, number))
        # the screen runs on the exploded seeds in generated code; the words around are cut out for hits only
        hits.append(d.select("doc_id", "h", F.posexplode(seeds).alias("doc_at", "doc_seed"))
                    .where(probe(words, F.col("doc_seed"), n_bits, PROBES, 9))
                    .select("doc_id", "doc_at", "doc_seed", _around(F.col("h"), F.col("doc_at"), window).alias("doc_near")))
    hits = reduce(DataFrame.unionByName, hits)

    pairs = hits.join(items, hits["doc_seed"] == items["seed"])
    back_d, back_i = F.least("doc_at", F.lit(window - 1)), F.least("item_at", F.lit(window - 1))
    back = F.least(back_d, back_i)
    ahead = F.least(F.size("doc_near") - back_d, F.size("item_near") - back_i)
    pairs = (pairs.withColumn("back", back).withColumn("len", back + ahead)
             .withColumn("doc_side", F.slice("doc_near", back_d - back + 1, F.col("len")))
             .withColumn("item_side", F.slice("item_near", back_i - back + 1, F.col("len")))
             .withColumn("same", F.zip_with("doc_side", "item_side", lambda a, b: (a == b).cast("int"))))
    size = F.least(F.col("item_words"), F.lit(window))
    runs = F.transform(F.when(F.col("len") >= size, F.sequence(F.lit(1), F.col("len") - size + 1)).otherwise(F.array().cast("array<int>")),
                       lambda k: F.struct(F.aggregate(F.slice("same", k, size), F.lit(0), lambda s, x: s + x).alias("m"), (-k).alias("k")))
    allowed = F.when(F.col("item_words") >= window, F.lit(substitutions)).otherwise(F.lit(0))
    best = pairs.withColumn("size", size).withColumn("allowed", allowed).withColumn("best", F.array_max(runs))
    return (best.where(F.col("best.m") >= F.col("size") - F.col("allowed"))
            .groupBy("doc_id", "item_id")
            .agg(F.min(F.col("doc_at") - F.col("back") - F.col("best.k") - 1).cast("bigint").alias("first_word"),
                 F.max("best.m").cast("bigint").alias("matched_words"), F.count(F.lit(1)).alias("hits")))


def keep_clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` with all its columns without the rows that overlap a benchmark item. Rows are named by the SHA-256 of their
    text, since equal texts share the decision; null and repeated ids are rows like others."""
    key = free_name(docs, "_digest")
    rows = docs.withColumn(key, F.sha2(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary"), 256))
    found = find_overlaps(rows, benchmark, id_col=key, text_col=text_col, **options)
    return without_rows(rows, key, found.select("doc_id").distinct())
