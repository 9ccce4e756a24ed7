"""Bit arrays built and probed with column expressions only.

A filter is one ``array<bigint>``: 64 bits a word. Its number of words is fixed from a counted
number of keys before it is built, so its size has a proven bound; it reaches the tasks as a scalar
subquery.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bits_for(keys: int, bits_per_key: float) -> int:
    """Number of bits: a multiple of 64."""
    return max(64, (int(keys * bits_per_key) + 63) // 64 * 64)


def positions(key: Column, n_bits: int, probes: int, salt: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(salt * 1000 + i)), F.lit(n_bits).cast("bigint")) for i in range(probes)]


def build_words(keys: DataFrame, key: str, n_bits: int, probes: int, salt: int) -> DataFrame:
    """One row, one column ``words``: the filter of the column ``key``."""
    at = (keys.select(F.explode(F.array(*positions(F.col(key), n_bits, probes, salt))).alias("p"))
          .select(F.expr("p div 64").alias("word"), F.expr("shiftleft(1L, cast(p % 64 as int))").alias("bit")))
    words = at.groupBy("word").agg(F.bit_or("bit").alias("bits"))
    # all words in order, empty ones too; at most n_bits / 64 rows meet in the one output row
    every = keys.sparkSession.range(n_bits // 64).withColumn("bits", F.lit(0).cast("bigint")).withColumnRenamed("id", "word")
    dense = words.unionByName(every).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    return dense.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda x: x["bits"]).alias("words"))


def probe(words: Column, key: Column, n_bits: int, probes: int, salt: int, offset: int = 0) -> Column:
    """True for every key in the filter (``offset``: the filter's first word in ``words``)."""
    tests: list[Callable] = []
    for p in positions(key, n_bits, probes, salt):
        # n_bits is a multiple of 64, so the word is p >> 6 and the bit p & 63 (a shift takes the low six bits)
        word = F.get(words, F.shiftright(p, 6).cast("int") + F.lit(offset))
        tests.append(F.getbit(word, p.bitwiseAND(F.lit(63).cast("bigint")).cast("int")) == 1)
    out = tests[0]
    for t in tests[1:]:
        out = out & t
    return out
