"""Lasting surrogate keys (D6): a stored dimension only grows, and a given key never changes.

SERIAL gives each new row the next number. Here a load's natural keys meet the stored dimension in an anti join;
what remains is numbered by ranges (``ranking.surrogate_keys``), counted on from the greatest stored key, and
appended. A load that runs again finds its keys stored and adds nothing. One load runs at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage_table
from ..sources.warehouse import read_loads
from .ranking import surrogate_keys


def new_members(stored: DataFrame | None, members: DataFrame, key: str) -> DataFrame:
    """The rows of ``members`` (one a natural key, none NULL) whose key is not stored."""
    if stored is None:
        return members
    return members.join(stored.select(F.col(key).alias("_known")), members[key] == F.col("_known"), "left_anti")


def extend_dimension(path: str, members: DataFrame, key: str, out: str, key_type: str = "bigint") -> DataFrame:
    """Add the new ones of ``members`` to the dimension at ``path`` and return the whole dimension.

    ``members`` has one row a natural ``key`` with its attributes; rows with a NULL key have no place in a
    dimension and are left out. Stored rows, attributes included, stay as they are; the new ones get keys after the
    greatest stored key, dense and in the order of ``key``.
    """
    spark = members.sparkSession
    stored = read_loads(spark, path)
    last = 0 if stored is None else stored.agg(F.max(out)).first()[0] or 0
    # written first: the numbering passes twice over it, and the append must not read its own output
    fresh = stage_table(new_members(stored, members.where(F.col(key).isNotNull()), key), "new-members")
    numbered = surrogate_keys(fresh, key, out).withColumn(out, (F.col(out) + F.lit(last)).cast(key_type))
    if stored is None or not fresh.isEmpty():
        numbered.select(out, *[c for c in members.columns]).write.mode("append").parquet(path)
    return spark.read.parquet(path)
