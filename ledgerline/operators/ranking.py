"""Distributed ranking and surrogate keys.

``rank() OVER (PARTITION BY network ORDER BY amount DESC)`` puts every row of a network into
one task; with two networks, 100 TB would be sorted by two tasks. ``row_number() OVER (ORDER BY
key)`` is worse: one task for everything. Both are rebuilt here from shuffles that spread the
work evenly:

* equal values are counted first (``groupBy(part, value).count()`` is partially aggregated
  map-side, so a value that holds a third of all rows shrinks to one row per map task);
* the distinct values are range-partitioned on (part, value); each range gets its id from
  ``spark_partition_id()`` and the result is checkpointed, so ids and bounds cannot change
  between the two reads below, and a lost executor does not lose them;
* per (part, range) totals give every range the count of rows before it (a table with one row
  per range: bounded by the number of ranges, not by the data);
* inside a range a window over the range's own values adds the running count;
* the rank of a value is 1 + the number of rows ordered before it, which is ``rank()``.
  Rows get their rank back through an equi-join on (part, value); AQE's skew-join splits a hot
  value on the row side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def _num_ranges(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _order_expr(c: str, descending: bool) -> Column:
    return F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_last()


def _before_counts(values: DataFrame, part: list[str], value: str, descending: bool,
                   weight: str | None, num_ranges: int | None) -> DataFrame:
    """For each distinct (part, value): ``_before`` = total weight ordered strictly before it."""
    n = num_ranges or _num_ranges(values)
    w_col = F.col(weight) if weight else F.lit(1).cast("bigint")
    ranged = (values.repartitionByRange(n, *[F.col(p) for p in part], _order_expr(value, descending))
              .withColumn("_range", F.spark_partition_id())
              .withColumn("_w", w_col.cast("bigint")))
    ranged = materialize(ranged)

    totals = ranged.groupBy(*part, "_range").agg(F.sum("_w").alias("_range_total"))
    by_range = Window.partitionBy(*part).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*part, "_range",
                            F.coalesce(F.sum("_range_total").over(by_range), F.lit(0)).alias("_offset"))

    in_range = (Window.partitionBy(*part, "_range").orderBy(_order_expr(value, descending))
                .rowsBetween(Window.unboundedPreceding, -1))
    local = ranged.withColumn("_local", F.coalesce(F.sum("_w").over(in_range), F.lit(0)))
    # null-safe on the partition columns: a NULL partition is a partition of its own
    offsets = offsets.select(*[F.col(p).alias(f"_o_{p}") for p in part], F.col("_range").alias("_o_range"),
                             "_offset")
    cond = [local[p].eqNullSafe(offsets[f"_o_{p}"]) for p in part] + [local["_range"] == offsets["_o_range"]]
    return (local.join(offsets, cond)
            .select(*values.columns, (F.col("_offset") + F.col("_local")).cast("bigint").alias("_before")))


def rank_by_value(df: DataFrame, part: list[str], value: str, out: str = "rank",
                  descending: bool = True, num_ranges: int | None = None) -> DataFrame:
    """``df`` plus ``out`` = rank() over (partition by part order by value [desc] nulls last)."""
    counts = df.groupBy(*part, value).agg(F.count(F.lit(1)).alias("_cnt"))
    before = _before_counts(counts, part, value, descending, "_cnt", num_ranges)
    ranks = before.select(*[F.col(p).alias(f"_k_{p}") for p in part], F.col(value).alias("_k_v"),
                          (F.col("_before") + 1).alias(out))
    cond = [df[p].eqNullSafe(ranks[f"_k_{p}"]) for p in part] + [df[value].eqNullSafe(ranks["_k_v"])]
    return df.join(ranks, cond, "left").drop(*[f"_k_{p}" for p in part], "_k_v")


def surrogate_keys(df: DataFrame, key: str, out: str, num_ranges: int | None = None,
                   key_type: str = "bigint") -> DataFrame:
    """Dense 1..n keys in ``key`` order for a table whose ``key`` is unique (SERIAL semantics).

    No single-partition window: rows are range-partitioned on the key and numbered inside their
    range plus the sizes of the ranges before it; the rows travel with their key, so no join back.
    """
    before = _before_counts(df, [], key, False, None, num_ranges)
    return before.select(*df.columns, (F.col("_before") + 1).cast(key_type).alias(out))


def sequence_in_group(df: DataFrame, part: list[str], order: str, out: str, num_ranges: int | None = None) -> DataFrame:
    """``df`` plus ``out`` = 1..n inside each ``part`` in the order of column ``order`` (a struct orders by its fields, NULLs
    first). A group that holds a third of all rows is numbered by as many tasks as it has ranges; rows that agree in
    ``part`` and ``order`` get different numbers in any order."""
    before = _before_counts(df, part, order, False, None, num_ranges)
    return before.select(*df.columns, (F.col("_before") + 1).cast("bigint").alias(out))
