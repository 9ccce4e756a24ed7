"""Window operators.

W1 ranks raw rows inside a network: there are only two networks, so it uses the distributed
rank of ``ranking.py`` instead of a two-task window. W2-W4 run on grouped tables whose window
partitions are bounded by the number of days, not by the number of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .median import MAX_RANK_ROWS, group_median
from .ranking import rank_by_value


def rank_in_network(df: DataFrame, out: str = "rank_in_network") -> DataFrame:
    """rank() by amount desc (nulls last) within each network, over all rows."""
    return rank_by_value(df, ["network"], "amount", out=out, descending=True)


def running_total(df: DataFrame, part: list[str], order: str, value: str, out: str) -> DataFrame:
    """SUM(value) OVER (PARTITION BY part ORDER BY order ROWS UNBOUNDED PRECEDING..CURRENT ROW)."""
    w = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(out, F.sum(value).over(w))


def rank_desc(df: DataFrame, part: list[str], value: str, out: str) -> DataFrame:
    """RANK() OVER (PARTITION BY part ORDER BY value DESC) on an aggregated table."""
    return df.withColumn(out, F.rank().over(Window.partitionBy(*part).orderBy(F.col(value).desc())))


def previous_value(df: DataFrame, part: list[str], order: str, value: str, out: str) -> DataFrame:
    """LAG(value) over the previous present row (not the previous calendar day)."""
    return df.withColumn(out, F.lag(value).over(Window.partitionBy(*part).orderBy(order)))


def group_median_column(df: DataFrame, by: str, value: str, out: str,
                        max_rank_rows: int = MAX_RANK_ROWS) -> DataFrame:
    """The group's median on every row (pandas ``transform("median")``), via the exact
    distributed median and an equi-join instead of an unbounded partition window."""
    medians = group_median(df, [by], value, out=out, max_rank_rows=max_rank_rows)
    return df.join(medians, by, "left")
