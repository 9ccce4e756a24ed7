"""Aggregations (A1-A12). All are hash aggregates with map-side partials, so a hot key is
combined in every map task before it is shuffled. Money sums run on DECIMAL(18,8) and means
are that sum / count: exact, and independent of partition order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import count_where, money_avg, money_sum, ratio, wide_money

TOP_SENDERS = 20


def wallet_stats(df: DataFrame) -> DataFrame:
    """A1: per sender (NULL sender dropped, as pandas groupby does)."""
    return (df.where(F.col("sender").isNotNull())
            .groupBy("sender")
            .agg(money_sum("amount").alias("total_sent"),
                 money_avg("amount").alias("avg_tx_amount"),
                 F.count("tx_id").alias("tx_count"),
                 money_sum("fee").alias("total_fees_paid"),
                 count_where(F.col("status") == "FAILED").alias("failed_tx_count"),
                 F.countDistinct("receiver").alias("distinct_receivers"))
            .withColumnRenamed("sender", "wallet_address")
            .withColumn("failed_rate", F.bround(ratio("failed_tx_count", "tx_count"), 4)))


def daily_stats(df: DataFrame) -> DataFrame:
    """A2: per calendar date (NULL date dropped)."""
    return (df.withColumn("date", F.to_date("timestamp"))
            .where(F.col("date").isNotNull())
            .groupBy("date")
            .agg(money_sum("amount").alias("daily_volume"),
                 F.count("tx_id").alias("tx_count"),
                 F.countDistinct("sender").alias("unique_senders"),
                 money_avg("fee").alias("avg_fee")))


def daily_network_volume(df: DataFrame) -> DataFrame:
    """A3: per (date, network), Spark grouping (a NULL date is a group), ordered by date."""
    return (df.withColumn("date", F.to_date("timestamp"))
            .groupBy("date", "network")
            .agg(money_sum("amount").alias("daily_volume"),
                 F.count("tx_id").alias("tx_count"),
                 money_avg("fee").alias("avg_fee"))
            .orderBy("date", "network"))


def top_senders(df: DataFrame, n: int = TOP_SENDERS) -> DataFrame:
    """A4 (and L2): CONFIRMED only, largest total first, ties by sender; top ``n``.

    orderBy + limit plans as TakeOrderedAndProject: each task keeps its own n best, so only
    n rows per task reach the final merge.
    """
    return (df.where(F.col("status") == "CONFIRMED")
            .groupBy("sender")
            .agg(F.count(F.lit(1)).alias("tx_count"),
                 money_sum("amount").alias("total_amount"),
                 money_avg("amount").alias("avg_amount"),
                 money_sum("fee").alias("total_fees"))
            .orderBy(F.col("total_amount").desc(), F.col("sender").asc())
            .limit(n))


def top_amount_by_sender(df: DataFrame, n: int = TOP_SENDERS) -> DataFrame:
    """A5: the two-column form of A4."""
    return top_senders(df, n).select("sender", "total_amount")


def volume_by_network(df: DataFrame) -> DataFrame:
    """Sum and non-null count of amount per network."""
    return df.groupBy("network").agg(money_sum("amount").alias("volume"), F.count("amount").alias("tx_count"))


def volume_by_type(df: DataFrame) -> DataFrame:
    """Sum, mean and count of amount per tx_type."""
    return df.groupBy("tx_type").agg(money_sum("amount").alias("volume"),
                                     money_avg("amount").alias("mean_amount"),
                                     F.count("amount").alias("tx_count"))


def status_counts(df: DataFrame) -> DataFrame:
    """Total and per-status counts in one pass."""
    s = F.col("status")
    return df.agg(F.count(F.lit(1)).alias("total"),
                  count_where(s == "CONFIRMED").alias("confirmed"),
                  count_where(s == "PENDING").alias("pending"),
                  count_where(s == "FAILED").alias("failed"))


def amount_overview(df: DataFrame) -> DataFrame:
    """Total, mean and max amount."""
    return df.agg(money_sum("amount").alias("total_volume"),
                  money_avg("amount").alias("avg_amount"),
                  F.max("amount").alias("max_amount"))


def anomaly_rate(df: DataFrame) -> DataFrame:
    """A10: flagged count and percent (empty result when the flag column is absent)."""
    if "is_anomaly" not in df.columns:
        return df.sparkSession.createDataFrame([], "flagged bigint, flagged_pct double")
    return df.agg(F.coalesce(F.sum("is_anomaly"), F.lit(0)).cast("bigint").alias("flagged"),
                  F.bround(ratio(F.sum("is_anomaly") * 100, F.count(F.lit(1))), 4).alias("flagged_pct"))


def kpi_summary(df: DataFrame) -> DataFrame:
    """The one-row report (count, sum to 4 places, mean to 6, confirmed % to 2; half-even)."""
    return df.agg(F.count(F.lit(1)).alias("total_transactions"),
                  F.bround(F.sum(wide_money("amount")), 4).cast("double").alias("total_volume_btc"),
                  F.bround(money_avg("amount"), 6).alias("avg_amount"),
                  F.bround(ratio(count_where(F.col("status") == "CONFIRMED") * 100, F.count(F.lit(1))), 2)
                  .alias("confirmed_pct"))


def row_count(df: DataFrame) -> DataFrame:
    """The row count as a one-row table."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


# ---- one-pass report (A6-A11 from a single scan) ----------------------------------------------

def report_rollup(df: DataFrame) -> DataFrame:
    """One scan at (network, tx_type, status) grain, from which every report figure is derived exactly
    (sums are DECIMAL). The final aggregate keeps its shuffle partitions: gathered into one, a single
    task would fetch the output of every map task."""
    return df.groupBy("network", "tx_type", "status").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("amount").alias("n_amount"),
        F.sum(wide_money("amount")).alias("sum_amount"),
        F.max("amount").alias("max_amount"),
        (F.sum("is_anomaly") if "is_anomaly" in df.columns else F.lit(None).cast("bigint")).alias("n_anomaly")
    )


def report_table(r: DataFrame) -> DataFrame:
    """The rollup by network, by tx_type and in total, as one table (figure, value and the sums): the report's figures
    are rows of it. Grouping sets expand the rollup's few rows, not the data."""
    of = lambda status: F.coalesce(F.sum(F.when(F.col("status") == status, F.col("n"))), F.lit(0))
    level = F.grouping_id()
    figure = F.when(level == 1, "network").when(level == 2, "tx_type").otherwise("total")
    return r.groupingSets([["network"], ["tx_type"], []], "network", "tx_type").agg(
        figure.alias("figure"), F.sum("n").alias("n"), F.sum("n_amount").alias("n_amount"), F.sum("sum_amount").alias("sum_amount"),
        F.max("max_amount").alias("max_amount"), F.sum("n_anomaly").alias("n_anomaly"),
        of("CONFIRMED").alias("confirmed"), of("PENDING").alias("pending"), of("FAILED").alias("failed")).select(
        "figure", F.coalesce("network", "tx_type").alias("value"), "n", "n_amount", "sum_amount", "max_amount", "n_anomaly", "confirmed", "pending", "failed")


def report_from_rollup(r: DataFrame, table: DataFrame | None = None) -> dict[str, DataFrame]:
    """A6-A11 from ``report_rollup`` output; same columns as the direct functions. ``table`` takes the
    result of ``report_table`` where a caller keeps it."""
    table = report_table(r) if table is None else table
    totals = table.where("figure = 'total'")
    vol = F.col("sum_amount").cast("double").alias("volume")
    mean = F.try_divide(F.col("sum_amount").cast("double"), F.col("n_amount").cast("double"))
    return {
        "volume_by_network": table.where("figure = 'network'").select(F.col("value").alias("network"), vol, F.col("n_amount").alias("tx_count")),
        "volume_by_type": table.where("figure = 'tx_type'").select(F.col("value").alias("tx_type"), vol, mean.alias("mean_amount"),
                                                                   F.col("n_amount").alias("tx_count")),
        "status_counts": totals.select(F.col("n").alias("total"), "confirmed", "pending", "failed"),
        "amount_overview": totals.select(F.col("sum_amount").cast("double").alias("total_volume"),
                                         mean.alias("avg_amount"), "max_amount"),
        "anomaly_rate": totals.select(F.coalesce("n_anomaly", F.lit(0)).cast("bigint").alias("flagged"),
                                      F.bround(ratio(F.col("n_anomaly") * 100, F.col("n")), 4).alias("flagged_pct")),
        "kpi_summary": totals.select(F.col("n").alias("total_transactions"),
                                     F.bround("sum_amount", 4).cast("double").alias("total_volume_btc"),
                                     F.bround(mean, 6).alias("avg_amount"),
                                     F.bround(ratio(F.col("confirmed") * 100, F.col("n")), 2).alias("confirmed_pct")),
    }
