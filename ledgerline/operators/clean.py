"""Cleaning and enrichment: dedupe (C1), grouped-median impute (C2), positive filter (C3),
address normalisation (C4), removed-row count (C5) and the metadata join (J1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import nan_to_null, normalize_address, packed_key
from ..session import stage_table
from .median import MAX_RANK_ROWS, group_median


def dedupe_first(df: DataFrame, key: str = "tx_hash", order: str = "tx_id") -> DataFrame:
    """Keep the first row (lowest ``order``) per ``key``; a NULL key is one key of its own.

    Written as an aggregate, not a window: the least row is combined map-side, so a key shared by a
    third of all rows is cut down in every map task before the shuffle (Spark plans a sort aggregate,
    since the buffer is a row). The order is total: a NULL ``order`` comes after every value, and equal
    ones are told apart by the remaining columns in their order, so the survivor is fixed. A hash as ``key`` is
    shuffled and sorted in half its bytes.
    """
    rest = [c for c in df.columns if c not in (key, order)]
    least = F.min(F.struct(F.col(order).isNull().alias("_last"), F.col(order), *rest)).alias("_row")
    packed, back = packed_key(df, key)
    return df.groupBy(packed.alias("_key")).agg(least).select(back("_key").alias(key), "_row.*").select(*df.columns)


def impute_median(df: DataFrame, value: str = "amount", by: str = "tx_type",
                  max_rank_rows: int = MAX_RANK_ROWS) -> DataFrame:
    """Fill NULL ``value`` with the exact median of its ``by`` group (nulls skipped).

    The median table has one row per group and is written, so Spark sees its real size and joins it
    map-side while that is below the broadcast limit; rows with a NULL group find no median.
    """
    medians = group_median(df, [by], value, out="_median", max_rank_rows=max_rank_rows)
    return (df.join(medians, by, "left")
            .withColumn(value, F.coalesce(nan_to_null(value), F.col("_median")))
            .drop("_median")
            .select(*df.columns))


def positive_amounts(df: DataFrame, value: str = "amount") -> DataFrame:
    """Keep rows with ``value`` > 0 (NULL and NaN are dropped)."""
    return df.where(F.coalesce(nan_to_null(value) > 0, F.lit(False)))


def normalize_addresses(df: DataFrame, cols: tuple[str, ...] = ("sender", "receiver")) -> DataFrame:
    return df.withColumns({c: normalize_address(c) for c in cols})


def clean_transactions(df: DataFrame, max_rank_rows: int = MAX_RANK_ROWS) -> DataFrame:
    """C1 -> C2 -> C3 (the reference's order: the median sees <= 0 amounts) and C4.

    C4 only rewrites sender/receiver, which C1-C3 never read, so it commutes with them; it runs
    first, on the map side of the dedupe shuffle, where the scan's tasks do the per-row regex.
    The deduplicated table is written once as a stage table: the median reads two of its
    columns in several passes and the imputation joins back to it, and re-running the dedupe
    shuffle for each would cost more than writing it once to the shared checkpoint folder.
    """
    df = normalize_addresses(df.withColumn("amount", nan_to_null("amount")))
    deduped = stage_table(dedupe_first(df), "deduped", "zstd")
    return (impute_median(deduped, max_rank_rows=max_rank_rows)
            .transform(positive_amounts))


def removed_count(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row (rows_in, rows_out, removed), from two count aggregates."""
    rows_out = after.agg(F.count(F.lit(1))).scalar()
    return (before.agg(F.count(F.lit(1)).alias("rows_in"))
            .select("rows_in", rows_out.alias("rows_out"), (F.col("rows_in") - rows_out).alias("removed")))


def enrich_with_metadata(tx: DataFrame, metadata: DataFrame) -> DataFrame:
    """Left join wallet metadata on sender (metadata side not normalised; m:n fan-out kept).

    No forced broadcast: the metadata table grows with the user base, so Spark's size checks
    (static estimate, then AQE on the real shuffle size) decide; a hot sender on a sort-merge
    join is split by AQE's skew join.
    """
    md = metadata.withColumnRenamed("wallet_address", "sender")
    return tx.join(md, "sender", "left").select(*tx.columns, *[c for c in md.columns if c != "sender"])
