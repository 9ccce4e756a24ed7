"""Star schema (D1-D6) and 3NF tables (O1-O3) built from validated ledger rows.

Dimension sizes and what that means for joins:

* dim_date is bounded by the calendar: 3.65 million days from year 1 to 9999, made from one row;
* dim_tx_type and dim_network hold free text of the input, which nothing bounds, and dim_wallet grows
  with the number of wallets. All three get their keys from the distributed ``surrogate_keys``, and
  none is force-broadcast: they are written tables, so Spark's size checks decide.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import money
from ..schemas import RISK_DECIMAL, USD_DECIMAL
from .features import USD_RATE
from .quality import apply_defaults
from .ranking import surrogate_keys


def dim_date(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Every calendar day from the first to the last transaction date."""
    bounds = df.agg(F.min(F.to_date(ts)).alias("_lo"), F.max(F.to_date(ts)).alias("_hi"))
    d = F.col("full_date")
    return (bounds.select(F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 1 DAY"))).alias("full_date"))
            .select((F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int").alias("date_key"),
                    d,
                    F.year(d).cast("smallint").alias("year"),
                    F.quarter(d).cast("smallint").alias("quarter"),
                    F.month(d).cast("smallint").alias("month"),
                    F.date_format(d, "MMMM").alias("month_name"),
                    F.weekofyear(d).cast("smallint").alias("week"),
                    F.weekday(d).cast("smallint").alias("day_of_week"),
                    (F.weekday(d) >= 5).alias("is_weekend")))


def wallet_addresses(df: DataFrame) -> DataFrame:
    """Distinct addresses seen as sender or receiver, with the first time each was seen."""
    both = (df.select(F.col("sender").alias("wallet_address"), "timestamp")
            .unionByName(df.select(F.col("receiver").alias("wallet_address"), "timestamp")))
    return (both.where(F.col("wallet_address").isNotNull())
            .groupBy("wallet_address").agg(F.min("timestamp").alias("first_seen")))


def wallet_rows(df: DataFrame, metadata: DataFrame) -> DataFrame:
    """The members of dim_wallet without their keys; wallets without metadata keep NULL attributes."""
    md = metadata.select("wallet_address", "kyc_verified", F.col("country").alias("country_code"),
                         F.col("risk_score").cast(RISK_DECIMAL).alias("risk_score"))
    return (wallet_addresses(df).join(md, "wallet_address", "left")
            .select("wallet_address", "kyc_verified", "country_code", "risk_score", "first_seen"))


def dim_wallet(df: DataFrame, metadata: DataFrame) -> DataFrame:
    """D2 (+D6): wallet_key, wallet_address, kyc_verified, country_code, risk_score DECIMAL(5,2), numbered from 1
    (``keys.extend_dimension`` keeps keys over several loads)."""
    keyed = surrogate_keys(wallet_rows(df, metadata), "wallet_address", "wallet_key")
    return keyed.select("wallet_key", "wallet_address", "kyc_verified", "country_code", "risk_score", "first_seen")


def tx_type_rows(df: DataFrame, categories: dict | None = None, descriptions: dict | None = None) -> DataFrame:
    """The members of dim_tx_type; category/description from optional user mappings."""
    base = df.where(F.col("tx_type").isNotNull()).select("tx_type").distinct()
    return base.select("tx_type", _lookup("tx_type", categories).alias("category"), _lookup("tx_type", descriptions).alias("description"))


def dim_tx_type(df: DataFrame, categories: dict | None = None, descriptions: dict | None = None) -> DataFrame:
    """D3: one row per tx_type."""
    out = surrogate_keys(tx_type_rows(df, categories, descriptions), "tx_type", "tx_type_key", key_type="int")
    return out.select("tx_type_key", "tx_type", "category", "description")


def network_rows(df: DataFrame, chain_ids: dict | None = None, descriptions: dict | None = None) -> DataFrame:
    """The members of dim_network; chain_id/description from optional user mappings."""
    base = df.where(F.col("network").isNotNull()).select("network").distinct()
    return base.select("network", _lookup("network", chain_ids).cast("int").alias("chain_id"), _lookup("network", descriptions).alias("description"))


def dim_network(df: DataFrame, chain_ids: dict | None = None, descriptions: dict | None = None) -> DataFrame:
    """One row per network."""
    out = surrogate_keys(network_rows(df, chain_ids, descriptions), "network", "network_key", key_type="int")
    return out.select("network_key", "network", "chain_id", "description")


def _lookup(col: str, mapping: dict | None):
    if not mapping:
        return F.lit(None).cast("string")
    return F.element_at(F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv]), F.col(col)).cast("string")


def fact_transactions(df: DataFrame, dates: DataFrame, wallets: DataFrame, tx_types: DataFrame,
                      networks: DataFrame, usd_rate: float = USD_RATE) -> DataFrame:
    """Validated rows with dimension keys and warehouse types."""
    senders = wallets.select(F.col("wallet_key").alias("sender_key"), F.col("wallet_address").alias("sender"))
    receivers = wallets.select(F.col("wallet_key").alias("receiver_key"), F.col("wallet_address").alias("receiver"))
    anomaly = F.col("is_anomaly") if "is_anomaly" in df.columns else F.lit(0)
    joined = (df.withColumn("full_date", F.to_date("timestamp"))
              .join(dates.select("date_key", "full_date"), "full_date", "left")
              .join(senders, "sender", "left")
              .join(receivers, "receiver", "left")
              .join(tx_types.select("tx_type_key", "tx_type"), "tx_type", "left")
              .join(networks.select("network_key", "network"), "network", "left"))
    # fact_id (BIGSERIAL): the source's unique tx_id. A dense global numbering of the largest
    # table would cost a range shuffle and a checkpoint of all facts for no query's benefit.
    fact = joined.select(
        F.col("tx_id").cast("bigint").alias("fact_id"), "tx_id", "tx_hash", "date_key", "sender_key",
        "receiver_key", "tx_type_key", "network_key",
        F.col("block_id").cast("bigint").alias("block_id"),
        money("amount").alias("amount"),
        money("fee").alias("fee"),
        (F.col("amount") * F.lit(float(usd_rate))).cast(USD_DECIMAL).alias("amount_usd"),
        F.coalesce(anomaly, F.lit(0)).cast("smallint").alias("is_anomaly"),
        "status")
    return fact


# ---- 3NF tables (O1-O3) -------------------------------------------------------------------

def wallets_table(dim_wallets: DataFrame) -> DataFrame:
    """O1: wallets with the DDL defaults (kyc FALSE, risk 0.0); created_at = first seen."""
    t = dim_wallets.select(F.col("wallet_key").alias("wallet_id"), "wallet_address", "kyc_verified",
                           "country_code", "risk_score", F.col("first_seen").alias("created_at"))
    return apply_defaults(t, {"kyc_verified": False, "risk_score": F.lit(0).cast(RISK_DECIMAL)})


def blocks_table(df: DataFrame) -> DataFrame:
    """O2: one row per block. Hash, miner and reward have no source: the hash is derived from the
    block id (NOT NULL UNIQUE), miner stays NULL, reward takes its default 0."""
    return (df.where(F.col("block_id").isNotNull())
            .groupBy("block_id").agg(F.count(F.lit(1)).alias("tx_count"),
                                     F.min("timestamp").alias("created_at"))
            .select(F.col("block_id").cast("bigint").alias("block_id"),
                    F.concat(F.lit("0x"), F.sha2(F.concat(F.lit("block-"), F.col("block_id").cast("string")), 256))
                    .alias("block_hash"),
                    F.lit(None).cast("string").alias("miner_address"),
                    F.lit(0).cast("decimal(18,8)").alias("reward"),
                    "tx_count", "created_at"))


def transactions_table(df: DataFrame, wallets: DataFrame) -> DataFrame:
    """O3: transactions with addresses replaced by wallet ids, DDL types and defaults."""
    s = wallets.select(F.col("wallet_id").alias("sender_id"), F.col("wallet_address").alias("sender"))
    r = wallets.select(F.col("wallet_id").alias("receiver_id"), F.col("wallet_address").alias("receiver"))
    t = (df.join(s, "sender", "left").join(r, "receiver", "left")
         .select("tx_id", "tx_hash", F.col("block_id").cast("bigint").alias("block_id"), "sender_id", "receiver_id",
                 money("amount").alias("amount"), money("fee").alias("fee"), "tx_type", "status", "network",
                 F.col("timestamp").alias("created_at")))
    return apply_defaults(t, {"fee": F.lit(0).cast("decimal(18,8)"), "tx_type": "TRANSFER",
                              "status": "PENDING", "network": "mainnet"})
