"""Derived feature columns (F1-F6) and the re-aimed generator columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import block_of, hex_address, tx_hash_of

# Fixed values (parameters with the reference's defaults).
USD_RATE = 45_000.0
LARGE_TX = 1.0


def add_features(df: DataFrame, usd_rate: float = USD_RATE, large_tx: float = LARGE_TX) -> DataFrame:
    amount = F.col("amount")
    return df.withColumns({
        "amount_usd": amount * F.lit(float(usd_rate)),
        "fee_pct": F.bround(F.try_divide(F.col("fee"), amount) * F.lit(100.0), 4),
        "is_large_tx": (amount > F.lit(float(large_tx))).cast("int"),
        "hour_of_day": F.hour("timestamp"),
        "day_of_week": F.weekday("timestamp"),    # Monday = 0
        "amount_log": F.log1p(amount),
    })


def with_tx_hash(df: DataFrame, parts=("sender", "receiver", "amount", "timestamp"), out: str = "tx_hash") -> DataFrame:
    """'0x' + SHA-256 of the concatenated fields (deterministic: no random salt)."""
    return df.withColumn(out, tx_hash_of(*parts))


def with_address(df: DataFrame, id_col: str, out: str) -> DataFrame:
    """F8: '0x' + md5 of an id."""
    return df.withColumn(out, hex_address(id_col))


def with_block(df: DataFrame, tx_id: str = "tx_id", out: str = "block_id") -> DataFrame:
    """block = tx_id div 10 + 1."""
    return df.withColumn(out, block_of(tx_id))
