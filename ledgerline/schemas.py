"""Explicit schemas for every input and public table (never ``inferSchema``)."""

from pyspark.sql.types import (
    BooleanType, DateType, DecimalType, DoubleType, IntegerType, LongType, ShortType,
    StringType, StructField, StructType, TimestampNTZType,
)

# Raw payment rows as delivered in CSV (one header row).
TRANSACTIONS_RAW = StructType([
    StructField("tx_id", LongType(), False),
    StructField("tx_hash", StringType(), True),
    StructField("block_id", LongType(), True),
    StructField("sender", StringType(), True),
    StructField("receiver", StringType(), True),
    StructField("amount", DoubleType(), True),
    StructField("fee", DoubleType(), True),
    StructField("tx_type", StringType(), True),
    StructField("status", StringType(), True),
    StructField("timestamp", TimestampNTZType(), True),
    StructField("network", StringType(), True),
])

TRANSACTION_COLUMNS = [f.name for f in TRANSACTIONS_RAW.fields]

WALLET_METADATA = StructType([
    StructField("wallet_address", StringType(), True),
    StructField("kyc_verified", BooleanType(), True),
    StructField("country", StringType(), True),
    StructField("risk_score", DoubleType(), True),
])

# Stream event as it arrives: amount is kept as text and converted with try_cast, because
# producers send numbers, numeric strings and junk alike.
EVENT = StructType([
    StructField("tx_hash", StringType(), True),
    StructField("sender", StringType(), True),
    StructField("receiver", StringType(), True),
    StructField("amount", StringType(), True),
    StructField("fee", DoubleType(), True),
    StructField("status", StringType(), True),
    StructField("network", StringType(), True),
    StructField("timestamp", StringType(), True),
])

# Driver tables read by the ledger views (explicit, so no footer-inference job per read).
DRIVER_TABLES = {
    "events": StructType([
        StructField("event_id", LongType(), True),
        StructField("ts", TimestampNTZType(), True),
        StructField("user_id", LongType(), True),
        StructField("event_type", StringType(), True),
        StructField("value", DoubleType(), True),
        StructField("props", StringType(), True),
    ]),
    "customer": StructType([
        StructField("c_custkey", LongType(), True),
        StructField("c_name", StringType(), True),
        StructField("c_nationkey", IntegerType(), True),
        StructField("c_acctbal", DoubleType(), True),
        StructField("c_mktsegment", StringType(), True),
    ]),
}

# Warehouse money types.
AMOUNT_DECIMAL = DecimalType(18, 8)
# Sums of money: the widest scale-8 input whose Spark sum (10 more digits) still has 38 digits.
SUM_DECIMAL = DecimalType(28, 8)
USD_DECIMAL = DecimalType(18, 2)
RISK_DECIMAL = DecimalType(5, 2)

DIM_DATE = StructType([
    StructField("date_key", IntegerType(), False),
    StructField("full_date", DateType(), False),
    StructField("year", ShortType(), True),
    StructField("quarter", ShortType(), True),
    StructField("month", ShortType(), True),
    StructField("month_name", StringType(), True),
    StructField("week", ShortType(), True),
    StructField("day_of_week", ShortType(), True),
    StructField("is_weekend", BooleanType(), True),
])
