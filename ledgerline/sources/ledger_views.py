"""Ledger tables derived from the driver tables (``events``, ``customer``).

The rules are fixture rules: they turn every ``events`` row into a payment row with the dirt
that the cleaning stage has to handle (missing, negative and zero amounts, padded upper-case
addresses, malformed hashes, missing timestamps, self-sends, re-delivered duplicates). All of it
is plain column arithmetic on the scan, so it runs map-side with no shuffle and grows with the
input. The DuckDB oracle builds the same views from the same rules (``plans/oracle.py``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import hex_address
from ..schemas import DRIVER_TABLES, TRANSACTION_COLUMNS
from ..session import table_path

# Fixed values of the fixture rules.
TX_TYPE_OF_EVENT = {
    "click": "TRANSFER",
    "error": "SMART_CONTRACT",
    "purchase": "MINING_REWARD",
    "signup": "STAKE",
    "view": "UNSTAKE",
}
COUNTRIES = ["IN", "US", "UK", "SG", "AE", "DE"]
DUPLICATE_EVERY = 50            # every 50th tx_id is delivered a second time
DUPLICATE_ID_OFFSET = 1_000_000_000
RECEIVER_SPACE = 150            # receivers are drawn from 150 addresses
WALLET_HOLE_EVERY = 10          # customers with key % 10 == 9 have no metadata


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in DRIVER_TABLES:
        reader = reader.schema(DRIVER_TABLES[name])
    return reader.parquet(table_path(sf_dir, name))


def _ledger_rows(events: DataFrame, copy) -> DataFrame:
    """Payment rows from events; ``copy`` is 0 for the original delivery, 1 for a re-delivery."""
    eid = F.col("event_id")
    value = F.col("value")
    first_id = eid + F.lit(1)
    tx_id = first_id + copy * F.lit(DUPLICATE_ID_OFFSET)
    good_hash = F.concat(F.lit("0x"), F.sha2(F.concat(F.lit("tx-"), eid.cast("string")), 256))
    tx_hash = F.when(eid % 211 == 5, F.concat(F.lit("0xdead"), eid.cast("string"))).otherwise(good_hash)
    address = hex_address("user_id")
    sender = F.when(eid % 7 == 0, F.concat(F.lit(" "), F.upper(address), F.lit("\t"))).otherwise(address)
    receiver = hex_address((F.col("user_id") * 7 + eid) % RECEIVER_SPACE)
    amount = (F.when(eid % 33 == 1, F.lit(None).cast("double"))
              .when(eid % 97 == 2, -value)
              .when(eid % 101 == 3, F.lit(0.0))
              .otherwise(value))
    amount = F.when(copy == 1, amount * F.lit(2.0)).otherwise(amount)
    fee = F.round(value * (F.lit(1) + eid % 10) / F.lit(1000.0), 8)
    tx_type = F.element_at(F.create_map(*[F.lit(x) for kv in TX_TYPE_OF_EVENT.items() for x in kv]),
                           F.col("event_type"))
    status_slot = eid % 20
    status = (F.when(status_slot <= 16, F.lit("CONFIRMED"))
              .when(status_slot <= 18, F.lit("PENDING"))
              .otherwise(F.lit("FAILED")))
    timestamp = F.when(eid % 223 == 7, F.lit(None).cast("timestamp_ntz")).otherwise(F.col("ts"))
    network = F.when(F.floor(eid / 3) % 2 == 0, F.lit("mainnet")).otherwise(F.lit("testnet"))
    return events.select(
        tx_id.cast("bigint").alias("tx_id"),
        tx_hash.alias("tx_hash"),
        (F.floor(first_id / 10) + 1).cast("bigint").alias("block_id"),
        sender.alias("sender"),
        receiver.alias("receiver"),
        amount.cast("double").alias("amount"),
        fee.cast("double").alias("fee"),
        tx_type.alias("tx_type"),
        status.alias("status"),
        timestamp.alias("timestamp"),
        network.alias("network"),
    )


def ledger_raw0(events: DataFrame) -> DataFrame:
    """One payment row per event."""
    return _ledger_rows(events, F.lit(0))


def ledger_raw(events: DataFrame) -> DataFrame:
    """``ledger_raw0`` plus a later re-delivery of every 50th row (same hash, new id, doubled
    amount), so the dedupe survivor rule is observable. Both deliveries come from one pass over
    the scan (``explode`` of one or two copy numbers), not a union that would scan twice."""
    copies = F.when((F.col("event_id") + 1) % DUPLICATE_EVERY == 0, F.array(F.lit(0), F.lit(1))) \
        .otherwise(F.array(F.lit(0)))
    with_copy = events.withColumn("_copy", F.explode(copies))
    return _ledger_rows(with_copy, F.col("_copy")).select(*TRANSACTION_COLUMNS)


def ledger_wallets(customer: DataFrame) -> DataFrame:
    """Wallet metadata from customers (every 10th customer has none)."""
    key = F.col("c_custkey")
    return (customer.where(key % WALLET_HOLE_EVERY != WALLET_HOLE_EVERY - 1)
            .select(hex_address(key).alias("wallet_address"),
                    (key % 2 == 0).alias("kyc_verified"),
                    F.element_at(F.array(*[F.lit(c) for c in COUNTRIES]),
                                 (F.col("c_nationkey") % len(COUNTRIES) + 1).cast("int")).alias("country"),
                    (F.floor((F.col("c_acctbal") + 1000) / 11).cast("double") / F.lit(100.0))
                    .cast("double").alias("risk_score")))


def load_ledger(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(raw transactions, wallet metadata) for a driver data folder."""
    events = read_table(spark, sf_dir, "events")
    customer = read_table(spark, sf_dir, "customer")
    return ledger_raw(events), ledger_wallets(customer)
