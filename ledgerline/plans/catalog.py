"""Registered queries: one per operator (or operator group), each ``(spark, sf_dir) -> DataFrame``
over the whole driver tables, paired with its DuckDB oracle SQL (``plans/oracle.py``).

Float columns whose last bits depend on the engine's summation or libm (means of doubles,
sample std, logarithms) are rounded to a fixed number of places on both sides; money sums run
on DECIMAL and need no rounding.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from ..operators import aggregates as A
from ..operators import clean as C
from ..operators import features as FE
from ..operators import normalize as N
from ..operators import quality as V
from ..operators.median import group_median
from ..operators.ranking import surrogate_keys
from ..operators.windows import group_median_column, rank_in_network
from ..session import stage_table, work_dir
from ..sources import io, tables, warehouse
from ..sources.ledger_views import ledger_raw0, ledger_wallets, load_ledger, read_table
from ..streaming import events as ST
from . import queries as Q
from .incremental import StarWarehouse
from .oracle import sql
from .stages import Ledger

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def register(name: str, oracle: str | None):
    def deco(fn: Builder) -> Builder:
        REGISTRY[name] = (fn, sql(oracle) if oracle else None)
        return fn
    return deco


def _raw(spark, sf_dir):
    return load_ledger(spark, sf_dir)[0]


_LEDGERS: dict[tuple[str, str], Ledger] = {}


def _ledger(spark: SparkSession, sf_dir: str) -> Ledger:
    """One ``Ledger`` per Spark application and data folder: the registered queries of a run
    share the stage tables (clean, validated, star) built from the same whole tables, instead
    of rebuilding them per query. Stage tables live in that application's checkpoint folder."""
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    if key not in _LEDGERS:
        _LEDGERS[key] = Ledger(spark, sf_dir)
    return _LEDGERS[key]


RAW_COLS = "tx_id, tx_hash, block_id, sender, receiver, amount, fee, tx_type, status, \"timestamp\", network"

# ---- views and sources -----------------------------------------------------------------------


@register("ledger_raw", f"SELECT {RAW_COLS} FROM ledger_raw")
def q_ledger_raw(spark, sf_dir):
    """S3 scan + fixture view rules (F7-F9 style derived columns)."""
    return _raw(spark, sf_dir)


@register("ledger_wallets", "SELECT * FROM ledger_wallets")
def q_ledger_wallets(spark, sf_dir):
    return ledger_wallets(read_table(spark, sf_dir, "customer"))


@register("s1_csv_scan", f"SELECT {RAW_COLS} FROM ledger_raw")
def q_s1_csv(spark, sf_dir):
    """Ledger rows written as header CSV, read back with the typed schema."""
    path = work_dir(spark, "s1-csv")
    io.write_transactions_csv(_raw(spark, sf_dir), path)
    return io.read_transactions_csv(spark, path)


@register("s1_csv_rejects", """
SELECT CASE WHEN tx_id % 89 IN (4, 5, 6, 7) THEN 'rejected' ELSE 'good' END AS kind, tx_hash,
       CASE WHEN tx_id % 89 IN (4, 5, 6, 7) THEN NULL ELSE tx_id END AS tx_id, CASE WHEN tx_id % 89 IN (4, 5, 6, 7) THEN NULL ELSE amount END AS amount,
       CASE tx_id % 89 WHEN 4 THEN 'amount' WHEN 5 THEN 'tx_id' WHEN 6 THEN 'timestamp' WHEN 7 THEN 'number of fields' END AS reason
FROM ledger_raw""")
def q_s1_rejects(spark, sf_dir):
    """S1 with its reject path: CSV lines of the ledger, some with an amount, an id or a time that is none, or a field too
    few; they are rejected with the reason, and no amount is made up for them."""
    base = work_dir(spark, "s1-rejects")
    raw = _raw(spark, sf_dir)
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in raw.columns}
    slot = F.col("tx_id") % 89
    text["amount"] = F.when(slot == 4, F.lit("1;5")).otherwise(text["amount"])
    text["tx_id"] = F.when(slot == 5, F.concat(F.lit("id-"), text["tx_id"])).otherwise(text["tx_id"])
    text["timestamp"] = F.when(slot == 6, F.lit("yesterday")).otherwise(text["timestamp"])
    line = F.concat_ws(",", *text.values())
    raw.select(F.when(slot == 7, F.concat_ws(",", *list(text.values())[:-1])).otherwise(line).alias("value")).write.text(f"{base}/in")
    good, counts = io.ingest_transactions_csv(spark, f"{base}/in", f"{base}/out", header=False)
    bad = spark.read.parquet(f"{base}/out").where("kind = 'rejected'")
    if bad.count() != counts["rejected"]:
        raise AssertionError(f"observed {counts}")
    nothing = F.lit(None)
    return good.select(F.lit("good").alias("kind"), "tx_hash", "tx_id", "amount", nothing.cast("string").alias("reason")).unionByName(
        bad.select("kind", "tx_hash", nothing.cast("bigint").alias("tx_id"), nothing.cast("double").alias("amount"), F.col("reject_reason").alias("reason")))


@register("s2_json_scan", "SELECT * FROM ledger_wallets")
def q_s2_json(spark, sf_dir):
    """Wallet metadata as JSON, read back with the declared schema."""
    path = work_dir(spark, "s2-json")
    ledger_wallets(read_table(spark, sf_dir, "customer")).write.mode("overwrite").json(path)
    return io.read_wallet_metadata(spark, path, multiline=False)


CLEAN_COLS = ("tx_id, tx_hash, block_id, sender, receiver, amount, fee, tx_type, status, \"timestamp\", network, "
              "kyc_verified, country, risk_score")


@register("s2_json_array_scan", "SELECT * FROM ledger_wallets")
def q_s2_array(spark, sf_dir):
    """S2 on the array form: files that each hold one JSON array of wallets."""
    path = work_dir(spark, "s2-json-array")
    io.write_json_arrays(ledger_wallets(read_table(spark, sf_dir, "customer")), path)
    return io.read_wallet_metadata(spark, path, multiline=True)


@register("s2_one_array_file", "SELECT * FROM ledger_wallets")
def q_s2_one_file(spark, sf_dir):
    """S2 on the reference's form, all wallets as one JSON array in one file, read split by split. (Writing the
    stand-in file is one task; reading it isn't.)"""
    path = work_dir(spark, "s2-one-array")
    one = ledger_wallets(read_table(spark, sf_dir, "customer")).select(F.to_json(F.struct("*")).alias("value"))
    lines = Window.orderBy("value")
    numbered = one.select("value", F.row_number().over(lines).alias("n"), F.lead("value").over(lines).isNull().alias("last"))
    text = F.concat(F.when(F.col("n") == 1, "[\n").otherwise(""), "value", F.when(F.col("last"), "\n]").otherwise(","))
    numbered.select(text.alias("value")).coalesce(1).write.text(path)
    return io.read_wallet_metadata(spark, path, multiline=True)


@register("k1_parquet_roundtrip", f"SELECT {CLEAN_COLS} FROM features")
def q_k1(spark, sf_dir):
    """K1 + S3: the clean table written as Parquet and scanned back."""
    path = work_dir(spark, "k1-clean")
    io.write_parquet(_ledger(spark, sf_dir).clean, path)
    return io.read_parquet(spark, path).select(*[c.strip().strip('"') for c in CLEAN_COLS.split(",")])


@register("k2_partitioned_write", """
SELECT tx_id, amount, CAST(rank() OVER (PARTITION BY network ORDER BY amount DESC NULLS LAST) AS BIGINT)
         AS rank_in_network, network
FROM clean""")
def q_k2(spark, sf_dir):
    """K2 + W1: ranked clean rows written partitioned by network; each network's folder is read back with
    its filter (which prunes the other), and both are compared."""
    path = work_dir(spark, "k2-ranked")
    L = _ledger(spark, sf_dir)
    ranked = rank_in_network(L.clean)
    io.write_partitioned(ranked.select("tx_id", "amount", "rank_in_network", "network"), path)
    back = io.read_parquet(spark, path)
    return back.where(F.col("network") == "testnet").unionByName(back.where(F.col("network") != "testnet"))


KPI_SQL = """
SELECT count(*) AS total_transactions,
       CAST(round_even(sum(CAST(amount AS DECIMAL(18,8))), 4) AS DOUBLE) AS total_volume_btc,
       round_even(CAST(sum(CAST(amount AS DECIMAL(18,8))) AS DOUBLE) / count(amount), 6) AS avg_amount,
       round_even(CAST(count_if(status = 'CONFIRMED') * 100 AS DOUBLE) / count(*), 2) AS confirmed_pct
FROM validated"""

KPI_SCHEMA = StructType([StructField("total_transactions", LongType()), StructField("total_volume_btc", DoubleType()),
                         StructField("avg_amount", DoubleType()), StructField("confirmed_pct", DoubleType())])


@register("k3_report_csv", KPI_SQL)
def q_k3(spark, sf_dir):
    """K3: the KPI row written as one CSV file with header, read back."""
    path = work_dir(spark, "k3-report")
    io.write_report_csv(A.kpi_summary(_ledger(spark, sf_dir).validated), path)
    return io.read_report_csv(spark, path, KPI_SCHEMA)


@register("k7_warehouse_load_twice", "SELECT tx_id, tx_hash, amount, status FROM validated")
def q_k7(spark, sf_dir):
    """K6 + K7: create-if-absent, then load the validated table twice; the second load adds
    nothing."""
    path = work_dir(spark, "k7-warehouse")
    rows = _ledger(spark, sf_dir).validated.select("tx_id", "tx_hash", "amount", "status")
    io.create_table_like(rows, path)
    io.append_new(rows, path)
    io.append_new(rows, path)
    return io.read_parquet(spark, path)


@register("k6_bucketed_table", "SELECT tx_id, tx_hash, amount, status, CAST(strftime(\"timestamp\", '%Y%m%d') AS INTEGER) AS date_key FROM validated")
def q_k6_table(spark, sf_dir):
    """K6 + K7 with a catalog table: created if absent, by date and bucketed by hash; the validated rows are loaded in two
    overlapping batches, the second one twice."""
    path = work_dir(spark, "k6-table")
    name = f"fact_{os.path.basename(path).replace('-', '_')}"
    day = F.date_format("timestamp", "yyyyMMdd").cast("int").alias("date_key")
    rows = _ledger(spark, sf_dir).validated.select("tx_id", "tx_hash", "amount", "status", day)
    tables.create_table(spark, name, rows.schema, path)
    early = F.pmod(F.xxhash64("tx_hash"), F.lit(3))
    tables.append_new_rows(rows.where(early < 2), name)
    for _ in range(2):
        tables.append_new_rows(rows.where(early > 0), name)
    return spark.table(name)


@register("k7_rejects_twice", """
SELECT CASE WHEN length(tx_hash) = 66 THEN 'loaded' ELSE 'rejected' END AS kind, tx_id, amount FROM clean""")
def q_k7_rejects(spark, sf_dir):
    """K7's rejects: the clean rows, whose malformed hashes arrive as NULL, are loaded by date three times under one
    load id; loaded and rejected rows are those of one load."""
    path = work_dir(spark, "k7-rejects")
    well_formed = F.when(F.length("tx_hash") == V.HASH_LENGTH, F.col("tx_hash"))
    rows = _ledger(spark, sf_dir).clean.select("tx_id", well_formed.alias("tx_hash"), "amount", F.to_date("timestamp").alias("day"))
    for _ in range(3):
        warehouse.load_by_date(rows, path, "daily", date="day")
    kept = warehouse.read_loads(spark, path).select(F.lit("loaded").alias("kind"), "tx_id", "amount")
    return kept.unionByName(warehouse.read_loads(spark, f"{path}_rejected").select(F.lit("rejected").alias("kind"), "tx_id", "amount"))


_WAREHOUSES: dict[tuple[str, str], StarWarehouse] = {}


def _warehouse(spark: SparkSession, sf_dir: str) -> StarWarehouse:
    """All validated rows in three loads: the earlier half of the days without every tenth transaction, the later
    half, and then what came late, which touches days of the first load. The last two run twice."""
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    if key not in _WAREHOUSES:
        L = _ledger(spark, sf_dir)
        day = F.to_date("timestamp")
        first, last = L.validated.agg(F.min(day), F.max(day)).first()
        early = day <= F.lit(first + (last - first) // 2)
        late_arrival = F.col("tx_id") % 10 == 0
        loads = [("first", early & ~late_arrival), ("second", ~early), ("late", early & late_arrival), ("second", ~early), ("late", early & late_arrival)]
        house = StarWarehouse(spark, work_dir(spark, "warehouse"))
        for load_id, rows in loads:
            house.load(L.validated.where(rows), L.wallets, load_id)
        _WAREHOUSES[key] = house
    return _WAREHOUSES[key]


@register("d6_incremental", "SELECT wallet_key, wallet_address, country_code FROM lasting_wallet")
def q_d6_incremental(spark, sf_dir):
    """D6 + D2: the keys that the wallets got load by load; a later load changes none of them."""
    return _warehouse(spark, sf_dir).table("dim_wallet").select("wallet_key", "wallet_address", "country_code")


@register("k7_touched_partitions", """
SELECT v.tx_id AS fact_id, v.tx_hash, CAST(strftime(v."timestamp", '%Y%m%d') AS INTEGER) AS date_key, s.wallet_key AS sender_key,
       r.wallet_key AS receiver_key, CAST(v.amount AS DOUBLE) AS amount, l.load_id
FROM validated v JOIN load_of l ON l.tx_id = v.tx_id
LEFT JOIN lasting_wallet s ON s.wallet_address = v.sender LEFT JOIN lasting_wallet r ON r.wallet_address = v.receiver""")
def q_k7_touched(spark, sf_dir):
    """K7 by date: the fact after five runs of three loads, each row with its load and its lasting keys."""
    f = _warehouse(spark, sf_dir).table("fact_transactions")
    return f.select("fact_id", "tx_hash", "date_key", "sender_key", "receiver_key", F.col("amount").cast("double").alias("amount"), "load_id")


# ---- cleaning (C1-C5, J1) --------------------------------------------------------------------

@register("c1_dedupe", f"SELECT {RAW_COLS} FROM dedup")
def q_c1(spark, sf_dir):
    return C.dedupe_first(_raw(spark, sf_dir))


@register("c2_group_median", "SELECT tx_type, median_amount FROM med")
def q_c2_median(spark, sf_dir):
    """Exact per-type median of the deduplicated amounts."""
    return group_median(_ledger(spark, sf_dir).deduped, ["tx_type"], "amount", out="median_amount")


@register("c2_impute", "SELECT tx_id, tx_type, amount FROM imputed")
def q_c2_impute(spark, sf_dir):
    return C.impute_median(_ledger(spark, sf_dir).deduped).select("tx_id", "tx_type", "amount")


@register("c3_positive_filter", "SELECT tx_id, amount FROM imputed WHERE amount > 0")
def q_c3(spark, sf_dir):
    return C.positive_amounts(C.impute_median(_ledger(spark, sf_dir).deduped)).select("tx_id", "amount")


@register("c4_normalize_addresses", r"""
SELECT tx_id, regexp_replace(lower(sender), '^\s+|\s+$', '', 'g') AS sender,
       regexp_replace(lower(receiver), '^\s+|\s+$', '', 'g') AS receiver FROM ledger_raw""")
def q_c4(spark, sf_dir):
    return C.normalize_addresses(_raw(spark, sf_dir)).select("tx_id", "sender", "receiver")


@register("c5_removed_count", """
SELECT (SELECT count(*) FROM ledger_raw) AS rows_in, (SELECT count(*) FROM clean) AS rows_out,
       (SELECT count(*) FROM ledger_raw) - (SELECT count(*) FROM clean) AS removed""")
def q_c5(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return C.removed_count(raw, C.clean_transactions(raw))


@register("j1_metadata_join", "SELECT tx_id, sender, kyc_verified, country, risk_score FROM enriched")
def q_j1(spark, sf_dir):
    raw, wallets = load_ledger(spark, sf_dir)
    return C.enrich_with_metadata(C.clean_transactions(raw), wallets).select(
        "tx_id", "sender", "kyc_verified", "country", "risk_score")


# ---- features (F1-F9) ------------------------------------------------------------------------

@register("f1_f6_features", """
SELECT tx_id, amount_usd, fee_pct, is_large_tx, hour_of_day, day_of_week, round(amount_log, 8) AS amount_log
FROM features""")
def q_features(spark, sf_dir):
    return _ledger(spark, sf_dir).clean.select(
        "tx_id", "amount_usd", "fee_pct", "is_large_tx", "hour_of_day", "day_of_week",
        F.round("amount_log", 8).alias("amount_log"))


@register("f7_tx_hash", """
SELECT tx_id, '0x' || sha256(concat_ws('', sender, receiver, CAST(tx_id AS VARCHAR))) AS computed_hash
FROM features""")
def q_f7(spark, sf_dir):
    return (FE.with_tx_hash(_ledger(spark, sf_dir).clean, parts=("sender", "receiver", "tx_id"), out="computed_hash")
            .select("tx_id", "computed_hash"))


@register("f7_tx_hash_fields", """
SELECT tx_id, '0x' || sha256(concat_ws('', sender, receiver, CAST(block_id AS VARCHAR), strftime("timestamp", '%Y-%m-%d %H:%M:%S'))) AS computed_hash
FROM features""")
def q_f7_fields(spark, sf_dir):
    """F7 over addresses, a number and the time, all as text."""
    at = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")
    rows = _ledger(spark, sf_dir).clean.withColumn("at", at)
    return FE.with_tx_hash(rows, parts=("sender", "receiver", "block_id", "at"), out="computed_hash").select("tx_id", "computed_hash")


@register("f8_address", "SELECT c_custkey, '0x' || md5(CAST(c_custkey AS VARCHAR)) AS address FROM customer")
def q_f8(spark, sf_dir):
    return FE.with_address(read_table(spark, sf_dir, "customer"), "c_custkey", "address").select("c_custkey", "address")


@register("f9_block", "SELECT tx_id, CAST(tx_id // 10 + 1 AS BIGINT) AS block_id FROM ledger_raw")
def q_f9(spark, sf_dir):
    return FE.with_block(_raw(spark, sf_dir).select("tx_id")).select("tx_id", "block_id")


# ---- validation and quality (V1-V11, M1) -----------------------------------------------------

@register("v1_v4_rule_counts", """
SELECT CAST(count_if(NOT _r1) AS BIGINT) AS fail_amount, CAST(count_if(NOT _r2) AS BIGINT) AS fail_self_send,
       CAST(count_if(NOT _r3) AS BIGINT) AS fail_hash, CAST(count_if(NOT _r4) AS BIGINT) AS fail_timestamp,
       CAST(count_if(_r1 AND _r2 AND _r3 AND _r4) AS BIGINT) AS valid,
       CAST(count_if(NOT (_r1 AND _r2 AND _r3 AND _r4)) AS BIGINT) AS invalid
FROM rules""")
def q_v_rules(spark, sf_dir):
    tagged = V.with_rules(_ledger(spark, sf_dir).clean)
    r = V.rule_columns()
    return tagged.agg(
        F.count_if(~r["amount_positive"]).cast("bigint").alias("fail_amount"),
        F.count_if(~r["sender_not_receiver"]).cast("bigint").alias("fail_self_send"),
        F.count_if(~r["hash_length"]).cast("bigint").alias("fail_hash"),
        F.count_if(~r["timestamp_present"]).cast("bigint").alias("fail_timestamp"),
        F.count_if(F.col("_is_valid")).cast("bigint").alias("valid"),
        F.count_if(~F.col("_is_valid")).cast("bigint").alias("invalid"))


@register("v5_valid", "SELECT tx_id, tx_hash, sender, receiver, amount, status FROM valid0")
def q_v5_valid(spark, sf_dir):
    valid, _ = V.split_valid(_ledger(spark, sf_dir).clean)
    return valid.select("tx_id", "tx_hash", "sender", "receiver", "amount", "status")


@register("v5_quarantine", "SELECT tx_id, failed_rules FROM invalid")
def q_v5_invalid(spark, sf_dir):
    return _ledger(spark, sf_dir).invalid.select("tx_id", "failed_rules")


def _star_tables(L: Ledger) -> dict[str, DataFrame]:
    return {"fact_transactions": L.fact, "dim_date": L.dim_date, "dim_wallet": L.dim_wallet,
            "dim_tx_type": L.dim_tx_type, "dim_network": L.dim_network, "wallets": L.wallets_3nf,
            "blocks": L.blocks_3nf, "transactions": L.transactions_3nf}


NOT_NULL = [("fact_transactions", "fact", "tx_hash"), ("dim_date", "dim_date", "full_date"),
            ("dim_wallet", "dim_wallet", "wallet_address"), ("dim_tx_type", "dim_tx_type", "tx_type"),
            ("dim_network", "dim_network", "network"), ("wallets", "wallets_3nf", "wallet_address"),
            ("blocks", "blocks_3nf", "block_hash"), ("transactions", "transactions_3nf", "tx_hash"),
            ("transactions", "transactions_3nf", "amount")]


@register("v6_not_null_audit", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, 'NOT NULL' AS constraint_type, '{c}' AS column_name, "
    f"CAST(count_if({c} IS NULL) AS BIGINT) AS violations FROM {cte}" for t, cte, c in NOT_NULL))
def q_v6(spark, sf_dir):
    return _audited(spark, sf_dir).where("constraint_type = 'NOT NULL'")


UNIQUE = [("fact_transactions", "fact", "fact_id", "PRIMARY KEY"), ("dim_date", "dim_date", "date_key", "PRIMARY KEY"),
          ("dim_wallet", "dim_wallet", "wallet_key", "PRIMARY KEY"),
          ("dim_tx_type", "dim_tx_type", "tx_type_key", "PRIMARY KEY"),
          ("dim_network", "dim_network", "network_key", "PRIMARY KEY"),
          ("wallets", "wallets_3nf", "wallet_id", "PRIMARY KEY"), ("wallets", "wallets_3nf", "wallet_address", "UNIQUE"),
          ("blocks", "blocks_3nf", "block_id", "PRIMARY KEY"), ("blocks", "blocks_3nf", "block_hash", "UNIQUE"),
          ("transactions", "transactions_3nf", "tx_id", "PRIMARY KEY"),
          ("transactions", "transactions_3nf", "tx_hash", "UNIQUE")]


@register("v7_key_audit", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{k}' AS constraint_type, '{c}' AS column_name, "
    f"CAST(coalesce(sum(_n), 0) AS BIGINT) AS violations FROM (SELECT {c}, count(*) AS _n FROM {cte} "
    f"WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)" for t, cte, c, k in UNIQUE))
def q_v7(spark, sf_dir):
    return _audited(spark, sf_dir).where("constraint_type IN ('PRIMARY KEY', 'UNIQUE')")


FOREIGN = [("fact_transactions", "fact", "date_key", "dim_date", "dim_date", "date_key"),
           ("fact_transactions", "fact", "sender_key", "dim_wallet", "dim_wallet", "wallet_key"),
           ("fact_transactions", "fact", "receiver_key", "dim_wallet", "dim_wallet", "wallet_key"),
           ("fact_transactions", "fact", "tx_type_key", "dim_tx_type", "dim_tx_type", "tx_type_key"),
           ("fact_transactions", "fact", "network_key", "dim_network", "dim_network", "network_key"),
           ("transactions", "transactions_3nf", "block_id", "blocks", "blocks_3nf", "block_id"),
           ("transactions", "transactions_3nf", "sender_id", "wallets", "wallets_3nf", "wallet_id"),
           ("transactions", "transactions_3nf", "receiver_id", "wallets", "wallets_3nf", "wallet_id")]


@register("v8_foreign_key_audit", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, 'FOREIGN KEY -> {pk}' AS constraint_type, '{fk}' AS column_name, "
    f"CAST(count(*) AS BIGINT) AS violations FROM {cte} c WHERE c.{fk} IS NOT NULL AND NOT EXISTS "
    f"(SELECT 1 FROM {pcte} p WHERE p.{pk} = c.{fk})" for t, cte, fk, _, pcte, pk in FOREIGN))
def q_v8(spark, sf_dir):
    return _audited(spark, sf_dir).where("constraint_type LIKE 'FOREIGN KEY%'")


@register("v9_check_audit", """
SELECT 'transactions' AS table_name, 'CHECK (amount > 0)' AS constraint_type, 'amount' AS column_name,
       CAST(count_if(NOT (amount > 0)) AS BIGINT) AS violations FROM transactions_3nf""")
def q_v9(spark, sf_dir):
    return _audited(spark, sf_dir).where("constraint_type LIKE 'CHECK%'")


def star_constraints() -> list[V.Constraint]:
    """All declared constraints of the star schema and the 3NF tables."""
    return ([V.Constraint(t, "NOT NULL", c) for t, _, c in NOT_NULL] + [V.Constraint(t, k, c) for t, _, c, k in UNIQUE]
            + [V.Constraint(t, "FOREIGN KEY", fk, parent=(pt, pk)) for t, _, fk, pt, _, pk in FOREIGN]
            + [V.Constraint("transactions", "CHECK", "amount", rule="amount > 0")])


_AUDITS: dict[tuple[str, str], DataFrame] = {}


def _audited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V6-V9 in one audit, of which each query takes its own kind."""
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    if key not in _AUDITS:
        _AUDITS[key] = stage_table(V.audit(_star_tables(_ledger(spark, sf_dir)), star_constraints()), "audit")
    return _AUDITS[key]


@register("v10_defaults", """
SELECT wallet_address, kyc_verified, CAST(risk_score AS DOUBLE) AS risk_score FROM wallets_3nf""")
def q_v10(spark, sf_dir):
    w = _ledger(spark, sf_dir).wallets_3nf
    return w.select("wallet_address", "kyc_verified", F.col("risk_score").cast("double").alias("risk_score"))


@register("v11_dq_gate", """
SELECT count(*) AS total, CAST(count_if(amount <= 0) AS BIGINT) AS bad_amount,
       CAST(count_if(tx_hash IS NULL) AS BIGINT) AS null_hash FROM validated""")
def q_v11(spark, sf_dir):
    validated = _ledger(spark, sf_dir).validated
    V.assert_quality(validated)
    return V.quality_counts(validated)


@register("m1_stage_metrics", """
SELECT 'dedupe' AS stage, (SELECT count(*) FROM ledger_raw) AS rows_in, (SELECT count(*) FROM dedup) AS rows_out
UNION ALL SELECT 'clean', (SELECT count(*) FROM ledger_raw), (SELECT count(*) FROM clean)
UNION ALL SELECT 'validate', (SELECT count(*) FROM features), (SELECT count(*) FROM valid0)
UNION ALL SELECT 'quarantine', (SELECT count(*) FROM features), (SELECT count(*) FROM invalid)""")
def q_m1(spark, sf_dir):
    L = _ledger(spark, sf_dir)
    return V.stage_metrics([("dedupe", L.raw, L.deduped), ("clean", L.raw, L.clean),
                            ("validate", L.clean, L.validated), ("quarantine", L.clean, L.invalid)])


# ---- normalisation and anomalies (N1-N5) -----------------------------------------------------

@register("n1_min_max", "SELECT tx_id, round(amount_normalized, 8) AS amount_normalized FROM validated")
def q_n1(spark, sf_dir):
    return _ledger(spark, sf_dir).validated.select("tx_id", F.round("amount_normalized", 8).alias("amount_normalized"))


@register("n2_zscore", "SELECT tx_id, round(amount_zscore, 6) AS amount_zscore FROM validated")
def q_n2(spark, sf_dir):
    return _ledger(spark, sf_dir).validated.select("tx_id", F.round("amount_zscore", 6).alias("amount_zscore"))


@register("n3_anomalies", "SELECT tx_id, amount, is_anomaly FROM validated WHERE is_anomaly = 1")
def q_n3(spark, sf_dir):
    return _ledger(spark, sf_dir).validated.where(F.col("is_anomaly") == 1).select("tx_id", "amount", "is_anomaly")


@register("n4_failed_rate_flag", """
SELECT v.tx_id, v.sender, CAST(w.failed_rate IS NOT NULL AS INTEGER) AS high_failed_rate
FROM validated v LEFT JOIN (SELECT wallet_address, failed_rate FROM wallet_stats WHERE failed_rate > 0.2) w
  ON v.sender = w.wallet_address""")
def q_n4(spark, sf_dir):
    return N.flag_failed_rate(_ledger(spark, sf_dir).validated).select("tx_id", "sender", "high_failed_rate")


REPEAT_COLS = ("tx_id", "sender", "receiver", "timestamp")


@register("n5_rapid_repeat_1d", """
SELECT tx_id, sender, receiver, gap_seconds FROM (
  SELECT tx_id, sender, receiver,
         (epoch_us("timestamp") - lag(epoch_us("timestamp")) OVER (PARTITION BY sender, receiver
                                                                  ORDER BY "timestamp", tx_id)) / 1000000.0
           AS gap_seconds
  FROM validated WHERE "timestamp" IS NOT NULL)
WHERE gap_seconds < 86400""")
def q_n5(spark, sf_dir):
    flagged = N.flag_rapid_repeats(_ledger(spark, sf_dir).validated.select(*REPEAT_COLS), seconds=86400.0)
    return flagged.where(F.col("is_rapid_repeat") == 1).select("tx_id", "sender", "receiver", "gap_seconds")


@register("n5_rapid_repeat_1s", """
SELECT tx_id, sender, receiver, gap_seconds FROM (
  SELECT tx_id, sender, receiver,
         (epoch_us("timestamp") - lag(epoch_us("timestamp")) OVER (PARTITION BY sender, receiver
                                                                  ORDER BY "timestamp", tx_id)) / 1000000.0
           AS gap_seconds
  FROM validated WHERE "timestamp" IS NOT NULL)
WHERE gap_seconds < 1""")
def q_n5_1s(spark, sf_dir):
    flagged = N.flag_rapid_repeats(_ledger(spark, sf_dir).validated.select(*REPEAT_COLS), seconds=1.0)
    return flagged.where(F.col("is_rapid_repeat") == 1).select("tx_id", "sender", "receiver", "gap_seconds")


# ---- aggregates (A1-A12) ---------------------------------------------------------------------

@register("a1_wallet_stats", "SELECT * FROM wallet_stats")
def q_a1(spark, sf_dir):
    return A.wallet_stats(_ledger(spark, sf_dir).validated)


@register("a2_daily_stats", """
SELECT CAST("timestamp" AS DATE) AS date, CAST(sum(CAST(amount AS DECIMAL(18,8))) AS DOUBLE) AS daily_volume,
       count(tx_id) AS tx_count, count(DISTINCT sender) AS unique_senders,
       CAST(sum(CAST(fee AS DECIMAL(18,8))) AS DOUBLE) / count(fee) AS avg_fee
FROM validated WHERE "timestamp" IS NOT NULL GROUP BY CAST("timestamp" AS DATE)""")
def q_a2(spark, sf_dir):
    return A.daily_stats(_ledger(spark, sf_dir).validated)


@register("a3_daily_network_volume", """
SELECT CAST("timestamp" AS DATE) AS date, network, CAST(sum(CAST(amount AS DECIMAL(18,8))) AS DOUBLE) AS daily_volume,
       count(tx_id) AS tx_count, CAST(sum(CAST(fee AS DECIMAL(18,8))) AS DOUBLE) / count(fee) AS avg_fee
FROM clean GROUP BY CAST("timestamp" AS DATE), network""")
def q_a3(spark, sf_dir):
    return A.daily_network_volume(_ledger(spark, sf_dir).clean)


TOP_SQL = """
SELECT sender, count(*) AS tx_count, CAST(sum(CAST(amount AS DECIMAL(18,8))) AS DOUBLE) AS total_amount,
       CAST(sum(CAST(amount AS DECIMAL(18,8))) AS DOUBLE) / count(amount) AS avg_amount,
       CAST(sum(CAST(fee AS DECIMAL(18,8))) AS DOUBLE) AS total_fees
FROM clean WHERE status = 'CONFIRMED' GROUP BY sender ORDER BY total_amount DESC, sender ASC LIMIT {n}"""


@register("a4_top_senders", TOP_SQL.format(n=20))
def q_a4(spark, sf_dir):
    """A4/L1/L2: top 20 senders of the clean table (the Spark job reads clean, not validated)."""
    return A.top_senders(_ledger(spark, sf_dir).clean)


@register("a5_top_amount_by_sender", f"SELECT sender, total_amount FROM ({TOP_SQL.format(n=20)})")
def q_a5(spark, sf_dir):
    return A.top_amount_by_sender(_ledger(spark, sf_dir).clean)


@register("l3_head_preview", TOP_SQL.format(n=5))
def q_l3(spark, sf_dir):
    """L3: the first five rows of the ordered top-senders result."""
    return A.top_senders(_ledger(spark, sf_dir).clean).limit(5)


@register("a6_volume_by_network", """
SELECT network, CAST(sum(CAST(amount AS DECIMAL(18,8))) AS DOUBLE) AS volume, count(amount) AS tx_count
FROM validated GROUP BY network""")
def q_a6(spark, sf_dir):
    return A.volume_by_network(_ledger(spark, sf_dir).validated)


@register("a7_volume_by_type", """
SELECT tx_type, CAST(sum(CAST(amount AS DECIMAL(18,8))) AS DOUBLE) AS volume,
       CAST(sum(CAST(amount AS DECIMAL(18,8))) AS DOUBLE) / count(amount) AS mean_amount, count(amount) AS tx_count
FROM validated GROUP BY tx_type""")
def q_a7(spark, sf_dir):
    return A.volume_by_type(_ledger(spark, sf_dir).validated)


@register("a8_status_counts", """
SELECT count(*) AS total, CAST(count_if(status = 'CONFIRMED') AS BIGINT) AS confirmed,
       CAST(count_if(status = 'PENDING') AS BIGINT) AS pending, CAST(count_if(status = 'FAILED') AS BIGINT) AS failed
FROM validated""")
def q_a8(spark, sf_dir):
    return A.status_counts(_ledger(spark, sf_dir).validated)


@register("a9_amount_overview", """
SELECT CAST(sum(CAST(amount AS DECIMAL(18,8))) AS DOUBLE) AS total_volume,
       CAST(sum(CAST(amount AS DECIMAL(18,8))) AS DOUBLE) / count(amount) AS avg_amount, max(amount) AS max_amount
FROM validated""")
def q_a9(spark, sf_dir):
    return A.amount_overview(_ledger(spark, sf_dir).validated)


@register("a10_anomaly_rate", """
SELECT CAST(coalesce(sum(is_anomaly), 0) AS BIGINT) AS flagged,
       round_even(CAST(sum(is_anomaly) * 100 AS DOUBLE) / count(*), 4) AS flagged_pct FROM validated""")
def q_a10(spark, sf_dir):
    return A.anomaly_rate(_ledger(spark, sf_dir).validated)


@register("a11_kpi_summary", KPI_SQL)
def q_a11(spark, sf_dir):
    return A.kpi_summary(_ledger(spark, sf_dir).validated)


@register("report_rollup", """
SELECT network, tx_type, status, count(*) AS n, count(amount) AS n_amount,
       CAST(sum(CAST(amount AS DECIMAL(28,8))) AS DOUBLE) AS volume, max(amount) AS max_amount,
       CAST(sum(is_anomaly) AS BIGINT) AS n_anomaly
FROM validated GROUP BY network, tx_type, status""")
def q_report_rollup(spark, sf_dir):
    """The one scan that the report's figures A6-A11 come from."""
    r = A.report_rollup(_ledger(spark, sf_dir).validated)
    return r.withColumn("volume", F.col("sum_amount").cast("double")).drop("sum_amount")


@register("report_table", """
SELECT 'network' AS figure, network AS value, count(*) AS n, CAST(sum(CAST(amount AS DECIMAL(28,8))) AS DOUBLE) AS volume FROM validated GROUP BY network
UNION ALL SELECT 'tx_type', tx_type, count(*), CAST(sum(CAST(amount AS DECIMAL(28,8))) AS DOUBLE) FROM validated GROUP BY tx_type
UNION ALL SELECT 'total', NULL, count(*), CAST(sum(CAST(amount AS DECIMAL(28,8))) AS DOUBLE) FROM validated""")
def q_report_table(spark, sf_dir):
    """All figures of the report as one table, from one scan."""
    t = A.report_table(A.report_rollup(_ledger(spark, sf_dir).validated))
    return t.select("figure", "value", "n", F.col("sum_amount").cast("double").alias("volume"))


@register("report_kpi_from_rollup", KPI_SQL)
def q_report_kpi(spark, sf_dir):
    """A11 as the report computes it, from the rollup."""
    return A.report_from_rollup(A.report_rollup(_ledger(spark, sf_dir).validated))["kpi_summary"]


@register("a12_row_count", "SELECT count(*) AS row_count FROM validated")
def q_a12(spark, sf_dir):
    return A.row_count(_ledger(spark, sf_dir).validated)


# ---- windows (W1, W5; W2-W4 are in Q3/Q5) ----------------------------------------------------

@register("w1_rank_in_network", """
SELECT tx_id, network, amount,
       CAST(rank() OVER (PARTITION BY network ORDER BY amount DESC NULLS LAST) AS BIGINT) AS rank_in_network
FROM clean""")
def q_w1(spark, sf_dir):
    """W1 over whole networks (distributed rank: no row-count hint, so the bounded path runs)."""
    return rank_in_network(_ledger(spark, sf_dir).clean).select("tx_id", "network", "amount", "rank_in_network")


@register("w5_group_median_column", """
SELECT d.tx_id, d.tx_type, m.median_amount FROM dedup d LEFT JOIN med m ON d.tx_type = m.tx_type""")
def q_w5(spark, sf_dir):
    return (group_median_column(_ledger(spark, sf_dir).deduped, "tx_type", "amount", "median_amount")
            .select("tx_id", "tx_type", "median_amount"))


# ---- star schema and 3NF (D1-D6, O1-O3) -----------------------------------------------------

@register("d1_dim_date", "SELECT * FROM dim_date")
def q_d1(spark, sf_dir):
    return _ledger(spark, sf_dir).dim_date


@register("d2_dim_wallet", """
SELECT wallet_key, wallet_address, kyc_verified, country_code, CAST(risk_score AS DOUBLE) AS risk_score
FROM dim_wallet""")
def q_d2(spark, sf_dir):
    return _ledger(spark, sf_dir).dim_wallet.select("wallet_key", "wallet_address", "kyc_verified", "country_code",
                                                   F.col("risk_score").cast("double").alias("risk_score"))


@register("d6_surrogate_keys", """
SELECT row_number() OVER (ORDER BY tx_id) AS row_key, tx_id FROM clean""")
def q_d6(spark, sf_dir):
    """D6 over a large table: dense keys in tx_id order, numbered by ranges."""
    return surrogate_keys(_ledger(spark, sf_dir).clean.select("tx_id"), "tx_id", "row_key").select("row_key", "tx_id")


@register("d3_dim_tx_type", "SELECT * FROM dim_tx_type")
def q_d3(spark, sf_dir):
    return _ledger(spark, sf_dir).dim_tx_type


@register("d4_dim_network", "SELECT * FROM dim_network")
def q_d4(spark, sf_dir):
    return _ledger(spark, sf_dir).dim_network


FACT_OUT = ("fact_id", "tx_id", "tx_hash", "date_key", "sender_key", "receiver_key", "tx_type_key", "network_key",
            "block_id", "amount", "fee", "amount_usd", "is_anomaly", "status")


@register("d5_fact_transactions", """
SELECT fact_id, tx_id, tx_hash, date_key, sender_key, receiver_key, tx_type_key, network_key, block_id,
       CAST(amount AS DOUBLE) AS amount, CAST(fee AS DOUBLE) AS fee, CAST(amount_usd AS DOUBLE) AS amount_usd,
       is_anomaly, status
FROM fact""")
def q_d5(spark, sf_dir):
    f = _ledger(spark, sf_dir).fact
    return f.select(*[F.col(c).cast("double").alias(c) if c in ("amount", "fee", "amount_usd") else c
                      for c in FACT_OUT])


@register("o1_wallets", """
SELECT wallet_id, wallet_address, kyc_verified, country_code, CAST(risk_score AS DOUBLE) AS risk_score, created_at
FROM wallets_3nf""")
def q_o1(spark, sf_dir):
    w = _ledger(spark, sf_dir).wallets_3nf
    return w.withColumn("risk_score", F.col("risk_score").cast("double"))


@register("o2_blocks", """
SELECT block_id, block_hash, miner_address, CAST(reward AS DOUBLE) AS reward, tx_count, created_at FROM blocks_3nf""")
def q_o2(spark, sf_dir):
    return _ledger(spark, sf_dir).blocks_3nf.withColumn("reward", F.col("reward").cast("double"))


@register("o3_transactions", """
SELECT tx_id, tx_hash, block_id, sender_id, receiver_id, CAST(amount AS DOUBLE) AS amount,
       CAST(fee AS DOUBLE) AS fee, tx_type, status, network, created_at FROM transactions_3nf""")
def q_o3(spark, sf_dir):
    t = _ledger(spark, sf_dir).transactions_3nf
    return t.withColumns({"amount": F.col("amount").cast("double"), "fee": F.col("fee").cast("double")})


# ---- analytical queries (Q1-Q5, J2, J3, L1, L2, T1, T2) --------------------------------------

@register("q1_confirmed_per_day", """
SELECT day AS full_date, count(*) AS tx_count, CAST(sum(paid) AS DOUBLE) AS total_volume,
       CAST(sum(charged) AS DOUBLE) / count(charged) AS avg_fee
FROM (SELECT CAST("timestamp" AS DATE) AS day, CAST(amount AS DECIMAL(18,8)) AS paid,
             CAST(fee AS DECIMAL(18,8)) AS charged FROM validated WHERE status = 'CONFIRMED')
GROUP BY day""")
def q_q1(spark, sf_dir):
    L = _ledger(spark, sf_dir)
    return Q.q1_confirmed_per_day(L.fact, L.dim_date)


@register("q2_top_wallets", """
SELECT p.sender AS wallet_address, m.country AS country_code, p.n AS tx_count, CAST(p.paid AS DOUBLE) AS total_sent,
       CAST(p.charged AS DOUBLE) AS total_fees
FROM (SELECT sender, count(*) AS n, sum(CAST(amount AS DECIMAL(18,8))) AS paid, sum(CAST(fee AS DECIMAL(18,8))) AS charged
      FROM validated WHERE status = 'CONFIRMED' AND sender IS NOT NULL GROUP BY sender) p
LEFT JOIN ledger_wallets m ON m.wallet_address = p.sender
ORDER BY p.paid DESC, p.sender LIMIT 10""")
def q_q2(spark, sf_dir):
    L = _ledger(spark, sf_dir)
    return Q.q2_top_wallets(L.fact, L.dim_wallet)


@register("q3_running_volume_rank", """
SELECT a.day AS full_date, a.network, CAST(a.vol AS DOUBLE) AS daily_volume,
       CAST(sum(b.vol) FILTER (b.day <= a.day) AS DOUBLE) AS running_volume,
       CAST(1 + count(*) FILTER (b.vol > a.vol) AS BIGINT) AS volume_rank
FROM (SELECT CAST("timestamp" AS DATE) AS day, network, sum(CAST(amount AS DECIMAL(18,8))) AS vol FROM validated
      WHERE network IS NOT NULL GROUP BY ALL) a
JOIN (SELECT CAST("timestamp" AS DATE) AS day, network, sum(CAST(amount AS DECIMAL(18,8))) AS vol FROM validated
      WHERE network IS NOT NULL GROUP BY ALL) b ON a.network = b.network
GROUP BY a.day, a.network, a.vol""")
def q_q3(spark, sf_dir):
    L = _ledger(spark, sf_dir)
    return Q.q3_running_volume(L.fact, L.dim_date, L.dim_network)


@register("q4_high_risk_senders", """
SELECT v.tx_hash, CAST(CAST(v.amount AS DECIMAL(18,8)) AS DOUBLE) AS amount, v.status, CAST(m.risk AS DOUBLE) AS risk_score
FROM validated v, (SELECT wallet_address, CAST(risk_score AS DECIMAL(5,2)) AS risk FROM ledger_wallets) m
WHERE m.wallet_address = v.sender AND m.risk > 7.0 AND v.status <> 'FAILED'""")
def q_q4(spark, sf_dir):
    L = _ledger(spark, sf_dir)
    return Q.q4_high_risk_senders(L.fact, L.dim_wallet)


Q5_ORACLE = """
SELECT k.wallet_key AS sender_key, now.day AS full_date, now.n AS daily_tx_count, before.n AS prev_day_count,
       round(CAST(now.n - before.n AS DOUBLE) / CAST(before.n AS DOUBLE) * 100, 2) AS pct_change
FROM (SELECT sender, day, n, row_number() OVER (PARTITION BY sender ORDER BY day) AS place
      FROM (SELECT sender, CAST("timestamp" AS DATE) AS day, count(*) AS n FROM validated GROUP BY ALL)) now
JOIN (SELECT sender, n, 1 + row_number() OVER (PARTITION BY sender ORDER BY day) AS place
      FROM (SELECT sender, CAST("timestamp" AS DATE) AS day, count(*) AS n FROM validated GROUP BY ALL)) before
  ON now.sender IS NOT DISTINCT FROM before.sender AND now.place = before.place
LEFT JOIN dim_wallet k ON k.wallet_address = now.sender
WHERE now.n > 3 * before.n"""


@register("q5_daily_spike", Q5_ORACLE)
def q_q5(spark, sf_dir):
    L = _ledger(spark, sf_dir)
    return Q.q5_daily_spike(L.fact, L.dim_date)


@register("q5_daily_spike_sql", Q5_ORACLE)
def q_q5_sql(spark, sf_dir):
    """Q5 as Spark SQL text with a CTE chain over temp views."""
    L = _ledger(spark, sf_dir)
    return Q.q5_daily_spike_sql(L.fact, L.dim_date)


# ---- streaming (ST1-ST6, S4, S5, K4, K5) -----------------------------------------------------

@register("st5_event_build", """
SELECT tx_hash, sender, receiver, amount, fee, status, network, "timestamp" FROM stream_events""")
def q_st5(spark, sf_dir):
    return ST.build_events(ledger_raw0(read_table(spark, sf_dir, "events")))


@register("st6_batch_enrich", "SELECT tx_hash, amount, status, flag, network FROM stream_enriched")
def q_st6(spark, sf_dir):
    ev = ST.build_events(ledger_raw0(read_table(spark, sf_dir, "events")))
    return ST.enrich_events(ev).select("tx_hash", "amount", "status", "flag", "network")


@register("k5_kafka_records", """
SELECT network AS key, tx_hash, sender, receiver, CAST(amount AS VARCHAR) AS amount_text, fee, status, network, "timestamp"
FROM stream_events""")
def q_k5(spark, sf_dir):
    """K5 + S4 payload: keyed JSON records, parsed back with the event schema (amount as text)."""
    ev = ST.build_events(ledger_raw0(read_table(spark, sf_dir, "events")))
    parsed = ST.parse_kafka_records(ST.to_kafka_records(ev))
    return parsed.select("key", "tx_hash", "sender", "receiver", F.col("amount").alias("amount_text"), "fee", "status", "network", "timestamp")


def _sequenced(records: DataFrame) -> DataFrame:
    parsed = ST.parse_kafka_records(records.select("key", "value", "seq"), ["seq"])
    return parsed.select("key", "seq", "tx_hash", F.col("amount").cast("double").alias("amount"), "timestamp")


@register("st4_key_order", """
SELECT network AS key, row_number() OVER (PARTITION BY network ORDER BY "timestamp" NULLS FIRST, tx_hash NULLS FIRST) AS seq, tx_hash, amount, "timestamp"
FROM stream_events""")
def q_st4_order(spark, sf_dir):
    """ST4: every event published in order inside its network, written to ordered files and read back with its number."""
    path = work_dir(spark, "ordered-topic")
    ST.write_ordered_files(ST.to_ordered_records(ST.build_events(ledger_raw0(read_table(spark, sf_dir, "events")))), path)
    return _sequenced(spark.read.schema("key string, value string, seq bigint").json(path))


@register("st4_ready_records", """
SELECT key, seq, tx_hash, amount, "timestamp" FROM (
  SELECT *, min(CASE WHEN tx_hash LIKE '%77' THEN seq END) OVER (PARTITION BY key) AS missing FROM (
    SELECT network AS key, row_number() OVER (PARTITION BY network ORDER BY "timestamp" NULLS FIRST, tx_hash NULLS FIRST) AS seq,
           tx_hash, amount, "timestamp" FROM stream_events))
WHERE missing IS NULL OR seq < missing""")
def q_st4_ready(spark, sf_dir):
    """ST4's merge rule on a stand-in topic that has delivered everything twice but the events whose hashes end with 77: what
    a consumer may release, in every network up to its first missing record."""
    sent = stage_table(ST.to_ordered_records(ST.build_events(ledger_raw0(read_table(spark, sf_dir, "events")))), "sent")
    arrived = sent.where(~F.coalesce(F.get_json_object("value", "$.tx_hash").endswith("77"), F.lit(False)))
    return _sequenced(ST.ready_records(arrived.unionByName(arrived)))


def _torn_messages(spark, sf_dir) -> DataFrame:
    """A stand-in topic: every event as a JSON message (key, value); those of hashes that end with 7 are cut in the
    middle, as a producer that broke off would leave them."""
    records = ST.to_kafka_records(ST.build_events(ledger_raw0(read_table(spark, sf_dir, "events"))))
    torn = F.get_json_object("value", "$.tx_hash").endswith("7")
    return records.withColumn("value", F.when(torn, F.expr("substr(value, 1, length(value) div 2)")).otherwise(F.col("value")))


def _record_hash():
    return F.regexp_extract(F.col("record"), '"tx_hash":"([^"]*)"', 1).alias("tx_hash")


@register("s4_corrupt_records", """
SELECT CASE WHEN tx_hash LIKE '%7' THEN 'corrupt' ELSE 'event' END AS kind, tx_hash,
       CASE WHEN tx_hash LIKE '%7' THEN NULL ELSE amount END AS amount, CASE WHEN tx_hash LIKE '%7' THEN NULL ELSE status END AS status
FROM stream_enriched""")
def q_s4(spark, sf_dir):
    """Messages parsed and enriched; a torn one is a corrupt record and no payment of 0."""
    parsed = ST.parse_kafka_records(_torn_messages(spark, sf_dir))
    good = ST.enrich_events(parsed.where(F.col(ST.CORRUPT).isNull()))
    bad = parsed.where(F.col(ST.CORRUPT).isNotNull()).withColumnRenamed(ST.CORRUPT, "record")
    nothing = F.lit(None)
    return good.select(F.lit("event").alias("kind"), "tx_hash", "amount", "status").unionByName(
        bad.select(F.lit("corrupt").alias("kind"), _record_hash(), nothing.cast("double").alias("amount"), nothing.cast("string").alias("status")))


@register("st1_warehouse_stream", """
SELECT 'event' AS kind, tx_hash, amount, status, flag, day AS date_key FROM (
  SELECT e.*, CAST(replace(substr(s."timestamp", 1, 10), '-', '') AS INTEGER) AS day FROM stream_enriched e JOIN stream_events s USING (tx_hash))
WHERE tx_hash NOT LIKE '%7'
UNION ALL SELECT 'corrupt', tx_hash, NULL, NULL, NULL, NULL FROM stream_events WHERE tx_hash LIKE '%7'""")
def q_st1_warehouse(spark, sf_dir):
    """ST1 -> K7: message files streamed into the warehouse by date, two files a micro-batch; the second run of the stream
    finds nothing."""
    base = work_dir(spark, "stream-warehouse")
    _torn_messages(spark, sf_dir).select("value").repartition(5).write.text(f"{base}/in")
    for _ in range(2):
        ST.stream_into_warehouse(ST.read_event_stream(spark, f"{base}/in", max_files_per_trigger=2), f"{base}/events", f"{base}/checkpoint")
    names = ["tx_hash", "amount", "status", "flag", "date_key"]
    rows = warehouse.read_loads(spark, f"{base}/events").select(F.lit("event").alias("kind"), *names)
    bad = spark.read.parquet(f"{base}/events_corrupt").select(F.lit("corrupt").alias("kind"), _record_hash(), *[
        F.lit(None).cast(rows.schema[n].dataType).alias(n) for n in names[1:]])
    return rows.unionByName(bad)


@register("st2_bounded", "SELECT tx_hash, amount, status, flag, network FROM stream_enriched")
def q_st2(spark, sf_dir):
    """ST2: the events taken in four runs of at most a third of the messages each; the last one takes what is left."""
    base = work_dir(spark, "bounded")
    events = ST.build_events(ledger_raw0(read_table(spark, sf_dir, "events")))
    third = events.count() // 3
    ST.write_event_files(events, f"{base}/in", max(1, min(third, ST.FILE_ROWS)))
    taken = [ST.consume_bounded(spark, f"{base}/in", f"{base}/out", f"{base}/place", third) for _ in range(4)]
    if taken[:3] != [third] * 3 or taken[3] > 2:
        raise AssertionError(f"runs of {third} messages took {taken}")
    out = spark.read.schema("tx_hash string, amount double, status string, flag string, network string").json(f"{base}/out")
    return out.select("tx_hash", "amount", "status", "flag", "network")


@register("st1_stream_enrich", "SELECT tx_hash, amount, status, flag, network FROM stream_enriched")
def q_st1(spark, sf_dir):
    """S5 -> ST1 -> K4 with ST2 (availableNow) and ST3 (checkpoint): run twice on the same
    checkpoint; the second run adds no rows."""
    base = work_dir(spark, "stream")
    src, sink, ckpt = f"{base}/in", f"{base}/out", f"{base}/checkpoint"
    ST.write_event_files(ST.build_events(ledger_raw0(read_table(spark, sf_dir, "events"))), src)
    for _ in range(2):
        ST.run_enrich_stream(ST.read_event_stream(spark, src), sink, ckpt)
    out = spark.read.schema("tx_hash string, sender string, receiver string, amount double, fee double, "
                            "status string, network string, timestamp string, flag string").json(sink)
    return out.select("tx_hash", "amount", "status", "flag", "network")


@register("s5_array_stream", "SELECT tx_hash, amount, status, flag, network FROM stream_enriched")
def q_s5_array(spark, sf_dir):
    """S5 on the array form: files that each hold one JSON array of events."""
    base = work_dir(spark, "stream-array")
    src, sink, ckpt = f"{base}/in", f"{base}/out", f"{base}/checkpoint"
    events = ledger_raw0(read_table(spark, sf_dir, "events"))
    io.write_json_arrays(ST.build_events(events), src)
    ST.run_enrich_stream(ST.read_event_stream(spark, src, multiline=True), sink, ckpt)
    out = spark.read.schema("tx_hash string, amount double, status string, flag string, network string").json(sink)
    return out.select("tx_hash", "amount", "status", "flag", "network")


def queries() -> dict[str, Builder]:
    return {name: fn for name, (fn, _) in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: q for name, (_, q) in REGISTRY.items() if q}
