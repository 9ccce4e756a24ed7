"""Loads that can be rerun and keys that last."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.keys import extend_dimension
from ledgerline.plans.incremental import StarWarehouse
from ledgerline.sources import io
from ledgerline.sources import warehouse as WH

ROWS = "tx_id long, tx_hash string, date_key int, amount double"


def rows(spark, data):
    return spark.createDataFrame(data, ROWS)


def stored(spark, path):
    return sorted((r.tx_id, r.tx_hash, r.date_key, r.load_id) for r in WH.read_loads(spark, path).collect())


def test_three_runs_of_a_load_are_one(spark, tmp_path):
    path = str(tmp_path / "fact")
    batch = rows(spark, [(1, "a", 20240101, 1.0), (2, "a", 20240101, 2.0), (3, None, 20240101, 3.0), (4, "b", None, 4.0), (5, None, None, 5.0)])
    for _ in range(3):
        assert WH.load_by_date(batch, path, "x") == WH.LoadResult(2, 1, 2)
    assert stored(spark, path) == [(1, "a", 20240101, "x"), (4, "b", None, "x")]
    bad = WH.read_loads(spark, path + "_rejected")
    assert sorted((r.tx_id, r.reason, r.load_id) for r in bad.collect()) == [(3, "tx_hash is NULL", "x"), (5, "tx_hash is NULL", "x")]


def test_other_loads_stay_and_their_rows_are_skipped(spark, tmp_path):
    path = str(tmp_path / "fact")
    WH.load_by_date(rows(spark, [(1, "a", 1, 1.0), (2, "b", 2, 1.0), (7, "n", None, 1.0)]), path, "x")
    assert WH.load_by_date(rows(spark, [(3, "a", 1, 9.0), (4, "c", 1, 1.0), (8, "n", None, 1.0)]), path, "y") == WH.LoadResult(1, 2, 0)
    before = stored(spark, path)
    assert before == [(1, "a", 1, "x"), (2, "b", 2, "x"), (4, "c", 1, "y"), (7, "n", None, "x")]
    WH.load_by_date(rows(spark, [(1, "a", 1, 1.0), (2, "b", 2, 1.0), (7, "n", None, 1.0)]), path, "x")
    assert stored(spark, path) == before


def test_a_corrected_load_replaces_the_earlier_run(spark, tmp_path):
    path = str(tmp_path / "fact")
    WH.load_by_date(rows(spark, [(1, "a", 1, 1.0), (2, "b", 2, 1.0), (3, None, 2, 1.0), (4, "d", None, 1.0)]), path, "x")
    assert WH.load_by_date(rows(spark, [(5, "e", 3, 1.0), (1, "a", 1, 2.0)]), path, "x") == WH.LoadResult(2, 0, 0)
    assert stored(spark, path) == [(1, "a", 1, "x"), (5, "e", 3, "x")]
    assert WH.read_loads(spark, path + "_rejected") is None
    assert WH.load_by_date(rows(spark, []), path, "x") == WH.LoadResult(0, 0, 0) and WH.read_loads(spark, path) is None
    with pytest.raises(ValueError):
        WH.load_by_date(rows(spark, []), path, "2024")


def test_the_search_reads_only_the_batch_dates(spark, tmp_path):
    path = str(tmp_path / "fact")
    WH.load_by_date(spark.range(400).selectExpr("id AS tx_id", "concat('h', id) AS tx_hash", "cast(id % 40 as int) AS date_key", "1.0D AS amount"), path, "x")
    batch = rows(spark, [(500, "h3", 3, 1.0), (501, "new", 5, 1.0)])
    for limit in (1000, 1):                                     # a list of dates, and their range
        keep = WH.date_filter(batch, "date_key", limit)
        assert sorted(r[0] for r in spark.read.parquet(path).where(keep).select("date_key").distinct().collect()) == ([3, 5] if limit > 1 else [3, 4, 5])
    fresh = WH.fresh_rows(batch, WH.read_loads(spark, path), "y")
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "date_key" in plan.split("PartitionFilters: [")[1].split("]")[0]
    scan = [f for f in spark.read.parquet(path).where(WH.date_filter(batch, "date_key")).inputFiles()]
    assert len(scan) >= 1 and [r.tx_hash for r in fresh.collect()] == ["new"]
    files = spark.read.parquet(path).where(WH.date_filter(batch, "date_key")).select(F.input_file_name().alias("f")).distinct().collect()
    assert {f.f.split("date_key=")[1].split("/")[0] for f in files} == {"3", "5"} and len(os.listdir(path)) >= 40


def test_keys_last_over_loads(spark, tmp_path):
    path = str(tmp_path / "dim")
    make = lambda names: spark.createDataFrame([(n,) for n in names], "name string")
    assert {r.name: r.k for r in extend_dimension(path, make(["b", "d", None]), "name", "k").collect()} == {"b": 1, "d": 2}
    assert {r.name: r.k for r in extend_dimension(path, make(["a", "d", "c"]), "name", "k").collect()} == {"b": 1, "d": 2, "a": 3, "c": 4}
    again = extend_dimension(path, make(["a", "b"]), "name", "k")
    assert {r.name: r.k for r in again.collect()} == {"b": 1, "d": 2, "a": 3, "c": 4} and again.count() == 4
    assert extend_dimension(path, make([]), "name", "k").count() == 4


def test_star_warehouse_points_at_the_same_wallets(spark, tmp_path):
    schema = ("tx_id long, tx_hash string, block_id long, sender string, receiver string, amount double, fee double, "
              "tx_type string, status string, timestamp timestamp_ntz, network string")

    def batch(*data):
        return spark.createDataFrame([(i, f"h{i}", 1, s, r, 1.0, 0.1, "T", "CONFIRMED", dt.datetime(2024, 1, d), "mainnet") for i, s, r, d in data], schema)
    md = spark.createDataFrame([("m", True, "IN", 2.5)], "wallet_address string, kyc_verified boolean, country string, risk_score double")
    house = StarWarehouse(spark, str(tmp_path))
    house.load(batch((1, "m", "z", 1)), md, "one")
    house.load(batch((2, "a", "m", 1), (3, "z", "b", 2)), md, "two")
    house.load(batch((2, "a", "m", 1), (3, "z", "b", 2)), md, "two")
    names = {r.wallet_key: r.wallet_address for r in house.table("dim_wallet").collect()}
    assert names == {1: "m", 2: "z", 3: "a", 4: "b"}
    got = sorted((r.tx_id, names[r.sender_key], names[r.receiver_key], r.load_id) for r in house.table("fact_transactions").collect())
    assert got == [(1, "m", "z", "one"), (2, "a", "m", "two"), (3, "z", "b", "two")]
    assert [r.date_key for r in house.dim_date().orderBy("date_key").collect()] == [20240101, 20240102]


def test_plain_append_rejects_once(spark, tmp_path):
    path = str(tmp_path / "wh")
    batch = rows(spark, [(1, "a", 1, 1.0), (2, None, 1, 2.0), (2, None, 1, 2.0)])
    for _ in range(3):
        io.append_new(batch, path)
    assert spark.read.parquet(path).count() == 1 and spark.read.parquet(path + "_rejected").count() == 2
    io.append_new(rows(spark, [(9, None, 1, 2.0)]), path)
    assert spark.read.parquet(path + "_rejected").count() == 3
