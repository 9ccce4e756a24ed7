"""What the loads, the deduplication and the streams move and write for each row."""

import datetime as dt
import glob
from types import SimpleNamespace

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerline import session
from ledgerline.functions.columns import pack_hex, unpack_hex
from ledgerline.operators import normalize
from ledgerline.operators.clean import dedupe_first
from ledgerline.plans import catalog
from ledgerline.plans.stages import Ledger
from ledgerline.sources import json_arrays as J
from ledgerline.sources import tables
from ledgerline.sources import warehouse as WH

T0 = dt.datetime(2024, 1, 1)
HASHES = ["0x" + "0123456789abcdef" * 4, "0x" + "0123456789ABCDEF" * 4, "0xdead12", "0xdead1", "0x", "0", "", "é0xab", "0xzz", "0x00\x01", None]
RAW = ("tx_id long, tx_hash string, block_id long, sender string, receiver string, amount double, fee double, tx_type string, status string, "
       "timestamp timestamp_ntz, network string")


def raw(spark, n=40):
    return spark.createDataFrame([(i, f"0x{i % 30:064x}", 1, "s", f"r{i % 4}", float(i + 1), 0.1, "T", "CONFIRMED", T0 + dt.timedelta(hours=i), "n") for i in range(n)], RAW)


@pytest.fixture
def written(monkeypatch):
    """The names of the stage and scratch tables that are made."""
    names, make = [], session.work_dir
    monkeypatch.setattr(session, "work_dir", lambda spark, name: names.append(name) or make(spark, name))
    return names


def test_packed_texts_come_back(spark):
    df = spark.createDataFrame([(h,) for h in HASHES], "h string").withColumn("p", pack_hex("h")).withColumn("u", unpack_hex("p"))
    rows = df.collect()
    assert [r.u for r in rows] == HASHES
    assert len({bytes(r.p) for r in rows if r.p is not None}) == len(HASHES) - 1
    assert len(rows[0].p) == 33


def test_a_hash_is_shuffled_in_half_its_bytes(spark):
    once = dedupe_first(raw(spark))
    assert sorted((r.tx_id, r.tx_hash) for r in once.collect()) == [(i, f"0x{i:064x}") for i in range(30)]
    shuffled = [line for line in once._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]
    assert shuffled and all("tx_hash" not in line for line in shuffled)
    assert once._jdf.queryExecution().optimizedPlan().toString().count("unhex") >= 1


def test_stage_tables_of_the_ledger_are_small(spark):
    wallets = spark.createDataFrame([("s", True, "IN", 1.0)], "wallet_address string, kyc_verified boolean, country string, risk_score double")
    L = Ledger(spark, raw=raw(spark), wallets=wallets)
    for table in (L.deduped, L.clean, L.validated):
        for f in table.inputFiles():
            group = pq.ParquetFile(f.removeprefix("file://")).metadata.row_group(0)
            assert {group.column(i).compression for i in range(group.num_columns)} == {"ZSTD"}


def test_a_load_writes_its_batch_once(spark, tmp_path, written):
    path = str(tmp_path / "fact")
    batch = spark.createDataFrame([(1, HASHES[0], 1, 1.0), (2, HASHES[0], 1, 2.0), (3, "b", 2, 1.0)] + [(4, None, 2, 5.0)] * 3 + [(5, None, None, -0.0)],
                                  "tx_id long, tx_hash string, date_key int, amount double")
    for _ in range(2):
        assert WH.load_by_date(batch, path, "x") == WH.LoadResult(2, 1, 4)
    assert written == ["scratch-load-batch"] * 2
    assert sorted((r.tx_id, r.tx_hash, r.date_key) for r in WH.read_loads(spark, path).collect()) == [(1, HASHES[0], 1), (3, "b", 2)]
    bad = WH.read_loads(spark, f"{path}_rejected")
    assert sorted((r.tx_id, r.tx_hash, r.amount) for r in bad.collect()) == [(4, None, 5.0)] * 3 + [(5, None, 0.0)]
    assert WH.load_by_date(batch, path, "y") == WH.LoadResult(0, 3, 4)


def test_many_equal_rejects_all_stay(spark, tmp_path):
    batch = spark.range(2 * WH.REPEATS + 5).select(F.lit(None).cast("string").alias("tx_hash"), F.lit(1).alias("date_key"), F.lit(2.0).alias("amount"))
    assert WH.load_by_date(batch, str(tmp_path / "t"), "x") == WH.LoadResult(0, 0, 2 * WH.REPEATS + 5)


def test_a_bucketed_load_needs_no_scratch_table(spark, tmp_path, written):
    rows = raw(spark).select("tx_id", "tx_hash", F.date_format("timestamp", "yyyyMMdd").cast("int").alias("date_key"))
    tables.create_table(spark, "growth_fact", rows.schema, str(tmp_path / "t"), buckets=4)
    try:
        assert [tables.append_new_rows(rows.where("tx_id < 20"), "growth_fact"), tables.append_new_rows(rows, "growth_fact"), tables.append_new_rows(rows, "growth_fact")] == [20, 10, 0]
        assert written == [] and sorted(r.tx_id for r in spark.table("growth_fact").collect()) == list(range(30))
    finally:
        spark.sql("DROP TABLE growth_fact")


def test_rapid_repeats_sort_only_their_columns(spark, monkeypatch):
    staged, stage = [], normalize.stage_table
    monkeypatch.setattr(normalize, "stage_table", lambda df, *a: staged.append(df.columns) or stage(df, *a))
    rows = raw(spark).withColumn("timestamp", F.lit(T0).cast("timestamp_ntz"))
    monkeypatch.setattr(catalog, "_ledger", lambda spark, sf_dir: SimpleNamespace(validated=rows))
    assert catalog.q_n5_1s(spark, "").count() == 36
    assert set(staged[0]) == {"tx_id", "sender", "receiver", "timestamp", "_t", "_range"}


def test_more_messages_are_more_files(spark, monkeypatch):
    events = spark.createDataFrame([(i, T0, i, "click", 1.0, "") for i in range(90)], "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    at, make = [], catalog.work_dir
    monkeypatch.setattr(catalog, "work_dir", lambda spark, name: at.append(make(spark, name)) or at[-1])
    monkeypatch.setattr(catalog, "read_table", lambda *a: events.coalesce(1))
    monkeypatch.setattr(catalog.ST, "FILE_ROWS", 10)
    assert catalog.q_st2(spark, "").count() == 90
    assert len(glob.glob(f"{at[0].removeprefix('file:')}/in/*.json")) == 9


def test_pieces_of_an_array_are_joined_by_arrow(spark, tmp_path):
    batch = pa.RecordBatch.from_pydict({"value": ["[1", "2", "3]", "[4", "5]"], "file": ["a", "a", "a", "b", "b"], "block": [0, 0, 9, 9, 9]})
    assert list(J._chunks(iter([batch]))) == [("a", 0, b"[1,2,"), ("a", 9, b"3],"), ("b", 9, b"[4,5],")]
    (tmp_path / "a.json").write_text('[{"a":"x,y"}, {"a":"]"}]')
    found = J.elements(J.comma_text(spark, str(tmp_path)))
    # the elements inside a split bring no place of their own
    assert "MapInArrow whole" in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.value for r in found.collect()) == ['{"a":"]"}', '{"a":"x,y"}']
