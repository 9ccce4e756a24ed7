"""Event enrich (batch = stream), restart from a checkpoint, and file round trips."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from ledgerline.sources import io
from ledgerline.sources.ledger_views import load_ledger
from ledgerline.streaming import events as ST

from conftest import SF_SMALL

EDGE = [("h1", "-1"), ("h2", "60.5"), ("h3", "5"), ("h4", None), ("h5", "abc"), ("h6", "NaN"), ("h7", "50")]


def _edge_events(spark):
    return spark.createDataFrame([(h, "0xs", "0xr", a, 0.1, "PENDING", "mainnet", "2024-01-01T00:00:00")
                                  for h, a in EDGE], ST.EVENT)


def test_enrich_edge_amounts(spark):
    got = {r.tx_hash: (r.amount, r.status, r.flag) for r in ST.enrich_events(_edge_events(spark)).collect()}
    assert got == {"h1": (0.0, "INVALID", None), "h2": (60.5, "PENDING", "HIGH_VALUE"), "h3": (5.0, "PENDING", None),
                   "h4": (0.0, "INVALID", None), "h5": (0.0, "INVALID", None), "h6": (0.0, "INVALID", None),
                   "h7": (50.0, "PENDING", None)}


def test_stream_equals_batch_and_restart_adds_nothing(spark):
    base = tempfile.mkdtemp(prefix="ledgerline-stream-")
    src, sink, ckpt = f"{base}/in", f"{base}/out", f"{base}/ckpt"
    os.makedirs(src)
    # a JSON array document (the reference's file form) and JSON lines with a missing amount
    with open(f"{src}/a.json", "w") as f:
        f.write("\n".join(json.dumps({"tx_hash": h, "sender": "0xs", "receiver": "0xr", "amount": a, "fee": 0.1,
                                      "status": "PENDING", "network": "mainnet"}) for h, a in EDGE[:4]))
    with open(f"{src}/b.json", "w") as f:
        f.write("\n".join(json.dumps({"tx_hash": h, "amount": a, "status": "PENDING"}) for h, a in EDGE[4:]))
        f.write("\n" + json.dumps({"tx_hash": "h8", "status": "PENDING"}))
    ST.run_enrich_stream(ST.read_event_stream(spark, src), sink, ckpt)
    first = spark.read.json(sink).count()
    ST.run_enrich_stream(ST.read_event_stream(spark, src), sink, ckpt)
    out = spark.read.json(sink)
    assert first == out.count() == 8
    got = {r.tx_hash: (r.amount, r.status) for r in out.collect()}
    assert got["h2"] == (60.5, "PENDING") and got["h8"] == (0.0, "INVALID")


def test_json_array_metadata(spark):
    path = tempfile.mkdtemp(prefix="ledgerline-md-") + "/wallets.json"
    with open(path, "w") as f:
        json.dump([{"wallet_address": "0xa", "kyc_verified": True, "country": "IN", "risk_score": 2.5},
                   {"wallet_address": "0xb", "kyc_verified": False, "country": "US", "risk_score": 7}], f, indent=2)
    rows = io.read_wallet_metadata(spark, path).orderBy("wallet_address").collect()
    assert [(r.wallet_address, r.risk_score) for r in rows] == [("0xa", 2.5), ("0xb", 7.0)]


def test_csv_round_trip_keeps_padding(spark):
    raw = load_ledger(spark, SF_SMALL)[0]
    path = tempfile.mkdtemp(prefix="ledgerline-csv-") + "/raw"
    io.write_transactions_csv(raw, path)
    back = io.read_transactions_csv(spark, path)
    assert back.exceptAll(raw).count() == 0 and raw.exceptAll(back).count() == 0


def test_load_twice_is_idempotent(spark):
    raw = load_ledger(spark, SF_SMALL)[0].dropDuplicates(["tx_hash"])
    path = tempfile.mkdtemp(prefix="ledgerline-wh-") + "/fact"
    n1 = io.append_new(raw, path)
    n2 = io.append_new(raw, path)
    assert n1 == raw.count() and n2 == 0 and spark.read.parquet(path).count() == n1


def test_kafka_records_round_trip(spark):
    ev = ST.build_events(load_ledger(spark, SF_SMALL)[0])
    rec = ST.to_kafka_records(ev)
    assert rec.count() == ev.count() and rec.where(F.col("key").isin("mainnet", "testnet")).count() == ev.count()
    back = ST.parse_kafka_records(rec)
    assert back.where(F.col("key") != F.col("network")).count() == 0


def test_csv_nan_text_is_null(spark):
    path = tempfile.mkdtemp(prefix="ledgerline-csvnan-") + "/t.csv"
    with open(path, "w") as f:
        f.write("tx_id,tx_hash,block_id,sender,receiver,amount,fee,tx_type,status,timestamp,network\n")
        f.write("1,0xa,1,0xs,0xr,NaN,0.1,TRANSFER,CONFIRMED,2024-01-01 00:00:01,mainnet\n")
        f.write("2,0xb,1,0xs,0xr,,0.1,TRANSFER,CONFIRMED,2024-01-01 00:00:02,mainnet\n")
        f.write("3,0xc,1,0xs,0xr,2.5,0.1,TRANSFER,CONFIRMED,2024-01-01 00:00:03.250000,mainnet\n")
    rows = {r.tx_id: (r.amount, r.timestamp) for r in io.read_transactions_csv(spark, path).collect()}
    assert rows[1][0] is None and rows[2][0] is None and rows[3][0] == 2.5
    assert rows[3][1].microsecond == 250000 and rows[1][1].second == 1


def test_json_arrays_are_bounded_by_rows(spark, tmp_path, monkeypatch):
    import json

    import pyspark.sql.functions as F

    from ledgerline.plans import catalog
    from ledgerline.sources import io

    monkeypatch.setattr(io, "ARRAY_ROWS", 7)
    same = spark.range(1000, numPartitions=3).select(F.lit("one hash").alias("tx_hash"), F.col("id").alias("n"))
    for size, path in ((100, "few"), (1000, "many")):
        io.write_json_arrays(same.where(F.col("n") < size), str(tmp_path / path))
        arrays = [json.loads(f.read_text()) for f in (tmp_path / path).glob("part-*") if f.stat().st_size]
        assert max(map(len, arrays)) <= 7 and len(arrays) >= size / 7
        assert sorted(r["n"] for a in arrays for r in a) == list(range(size))
    folders = []
    monkeypatch.setattr(catalog, "work_dir", lambda _, name: folders.append(f"{tmp_path}/{name}") or folders[-1])
    for name, written in (("s2_json_array_scan", "s2-json-array"), ("s5_array_stream", "stream-array/in")):
        catalog.queries()[name](spark, "/root/testdata/sf0.001").count()
        arrays = [json.loads(f.read_text()) for f in (tmp_path / written).glob("part-*") if f.stat().st_size]
        assert arrays and max(map(len, arrays)) <= 7
