"""Reject paths of the sources, the stream into the warehouse, and runs bounded by messages."""

import json

import pytest
from pyspark.sql import functions as F

from ledgerline.sources import io
from ledgerline.sources.warehouse import read_loads
from ledgerline.streaming import events as ST

HEADER = "tx_id,tx_hash,block_id,sender,receiver,amount,fee,tx_type,status,timestamp,network\n"
TAIL = "0.1,T,CONFIRMED,2024-01-01 00:00:01,mainnet"
LINES = {
    "1,h1,1,s,r,1.5," + TAIL: None,
    "2,h2,1,s,r,1;5," + TAIL: "amount",
    "x,h3,1,s,r,1.5," + TAIL: "tx_id",
    ",h4,1,s,r,1.5," + TAIL: "tx_id",
    "5,h5,1,s,r,1.5,0.1,T,CONFIRMED,yesterday,mainnet": "timestamp",
    "6,h6,1,s,r,1.5,0.1,T,CONFIRMED,2024-01-01 00:00:01": "number of fields",
    "7,h7,1,s,r,1.5,0.1,T,CONFIRMED,2024-01-01 00:00:01,mainnet,more": "number of fields",
    "8,h8,b,s,r,abc,,T,CONFIRMED,,mainnet": "block_id, amount",
    "9,h9,,s,r,NA,NaN,T,CONFIRMED,,": None,
}


def test_bad_lines_are_rejected_and_none_is_imputed(spark, tmp_path):
    (tmp_path / "in.csv").write_text(HEADER + "\n".join(LINES) + "\n")
    good, counts = io.ingest_transactions_csv(spark, str(tmp_path / "in.csv"), str(tmp_path / "out"))
    assert counts == {"good": 2, "rejected": 7}
    assert [(r.tx_id, r.amount, r.fee, r.timestamp is None) for r in good.orderBy("tx_id").collect()] == [(1, 1.5, 0.1, False), (9, None, None, True)]
    bad = spark.read.parquet(str(tmp_path / "out")).where("kind = 'rejected'").collect()
    assert {r.tx_hash: r.reject_reason for r in bad} == {line.split(",")[1]: why for line, why in LINES.items() if why}
    assert all(r.record.split(",")[1] == r.tx_hash for r in bad)
    plain = io.read_transactions_csv(spark, str(tmp_path / "in.csv"))
    assert plain.count() == 2 and plain.select("amount").count() == 2 and [r.network for r in plain.select("network").orderBy("network").collect()] == [None, "mainnet"]
    odd = tmp_path / "odd.csv"
    odd.write_text(HEADER + "1,h1,1,s,r,1.5,0.1,T,CONFIRMED,01/02/2024,mainnet\n2,h2,1,s,r,1.5,0.1,T,CONFIRMED,2024-01-01,mainnet\n")
    rows = io.scan_transactions_csv(spark, str(odd), timestamp_format="dd/MM/yyyy").orderBy("tx_id").collect()
    assert rows[0].timestamp.month == 2 and rows[1].reject_reason == "timestamp"


EVENT = {"tx_hash": "h", "sender": "s", "receiver": "r", "amount": "60", "fee": 0.1, "status": "PENDING", "network": "mainnet", "timestamp": "2024-03-05T10:00:00"}


def test_values_that_are_no_events(spark):
    values = [json.dumps(EVENT), "{not json", None, "", "[1]", "7", json.dumps(EVENT | {"fee": "much"}), json.dumps({"tx_hash": "x"})]
    records = spark.createDataFrame([(b"k", v.encode() if v is not None else None) for v in values], "key binary, value binary")
    rows = ST.parse_kafka_records(records).collect()
    assert sorted(r[ST.CORRUPT] for r in rows if r[ST.CORRUPT] is not None) == sorted(["{not json", "", "", "[1]", "7", values[6]])
    assert sorted(r.tx_hash for r in rows if r[ST.CORRUPT] is None) == ["h", "x"]


def event_file(folder, name, hashes, extra=()):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([*[json.dumps(EVENT | {"tx_hash": h}) for h in hashes], *extra]) + "\n")


def test_stream_into_the_warehouse_and_a_replayed_batch(spark, tmp_path):
    src, path = tmp_path / "in", str(tmp_path / "wh")
    event_file(src, "a.json", ["a", "b", "b"], ["{torn", json.dumps(EVENT | {"tx_hash": None}), json.dumps(EVENT | {"tx_hash": "n", "timestamp": "?"})])
    run = lambda: ST.stream_into_warehouse(ST.read_event_stream(spark, str(src)), path, str(tmp_path / "ck"))
    query = run()
    # one read of the source gives good, rejected and corrupt records: six messages are six input rows
    assert sum(p.numInputRows for p in query.recentProgress) == 6

    def state():
        rows = sorted((r.tx_hash, r.date_key, r.flag, r.load_id) for r in read_loads(spark, path).collect())
        return rows, read_loads(spark, path + "_rejected").count(), [r.record for r in spark.read.parquet(path + "_corrupt").collect()]
    first = state()
    assert first == ([("a", 20240305, "HIGH_VALUE", "stream-0"), ("b", 20240305, "HIGH_VALUE", "stream-0"), ("n", None, "HIGH_VALUE", "stream-0")], 1, ["{torn"])
    # the batch runs again, as after a failure before its offsets were committed
    again = spark.read.schema(ST.read_event_stream(spark, str(src)).schema).option("columnNameOfCorruptRecord", ST.CORRUPT).json(str(src))
    ST.load_event_batch(again, 0, path)
    assert state() == first
    event_file(src, "b.json", ["b", "c"])
    run()
    run()
    assert [r[::3] for r in state()[0]] == [("a", "stream-0"), ("b", "stream-0"), ("c", "stream-1"), ("n", "stream-0")]


@pytest.mark.parametrize("split", [None, 300])
def test_bounded_runs_take_exactly_n(spark, tmp_path, split):
    import os

    src = tmp_path / "in"
    for k, name in enumerate(("z.json", "a.json", "m.json")):     # in the order of their time, not of their names
        event_file(src, name, [f"{name[0]}{i}" for i in range((7, 5, 9)[k])], ["{torn"] if k == 1 else ())
        os.utime(src / name, (1_700_000_000 + k, 1_700_000_000 + k))
    keys = {"spark.sql.files.maxPartitionBytes": split, "spark.sql.files.openCostInBytes": 1} if split else {}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        sink, place, got, order = str(tmp_path / "out"), str(tmp_path / "place"), [], []
        for n in (4, 4, 4, 1, 100, 3):
            got.append(ST.consume_bounded(spark, str(src), sink, place, n))
            if got[-1]:
                run = spark.read.schema("tx_hash string").json(f"{sink}/run={len(got)}")
                order.append(sorted(r.tx_hash for r in run.collect()))
        assert got == [4, 4, 4, 1, 9, 0]
        everything = [f"z{i}" for i in range(7)] + [f"a{i}" for i in range(5)] + ["torn"] + [f"m{i}" for i in range(9)]
        at = 0
        for n, rows in zip(got, order, strict=False):
            assert rows == sorted(x for x in everything[at:at + n] if x != "torn")
            at += n
        assert [r.record for r in spark.read.json(sink + "_corrupt").collect()] == ["{torn"]
        event_file(src, "b.json", ["late"])
        # a run whose place was never written takes the same messages again, into the same folder
        assert ST.consume_bounded(spark, str(src), sink, place, 5) == 1
        files = spark._jvm.org.apache.hadoop.fs.Path(f"{place}/run=6")
        files.getFileSystem(spark._jsc.hadoopConfiguration()).delete(files, True)
        assert ST.consume_bounded(spark, str(src), sink, place, 5) == 1 and ST.consume_bounded(spark, str(src), sink, place, 5) == 0
        assert spark.read.schema("tx_hash string").json(sink).where(F.col("tx_hash") == "late").count() == 1
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
