"""Order inside a key at publish, and the consumer's merge rule."""

import glob
import json
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.streaming import events as ST

SCHEMA = "tx_hash string, sender string, receiver string, amount double, fee double, status string, network string, timestamp string"


def _events(spark, n=600, seed=3):
    """Two thirds of one network, a burst at one instant, repeated rows, NULL times, hashes and networks."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        when = None if i % 50 == 0 else "2024-01-01T00:00:00.000000" if i % 3 == 0 else f"2024-01-{rnd.randint(1, 28):02d}T00:00:{rnd.randint(0, 59):02d}.000000"
        rows.append((None if i % 70 == 0 else f"h{i:04d}", "s", "r", float(i % 5), 0.1, "PENDING", None if i % 90 == 0 else rnd.choice(["eth", "eth", "btc"]), when))
    rows += rows[:40]
    rnd.shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def _nulls_first(*fields):
    return tuple((f is not None, f) if f is not None else (False,) for f in fields)


def test_sequence_equals_plain_sort(spark):
    events = _events(spark)
    got = {}
    for r in ST.to_ordered_records(events).collect():
        got.setdefault(r.key, []).append((r.seq, json.loads(r.value)))
    want = {}
    for r in events.collect():
        want.setdefault(r.network, []).append(_nulls_first(r.timestamp, r.tx_hash, r.sender, r.receiver, r.amount))
    assert got.keys() == want.keys()
    for key, records in got.items():
        records.sort(key=lambda x: x[0])
        assert [s for s, _ in records] == list(range(1, len(want[key]) + 1))
        fields = [_nulls_first(*[v.get(c) for c in ("timestamp", "tx_hash", "sender", "receiver", "amount")]) for _, v in records]
        assert fields == sorted(want[key])


def test_files_hold_each_key_in_order(spark, tmp_path):
    path = str(tmp_path / "topic")
    ST.write_ordered_files(ST.to_ordered_records(_events(spark)), path)
    files = sorted(glob.glob(f"{path}/part-*.json"))
    assert len(files) > 2
    last, hot = {}, set()
    for name in files:
        with open(name) as lines:
            for line in lines:
                r = json.loads(line)
                key = r.get("key")
                assert r["seq"] == last.get(key, 0) + 1
                last[key] = r["seq"]
                if key == "eth":
                    hot.add(name)
    assert sum(last.values()) == 640 and len(hot) > 1        # the hot key is spread over several tasks


def test_ready_records_wait_for_missing_ones(spark):
    records = ST.to_ordered_records(_events(spark)).withColumn("seq", F.col("seq"))
    rows = [(r.key, r.value, r.seq) for r in records.collect()]
    rnd = random.Random(5)
    lost = {(k, s) for k, _, s in rows if (k == "eth" and s in (7, 200)) or (k is None and s == 1)}
    arrived = [r for r in rows if (r[0], r[2]) not in lost] * 2
    rnd.shuffle(arrived)
    frame = spark.createDataFrame([*arrived, ("eth", "x", None), ("eth", "x", 0)], "key string, value string, seq bigint")
    got = sorted(((r.key, r.seq) for r in ST.ready_records(frame).collect()), key=repr)
    assert got == sorted([(k, s) for k, _, s in rows if (k == "btc") or (k == "eth" and s < 7)], key=repr)
    assert ST.ready_records(frame.where("false")).count() == 0
    whole = spark.createDataFrame(rows, "key string, value string, seq bigint")
    assert sorted(map(tuple, ST.ready_records(whole).collect()), key=repr) == sorted(rows, key=repr)


@pytest.mark.parametrize("rows", [0, 1])
def test_small_tables(spark, rows):
    events = _events(spark, 10).limit(rows)
    assert ST.to_ordered_records(events).count() == rows
