"""JSON arrays read by many tasks a file."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from ledgerline.sources import json_arrays as J

SCHEMA = T.StructType([T.StructField("a", T.StringType()), T.StructField("n", T.LongType()),
                       T.StructField("x", T.StructType([T.StructField("y", T.ArrayType(T.LongType()))]))])


def records(first, n=40):
    rnd = random.Random(first)
    return [{"a": "".join(rnd.choice('a,b"{}[]\\\n é😀:') for _ in range(rnd.randrange(25))), "n": first + i, "x": {"y": [i, i + 1]}} for i in range(n)]


FILES = {"indented": json.dumps(records(0), indent=2), "flat": json.dumps(records(1000)), "one": json.dumps(records(3000, 1)[0], indent=1),
         "plain": json.dumps(records(2000), ensure_ascii=False, separators=(",", ":")), "empty": "[]", "blank": " \n", "single": json.dumps(records(5000, 1)),
         "nested": json.dumps([{"n": 1, "x": {"y": []}}, {"n": 2, "x": None}, {"a": "]},{", "n": 3}])}
ODD = '[1, "x,y", {"n": 4000}, {"n":"bad"}, null, [1,2]]\n'


@pytest.fixture(params=[None, 700, 90])
def splits(spark, request):
    """Splits of the default size, and so small that every record is torn."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}
    if request.param:
        for key, value in zip(keys, (request.param, 1), strict=True):
            spark.conf.set(key, value)
    yield request.param
    for key, value in before.items():
        spark.conf.set(key, value)


def test_arrays_equal_the_plain_parser(spark, tmp_path, splits):
    for name, text in {**FILES, "odd": ODD}.items():
        (tmp_path / f"{name}.json").write_text(text)
    want = []
    for text in FILES.values():
        got = json.loads(text) if text.strip() else []
        want += [(r.get("n"), r.get("a"), (r.get("x") or {}).get("y")) for r in (got if isinstance(got, list) else [got])]
    rows = J.read_json_arrays(spark, str(tmp_path), SCHEMA).collect()
    key = lambda r: (r[0], str(r))
    good = [(r.n, r.a, r.x.y if r.x else None) for r in rows if r._corrupt_record is None]
    assert sorted(good, key=key) == sorted([*want, (4000, None, None)], key=key)
    assert sorted(r._corrupt_record for r in rows if r._corrupt_record) == sorted(["1", '"x,y"', '{"n":"bad"}', "null", "[1,2]"])


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    rows = [{"a": f"wallet, {i}", "n": i, "x": {"y": [1]}} for i in range(60_000)]
    path = tmp_path / "big.json"
    path.write_text(json.dumps(rows, indent=2))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 1 << 20)
    try:
        tokens = J.comma_text(spark, str(path))
        tasks = tokens.rdd.getNumPartitions()
        assert tasks >= path.stat().st_size // (1 << 20) > 4
        whole = J.read_json_arrays(spark, str(path), SCHEMA)
        assert whole.where("_corrupt_record IS NOT NULL").count() == 0
        assert sorted(r.n for r in whole.select("n").collect()) == list(range(60_000))
        one_task = spark.read.schema(SCHEMA).option("multiLine", True).json(str(path))
        assert one_task.exceptAll(whole.drop("_corrupt_record")).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_quotes_and_escapes():
    for text in (r'{"a":"\\"}', r'{"a":"\\\"}"}', r'"\\\\",[', 'ab"cd', r'x\"y"z'):
        for start in (False, True):
            inside, marks, escaped = start, [], False
            for c in text:
                was = inside
                if c == '"' and not escaped:
                    inside = not inside
                marks.append(not was and not inside)
                escaped = c == "\\" and not escaped
            outside, end = J._outside(np.frombuffer(text.encode(), np.uint8), start)
            assert outside.tolist() == marks and end == inside
