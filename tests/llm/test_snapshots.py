"""Batches against kept snapshots, compared with plain Python sets."""

import glob
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from llm_fixtures import EDGE, edge, llm, make_docs  # noqa: F401
from ledgerline.llm import exact_dedup as X


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def expected(snapshots, rows):
    old = {}
    for snap in snapshots:
        for i, t in snap:
            old.setdefault(low(t), []).append(i)
    ids = {}
    for i, t in rows:
        ids.setdefault(low(t), []).append(i)
    top = lambda xs: max((x for x in xs if x is not None), default=None)
    return sorted(((i, low(t) in old, top(old.get(low(t), [])), top(ids[low(t)]), len(ids[low(t)]), low(t) not in old and i == top(ids[low(t)])) for i, t in rows), key=repr)


def answer(df):
    return sorted(((r.doc_id, r.in_snapshot, r.snapshot_id, r.keep_id, r.group_size, r.kept) for r in df.collect()), key=repr)


def weak(text):
    return F.substring(F.sha2(text.cast("binary"), 256), 1, 1)


def files(path):
    return {(f, os.path.getmtime(f), os.path.getsize(f)) for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


@pytest.mark.parametrize("digest, bucket_keys", [(X.sha256_key, X.BUCKET_KEYS), (X.sha256_key, 7), (weak, 3)])
def test_two_batches_against_one_snapshot(llm, make_docs, tmp_path, digest, bucket_keys):
    rnd = random.Random(bucket_keys)
    words = ["Alpha", "beta", "GAMMA", "É", "x" * 3000, ""]
    text = lambda: " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 3)))
    first, second, third = ([(rnd.randint(1, 90), text()) for _ in range(n)] for n in (60, 80, 50))
    path = str(tmp_path / "snapshot")
    X.keep_snapshot(make_docs(first), path, digest=digest, bucket_keys=bucket_keys)
    kept = files(path)
    for batch in (second, third):
        assert answer(X.dedup_batch([path], make_docs(batch), digest=digest, bucket_keys=bucket_keys)) == expected([first], batch)
    assert files(path) == kept                       # a snapshot is built once and read only
    # the second batch becomes a snapshot of its own, and the third meets both
    more = str(tmp_path / "more")
    X.keep_snapshot(make_docs(second), more, digest=digest, bucket_keys=bucket_keys)
    assert answer(X.dedup_batch([path, more], make_docs(third), digest=digest, bucket_keys=bucket_keys)) == expected([first, second], third)


def test_edge_rows_and_empty_tables(llm, make_docs, edge, tmp_path):
    full, none = str(tmp_path / "full"), str(tmp_path / "none")
    X.keep_snapshot(edge, full)
    X.keep_snapshot(make_docs([]), none)
    assert answer(X.dedup_batch([none], edge)) == expected([], EDGE) == answer(X.dedup_batch([], edge))
    assert answer(X.dedup_batch([none, full], edge)) == expected([EDGE], EDGE)
    assert X.dedup_batch([full], make_docs([])).count() == 0


def test_only_touched_buckets_are_read(llm, make_docs, tmp_path):
    path = str(tmp_path / "snapshot")
    X.keep_snapshot(make_docs([(i, f"text number {i}") for i in range(200)]), path, bucket_keys=5)
    assert len(glob.glob(f"{path}/exact/bucket=*")) > 30
    out = X.dedup_batch([path], make_docs([(1000, "Text number 17"), (1001, "nowhere")]), bucket_keys=5)
    plan = out._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket#\d+ (= |IN )", plan)
    assert {(r.doc_id, r.in_snapshot, r.snapshot_id, r.kept) for r in out.collect()} == {(1000, True, 17, False), (1001, False, None, True)}
