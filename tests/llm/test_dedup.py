import hashlib
import random
import string
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerline.llm import exact_dedup as X
from ledgerline.llm import minhash as M
from ledgerline.llm.components import components

from llm_fixtures import EDGE, edge, llm, make_docs  # noqa: F401

LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def _norm(t):
    return (t or "").translate(LOW)


def test_binary_fuse_filter():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 10, 1000, 50_000):
        keys = rng.integers(0, 2**63, n, np.uint64)
        f = X.build_filter(np.concatenate([keys, keys]))
        assert X.probe_filter(keys, *f).all()
        other = rng.integers(0, 2**63, 20_000, np.uint64)
        assert X.probe_filter(other, *f).mean() < 0.02


def _exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[_norm(t)].append(i)
    return sorted(((i, max((x for x in groups[_norm(t)] if x is not None), default=None), len(groups[_norm(t)]),
                    hashlib.sha256(_norm(t).encode()).hexdigest()) for i, t in rows), key=repr)


def _got(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect()), key=repr)


def test_exact_dedup_edges(edge):
    out = X.exact_dedup(*X.two_batches(edge))
    assert _got(out) == _exact(EDGE)
    assert {(r.doc_id, r.kept) for r in out.collect()} >= {(8, True), (7, False), (None, False), (6, True), (9, True), (10, True)}


@pytest.mark.parametrize("split", [0, 3, 100])
def test_exact_dedup_batches(llm, make_docs, split):
    rnd = random.Random(split)
    rows = [(i, rnd.choice(["a", "A", "b b", "c", ""]) + rnd.choice(["", "x", "y"]) * rnd.randint(0, 3)) for i in range(60)]
    out = X.exact_dedup(make_docs(rows[:split]), make_docs(rows[split:]))
    assert _got(out) == _exact(rows)


def test_exact_dedup_byte_check_splits_collisions(make_docs):
    rows = [(i, t) for i, t in enumerate(["one", "two", "ONE", "three", "two", "four"] * 3)]
    weak = lambda c: F.substring(F.sha2(c.cast("binary"), 256), 1, 1)
    constant = lambda c: F.when(c.isNotNull(), F.lit("x"))
    for digest in (weak, constant):
        assert _got(X.exact_dedup(*X.two_batches(make_docs(rows)), digest=digest)) == _exact(rows)


def test_components(llm):
    rnd = random.Random(4)
    links = [(rnd.randint(0, 60), rnd.randint(0, 60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(30)] + [(5, 5)]
    parent = {}
    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    want = {x: find(x) for pair in links if pair[0] != pair[1] for x in pair}
    got = {r.node: r.component for r in components(llm.createDataFrame(links, "u long, v long")).collect()}
    assert got == want
    assert components(llm.createDataFrame([], "u long, v long")).count() == 0


def _sets(rows, k):
    out = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        out.append(frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else []))
    return out


def _near(rows, k):
    sets = _sets(rows, k)
    parent = list(range(len(rows)))
    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                same = len(sets[i] & sets[j])
                if 100 * same >= 80 * (len(sets[i]) + len(sets[j]) - same):
                    parent[find(i)] = find(j)
    least = defaultdict(lambda: None)
    for i, (doc, _) in enumerate(rows):
        if sets[i] and doc is not None:
            c = find(i)
            least[c] = doc if least[c] is None else min(least[c], doc)
    return sorted(((doc, len(sets[i]), least[find(i)] if sets[i] else doc) for i, (doc, _) in enumerate(rows)), key=repr)


@pytest.mark.parametrize("small,k", [(32, 2), (2, 2), (2, 5)])
def test_near_duplicates_match_brute_force(make_docs, monkeypatch, small, k):
    """Groups of copies with edits around the threshold; ``small`` = 2 sends all of them through the prefix filter."""
    monkeypatch.setattr(M, "SMALL", small)
    rnd = random.Random(small + k)
    rows = []
    for g in range(4):
        base = [f"w{rnd.randint(0, 400)}" for _ in range(60)]
        for _ in range(30):
            words = list(base)
            for _ in range(rnd.randint(0, 9)):
                words[rnd.randrange(60)] = f"e{rnd.randint(0, 3000)}"
            rows.append((len(rows) + 10, " ".join(words)))
    rows += [(1, None), (2, " "), (3, "one"), (4, "ONE"), (5, rows[0][1].upper()), (None, rows[1][1]), (11, rows[1][1])]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in M.near_duplicates(make_docs(rows), shingle=k).collect()), key=repr)
    assert got == _near(rows, k)


def test_near_duplicates_edges(edge, make_docs):
    out = M.near_duplicates(edge, shingle=2)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out.collect()), key=repr)
    assert got == _near(EDGE, 2)
    assert M.near_duplicates(make_docs([])).count() == 0
    kept = M.keep_one(edge)
    assert kept.columns == edge.columns and {r.doc_id for r in kept.collect()} >= {1, 2, 3, 4, 6, 7, 9} and kept.where("doc_id = 5").count() == 0


def test_prefix_filter_is_exact(llm, make_docs):
    rnd = random.Random(9)
    base = [f"w{i}" for i in range(50)]
    rows = []
    for i in range(40):
        words = list(base)
        for _ in range(rnd.randint(0, 12)):
            words[rnd.randrange(50)] = f"e{rnd.randint(0, 40)}"
        rows.append((i, " ".join(words)))
    memo = M._WordHashes()
    sets = {i: M.shingle_set(t.encode(), 2, memo) for i, t in rows}
    key = lambda i: bytearray(i.to_bytes(16, "big"))
    full = llm.createDataFrame([(key(i), bytearray(s.tobytes())) for i, s in sets.items()], "set_key binary, shingles binary")
    members = llm.createDataFrame([(key(i), len(s), i % 7, key(i)) for i, s in sets.items()], "set_key binary, n long, central long, component binary")
    found = {tuple(sorted((bytes(r.a), bytes(r.b)))) for r in M.prefix_pairs(members, full, 80).collect()}
    for i in sets:
        for j in range(i):
            same = len(np.intersect1d(sets[i], sets[j]))
            if 100 * same >= 80 * (len(sets[i]) + len(sets[j]) - same):
                assert tuple(sorted((bytes(key(i)), bytes(key(j))))) in found


def test_exact_dedup_sql(llm):
    import duckdb

    import __spark_entry__ as entry

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    want = con.execute(f"SELECT doc_id, keep_id, group_size, text_sha256 FROM ({entry.oracle_sql()['op10_exact_dedup']})").fetchall()
    got = [(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in entry.queries()["op10_exact_dedup"](llm, SF_SMALL).collect()]
    assert sorted(got) == sorted(want)
