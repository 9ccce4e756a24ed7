"""The pipeline's decisions row by row, and run() against brute force."""

import zlib
from collections import Counter

import numpy as np
from conftest import SF_SMALL
from llm_fixtures import LONG, edge, llm, make_docs  # noqa: F401

import corpus_pipeline
from ledgerline.llm import decontaminate, exact_dedup, minhash, quality, tokens
from ledgerline.llm.common import read_table


def kept(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


def low(text):
    return (text or "").encode().lower()


def test_exact_stage_by_rows(make_docs):
    rows = [(1, "copied text"), (1, "a unique text lost"), (2, "copied text"), (7, "Foo bar"), (7, "foo bar"), (None, "dup"), (None, "DUP"), (None, None), (3, ""), (4, LONG)]
    got = kept(exact_dedup.keep_one(make_docs(rows)))
    assert len(got) == 6 and {low(t) for _, t in got} == {low(t) for _, t in rows}
    assert {r for r in got if low(r[1]) in (b"copied text", b"a unique text lost", b"")} == {(2, "copied text"), (1, "a unique text lost"), (3, "")}
    assert exact_dedup.keep_one(make_docs([])).collect() == [] and exact_dedup.keep_one(make_docs(rows)).columns == make_docs(rows).columns


def test_near_and_benchmark_stages_by_rows(llm, make_docs):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(1, base), (1, "another text of this id that nothing else is like"), (None, base + " end"), (None, "no words like it at all here"), (None, None), (5, " ")]
    got = kept(minhash.keep_one(make_docs(rows)))
    assert len(got) == 5 and sum(t is not None and t.startswith("w0") for _, t in got) == 1
    bench = llm.createDataFrame([(1, " ".join(f"b{i}" for i in range(20)))], "item_id long, text string")
    leak = "before " + " ".join(f"b{i}" for i in range(20)) + " after"
    rows = [(None, leak), (8, leak), (8, "a clean text with the id of a leak"), (None, "clean"), (9, None)]
    assert kept(decontaminate.keep_clean(make_docs(rows), bench)) == sorted([(8, "a clean text with the id of a leak"), (None, "clean"), (9, None)], key=repr)


def groups_of(texts, shingle=5, percent=80):
    """Components of all pairs of shingle sets."""
    sets = {}
    for i, t in texts.items():
        words = low(t).split()
        sets[i] = {tuple(words[k:k + shingle]) for k in range(len(words) - shingle + 1)} or ({tuple(words)} if words else set())
    top = {i: i for i in texts}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i
    ids = sorted(texts)
    for a in range(len(ids)):
        for b in range(a):
            x, y = sets[ids[a]], sets[ids[b]]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                top[find(ids[a])] = find(ids[b])
    return {i: find(i) for i in ids}


def test_run_against_brute_force(llm):
    docs, labels = read_table(llm, SF_SMALL, "documents"), read_table(llm, SF_SMALL, "labels")
    text = {r.doc_id: r.text for r in docs.collect()}
    good = {r.doc_id for r in quality.score_quality(docs, quality.fit(docs, labels)).collect() if r.predicted}
    last = {}
    for i in sorted(good):
        last[low(text[i])] = i
    unique = {i: text[i] for i in last.values()}
    group = groups_of(unique)
    bench = [low(r.text).split() for r in read_table(llm, SF_SMALL, "benchmark").collect()]

    def leaks(i):
        words = np.array(low(text[i]).split(), object)
        for item in bench:
            size = min(13, len(item))
            if size < 8:
                continue
            for a in range(len(item) - size + 1):
                for b in range(len(words) - size + 1):
                    if sum(x == y for x, y in zip(item[a:a + size], words[b:b + size], strict=True)) >= size - (2 if len(item) >= 13 else 0):
                        return True
        return False

    rows = corpus_pipeline.run(llm, SF_SMALL).collect()
    got = {r.doc_id for r in rows}
    # one of each group of near copies, and of those the ones without a benchmark passage
    assert got <= set(unique) and max(Counter(group[i] for i in got).values()) == 1
    for g in set(group.values()) - {group[i] for i in got}:
        assert any(leaks(i) for i in unique if group[i] == g)
    assert not any(leaks(i) for i in sorted(got)[:40])
    # every id of every document that is left lies in exactly one piece, in sequences without gaps
    encode, _ = tokens.encoder(*tokens.default_paths())
    pieces = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
    for i, mine in pieces.items():
        ids = np.append(encode(text[i] or ""), 1).astype("<u4")
        at = 0
        for r in sorted(mine, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
