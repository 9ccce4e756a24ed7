"""Licence scan, URL filter and decontamination: the operators in DataFrame functions."""

import random
import re

import pytest

from conftest import SF_SMALL
from llm_fixtures import edge, llm, make_docs  # noqa: F401
from ledgerline.llm import decontaminate as D
from ledgerline.llm import license_scan as L
from ledgerline.llm import url_filter as U


def _plan(df):
    return df._jdf.queryExecution().toString()


def test_licence_equivalences(llm, make_docs):
    known = L.known_digests(llm)
    mit = L.KNOWN_LICENSES[0][1]
    changed = mit.replace("MIT License", "mit  LICENCE!!").replace("Copyright (c) <year> <copyright holders>", "(c) 2024 Jane Doe\nAll rights reserved.")
    rows = [(1, mit), (2, changed), (3, mit + " x"), (4, None), (5, ""), (6, "...!"), (None, mit), (7, "Released under the MIT licence"), (7, "Released under the MIT licence")]
    got = sorted(((r.doc_id, r.license_id) for r in L.license_scan(make_docs(rows), known).collect()), key=repr)
    assert got == sorted([(1, "MIT"), (2, "MIT"), (3, None), (4, None), (5, None), (6, None), (None, "MIT"), (7, "MIT"), (7, "MIT")], key=repr)
    assert L.license_scan(make_docs([]), known).count() == 0
    notices = {(r.doc_id, r.line_no, r.license_id) for r in L.notice_scan(make_docs([(1, "a\nReleased under the MIT license.\nb"), (2, None)]), known).collect()}
    assert notices == {(1, 2, "MIT")}
    assert "Python" not in _plan(L.license_scan(make_docs(rows), known))


def test_body_lines_that_begin_with_copyright_stay(llm, make_docs):
    isc = next(text for name, text in L.KNOWN_LICENSES if name == "ISC")
    mit = next(text for name, text in L.KNOWN_LICENSES if name == "MIT")
    rows = [(1, isc.replace("above copyright notice", "above\ncopyright notice")), (2, mit.replace("OR COPYRIGHT HOLDERS", "OR\nCOPYRIGHT HOLDERS")),
            (3, mit.replace("Copyright (c) <year> <copyright holders>", "Copyright 2020 Jane Doe\n\u00a9 2021 Joe\nCOPYRIGHT: [yyyy] [name]\nAll rights reserved."))]
    got = {r.doc_id: r.license_id for r in L.license_scan(make_docs(rows), L.known_digests(llm)).collect()}
    assert got == {1: "ISC", 2: "MIT", 3: "MIT"}


def test_known_texts_in_any_wrapping(llm, make_docs):
    import textwrap

    def wrapped(text, width):
        out, para = [], []
        for line in [*text.split("\n"), ""]:
            notice = re.match(r"\W*(copyright|\(c\))\W+(\(c\)|[<\[]|\d{4})", line, re.I)
            if notice or not line.strip():
                out += [textwrap.fill(" ".join(para), width, break_long_words=False, break_on_hyphens=False), line]
                para = []
            else:
                para.append(line.strip())
        return "\n".join(out)

    texts = L.known_texts()
    assert {"Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0-only", "GPL-3.0-only", "LGPL-2.1-only", "MPL-2.0", "Unlicense", "Zlib"} <= {i for i, t in texts if len(t) > 500}
    rows = [(n * 1000 + width, wrapped(text, width)) for n, (_, text) in enumerate(texts) for width in range(60, 101)]
    got = {r.doc_id: r.license_id for r in L.license_scan(make_docs(rows), L.known_digests(llm)).collect()}
    assert {i: name for i, name in got.items() if name != texts[i // 1000][0]} == {}


def test_edge_rows_do_not_crash(llm, edge):
    known = L.known_digests(llm)
    assert L.license_scan(edge, known).count() == edge.count()
    assert D.find_overlaps(edge, llm.createDataFrame([(1, "x " * 20), (None, "y " * 20), (2, None)], "item_id long, text string")).count() == 0


def _judge(url, rules, blocked):
    low = lambda s: re.sub("[A-Z]", lambda m: m[0].lower(), s)
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = low(re.match(r"[^/?#]*", rest)[0])
        path = re.match(r"[^?#]*", rest[len(host):], re.S)[0]
    best = None
    for action, h, p in rules:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or (len(h) + len(p), len(h), action) > best[0]):
            best = ((len(h) + len(p), len(h), action), h + p, action)
    listed = any(host == b or host.endswith("." + b) for b in blocked)
    return host, path, best and best[1], best[2] if best else ("block" if listed else "allow")


@pytest.mark.parametrize("max_listed", [1_000_000, 2])
def test_url_filter_matches_plain_rules(llm, max_listed):
    rnd = random.Random(max_listed)
    hosts = [".".join(rnd.choice(["a", "b", "shop", "example", "x"]) for _ in range(rnd.randint(0, 3))) + rnd.choice([".net", ".com", ".org", "net", "org"]) for _ in range(60)]
    urls = [rnd.choice(["http://", "HTTPS://", "ftp://", ""]) + rnd.choice(hosts).upper() * (i % 5 == 0) + rnd.choice(hosts) * (i % 5 > 0)
            + rnd.choice(["", "/", "/en/", "/de/x", "/fr/?q", "/EN/", "?a=/en/", "#t", "/en"]) for i in range(250)]
    urls += [None, "", "://", "http://example.net", "http://example.net/en/a/b", "http://x.example.com/de/1", "http://www.org/fr/", "http://a.net:80/", urls[0]]
    pages = llm.createDataFrame([(i if i else None, u, 1, "x") for i, u in enumerate(urls)], "page_id long, url string, host int, rule string")
    blocked = ["shop.com", "x.org", "b.a.com"]
    out = U.judge_urls(pages, U.rules_frame(llm), llm.createDataFrame([(b,) for b in blocked], "host string"), max_listed=max_listed)
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in out.collect()), key=repr)
    assert got == sorted(((i if i else None, *_judge(u, U.RULES, blocked)) for i, u in enumerate(urls)), key=repr)
    assert "Python" not in _plan(out)


def test_url_filter_empty_sides(llm):
    none = llm.createDataFrame([], "host string")
    pages = llm.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    assert U.judge_urls(pages, U.rules_frame(llm).where("false"), none).collect()[0].verdict == "allow"
    assert U.judge_urls(pages.where("false"), U.rules_frame(llm), none).count() == 0


def test_url_filter_sql(llm):
    import duckdb

    import __spark_entry__ as entry

    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF_SMALL}/pages.parquet'")
    want = con.execute(f"SELECT page_id, host, path, rule, verdict, listed_host FROM ({entry.oracle_sql()['op3_url_filter']})").fetchall()
    got = [tuple(r) for r in entry.queries()["op3_url_filter"](llm, SF_SMALL).select("page_id", "host", "path", "rule", "verdict", "listed_host").collect()]
    assert sorted(got) == sorted(want)


def _overlaps(doc, item):
    d, i = (re.findall(r"[^\W_]+", (t or "").lower()) for t in (doc, item))
    if len(i) < 8:
        return False
    w, miss = (13, 2) if len(i) >= 13 else (len(i), 0)
    return any(sum(a != b for a, b in zip(d[p:p + w], i[q:q + w])) <= miss for p in range(len(d) - w + 1) for q in range(len(i) - w + 1))


def test_decontamination_matches_brute_force(llm, make_docs):
    rnd = random.Random(2)
    word = lambda: f"w{rnd.randint(0, 60)}"
    items = [(k, " ".join(word() for _ in range(n))) for k, n in enumerate([30, 13, 14, 40, 8, 12, 7, 25, 20])]
    docs = []
    for i in range(90):
        words = [word() for _ in range(rnd.randint(0, 40))]
        _, text = rnd.choice(items)
        piece = text.split()
        cut = rnd.randint(0, max(0, len(piece) - 12))
        piece = piece[cut: cut + rnd.randint(8, 40)]
        for _ in range(rnd.randint(0, 4)):
            piece[rnd.randrange(len(piece))] = "zz"
        at = rnd.randint(0, len(words))
        docs.append((i, " ".join(words[:at] + [x.upper() + "," for x in piece] + words[at:])))
    docs += [(200, None), (201, ""), (None, items[0][1]), (202, items[0][1]), (202, items[0][1])]
    bench = llm.createDataFrame(items + [(50, None), (None, items[0][1])], "item_id long, text string")
    out = D.find_overlaps(make_docs(docs), bench)
    got = {(r.doc_id, r.item_id) for r in out.collect()}
    assert got == {(i, k) for i, t in docs for k, x in items if i is not None and _overlaps(t, x)} and out.count() == len(got)
    assert "Python" not in _plan(out)
    full = D.find_overlaps(make_docs(docs), bench, max_bits=64)          # a screen that lets nearly everything through
    assert sorted(map(str, full.collect())) == sorted(map(str, out.collect()))
    assert D.find_overlaps(make_docs(docs), bench.where("false")).count() == 0
    assert D.find_overlaps(make_docs([]), bench).count() == 0


def test_mask_is_lossless():
    import itertools

    for bad in itertools.combinations(range(13), 2):
        assert any(all(m == "0" or at + k not in bad for k, m in enumerate(D.MASKS[0])) for at in range(13 - len(D.MASKS[0]) + 1))
