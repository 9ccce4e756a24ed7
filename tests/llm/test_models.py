"""Classifiers, language model, packing, token counts and the pipeline."""

import itertools
import math
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from conftest import SF_SMALL
from llm_fixtures import EDGE, LONG, edge, llm, make_docs  # noqa: F401

import corpus_pipeline
from ledgerline.llm import hmm as H
from ledgerline.llm import packing as P
from ledgerline.llm import quality as Q
from ledgerline.llm import token_counts as C
from ledgerline.llm import tokens
from ledgerline.llm import toxicity as X
from ledgerline.llm.common import read_table

SF = "/root/testdata/sf0.01"


def _held(i, folds, fold):
    return zlib.crc32(str(i).encode()) % folds == fold


# ---- classifiers

def test_quality_on_held_out_rows(llm):
    docs, labels = read_table(llm, SF, "documents"), read_table(llm, SF, "labels")
    model = Q.fit(docs, labels)
    assert model.rules and all(abs(w) > 0 for _, w in model.rules) and len(model.explain()) == len(model.rules)
    rows = Q.score_quality(docs, model).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) and _held(r.doc_id, 4, 2) for r in rows)
    kept = {r.doc_id for r in Q.keep_good(docs, model).collect()}
    assert kept == {r.doc_id for r in Q.score_quality(docs, model).where("predicted = 1").collect()}


def test_toxicity_on_held_out_rows(llm):
    docs, labels = read_table(llm, SF, "documents"), read_table(llm, SF, "labels")
    rows = X.score_toxicity(docs, X.fit(docs, labels)).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.9
    clean = [r for r in rows if r.toxic == 0]
    assert np.mean([r.predicted == 0 for r in clean]) > 0.95
    assert np.mean([r.predicted for r in rows if r.toxic == 1]) > 0.6


def test_toxicity_of_skewed_labels(llm, make_docs):
    """One toxic text in ten: all texts count, the curve is fitted, and held-out toxic texts are found."""
    rnd = random.Random(4)
    common, bad = [f"word{i}" for i in range(150)], [f"slur{i}" for i in range(5)]
    toxic = lambda i: int(i % 10 == 0)
    rows = [(i, " ".join(rnd.choices(common, k=40) + rnd.choices(bad if toxic(i) else common, k=5))) for i in range(600)]
    docs, labels = make_docs(rows), llm.createDataFrame([(i, toxic(i)) for i, _ in rows], "doc_id long, toxic int")
    model = X.fit(docs, labels)
    seen = {(w, v) for i, t in rows if not _held(i, 4, 2) for w, v in zip(["", *t.split()], t.split())}
    assert model.kn.totals.sum() >= len(seen)
    held = [r for r in X.score_toxicity(docs, model).collect() if r.held_out]
    found = [r.predicted for r in held if toxic(r.doc_id)]
    assert np.mean(found) > 0.9 and np.mean([r.predicted for r in held if not toxic(r.doc_id)]) < 0.05


@pytest.mark.parametrize("which", ["quality", "toxicity"])
def test_classifier_edges(llm, edge, make_docs, which):
    fit, score = (Q.fit, Q.score_quality) if which == "quality" else (X.fit, X.score_toxicity)
    label = "quality" if which == "quality" else "toxic"
    none = llm.createDataFrame([], f"doc_id long, {label} int")
    some = llm.createDataFrame([(1, 0), (1, 1), (None, 1), (4, None), (7, 1), (7, 1), (9, 0), (6, 1), (5, 0), (10, 0)], f"doc_id long, {label} int")
    for labels in (none, some):
        out = score(edge, fit(edge, labels)).collect()
        assert sorted(map(repr, (r.doc_id for r in out))) == sorted(map(repr, (i for i, _ in EDGE)))
        assert all(0 <= r.score <= 1 and r.held_out == (r.doc_id is not None and _held(r.doc_id, 4, 2)) for r in out)
    assert score(make_docs([]), fit(make_docs([]), none)).count() == 0


def plain_kneser_ney(rows):
    """The formulas read literally, over (words, class): P_y(w | h) for any two words."""
    pairs = [set(), set()]
    for words, y in rows:
        pairs[y] |= set(zip(["", "", *words], ["", *words], words, strict=False))
    n_pair = [Counter((h, w) for _, h, w in p) for p in pairs]
    n_word = [Counter(w for h, w in {(h, w) for _, h, w in p}) for p in pairs]
    stem = lambda w: w[:5]
    n_stem = [Counter(), Counter()]
    for y in (0, 1):
        for w, n in n_word[y].items():
            n_stem[y][stem(w)] += n
    total = [sum(c.values()) for c in n_word]
    both_word, both_stem = n_word[0] + n_word[1], n_stem[0] + n_stem[1]
    words, stems = sorted(w for w in both_word if both_word[w] >= 2), sorted(s for s in both_stem if both_stem[s] >= 2)
    kept = {s: (both_stem[s] - 0.75) / sum(total) for s in stems}
    rest = (1 - sum(kept.values())) / (len(stems) + 1)
    shared = {s: kept[s] + rest for s in stems} | {None: rest}
    inside, unknown = {}, {}
    for s in stems:
        mine = [w for w in words if stem(w) == s]
        share = {w: (both_word[w] - 0.75) / both_stem[s] for w in mine}
        unknown[s] = (1 - sum(share.values())) / (len(mine) + 1)
        inside |= {w: share[w] + unknown[s] for w in mine}
    keep = lambda n, other, total, other_total: max(n - 2 - 4 * total * (other + 1) / max(other_total, 1), 0)

    def model(y):
        z = 1 - y
        own = {s: keep(n_stem[y][s], n_stem[z][s], total[y], total[z]) / total[y] for s in stems}
        no_stem = (1 - sum(own.values())) * rest
        free = 1 - sum(own.values())
        of_stem = {s: own[s] + free * shared[s] for s in stems} | {None: free * rest}
        own = {w: keep(n_word[y][w], n_word[z][w], total[y], total[z]) / total[y] for w in words}
        free = 1 - sum(own.values())
        of_word = {w: own[w] + free * of_stem[stem(w)] * inside[w] for w in words}
        of_word |= {("unknown", s): free * of_stem[s] * unknown[s] for s in stems} | {("unknown", None): free * no_stem}
        c_h = [Counter(), Counter()]
        for k in (0, 1):
            for (h, _), n in n_pair[k].items():
                c_h[k][h] += n
        extra = {}
        for (h, w), n in n_pair[y].items():
            if h in words and w in words:
                extra[h, w] = keep(n, n_pair[z][h, w], c_h[y][h], c_h[z][h]) / c_h[y][h]
        left = {h: 1 - sum(v for (g, _), v in extra.items() if g == h) for h in words}
        slot = lambda w: w if w in of_word else ("unknown", stem(w) if stem(w) in stems else None)
        return of_word, lambda h, w: extra.get((h, w), 0) + left.get(h, 1) * of_word[slot(w)]
    return model(0), model(1)


def toxic_corpus(seed=9):
    rnd = random.Random(seed)
    common = ["the", "of", "and", "walking", "walked", "walks", "house", "houses", "to", *(f"word{i}" for i in range(12))]
    bad = ["slur", "insulting", "insulted"]
    rows = []
    for i in range(160):
        y = int(i % 4 == 0)
        words = rnd.choices(common, k=25) + (rnd.choices(bad, k=6) if y else [])
        rnd.shuffle(words)
        rows.append((i, " ".join(words + (["you", "slur"] * 2 if y else ["you", "all"])), y))
    return rows


def test_kneser_ney_equals_the_formulas_and_sums_to_one(llm):
    rows = toxic_corpus()
    sample = llm.createDataFrame([(t, float(y), i // 4 % 4) for i, t, y in rows], "text string, y double, part long")
    models = X.fit_counts(sample)
    for part, kn in [(None, models[0]), *enumerate(models[1:])]:
        (word_0, p_0), (word_1, p_1) = plain_kneser_ney([(X.words_of(t), y) for i, t, y in rows if i // 4 % 4 != part])
        assert len(kn.probabilities) == len(word_0) == len(word_1)
        tested = ["the", "slur", "insulting", "insulter", "walkers", "never", "all", "you", "word3", "houseboat"]
        for h in ["the", "you", "slur", "never", "word1"]:
            got = [kn.chances([h, w])[1] for w in tested]
            assert np.allclose(got, [(p_0(h, w), p_1(h, w)) for w in tested], rtol=0, atol=1e-9)
            # over listed words, the unknown word of each listed stem and the word of an unknown stem
            place, size = kn.place(h), len(kn.probabilities)
            extra = kn.extra[kn.pairs // size == place].sum(axis=0) if len(kn.pairs) else 0.0
            assert np.allclose(kn.probabilities.sum(axis=0) * kn.left[place] + extra, 1.0, rtol=0, atol=1e-9)
        assert math.isclose(sum(word_0.values()), 1, abs_tol=1e-9) and math.isclose(sum(word_1.values()), 1, abs_tol=1e-9)
        assert np.allclose(kn.likelihoods(["slur", "the"]), np.log([word_0["slur"] * p_0("slur", "the"), word_1["slur"] * p_1("slur", "the")]), atol=1e-9)
        ratio = lambda w: float(np.diff(np.log(kn.chances([w])[0]))[0])  # noqa: E731, B023
        assert ratio("slur") > 0.5 and ratio("insulter") > 0.5 and abs(ratio("walkers") - ratio("the")) < 1e-9
        assert (kn.likelihoods([]) == 0).all()
    assert len(models[0].pairs)                                  # a pair that says more than its words


def test_quality_rules_equal_plain_python(llm):
    """The compiled column against the rules evaluated one by one, and a scan by as many tasks as the input has splits."""
    docs, labels = read_table(llm, SF, "documents").repartition(7), read_table(llm, SF, "labels")
    seen, stage = {}, Q.stage_table

    def spy(df, name):
        seen[name] = df.rdd.getNumPartitions()
        return stage(df, name)
    Q.stage_table = spy
    try:
        model = Q.fit(docs, labels)
    finally:
        Q.stage_table = stage
    assert seen["quality-sample"] == 7
    got = {r.doc_id: r.score for r in Q.score_quality(docs, model).collect()}
    for r in docs.limit(200).collect():
        stats = Q.text_statistics((r.text or "").encode())
        total = model.intercept + sum(w for rule, w in model.rules if all(stats[f] <= t if low else stats[f] > t for f, low, t in rule))
        assert math.isclose(got[r.doc_id], 1 / (1 + math.exp(-total)), rel_tol=1e-9)


# ---- language model

def _naive(hmm, seen):
    total = 0.0
    for path in itertools.product(range(len(hmm.start)), repeat=len(seen)):
        p = hmm.start[path[0]] * hmm.emit[seen[0], path[0]]
        for a, b, o in zip(path, path[1:], seen[1:]):
            p *= hmm.move[a, b] * hmm.emit[o, b]
        total += p
    return math.log10(total)


def test_forward_recursion_and_baum_welch():
    rng = np.random.default_rng(0)
    k, v = 3, 5
    hmm = H.Hmm(rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), k), rng.dirichlet(np.ones(v), k).T.copy())
    texts = [rng.integers(0, v, n).astype(np.uint16) for n in (1, 6, 3, 6, 2)]
    assert np.allclose(hmm.log10_likelihoods(texts), [_naive(hmm, t) for t in texts])
    train = [np.array([0, 1] * 30 + [2] * 20, np.uint16), np.array([3, 4] * 40, np.uint16)] * 3
    before, uniform = -np.inf, np.full(v, 1 / v)
    for _ in range(4):
        into = np.zeros(k), np.zeros((k, k)), np.zeros((v, k))
        hmm.expected(train, into)
        assert np.isclose(into[0].sum(), len(train)) and np.isclose(into[2].sum(), sum(map(len, train)))
        hmm = H.normalised(*into, uniform)
        now = hmm.log10_likelihoods(train).sum()
        assert now > before - 20
        before = now


def _check_scores(rows, docs):
    counts = Counter()
    for i, t in docs:
        if i is None or not _held(i, 10, 0):
            counts.update([*(t or "").encode().lower().split(), 0])
    n, v = sum(counts.values()), len(counts)
    want = []
    for i, t in docs:
        words = [*(t or "").encode().lower().split(), 0]
        want.append((i, len(words), sum(counts[w] > 0 for w in words), n, round(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words), 6)))
    got = [(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_language_model_base_and_gain(llm, monkeypatch):
    monkeypatch.setattr(H, "HEAD_WORDS", 500)           # most words go through the join
    docs = read_table(llm, SF_SMALL, "documents")
    rows = H.score_texts(docs).collect()
    _check_scores(rows, [(r.doc_id, r.text) for r in docs.collect()])
    held = [r for r in rows if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)


def test_language_model_edges(llm, edge, make_docs):
    rows = H.score_texts(edge).collect()
    _check_scores(rows, EDGE)
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)
    assert H.score_texts(make_docs([])).count() == 0
    only_held = [(i, "a b") for i in range(40) if _held(i, 10, 0)]
    assert all(r.n_known == 0 and r.train_tokens == 0 for r in H.score_texts(make_docs(only_held)).collect())


def test_language_model_learns_from_long_texts_only(llm, make_docs):
    rnd = random.Random(2)
    themes = [[f"t{k}w{i}" for i in range(40)] for k in range(4)]
    def text():
        return " ".join(" ".join(rnd.choices(themes[b % 4], k=50)) for b in range(rnd.randint(0, 3), 410))
    rows = H.score_texts(make_docs([(i, text()) for i in range(30)])).collect()
    assert min(r.n_tokens for r in rows) > 20_000
    held = [r for r in rows if r.held_out]
    # four themes in turn: knowing the theme is worth up to log10(4) a token
    assert held and sum(r.score - r.base_score for r in held) > 0.3 * sum(r.n_tokens for r in held)


def test_mixture_counts_every_token():
    rng = np.random.default_rng(1)
    texts = [rng.integers(0, 50, n).astype(np.uint16) for n in (1, 15, 16, 17, 30_000)]
    into = np.zeros(3), np.zeros((3, 3)), np.zeros((50, 3))
    emit = rng.dirichlet(np.ones(50), 3).T
    H.Mixture(np.full(3, 1 / 3), emit).expected(texts, into)
    assert np.allclose(into[2].sum(axis=1), np.bincount(np.concatenate(texts), minlength=50))
    assert np.isclose(into[0].sum(), sum(-(-len(t) // H.SEGMENT) for t in texts))


# ---- packing and token counts

def _pieces(rows, docs, window):
    encode, _ = tokens.encoder(*tokens.default_paths())
    want = Counter()
    for i, t in docs:
        want[i, tuple(encode(t or "")) + (1,)] += 1
    by_window = {}
    for r in rows:
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length
        by_window.setdefault(r.sequence_id, []).append((r.offset, r.length))
    padding = 0
    for parts in by_window.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    got = Counter()
    by_doc = {}
    for r in sorted(rows, key=lambda r: r.start):
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    for (i, _), parts in by_doc.items():
        copies = [p for p in parts if p.start == 0]
        if len(copies) == 1:
            got[i, tuple(np.concatenate([np.frombuffer(bytes(p.ids), "<u4") for p in parts]))] += 1
            assert [p.start for p in parts] == list(np.cumsum([0] + [p.length for p in parts[:-1]]))
        else:
            for _ in copies:        # repeated rows: whole pieces only, compared by total length
                got[i, next(k[1] for k in want if k[0] == i)] += 1
    assert got == want and sum(r.length for r in rows) == sum(len(k[1]) * n for k, n in want.items())
    return padding


@pytest.mark.parametrize("window,max_open", [(2048, 2048), (64, 8)])
def test_packing_round_trip(llm, edge, window, max_open):
    assert _pieces(P.pack(edge, window=window, max_open=max_open, with_ids=True).collect(), EDGE, window) == 0
    docs = read_table(llm, SF_SMALL, "documents").select("doc_id", "text")
    rows = P.pack(docs, window=window, max_open=max_open, with_ids=True).collect()
    assert _pieces(rows, [tuple(r) for r in docs.collect()], window) == 0


def test_open_windows_keep_no_documents():
    """300 long documents leave their remainders in open windows, not themselves."""
    packer = P.Packer()
    for i in range(300):
        list(packer.add(P.Piece(i, 0, np.zeros(100_000 + i, np.uint32), 0)))
    held = [p.ids if p.ids.base is None else p.ids.base for windows in packer.open.values() for w in windows for p in w]
    assert held and sum(x.nbytes for x in held) < 5_000_000


def test_packing_empty_table(make_docs):
    assert P.pack(make_docs([])).count() == 0


def test_sum_of_squares_rule():
    rnd = random.Random(5)
    packer = P.Packer(window=20)
    for _ in range(200):
        size = rnd.randint(1, 19)
        def cost(fill):
            level = packer.level.copy()
            if fill:
                level[fill] -= 1
            if fill + size < 20:
                level[fill + size] += 1
            return int((level[1:20] ** 2).sum())
        fills = [f for f in range(1, 20 - size + 1) if packer.level[f]]
        chosen = packer.best_level(size)
        assert chosen in [0, *fills] and cost(chosen) == min(cost(f) for f in [0, *fills])
        list(packer.add(P.Piece(0, 0, np.zeros(size, np.uint32), size)))


def test_ids_equal_the_json_tokenizer():
    from tokenizers import Tokenizer

    encode, lengths = tokens.encoder(*tokens.default_paths())
    slow = Tokenizer.from_file(tokens.default_paths()[0])
    for text in ("", " ", "Hello, world's  end\n\n x", "éà ü 漢字 😀‍", "a<|endoftext|>b", "  \t\r\n 12345 don't", LONG[:5000]):
        ids = encode(text)
        assert list(ids) == slow.encode(text, add_special_tokens=False).ids
        assert lengths[ids].sum() == len(text.encode())


@pytest.mark.parametrize("rule", C.RULES)
def test_token_counts(llm, edge, make_docs, rule):
    encode, lengths = tokens.encoder(*tokens.default_paths())
    rows = C.token_counts(edge, fields=("text", "lang"), rule=rule).collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    for i, t in EDGE:
        n = len(encode((t or "") + "en"))
        copies = sum(1 for j, _ in EDGE if j == i)
        assert math.isclose(sum(r.n_tokens for r in by_doc[i]), n * copies) and all(r.doc_tokens == n for r in by_doc[i])
        assert sum(r.n_bytes for r in by_doc[i]) == len((t or "").encode() + b"en") * copies
    assert C.token_counts(make_docs([])).count() == 0
    text = "one two\nthree\n\nfour"
    ends, _ = C.section_ends([text.encode()])
    assert ends == [8, 14, 15, 19]
    ids = encode(text)
    counts, _ = C.attribute(lengths[ids], np.array(ends), rule)
    spans, at = [], 0
    for size in lengths[ids]:
        spans.append((at, at + size))
        at += size
    want = np.zeros(len(ends))
    for a, b in spans:
        share = [sum(lo <= x < hi for x in range(a, b)) / (b - a) for lo, hi in zip([0, *ends], ends)]
        if rule == "split":
            want += share
        else:
            want[next(k for k, s in enumerate(share) if s) if rule == "start" else int(np.argmax(share))] += 1
    assert np.allclose(counts, want)


# ---- pipeline

def test_pipeline_stages(llm):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "minhash", "decontaminate", "packing"]
    docs = read_table(llm, SF, "documents")
    text = {r.doc_id: r.text for r in docs.collect()}
    label = {r.doc_id: r.quality for r in read_table(llm, SF, "labels").collect()}
    items = [r.text for r in read_table(llm, SF, "benchmark").collect()]
    base = llm._jsc.sc().getCheckpointDir().get()
    kept = None
    for name, stage in corpus_pipeline.STAGES:
        out = stage(llm, docs, SF)
        out.write.mode("overwrite").parquet(f"{base}/test-{name}")
        out = llm.read.parquet(f"{base}/test-{name}")
        if name == "packing":
            assert {r.doc_id for r in out.select("doc_id").distinct().collect()} == kept
            break
        assert out.columns == docs.columns
        before, kept = kept or set(text), {r.doc_id for r in out.select("doc_id").collect()}
        assert kept <= before and out.count() == len(kept)
        if name == "quality":
            right = [(i in kept) == bool(label[i]) for i in label]
            assert np.mean(right) > 0.95
        if name == "exact_dedup":
            lowest = {}
            for i in sorted(before):
                lowest[text[i].encode().lower()] = i
            assert kept == set(lowest.values())
        if name == "decontaminate":
            assert before - kept == {i for i in before if any(x in text[i] for x in items)}
        docs = out


def test_pipeline_drops_repeated_rows(llm, edge):
    kept = corpus_pipeline.exact_dedup_stage(llm, edge, SF).collect()
    assert sorted(map(repr, ((r.doc_id, r.text) for r in kept))) == sorted(map(repr, [
        (3, " \n\t "), (2, ""), (5, LONG), (6, "a text without an id"), (8, "same text HERE"), (9, "É é A"), (10, "é é a")]))


def test_sql_for_what_sql_can_express():
    import __spark_entry__ as entry

    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    for name in ("op3_url_filter", "op10_exact_dedup"):
        assert con.execute(entry.oracle_sql()[name]).fetchall()
