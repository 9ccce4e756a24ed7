"""Toxicity by two class-conditional Kneser-Ney models.

Counts are Kneser-Ney's: a word counts by the number of different words before it, a pair of words by the number of
different words before the pair, so a passage that is copied into many documents counts once. Words share a stem,
their first five letters.

Shared counts, over both classes, give the backoff: P(stem) interpolates its discounted share with the uniform
distribution over the listed stems and one unknown stem; P(word | stem) does so over the listed words of the stem and one
unknown word. Each class y then has three levels, every one a discounted estimate plus the freed mass times the level below:

    P_y(s)     = kept_y(s) / N_y       + a_y    * P(s)
    P_y(w)     = kept_y(w) / N_y       + b_y    * P_y(stem of w) * P(w | stem of w)
    P_y(w | h) = kept_y(h, w) / c_y(h) + l_y(h) * P_y(w)

where kept = max(count - discount, 0) and a, b, l are what the discounts free, so each is a distribution. The discount is
``CLASS_DISCOUNT`` contexts plus ``EXPECTED`` times the count that the other class's rate, with one context more, leads one
to expect. Absolute discounting by a constant leaves every chance difference between a small and a large class in the
models (``README`` has figures); this one leaves a class what it says clearly more often than the other, and all
else, rare expressions above all, speaks through the shared counts.

A text's two log-likelihoods are divided by its number of words and compared. A logistic curve turns the difference into a
score; it is fitted on all sample texts, each judged by counts of the three parts of the sample that it is not in.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Matrices
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage_table
from .common import id_text
from .labelled import held_out, labelled_texts, training_sample

PER_CLASS = 4_000               # bound of the fitting sample: texts a class
LISTED = 2                      # contexts, in both classes together, of a word or stem that is no unknown one
SHARED_DISCOUNT, CLASS_DISCOUNT, EXPECTED = 0.75, 2.0, 4.0
STEM = 5
SCALE = 20.0                    # of the difference a word before it is squeezed between -1 and 1
THRESHOLD = 0.3
PARTS = 4                       # of the sample; a text is judged by the others
_WORD = re.compile(r"\w+")
_CACHE = 300_000                # words whose listing a worker remembers


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def stem_of(word: str) -> str:
    """The mark, which no word holds, keeps stems apart from words."""
    return f"{word[:STEM]}*"


def expression_counts(sample: DataFrame) -> DataFrame:
    """(e, c0, c1, and by part p of the sample c0_p, c1_p): the contexts of each expression by class, in all
    parts and in all parts but p. A pair is two words and a blank between them, its history the first word and the blank;
    stems and histories have the sums of their words and pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set = set()
            for text, y, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = words_of(text)
                before, mark = ["", *words], [(y, 1 << part)] * len(words)
                seen.update(zip(before, words, mark, strict=False))
                seen.update((g, f"{h} {w}", m) for g, h, w, m in zip(before, words, words[1:], mark, strict=False))
            rows = list(seen)
            yield pa.RecordBatch.from_pydict({"context": pa.array([r[0] for r in rows], pa.string()), "e": pa.array([r[1] for r in rows], pa.string()),
                                              "y": pa.array([r[2][0] for r in rows], pa.float64()), "parts": pa.array([r[2][1] for r in rows], pa.int32())})

    found = (sample.select("text", "y", F.col("part").cast("int")).mapInArrow(run, "context string, e string, y double, parts int")
             .groupBy("context", "e", "y").agg(F.bit_or("parts").alias("parts")))
    blank = F.instr("e", " ")
    above = F.when(blank > 0, F.substring("e", F.lit(1), blank)).otherwise(F.concat(F.substring("e", 1, STEM), F.lit("*")))
    every = found.select("y", "parts", F.explode(F.array(F.col("e"), above)).alias("e"))
    of = lambda y, seen: F.sum(F.when((F.col("y") == y) & (F.col("parts").bitwiseAND(F.lit(seen)) != 0), 1).otherwise(0))
    every_part = (1 << PARTS) - 1
    return every.groupBy("e").agg(*[of(float(y), every_part).alias(f"c{y}") for y in (0, 1)],
                                  *[of(float(y), every_part & ~(1 << p)).alias(f"c{y}_{p}") for p in range(PARTS) for y in (0, 1)])


def _interpolated(counts: np.ndarray, total: float, slots: int) -> tuple[np.ndarray, float]:
    """Shared estimates of listed expressions and of the one unknown, among ``slots`` in all."""
    kept = np.maximum(counts - SHARED_DISCOUNT, 0.0) / total
    rest = (1.0 - kept.sum()) / slots
    return kept + rest, rest


def _kept(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """What each class keeps of its counts (E, 2), of ``totals`` in all: beyond the discount and the other class's rate."""
    expected = totals * (counts[..., ::-1] + 1.0) / np.maximum(totals[..., ::-1], 1.0)
    return np.maximum(counts - CLASS_DISCOUNT - EXPECTED * expected, 0.0)


class KneserNeyPair:
    """Both classes' models (column 0 ordinary, 1 toxic).

    ``probabilities`` holds P_y of every listed word, then of the unknown word of every listed stem, then of a word of an
    unknown stem. ``left`` is l_y(h) by word h (1 without kept pairs), ``pairs`` the sorted codes of kept pairs and ``extra``
    their kept_y / c_y(h).
    """

    def __init__(self, expressions: list[str], counts: np.ndarray, totals: np.ndarray):
        """counts (E, 2) of words, stems, pairs and histories, totals (2,) of all words by class."""
        self.totals = totals = np.maximum(np.asarray(totals, float), 1.0)
        kind = {"word": [], "stem": [], "pair": [], "history": []}
        for i, e in enumerate(expressions):
            kind["stem" if e.endswith("*") else "history" if e.endswith(" ") else "pair" if " " in e else "word"].append(i)
        at_stem = {expressions[i]: k for k, i in enumerate(kind["stem"])}
        words = [expressions[i] for i in kind["word"]]
        stem = np.array([at_stem[stem_of(w)] for w in words], np.int64)
        c_word, c_stem = counts[kind["word"]].reshape(-1, 2), counts[kind["stem"]].reshape(-1, 2)

        shared_stem, unknown_stem = _interpolated(c_stem.sum(axis=1), totals.sum(), len(at_stem) + 1)
        kept = np.maximum(c_word.sum(axis=1) - SHARED_DISCOUNT, 0.0) / c_stem.sum(axis=1)[stem]
        slots = np.bincount(stem, minlength=len(at_stem)) + 1
        unknown_word = (1.0 - np.bincount(stem, kept, len(at_stem))) / slots
        in_stem = kept + unknown_word[stem]

        own = _kept(c_stem, totals) / totals
        free = 1.0 - own.sum(axis=0)
        stem_y, no_stem_y = own + free * shared_stem[:, None], free * unknown_stem
        below = stem_y[stem] * in_stem[:, None]
        own = _kept(c_word, totals) / totals
        free = 1.0 - own.sum(axis=0)
        self.probabilities = np.vstack([own + free * below, free * stem_y * unknown_word[:, None], free * no_stem_y])
        self.ids = {w: i for i, w in enumerate(words)} | {s: len(words) + k for s, k in at_stem.items()}

        self.left = np.ones((len(self.probabilities), 2))
        codes, extra = [], []
        history = {expressions[i][:-1]: counts[i] for i in kind["history"]}
        for i in kind["pair"]:
            h, _, w = expressions[i].partition(" ")
            if h not in self.ids or w not in self.ids:
                continue
            c_h = np.maximum(history[h], 1.0)
            own = _kept(counts[i], history[h]) / c_h
            if own.any():
                codes.append(self.ids[h] * len(self.probabilities) + self.ids[w])
                extra.append(own)
                self.left[self.ids[h]] -= own
        order = np.argsort(np.array(codes, np.int64), kind="stable")
        self.pairs, self.extra = np.array(codes, np.int64)[order], np.array(extra, float).reshape(-1, 2)[order]
        self._memo: dict[str, int] = {}

    def place(self, word: str) -> int:
        at = self._memo.get(word)
        if at is None:
            at = self.ids.get(word)
            if at is None:
                at = self.ids.get(stem_of(word), len(self.probabilities) - 1)
            if len(self._memo) >= _CACHE:
                self._memo.clear()
            self._memo[word] = at
        return at

    def chances(self, words: list[str]) -> np.ndarray:
        """P_y of each word given the one before it (the first one's has no history), one row a word."""
        at = np.fromiter(map(self.place, words), np.int64, len(words))
        p = self.probabilities[at]
        if len(self.pairs) and len(at) > 1:
            p[1:] *= self.left[at[:-1]]
            codes = at[:-1] * len(self.probabilities) + at[1:]
            found = np.minimum(np.searchsorted(self.pairs, codes), len(self.pairs) - 1)
            hit = np.flatnonzero(self.pairs[found] == codes)
            p[hit + 1] += self.extra[found[hit]]
        return p

    def likelihoods(self, words: list[str]) -> np.ndarray:
        """Natural-log likelihoods of a text under both models; zeros without words."""
        return np.log(self.chances(words)).sum(axis=0) if words else np.zeros(2)


def fit_counts(sample: DataFrame) -> list[KneserNeyPair]:
    """The model of the whole sample, then for each part the one of all other parts. What reaches the driver and the tasks
    are words and stems of ``LISTED`` contexts and pairs that can be kept: fewer than half the sample's words."""
    counts = stage_table(expression_counts(sample), "kn-counts")
    is_pair = F.contains(F.col("e"), F.lit(" ")) & ~F.col("e").endswith(" ")
    is_history = F.col("e").endswith(" ")
    words = ~F.contains(F.col("e"), F.lit(" ")) & ~F.col("e").endswith("*")
    columns = [("c0", "c1"), *((f"c0_{p}", f"c1_{p}") for p in range(PARTS))]
    totals = counts.where(words).agg(*[F.sum(c).alias(c) for pair in columns for c in pair]).first()
    keepable = counts.where(is_pair & (F.greatest("c0", "c1") > CLASS_DISCOUNT))
    heads = keepable.select(F.substring("e", F.lit(1), F.instr("e", " ")).alias("e")).distinct()
    listed = counts.where(~is_pair & ~is_history & (F.col("c0") + F.col("c1") >= LISTED)).unionByName(keepable).unionByName(
        counts.where(is_history).join(heads, "e", "left_semi")).orderBy("e").toPandas()
    models = []
    for pair in columns:
        number = listed[list(pair)].to_numpy(float).reshape(-1, 2)
        several = listed["e"].str.endswith("*") | ~listed["e"].str.contains(" ")
        rows = listed[(number.sum(axis=1) >= LISTED) | ~several]
        models.append(KneserNeyPair(rows["e"].tolist(), rows[list(pair)].to_numpy(float).reshape(-1, 2), np.array([totals[c] or 0 for c in pair], float)))
    return models


def with_likelihoods(texts: DataFrame, model: KneserNeyPair) -> DataFrame:
    """``texts`` (doc_id, text, ...) with n_words, ll_ordinary and ll_toxic in place of the text."""
    others = [c for c in texts.columns if c != "text"]
    schema = T.StructType([texts.schema[c] for c in others] + [T.StructField("n_words", T.LongType()),
                          T.StructField("ll_ordinary", T.DoubleType()), T.StructField("ll_toxic", T.DoubleType())])
    shared = texts.sparkSession.sparkContext.broadcast(model)       # bounded by the fitting sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kn = shared.value
        for batch in batches:
            lengths, lls = [], []
            for text in batch.column(0).to_pylist():
                words = words_of(text)
                lengths.append(len(words))
                lls.append(kn.likelihoods(words))
            table = np.array(lls).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(lengths, pa.int64()), pa.array(table[:, 0], pa.float64()),
                                              pa.array(table[:, 1], pa.float64())], names=[*others, "n_words", "ll_ordinary", "ll_toxic"])

    return texts.select("text", *others).mapInArrow(run, schema)


def _normalised():
    """The difference a word, squeezed between -1 and 1 so that a few texts with a large one do not decide the curve."""
    x = F.when(F.col("n_words") > 0, (F.col("ll_toxic") - F.col("ll_ordinary")) / F.col("n_words")).otherwise(0.0) * SCALE
    return x / (1 + F.abs(x))


class ToxicityModel:
    def __init__(self, kn: KneserNeyPair | None, slope: float, intercept: float):
        self.kn, self.slope, self.intercept = kn, slope, intercept


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
        per_class: int = PER_CLASS) -> ToxicityModel:
    """Counts from at most about ``per_class`` labelled texts of each class outside the held-out fold; the
    logistic curve from the same texts, each by the counts of the other parts. Without rows of both
    classes the score is the smoothed share of label 1."""
    sample = training_sample(labels, label, per_class)
    rows = stage_table(labelled_texts(id_text(docs, id_col, text_col), sample), "kn-sample")
    n = {0.0: 0, 1.0: 0} | {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    if not n[0.0] or not n[1.0]:
        return ToxicityModel(None, 0.0, float(np.log((n[1.0] + 1) / (n[0.0] + 1))))
    kn, *others = fit_counts(rows)
    judged = [stage_table(with_likelihoods(rows.where(F.col("part") == p), other).select("y", _normalised().alias("x")), "kn-judged")
              for p, other in enumerate(others)]
    curve = stage_table(reduce(DataFrame.unionByName, judged).repartition(1).sortWithinPartitions("x", "y"), "kn-curve")   # two numbers a sample text
    # a larger difference never speaks for the other class
    lr = (LogisticRegression(labelCol="y", featuresCol="v", regParam=1e-5, maxIter=200, lowerBoundsOnCoefficients=Matrices.dense(1, 1, [0.0]))
          .fit(curve.select("y", array_to_vector(F.array("x")).alias("v"))))
    return ToxicityModel(kn, float(lr.coefficients[0]), float(lr.intercept))


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text",
                   threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted, n_words, ll_ordinary, ll_toxic.

    Null, empty and wordless texts have likelihoods of 0 and the curve's value at 0. Null ids are
    scored and not held out; repeated rows are scored alike.
    """
    texts = id_text(docs, id_col, text_col)
    if model.kn is None:
        lls = texts.select("doc_id", F.lit(0).cast("bigint").alias("n_words"), F.lit(0.0).alias("ll_ordinary"), F.lit(0.0).alias("ll_toxic"))
    else:
        lls = with_likelihoods(texts, model.kn)
    x = F.lit(model.intercept) + F.lit(model.slope) * _normalised()
    return (lls.withColumn("score", 1 / (1 + F.exp(-x)))
            .select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"),
                    "n_words", "ll_ordinary", "ll_toxic"))
