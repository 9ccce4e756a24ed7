"""Quality classifier as a sparse rule ensemble.

Every text becomes a row of statistics. Shallow trees of a random forest are fitted on a bounded
sample of labelled rows; each path from a root is a rule, a conjunction of conditions on
statistics. A logistic regression with a lasso penalty weighs the rules, most of them by zero,
and the rest are compiled into one Spark column expression that gives the score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage_table
from .common import id_text
from .labelled import held_out, labelled_texts, training_sample

PER_CLASS = 8_000               # bound of the fitting sample: rows a class
TREES, DEPTH, LASSO, ITERATIONS = 16, 3, 0.0004, 60
THRESHOLD = 0.7
STATISTICS = ("log_words", "word_len", "upper", "digit", "symbol", "exclaim", "pipe", "space", "other",
              "symbol_words", "short_words", "long_words", "distinct", "top_word", "repeat_next", "line_len", "repeat_lines", "log_lines")


def _byte_classes() -> np.ndarray:
    kind = np.full(256, 7, np.int64)                     # 7: bytes beyond ASCII and controls
    for number, chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789",
                                    b"#$%&*+<=>@[\\]^_`{}~/", b"!?", b"|", b" \t\n\r\x0b\x0c", b"\"'(),-.:;")):
        kind[np.frombuffer(chars, np.uint8)] = number if number < 7 else 8
    return kind


_KIND = _byte_classes()


def text_statistics(raw: bytes) -> list[float]:
    """The values of ``STATISTICS`` for one UTF-8 text; all 0 for a text without words."""
    words = raw.split()
    if not words:
        return [0.0] * len(STATISTICS)
    n, size = len(words), len(raw)
    kinds = np.bincount(_KIND[np.frombuffer(raw, np.uint8)], minlength=9) / size
    low = [w.lower().strip(b".,;:!?") for w in words]
    counts: dict[bytes, int] = {}
    for w in low:
        counts[w] = counts.get(w, 0) + 1
    ends = np.fromiter((w[-1] for w in words), np.uint8, n)
    lens = np.fromiter(map(len, words), np.int64, n)
    again = sum(map(bytes.__eq__, low, low[1:]))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return [float(np.log1p(n)), float(lens.mean()), kinds[1], kinds[2], kinds[3], kinds[4], kinds[5], kinds[6], kinds[7],
            float((_KIND[ends] == 3).mean()), float((lens <= 2).mean()), float((lens >= 12).mean()), len(counts) / n,
            max(counts.values()) / n, again / n, float(np.log1p(n / len(lines))), 1 - len(set(lines)) / len(lines),
            float(np.log1p(len(lines)))]


def with_statistics(texts: DataFrame) -> DataFrame:
    """``texts`` (doc_id, text bytes, ...) with ``stats`` in place of the text."""
    others = [c for c in texts.columns if c != "text"]
    schema = T.StructType([texts.schema[c] for c in others] + [T.StructField("stats", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = pa.array([text_statistics(t) for t in batch.column(0).to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], stats], names=[*others, "stats"])

    return texts.select("text", *others).mapInArrow(run, schema)


Rule = tuple[tuple[int, bool, float], ...]      # (statistic, is "<=", threshold) of each condition


def tree_rules(node, path: Rule = ()) -> list[Rule]:
    """Every path below a tree's node as a rule (public node classes of the tree models)."""
    out = [path] if path else []
    if node.getClass().getSimpleName() == "InternalNode":
        f, t = int(node.split().featureIndex()), float(node.split().threshold())
        out += tree_rules(node.leftChild(), (*path, (f, True, t))) + tree_rules(node.rightChild(), (*path, (f, False, t)))
    return out


def simplify(rule: Rule) -> Rule:
    """One condition for each statistic and direction: the tightest."""
    tight: dict[tuple[int, bool], float] = {}
    for f, low, t in rule:
        tight[f, low] = t if (f, low) not in tight else (min if low else max)(tight[f, low], t)
    return tuple(sorted((f, low, t) for (f, low), t in tight.items()))


def rule_column(rule: Rule, stats: Column) -> Column:
    out = F.lit(True)
    for f, low, t in rule:
        x = F.get(stats, F.lit(f))
        out = out & ((x <= t) if low else (x > t))
    return out


class RuleEnsemble:
    """Weighted rules; ``score`` is a column expression over the statistics."""

    def __init__(self, rules: list[tuple[Rule, float]], intercept: float):
        self.rules, self.intercept = rules, intercept

    def score(self, stats: Column) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(rule_column(rule, stats), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))

    def explain(self) -> list[str]:
        say = lambda f, low, t: f"{STATISTICS[f]} {'<=' if low else '>'} {t:.4g}"
        return [f"{w:+.3f}  {' and '.join(say(*c) for c in r)}" for r, w in sorted(self.rules, key=lambda x: -abs(x[1]))]


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text",
        per_class: int = PER_CLASS) -> RuleEnsemble:
    """Fitted on at most ``per_class`` labelled rows a class outside the held-out fold. Without rows of
    both classes the ensemble has no rules and its score is the smoothed share of label 1."""
    sample = training_sample(labels, label, per_class)
    rows = with_statistics(labelled_texts(id_text(docs, id_col, text_col, binary=True), sample))
    # the table is read and measured by as many tasks as it has splits; only the written sample, of a bounded number of
    # rows, is gathered for the two fits
    measured = stage_table(rows.select("doc_id", "y", "stats"), "quality-sample")
    train = stage_table(measured.withColumn("features", array_to_vector("stats")).repartition(4, "doc_id"), "quality-train")
    count = {r["y"]: r["count"] for r in train.groupBy("y").count().collect()}
    if len(count) < 2:
        p = (count.get(1.0, 0) + 1) / (sum(count.values()) + 2)
        return RuleEnsemble([], float(np.log(p / (1 - p))))
    forest = RandomForestClassifier(labelCol="y", numTrees=TREES, maxDepth=DEPTH, maxBins=64, minInstancesPerNode=2,
                                    featureSubsetStrategy="onethird", subsamplingRate=0.7, seed=7).fit(train)
    rules = sorted({simplify(r) for tree in forest.trees for r in tree_rules(tree._call_java("rootNode"))})
    fired = F.array(*[rule_column(r, F.col("stats")).cast("double") for r in rules])
    lasso = LogisticRegression(labelCol="y", featuresCol="rules", elasticNetParam=1.0, regParam=LASSO, maxIter=ITERATIONS,
                               standardization=False).fit(train.select("y", array_to_vector(fired).alias("rules")))
    weights = lasso.coefficients.toArray()
    return RuleEnsemble([(r, float(w)) for r, w in zip(rules, weights, strict=True) if w], float(lasso.intercept))


def score_quality(docs: DataFrame, model: RuleEnsemble, id_col: str = "doc_id", text_col: str = "text",
                  threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Null and empty texts, and texts of white space, have all statistics 0 and get the score that
    the rules give to that. Null ids are scored and not held out; repeated rows are scored alike.
    """
    stats = with_statistics(id_text(docs, id_col, text_col, binary=True))
    return (stats.select("doc_id", held_out().alias("held_out"), model.score(F.col("stats")).alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def keep_good(docs: DataFrame, model: RuleEnsemble, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with all its columns without the rows that the model rejects, in one pass."""
    stats = F.pandas_udf(lambda texts: texts.map(text_statistics), T.ArrayType(T.DoubleType()))
    raw = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")
    scratch = "_quality_stats"
    while scratch in docs.columns:
        scratch += "_"
    return docs.withColumn(scratch, stats(raw)).where(model.score(F.col(scratch)) >= threshold).drop(scratch)
