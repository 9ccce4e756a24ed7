"""The bounded sample of labelled rows on which the two classifiers are fitted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_fold

HELD_OUT_FOLD, FOLDS = 2, 4


def held_out(id_col: str = "doc_id"):
    """False for a null id, which no label names."""
    return F.coalesce(id_fold(id_col, FOLDS) == HELD_OUT_FOLD, F.lit(False))


def training_sample(labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """(lab_id, y, part) of at most about ``per_class`` training rows a class, chosen by a hash of the id;
    ``part`` is 0-3 by another hash. Rows with a null id or label, held-out rows and rows whose id
    carries both labels teach nothing; repeated rows count once."""
    clean = (labels.select(F.col("doc_id").alias("lab_id"), F.col(label).alias("y"))
             .where("lab_id is not null and y in (0, 1)").where(~held_out("lab_id"))
             .groupBy("lab_id").agg(F.min("y").alias("y"), F.max("y").alias("_top")).where("y = _top").drop("_top"))
    counts = {int(r["y"]): r["count"] for r in clean.groupBy("y").count().collect()}
    share = F.lit(0.0)
    for y, n in counts.items():
        share = F.when(F.col("y") == y, F.lit(min(1.0, per_class / n))).otherwise(share)
    draw = F.pmod(F.xxhash64("lab_id", F.lit(5)), F.lit(1_000_000)) / 1e6
    return (clean.where(draw < share)
            .select("lab_id", F.col("y").cast("double").alias("y"), F.pmod(F.xxhash64("lab_id", F.lit(6)), F.lit(4)).alias("part")))


def labelled_texts(texts: DataFrame, sample: DataFrame) -> DataFrame:
    """``texts`` (doc_id, ...) that the sample names, with y and part. The sample's bound is a
    parameter (16 bytes a row), so it is broadcast and no text is shuffled."""
    return texts.join(F.broadcast(sample), texts["doc_id"] == sample["lab_id"]).drop("lab_id")
