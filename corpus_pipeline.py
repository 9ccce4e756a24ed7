"""From ``documents`` to packed training sequences, in five stages.

Each stage is a function (spark, docs, sf_dir) -> DataFrame over what its predecessor kept; all but the
last return the columns of ``docs``. ``run`` writes each result as Parquet in the shared folder and
reads it again as the next stage's input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import decontaminate, exact_dedup, minhash, packing, quality
from ledgerline.llm.common import read_table, ship_package
from ledgerline.session import ensure_checkpoint_dir, stage_table


def _ready(spark: SparkSession) -> None:
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the rule ensemble doesn't reject, each judged by its text alone; null and repeated ids are rows like others,
    except that the fit takes no labels for a null id."""
    _ready(spark)
    return quality.keep_good(docs, quality.fit(docs, read_table(spark, sf_dir, "labels")))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows with equal texts the one with the largest id, the last of those that repeat it; a null id ranks below
    all others. A row with a text of its own stays, whatever its id."""
    _ready(spark)
    return exact_dedup.keep_one(docs)


def minhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates (five-word shingles, 0.8), the first in the table's order; null and
    repeated ids are rows like others, and a row without words stays."""
    _ready(spark)
    return minhash.keep_one(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that overlap no benchmark item; null and repeated ids are rows like others."""
    _ready(spark)
    return decontaminate.keep_clean(docs, read_table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences; rows that repeat an id or have none are packed each."""
    _ready(spark)
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("exact_dedup", exact_dedup_stage),
    ("minhash", minhash_stage),
    ("decontaminate", decontaminate_stage),
    ("packing", packing_stage),
]

#: SQL can express neither the fitted classifier nor the tokenizer.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ready(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
