"""Small helpers shared by the operators of this subpackage.

Words are what ``bytes.lower().split()`` gives on UTF-8 bytes: Python lower-cases only A-Z in
bytes and splits on exactly the six characters 0x20 and 0x09-0x0D.
"""

from __future__ import annotations

import os
import string
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table_path, work_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", binary: bool = False) -> DataFrame:
    """Only (doc_id, text), so that further columns of ``docs``, whatever their names, cannot
    clash with an operator's own; a null text is the empty text. ``binary`` gives UTF-8 bytes."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), (text.cast("binary") if binary else text).alias("text"))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else (``lower`` would also map other alphabets)."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def id_fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def numbered(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """(``docs`` as a written table with a number for each row, the number's column). Decisions by this number cannot touch
    another row that repeats an id, nor miss one without an id. The column has no name that ``docs`` has. The copy is
    compressed by zstd, since it holds whole texts."""
    key = free_name(docs, "_row")
    path = work_dir(docs.sparkSession, f"stage-numbered-{name}")
    docs.withColumn(key, F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.parquet(path), key


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, longer where ``docs`` has such a column."""
    while name in docs.columns:
        name += "_"
    return name


def without_rows(rows: DataFrame, key: str, dropped: DataFrame) -> DataFrame:
    """``rows`` without those whose ``key`` is in the one column of ``dropped``, and without the key."""
    gone = dropped.select(F.col(f"`{dropped.columns[0]}`").alias("_gone"))
    return rows.join(gone, rows[key] == gone["_gone"], "left_anti").drop(key)


def ship_package(spark: SparkSession) -> None:
    """Give this package's modules to the executors' Python workers (as ``--py-files`` would), once
    per application."""
    sc = spark.sparkContext
    if getattr(sc, "_ledgerline_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="ledgerline-pyfiles-"), "ledgerline_package.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(archive)
    sc._ledgerline_shipped = True
