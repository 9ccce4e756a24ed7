"""Warehouse loads that can be rerun (K7): one folder a date and load, rejects included.

A load has an id. Its rows go to ``date_key=<date>/load_id=<id>``, its rejects to ``<path>_rejected/load_id=<id>``,
and both are replaced as a whole when the load runs again, so a rerun after a failure at any point, or with a corrected
batch, gives the rows of one load. A transaction's hash covers its time, so equal hashes share their date: the
search for rows that other loads have already brought reads only the batch's own dates, and its cost grows with
the batch instead of the table. (The key audit V7 finds a hash under two dates.) One load runs at a time.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import packed_key
from ..session import scratch_tables

LOAD = "load_id"
DATE_LIST = 1000                # dates that a partition filter lists; a longer batch filters by its first and last date
_LOAD_NAME = re.compile(r"[A-Za-z][A-Za-z0-9_.-]*")


@dataclass(frozen=True)
class LoadResult:
    loaded: int
    repeated: int               # rows whose key another load, or another row of the batch, has
    rejected: int


def _folder(spark: SparkSession, path: str):
    """(file system, path) as Hadoop knows them."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def read_loads(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None while no load has written a row. Any other error of the read surfaces."""
    files, where = _folder(spark, path)
    if not files.exists(where):
        return None
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "UNABLE_TO_INFER_SCHEMA":        # a folder without any data file
            return None
        raise


def date_filter(batch: DataFrame, date: str, limit: int = DATE_LIST) -> Column:
    """A filter on the partition column that keeps the dates of ``batch``: a list of them, or their range."""
    dates = [r[0] for r in batch.select(date).distinct().limit(limit + 1).collect()]
    known = [d for d in dates if d is not None]
    if len(dates) <= limit:
        keep = F.col(date).isin(known)
        return keep | F.col(date).isNull() if len(known) < len(dates) else keep
    first, last = batch.agg(F.min(date), F.max(date)).first()
    return F.col(date).between(first, last) | F.col(date).isNull()


def one_per_key(batch: DataFrame, key: str) -> DataFrame:
    """Of rows with one key the least by all columns in their order; combined in the map tasks."""
    rest = [c for c in batch.columns if c != key]
    return (batch.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*rest)).alias("_row"))
            .select(key, "_row.*").select(*batch.columns))


def keys_and_rejects(batch: DataFrame, key: str) -> DataFrame:
    """``one_per_key`` and the rows with a NULL key, from one pass and one shuffle of ``batch``: its columns, the key packed
    (``columns.packed_key``), and ``_n``, how many rows of the batch a row stands for (of those with a NULL key, equal ones)."""
    packed, _ = packed_key(batch, key)
    rest = [c for c in batch.columns if c != key]
    rows = batch.select(packed.alias(key), F.struct(*rest).alias("_row"))
    groups = rows.groupBy(key, F.when(F.col(key).isNull(), F.col("_row")).alias("_reject"))
    return groups.agg(F.min("_row").alias("_row"), F.count(F.lit(1)).alias("_n")).select(key, "_row.*", "_n").select(*batch.columns, "_n")


REPEATS = 4096


def _repeated(rows: DataFrame) -> DataFrame:
    """Every row as often as its ``_n`` says."""
    runs = rows.withColumn("_run", F.explode(F.expr(f"sequence(0L, (_n - 1) div {REPEATS})")))
    return runs.withColumn("_one", F.explode(F.expr(f"sequence(1L, least({REPEATS}L, _n - _run * {REPEATS}))"))).drop("_n", "_run", "_one")


def fresh_rows(batch: DataFrame, stored: DataFrame | None, load_id: str, key: str = "tx_hash", date: str = "date_key") -> DataFrame:
    """Rows of ``batch`` that no other load of the same dates has; ``batch`` itself where there is no such load."""
    if stored is None:
        return batch
    others = stored.where(date_filter(batch, date) & (F.col(LOAD) != load_id)).select(F.col(key).alias("_k"), F.col(date).alias("_d"))
    if others.isEmpty():
        return batch
    return batch.join(others, (batch[key] == others["_k"]) & batch[date].eqNullSafe(others["_d"]), "left_anti")


def _replace(df: DataFrame, path: str, by: list[str]) -> int:
    """Write ``df`` over exactly the partitions that it has; the number of its rows, observed."""
    rows = Observation("written")
    (df.observe(rows, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option("compression", "zstd")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path))
    return int(rows.get["rows"])


def _delete(spark: SparkSession, folders: list[str]) -> None:
    for folder in folders:
        files, where = _folder(spark, folder)
        files.delete(where, True)


def load_by_date(df: DataFrame, path: str, load_id: str, key: str = "tx_hash", date: str = "date_key") -> LoadResult:
    """K7: bring a batch into the table at ``path``, as load ``load_id``.

    Rows with a NULL key are rejected, with the reason; of rows with one key the least is taken; rows that
    another load of the same date has are skipped. Rows without a date have a partition of their own. Running a
    load again replaces it; dates that it no longer has are emptied.

    The batch is read once and crosses the network twice: to its keys, and to the files of its dates. Both times, and in
    between, a hash has half its bytes.
    """
    if not _LOAD_NAME.fullmatch(load_id):
        raise ValueError(f"a load id is a letter and then letters, digits, '_', '.' or '-': {load_id!r}")
    spark, path = df.sparkSession, path.rstrip("/")
    _, back = packed_key(df, key)
    with scratch_tables(spark, "zstd") as stage:
        batch = stage(keys_and_rejects(df, key), "load-batch")
        given = batch.where(F.col(key).isNotNull())
        unique = given.drop("_n")
        stored = read_loads(spark, path)
        fresh = fresh_rows(unique, None if stored is None else stored.withColumn(key, packed_key(df, key)[0]), load_id, key, date)
        if fresh is not unique:                                 # the load's own folders are replaced below
            fresh = stage(fresh, "load-fresh")

        # every date of this load's earlier run: a scan of its own folders only
        before = [] if stored is None else [r[0] for r in stored.where(F.col(LOAD) == load_id).select(date).distinct().collect()]
        spread = fresh.hint("rebalance", F.col(date)).withColumns({key: back(key), LOAD: F.lit(load_id)})
        loaded = _replace(spread, path, [date, LOAD])
        now = {r[0] for r in fresh.select(date).distinct().collect()} if before else set()
        name = "__HIVE_DEFAULT_PARTITION__"
        _delete(spark, [f"{path}/{date}={name if d is None else d}/{LOAD}={load_id}" for d in before if d not in now])

        bad = _repeated(batch.where(F.col(key).isNull()))
        bad = bad.withColumns({key: F.lit(None).cast(df.schema[key].dataType), "reason": F.lit(f"{key} is NULL"), LOAD: F.lit(load_id)})
        rejected = _replace(bad, f"{path}_rejected", [LOAD])
        if not rejected:
            _delete(spark, [f"{path}_rejected/{LOAD}={load_id}"])
        return LoadResult(loaded, (given.agg(F.sum("_n")).first()[0] or 0) - loaded, rejected)
