"""Catalog tables of the warehouse (K6): created only where absent, partitioned by date and bucketed by the row's own key.

The bucket column is the transaction hash: it is unique, so buckets stay even however many rows a sender has (buckets by
sender would put a hot sender's rows into one). Rows that are already in buckets need no shuffle: the search for known
hashes (K7), the audit for repeated ones (V7) and joins by hash read the stored table bucket by bucket.

A table has a location of its own. A session without a lasting catalog creates it over the files that are there and
finds their partitions again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .warehouse import _folder, one_per_key


def _quoted(name: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def create_table(spark: SparkSession, name: str, schema: StructType, location: str, key: str = "tx_hash", date: str | None = "date_key",
                 buckets: int | None = None) -> None:
    """K6: CREATE TABLE IF NOT EXISTS, Parquet, one folder a ``date`` (None: not partitioned), ``buckets`` buckets by ``key``.

    The number of buckets lasts as long as the table: choose it for the size that the table will reach. Spark joins
    without a shuffle of the table when it is at least ``spark.sql.shuffle.partitions``, the default. An existing table
    stays as it is, whatever ``schema`` says.
    """
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    parts = f"PARTITIONED BY ({_quoted(date)}) " if date else ""
    place = location.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_quoted(name)} ({columns}) USING parquet OPTIONS (compression 'zstd') {parts}"
              f"CLUSTERED BY ({_quoted(key)}) INTO {n} BUCKETS LOCATION '{place}'")
    if date:
        files, where = _folder(spark, location)
        files.mkdirs(where)                              # the search for partitions needs the folder
        spark.catalog.recoverPartitions(name)


def bucket_count(spark: SparkSession, name: str) -> int:
    rows = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(name)}").collect()}
    return int(rows["Num Buckets"])


def new_rows(batch: DataFrame, name: str, key: str = "tx_hash") -> DataFrame:
    """The rows of ``batch`` whose key the table does not have. The batch comes to the table's buckets, not the other way."""
    spark = batch.sparkSession
    stored = spark.table(name).select(F.col(key).alias("_k"))
    dealt = batch.repartition(bucket_count(spark, name), F.col(key))
    return dealt.join(stored.hint("merge"), dealt[key] == stored["_k"], "left_anti")


def append_new_rows(batch: DataFrame, name: str, key: str = "tx_hash") -> int:
    """K7 into a catalog table: append the rows whose key it does not have, one row a key (the least by all columns in
    their order); the number of rows added. Rows with a NULL key are left out. Running it again adds nothing. The batch
    is shuffled once, to the table's buckets: each task looks for its keys in one bucket and writes that bucket's files. One
    load runs at a time."""
    spark = batch.sparkSession
    columns = spark.table(name).columns
    added = Observation("added")
    fresh = new_rows(one_per_key(batch.select(*columns), key), name, key).select(*columns)
    fresh.observe(added, F.count(F.lit(1)).alias("rows")).write.insertInto(name)
    spark.catalog.refreshTable(name)
    return int(added.get["rows"])


def repeated_keys(spark: SparkSession, name: str, key: str = "tx_hash") -> DataFrame:
    """V7 over a bucketed table: (key, rows) of the keys with more than one row, counted bucket by bucket, without a shuffle."""
    return spark.table(name).groupBy(key).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
