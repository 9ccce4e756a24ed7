"""File sources and sinks (S1-S3, K1-K3, K6, K7). Explicit schemas, no inference."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType, TimestampNTZType

from ..functions.columns import nan_to_null
from ..schemas import TRANSACTIONS_RAW, WALLET_METADATA
from ..session import stage_table
from .json_arrays import CORRUPT, read_json_arrays
from .warehouse import one_per_key

# Fixed value: the generator's timestamp text format, optionally with microseconds.
CSV_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
# What the usual CSV readers of data frames take as a missing number or time.
MISSING_TEXT = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
                "n/a", "nan", "null", "NaT")
_CSV_TEXT = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def scan_transactions_csv(spark: SparkSession, path: str, timestamp_format: str = CSV_TIMESTAMP_FORMAT, header: bool = True) -> DataFrame:
    """Every line of the CSV with the typed raw columns, ``reject_reason`` and ``record``.

    All fields are read as text and converted here, so a field that cannot be converted is told from one that is
    missing (empty, or one of ``MISSING_TEXT``), whichever columns a query asks for. ``reject_reason`` lists what is wrong
    (a wrong number of fields, a field of the wrong type, no id) and is NULL for a good line; ``record`` is then the line.
    Padding is kept: cleaning strips it, not the reader.
    """
    text = StructType([*[StructField(f.name, StringType()) for f in TRANSACTIONS_RAW.fields], StructField(CORRUPT, StringType())])
    rows = (spark.read.schema(text).option("header", header).option("mode", "PERMISSIVE").option("columnPruning", False)
            .option("columnNameOfCorruptRecord", CORRUPT).options(**_CSV_TEXT).csv(path))
    typed, wrong = [], [F.when(F.col(CORRUPT).isNotNull(), F.lit("number of fields"))]
    for f in TRANSACTIONS_RAW.fields:
        raw = F.col(f.name)
        if isinstance(f.dataType, StringType):
            typed.append(raw)
            continue
        given = F.when(~F.trim(raw).isin(*MISSING_TEXT), raw)
        if isinstance(f.dataType, TimestampNTZType) and timestamp_format != CSV_TIMESTAMP_FORMAT:
            value = F.try_to_timestamp(given, F.lit(timestamp_format)).cast(f.dataType)
        else:
            value = given.try_cast(f.dataType)
        value = nan_to_null(value) if isinstance(f.dataType, DoubleType) else value
        wrong.append(F.when((value.isNull() & given.isNotNull()) | (F.lit(not f.nullable) & given.isNull()), F.lit(f.name)))
        typed.append(value.alias(f.name))
    reason = F.concat_ws(", ", *wrong)
    record = F.coalesce(F.col(CORRUPT), F.to_csv(F.struct(*[f.name for f in TRANSACTIONS_RAW.fields])))
    return rows.select(*typed, F.when(reason != "", reason).alias("reject_reason"), F.when(reason != "", record).alias("record"))


def read_transactions_csv(spark: SparkSession, path: str, timestamp_format: str = CSV_TIMESTAMP_FORMAT, header: bool = True) -> DataFrame:
    """The good lines of ``scan_transactions_csv``. None of the others becomes a payment with missing fields."""
    rows = scan_transactions_csv(spark, path, timestamp_format, header)
    return rows.where(F.col("reject_reason").isNull()).drop("reject_reason", "record")


def ingest_transactions_csv(spark: SparkSession, path: str, target: str, timestamp_format: str = CSV_TIMESTAMP_FORMAT,
                            header: bool = True) -> tuple[DataFrame, dict[str, int]]:
    """S1 with a reject path, from one scan: good lines to ``<target>/kind=good`` and the others, with their reason, to
    ``<target>/kind=rejected`` (overwritten). Returns the good lines and the counts of both, observed in the write."""
    seen = Observation("csv-lines")
    bad = F.col("reject_reason").isNotNull()
    (scan_transactions_csv(spark, path, timestamp_format, header)
     .observe(seen, F.count_if(~bad).alias("good"), F.count_if(bad).alias("rejected"))
     .withColumn("kind", F.when(bad, "rejected").otherwise("good"))
     .write.mode("overwrite").partitionBy("kind").parquet(target))
    written = StructType([*[StructField(f.name, f.dataType) for f in TRANSACTIONS_RAW.fields], StructField("reject_reason", StringType()),
                          StructField("record", StringType()), StructField("kind", StringType())])
    good = spark.read.schema(written).parquet(target).where("kind = 'good'").select(*[f.name for f in TRANSACTIONS_RAW.fields])
    return good, {k: int(v) for k, v in seen.get.items()}


def write_transactions_csv(df: DataFrame, path: str, timestamp_format: str = "yyyy-MM-dd HH:mm:ss.SSSSSS") -> None:
    (df.write.mode("overwrite").option("header", True).option("timestampNTZFormat", timestamp_format)
     .options(**_CSV_TEXT).csv(path))


def read_wallet_metadata(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Wallet metadata JSON. ``multiline=True`` reads one JSON array (or object) per file, as the reference ships
    it, each file by as many tasks as it has splits (``json_arrays``); ``False`` reads JSON lines. What is no such record
    is left out: ``json_arrays.read_json_arrays`` also returns its text."""
    if multiline:
        rows = read_json_arrays(spark, path, WALLET_METADATA)
        return rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return spark.read.schema(WALLET_METADATA).json(path)


ARRAY_ROWS = 10_000             # rows of one JSON array


def write_json_arrays(df: DataFrame, path: str, rows: int | None = None) -> None:
    """Files that each hold one JSON array of at most ``rows`` rows: runs of rows of one partition, so there
    are more files when there are more rows, whatever values the rows repeat."""
    one = df.select(F.to_json(F.struct("*")).alias("j"), F.monotonically_increasing_id().alias("at"))
    runs = one.groupBy(F.expr(f"at div {rows or ARRAY_ROWS}").alias("run"))
    arrays = runs.agg(F.concat(F.lit("["), F.concat_ws(",\n", F.collect_list("j")), F.lit("]")).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """S3: Parquet scan; filters and projections are pushed into the scan by Catalyst."""
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str) -> None:
    """K1: overwrite a Parquet table (snappy is Spark's default codec). Spark writes one file per
    task; there is no coalesce(1) funnel through a single task."""
    df.write.mode("overwrite").parquet(path)


def write_together(tables: dict[str, DataFrame]) -> None:
    """K1 for tables that don't depend on one another (path -> rows): their jobs run side by side, so the
    tail of one leaves no core idle. The first error surfaces after all have ended."""
    def write(path: str) -> None:
        write_parquet(tables[path], path)

    with ThreadPoolExecutor(max_workers=max(1, min(4, len(tables)))) as pool:
        for done in [pool.submit(inheritable_thread_target(next(iter(tables.values())).sparkSession)(write), path) for path in tables]:
            done.result()


def write_partitioned(df: DataFrame, path: str, by: str = "network", salt_buckets: int | None = None) -> None:
    """K2: Hive-style partitions by ``by``; a filter on ``by`` then prunes whole folders.

    ``repartition(by)`` (the reference's way) would give each value one writer task: two
    networks, two writers. By default the data is written as it is already spread (each task
    writes one file per value it holds). With ``salt_buckets`` the rows of each value are first
    clustered into that many tasks, which bounds the file count for high-cardinality columns.
    """
    if salt_buckets:
        salt = F.abs(F.xxhash64(*df.columns)) % F.lit(salt_buckets)
        df = df.repartition(salt_buckets, F.col(by), salt)
    df.write.mode("overwrite").partitionBy(by).parquet(path)


def write_by_date(df: DataFrame, path: str, by: str = "date_key") -> None:
    """A table in one folder a day. ``rebalance`` collects a day's rows into few files and splits a day
    that is larger than a shuffle partition should be."""
    df.hint("rebalance", F.col(by)).write.mode("overwrite").partitionBy(by).parquet(path)


def write_report_csv(df: DataFrame, path: str) -> None:
    """K3: a one-row report as CSV with header. ``coalesce(1)`` is safe only because the
    input is a single aggregate row."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def read_report_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


# ---- warehouse load (K6, K7) -------------------------------------------------------------------

def table_exists(spark: SparkSession, path: str) -> bool:
    """False only when the path is missing; any other error of the read surfaces."""
    try:
        spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def create_table_like(df: DataFrame, path: str) -> None:
    """K6: create an empty Parquet table with ``df``'s schema if none exists (CTAS WHERE 1=0). Never
    overwrites: a table that exists but cannot be read raises and stays as it is."""
    if not table_exists(df.sparkSession, path):
        df.where(F.lit(False)).write.mode("errorifexists").parquet(path)


def append_new(df: DataFrame, path: str, key: str = "tx_hash") -> int:
    """K7: idempotent append: rows whose ``key`` is already in the table are skipped (left anti join), so
    a re-run does not double the table. Returns the number of rows written.

    The key is NOT NULL UNIQUE: of rows with one key inside the batch the least one (by all columns in
    their order) is loaded. Rows with a NULL key go to ``<path>_rejected/batch=<name>`` instead, which is
    overwritten; the name follows from the rejected rows themselves, so the same batch keeps its folder.
    The table is one unpartitioned folder and every load reads all its keys: ``warehouse.load_by_date`` is the load
    for a table that grows.
    """
    spark = df.sparkSession
    create_table_like(df, path)
    batch = one_per_key(df, key)
    existing = spark.read.parquet(path).select(F.col(key).alias("_existing"))
    rows = Observation("appended")
    fresh = batch.join(existing, batch[key] == existing["_existing"], "left_anti")
    fresh.observe(rows, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(path)

    rejected = stage_table(df.where(F.col(key).isNull()), "rejected")
    mark = F.xxhash64(*[F.col(c).cast("string") for c in df.columns]).cast("decimal(38,0)")
    n, total = rejected.agg(F.count(F.lit(1)), F.sum(mark)).first()
    if n:
        rejected.write.mode("overwrite").parquet(f"{path.rstrip('/')}_rejected/batch=r{n}_{abs(total)}")
    return int(rows.get["rows"])
