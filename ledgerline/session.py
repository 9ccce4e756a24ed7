"""Session helpers: building a session, the shared checkpoint folder, stage materialisation.

Library code never fixes the number of shuffle partitions or hard-codes a local folder: it reads
what the cluster configured and only fills gaps (tests, local runs).
"""

from __future__ import annotations

import math
import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Settings that the operators rely on. AQE gives runtime broadcast conversion (size checked on
# real shuffle statistics), partition coalescing and skew-join splitting of hot keys.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    # Static and runtime broadcast limits: a join side is only broadcast when Spark has
    # checked its (estimated or measured) size against these.
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def scale_conf(input_bytes: int, partition_bytes: int = 512 << 20, max_partitions: int = 100_000) -> dict:
    """Shuffle and scan sizing for an input of ``input_bytes``.

    Shuffle partitions are sized so that each holds about ``partition_bytes`` of the largest
    shuffle (the dedupe, which moves roughly the whole input) and fits an executor's memory
    with room to spill; AQE then merges small ones towards the same advisory size. The count is
    capped because map-status metadata grows with mappers x reducers: at 100 TB and 512 MB this
    gives ~190,000, so the cap applies (about 1 GB per partition, spill-backed). Scan splits use
    the same size, so a task reads about as much as it shuffles.
    """
    parts = min(max_partitions, max(200, math.ceil(input_bytes / partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * partition_bytes),
    }


def build_session(master: str | None = None, app_name: str = "ledgerline",
                  shuffle_partitions: int | None = None, extra: dict | None = None,
                  input_bytes: int | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings above. ``master`` and
    ``shuffle_partitions`` are for local runs; on a cluster pass ``input_bytes`` (or leave the
    sizing to spark-submit)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.ui.enabled"] = "false"
    if input_bytes:
        conf.update(scale_conf(input_bytes))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, honouring ``spark.checkpoint.dir``.

    Only a local master without a configured folder (unit tests on one machine) gets a fresh local one;
    any other master raises, since its executors would each write to a disk of their own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for written stage tables, under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/ledgerline-work/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage at a stage boundary with a reliable checkpoint.

    The result is stable across re-executions (needed where range partition ids or sampling
    must not change between two reads of the same data) and survives executor loss.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stage_table(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Cut lineage at a large stage boundary by writing a Parquet table in the shared
    checkpoint folder and reading it back.

    Unlike an RDD checkpoint (whole rows), later passes read only the columns they use and get
    filter pushdown, and Spark sees the table's real size when it decides on broadcasts. Like a
    checkpoint, the table survives executor loss. ``compression`` is a Parquet codec (default: the session's).
    """
    return counted_stage_table(df, name, compression)[0]


def _parquet(df: DataFrame, path: str, compression: str | None) -> None:
    writer = df.write.mode("overwrite")
    (writer.option("compression", compression) if compression else writer).parquet(path)


def counted_stage_table(df: DataFrame, name: str, compression: str | None = None) -> tuple[DataFrame, int]:
    """``stage_table`` plus its row count, observed during the write (no extra job)."""
    spark = df.sparkSession
    path = work_dir(spark, f"stage-{name}")
    obs = Observation(f"rows-{name}")
    _parquet(df.observe(obs, F.count(F.lit(1)).alias("rows")), path, compression)
    return spark.read.parquet(path), int(obs.get["rows"])


@contextmanager
def scratch_tables(spark: SparkSession, compression: str | None = None):
    """A ``stage(df, name)`` for tables that nothing reads after the block; they are deleted at its end."""
    made: list[str] = []

    def stage(df: DataFrame, name: str) -> DataFrame:
        path = work_dir(spark, f"scratch-{name}")
        made.append(path)
        _parquet(df, path, compression)
        return spark.read.parquet(path)

    try:
        yield stage
    finally:
        for path in made:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def release_stages(spark: SparkSession) -> None:
    """Delete this application's stage tables, at its end: frames that read them are unusable afterwards.
    The checkpoint folder is the application's own (Spark makes one per ``setCheckpointDir``)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/ledgerline-work")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
