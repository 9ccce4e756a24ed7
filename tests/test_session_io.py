"""Sizing helper, under-split spreading and the salted partitioned write."""

import os
import tempfile

from pyspark.sql import functions as F

from ledgerline.session import ensure_checkpoint_dir, release_stages, scale_conf, stage_table
from ledgerline.sources import io


def test_scale_conf_bounds():
    small = scale_conf(10 * 2**30)
    assert small["spark.sql.shuffle.partitions"] == "200"
    big = scale_conf(100 * 10**12)
    assert big["spark.sql.shuffle.partitions"] == "100000"
    assert big["spark.sql.files.maxPartitionBytes"] == big["spark.sql.adaptive.advisoryPartitionSizeInBytes"]


def test_salted_partitioned_write_bounds_files(spark):
    df = spark.range(4000).select((F.col("id") % 2).cast("string").alias("network"), F.col("id").alias("v"))
    path = tempfile.mkdtemp(prefix="ledgerline-k2-") + "/t"
    io.write_partitioned(df.repartition(16), path, by="network", salt_buckets=3)
    for value in ("0", "1"):
        files = [f for f in os.listdir(f"{path}/network={value}") if f.endswith(".parquet")]
        assert 1 <= len(files) <= 3
    back = spark.read.parquet(path)
    assert back.count() == 4000 and back.where("network = '1'").count() == 2000


def test_release_stages_deletes_only_the_stage_tables(spark, tmp_path):
    before = ensure_checkpoint_dir(spark)
    try:
        spark.sparkContext.setCheckpointDir(str(tmp_path))      # a folder of its own, apart from the other tests'
        own = spark.sparkContext.getCheckpointDir().removeprefix("file:")
        other = os.path.join(own, "other")
        os.makedirs(other)
        assert stage_table(spark.range(5), "t").count() == 5 and os.listdir(f"{own}/ledgerline-work")
        release_stages(spark)
        assert not os.path.exists(f"{own}/ledgerline-work") and os.path.isdir(other)
        release_stages(spark)
    finally:
        spark.sparkContext.setCheckpointDir(before)
