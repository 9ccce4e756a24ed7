"""Catalog tables: created where absent, loads that add only new rows, and plans that don't shuffle the stored table."""

import glob
import re
import uuid

import pytest
from pyspark.sql import functions as F

from ledgerline.sources import tables as T


@pytest.fixture
def name(spark):
    n = f"t_{uuid.uuid4().hex}"
    yield n
    spark.sql(f"DROP TABLE IF EXISTS {n}")


def _batch(spark, lo, hi, day=None):
    """Transactions, four fifths of one sender."""
    return spark.range(lo, hi).select(F.col("id").alias("tx_id"), F.concat(F.lit("h"), "id").alias("tx_hash"),
                                      F.when(F.col("id") % 5 < 4, "hot").otherwise(F.col("id").cast("string")).alias("sender"),
                                      (F.lit(day) if day else F.col("id") % 3 + 20240101).cast("int").alias("date_key"))


def _ids(spark, name):
    return sorted(r[0] for r in spark.table(name).select("tx_id").collect())


def test_loads_add_only_new_rows(spark, name, tmp_path):
    first = _batch(spark, 0, 300)
    T.create_table(spark, name, first.schema, str(tmp_path / "fact"), buckets=8)
    assert T.append_new_rows(first, name) == 300
    assert T.append_new_rows(first, name) == 0
    T.create_table(spark, name, first.schema, str(tmp_path / "fact"), buckets=3)          # there already: nothing changes
    assert T.bucket_count(spark, name) == 8
    overlap = _batch(spark, 250, 400).unionByName(_batch(spark, 390, 400)).unionByName(_batch(spark, 400, 401).withColumn("tx_hash", F.lit(None).cast("string")))
    assert T.append_new_rows(overlap, name) == 100
    assert _ids(spark, name) == list(range(400))
    assert T.append_new_rows(first.where("false"), name) == 0
    assert T.repeated_keys(spark, name).count() == 0
    # a file belongs to one bucket, so at most buckets x dates x loads of them
    assert len(glob.glob(str(tmp_path / "fact" / "date_key=*" / "*.parquet"))) <= 8 * 3 * 2


def test_a_table_is_found_again_without_its_catalog_entry(spark, name, tmp_path):
    batch = _batch(spark, 0, 50)
    T.create_table(spark, name, batch.schema, str(tmp_path / "fact"), buckets=4)
    T.append_new_rows(batch, name)
    spark.sql(f"DROP TABLE {name}")                       # as a new session without a lasting catalog; the files stay
    T.create_table(spark, name, batch.schema, str(tmp_path / "fact"), buckets=4)
    assert _ids(spark, name) == list(range(50))
    assert T.append_new_rows(batch, name) == 0


def test_the_stored_table_is_not_shuffled(spark, name, tmp_path):
    T.create_table(spark, name, _batch(spark, 0, 1).schema, str(tmp_path / "fact"), buckets=8)
    T.append_new_rows(_batch(spark, 0, 300), name)
    plan = T.new_rows(_batch(spark, 250, 400), name)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "LeftAnti" in plan
    assert plan.count("Exchange") == 1 and re.search(r"Bucketed: true", plan)             # the batch's own
    audit = T.repeated_keys(spark, name)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in audit and "Bucketed: true" in audit
    # a hot sender doesn't make a hot bucket
    sizes = [r[0] for r in spark.table(name).groupBy(F.pmod(F.hash("tx_hash"), F.lit(8))).count().select("count").collect()]
    assert max(sizes) < 3 * min(sizes)


def test_unpartitioned_table_and_repeated_keys(spark, name, tmp_path):
    batch = _batch(spark, 0, 20)
    T.create_table(spark, name, batch.schema, str(tmp_path / "flat"), date=None, buckets=4)
    T.append_new_rows(batch, name)
    batch.where("tx_id < 2").write.insertInto(name)       # past the loader
    assert sorted(map(tuple, T.repeated_keys(spark, name).collect())) == [("h0", 2), ("h1", 2)]
