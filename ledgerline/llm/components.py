"""Connected components of a graph of links by alternating large-star and small-star steps
(Kiveris et al. 2014). Minima are aggregates with map-side partials and the rest are equi-joins,
so a vertex with a great many links is never gathered in one task; every step is written to the
shared folder, and only two numbers of it reach the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..session import work_dir


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    seen = Observation("links")
    path = work_dir(edges.sparkSession, "stage-links")
    (edges.observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"))
     .write.mode("overwrite").parquet(path))
    return edges.sparkSession.read.parquet(path), (seen.get["n"], seen.get["x"])


def _step(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    small = large.groupBy("u").agg(F.min("v").alias("m"))
    moved = large.join(small, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(small.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every end of a link (u, v); the component is its least node. Links of a
    node with itself, repeated links and either direction are fine; no links give no rows."""
    edges = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct()
    edges, mark = _written(edges)
    while mark[0]:
        edges, after = _written(_step(edges))
        if after == mark:
            break
        mark = after
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return leaves.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
