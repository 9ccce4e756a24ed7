"""Exact per-group median without holding a large group in one task.

Spark's ``median``/``percentile`` keeps every distinct value of a group in one aggregation
buffer, so a group holding a third of 100 TB would sit in one task. This operator is exact and
keeps every task bounded:

1. the first scan gives, per group, the count, min and max, and from a mergeable quantile sketch (``percentile_approx``,
   combined in the map tasks) two values around the median, a little further apart than the sketch's error;
2. the second scan counts, per group, the values below that bracket and each distinct value inside it. The counts are
   exact, so they prove whether the two middle ranks lie inside; each of them gets a candidate interval: the bracket,
   or [min, max] in the rare case that the sketch missed;
3. if there are at most ``max_rank_rows`` counts and no miss, the ranks are read off the counts: two scans in all.
   Otherwise rounds follow: each counts the candidates of each open interval in ``buckets`` equal-width buckets (a hash
   aggregate to count/min/max, with map-side partials) and narrows the interval to the one bucket that holds its rank. The
   least and the greatest candidate never share a bucket, so every round drops at least one distinct value, and an
   interval of one value is closed: the rounds end by themselves, and two heavy middle values close in one round each. The
   candidates left are ranked with a window.

The per-interval state is a small table, written after each step, so Spark knows its size and
decides itself whether to broadcast it; one number per step reaches the driver.

The median of an even count is the mean of the two middle values, ``(a + b) / 2``, as pandas
computes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions.columns import nan_to_null
from ..session import counted_stage_table, stage_table

MAX_RANK_ROWS = 100_000
BUCKETS = 4096
SKETCH = 10_000                 # the sketch's rank error is at most a 10,000th of the group


def _open(state: DataFrame) -> DataFrame:
    return state.where(F.col("_lo") < F.col("_hi"))


def _candidates(base: DataFrame, state: DataFrame, by: list[str]) -> DataFrame:
    x = F.col("_x")
    return base.join(_open(state), by).where((x >= F.col("_lo")) & (x <= F.col("_hi")))


def _written(state: DataFrame) -> tuple[DataFrame, int]:
    """The state as a table, and the candidates of its widest open interval (observed during the write)."""
    seen = Observation("open-intervals")
    most = F.max(F.when(F.col("_lo") < F.col("_hi"), F.col("_m"))).alias("most")
    return stage_table(state.observe(seen, most), "median-state"), int(seen.get["most"] or 0)


def _refine(base: DataFrame, state: DataFrame, by: list[str], buckets: int) -> DataFrame:
    """One histogram round over the open intervals; closed ones pass through unchanged."""
    x, lo, hi = F.col("_x"), F.col("_lo"), F.col("_hi")
    # halves keep x - lo finite for values near the double range
    frac = F.coalesce(F.try_divide(x * 0.5 - lo * 0.5, hi * 0.5 - lo * 0.5), F.lit(0.0))
    # the greatest value has the last bucket and the least one the first, whatever rounding does
    inner = F.least(F.floor(frac * F.lit(float(buckets))).cast("bigint"), F.lit(buckets - 1))
    bucket = F.when(x >= hi, F.lit(buckets)).when(x <= lo, F.lit(-1)).otherwise(inner)
    key = [*by, "_which"]
    # _k and _off follow from the interval: they are grouped along, so the histogram needs no join back
    hist = (_candidates(base, state, by).withColumn("_b", bucket).groupBy(*key, "_k", "_off", "_b")
            .agg(F.count(F.lit(1)).alias("_c"), F.min("_x").alias("_bmin"), F.max("_x").alias("_bmax")))
    # rows before each bucket, within the interval's candidates (at most buckets + 2 rows an interval)
    w = Window.partitionBy(*key).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    hist = hist.withColumn("_before", F.coalesce(F.sum("_c").over(w), F.lit(0)))
    rank = F.col("_k") - F.col("_off")
    found = (hist.where((rank >= F.col("_before")) & (rank < F.col("_before") + F.col("_c")))
             .select(*key, "_k", F.col("_bmin").alias("_lo"), F.col("_bmax").alias("_hi"),
                     (F.col("_off") + F.col("_before")).alias("_off"), F.col("_c").alias("_m")))
    closed = state.where(~(F.col("_lo") < F.col("_hi")))
    return closed.unionByName(found.select(*closed.columns))


def group_median(df: DataFrame, by: list[str], value: str, out: str = "median",
                 max_rank_rows: int = MAX_RANK_ROWS, buckets: int = BUCKETS) -> DataFrame:
    """One row per group with a non-null value: ``by`` columns + ``out``."""
    base = df.select(*by, nan_to_null(value).alias("_x")).where(F.col("_x").isNotNull())
    for c in by:  # pandas groupby drops null keys: such rows get no median
        base = base.where(F.col(c).isNotNull())

    # twice the sketch's error to each side of the median
    around = F.percentile_approx("_x", [0.5 - 2 / SKETCH, 0.5 + 2 / SKETCH], SKETCH)
    groups, n_groups = counted_stage_table(base.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.min("_x").alias("_min"), F.max("_x").alias("_max"),
                                               around.alias("_q")).withColumns({"_from": F.col("_q")[0], "_to": F.col("_q")[1]}).drop("_q"), "median-groups")
    # one row for all that lies below a group's bracket (NULL), and one for each value inside it
    x = F.col("_x")
    counts, rows = counted_stage_table(base.join(groups, by).where(x <= F.col("_to")).withColumn("_v", F.when(x >= F.col("_from"), x))
                                       .groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_c")), "median-counts")
    state = _intervals(groups, counts, by)
    key = [*by, "_which"]
    if rows <= max_rank_rows:
        upto = F.sum("_c").over(Window.partitionBy(*key).orderBy("_v"))
        found = (counts.where(F.col("_v").isNotNull()).join(state.where("_inside"), by).withColumn("_last", F.col("_off") + upto)
                 .where((F.col("_k") < F.col("_last")) & (F.col("_k") >= F.col("_last") - F.col("_c"))).select(*key, "_v"))
        medians, decided = counted_stage_table(_middle(found, by, out), "median")
        if decided == n_groups:                                 # both middle ranks of every group were inside its bracket
            return medians

    state, most = _written(state.drop("_inside"))
    while most > max_rank_rows:
        state, most = _written(_refine(base, state, by, buckets))

    closed = state.where(~(F.col("_lo") < F.col("_hi"))).select(*key, F.col("_lo").alias("_v"))
    place = F.row_number().over(Window.partitionBy(*key).orderBy("_x")) - 1 + F.col("_off")
    ranked = (_candidates(base, state, by).withColumn("_pos", place)
              .where(F.col("_pos") == F.col("_k")).select(*key, F.col("_x").alias("_v")))
    return stage_table(_middle(closed.unionByName(ranked), by, out), "median")


def _intervals(groups: DataFrame, counts: DataFrame, by: list[str]) -> DataFrame:
    """One row a group and middle rank: its candidates' interval, and how many rows lie before it (``_off``) and in it
    (``_m``); ``_inside`` is false where the sketch's bracket missed the rank."""
    n, value = F.col("_n"), F.col("_v")
    sums = counts.groupBy(*by).agg(F.coalesce(F.sum(F.when(value.isNull(), F.col("_c"))), F.lit(0)).alias("_below"),
                                   F.coalesce(F.sum(F.when(value.isNotNull(), F.col("_c"))), F.lit(0)).alias("_within"),
                                   F.min("_v").alias("_vmin"), F.max("_v").alias("_vmax"))
    middle = F.array(F.struct(F.lit(1).alias("which"), F.floor((n - 1) / 2).cast("bigint").alias("k")),
                     F.struct(F.lit(2).alias("which"), F.floor(n / 2).cast("bigint").alias("k")))
    rows = groups.join(sums, by).withColumn("_r", F.explode(middle)).withColumns({"_which": F.col("_r.which"), "_k": F.col("_r.k")})
    inside = (F.col("_k") >= F.col("_below")) & (F.col("_k") < F.col("_below") + F.col("_within"))
    either = lambda a, b: F.when(F.col("_inside"), a).otherwise(b)
    return rows.withColumn("_inside", inside).select(
        *by, "_which", "_k", either(F.col("_vmin"), F.col("_min")).alias("_lo"), either(F.col("_vmax"), F.col("_max")).alias("_hi"),
        either(F.col("_below"), F.lit(0)).cast("bigint").alias("_off"), either(F.col("_within"), n).cast("bigint").alias("_m"), "_inside")


def _middle(values: DataFrame, by: list[str], out: str) -> DataFrame:
    """The mean of a group's two middle values, where both are known."""
    both = values.groupBy(*by).agg(F.max(F.when(F.col("_which") == 1, F.col("_v"))).alias("_a"), F.max(F.when(F.col("_which") == 2, F.col("_v"))).alias("_b"))
    return both.where(F.col("_a").isNotNull() & F.col("_b").isNotNull()).select(*by, ((F.col("_a") + F.col("_b")) / F.lit(2.0)).alias(out))
