"""Scaling and anomaly flags.

Global statistics are computed with one aggregate (partials map-side, a single-row final) and
attached as a scalar subquery: the aggregate runs once and its value is read inside the rows'
whole-stage-codegen projection, with no join. Never an empty ``Window``, which would move every
row into one task.

Mean and deviation come from integer sums (``moments``), so their bits don't depend on how rows are spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage_table
from .aggregates import wallet_stats

Z_THRESHOLD = 3.5
FAILED_RATE_THRESHOLD = 0.2
RAPID_REPEAT_SECONDS = 1.0


def _with_global(df: DataFrame, stats: DataFrame) -> DataFrame:
    """``df`` plus the columns of the one-row ``stats``, through one scalar subquery."""
    fields = stats.columns
    one = stats.select(F.struct(*fields).alias("_g")).scalar()
    return (df.withColumn("_g", one)
            .withColumns({f: F.col("_g").getField(f) for f in fields})
            .drop("_g"))


UNITS = 100_000_000            # money has eight decimals
HALF = 1_000_000_000           # a value's units are cut into high * HALF + low; products of two halves fit a long
EXACT_BELOW = 9e9              # larger values have no exact units in a long


def moments(df: DataFrame, col: str, *more: Column) -> DataFrame:
    """One row: ``_mu``, the mean, and ``_sd``, the sample deviation (NULL for fewer than two values), of ``col``, and the
    further aggregates ``more``, from one scan.

    Values are rounded to eight decimals and summed, with their squares, as integers of 38 digits; the squares are
    centred at the mean before anything becomes a double. Sums of integers are the same in any order. Where a value is
    not a number or is 9e9 and more, both come from the engine's doubles instead.
    """
    x = F.col(col).cast("double")
    fits = F.abs(x) < EXACT_BELOW
    unit = F.when(fits, F.rint(x * F.lit(float(UNITS))).cast("bigint"))
    halves = df.withColumns({"_x": x, "_u": unit}).withColumns({"_h": F.expr(f"_u div {HALF}"), "_l": F.expr(f"_u % {HALF}")})

    def total(product: str) -> Column:
        return F.coalesce(F.sum(F.expr(f"cast({product} as decimal(28,0))")), F.lit(0)).cast("decimal(38,0)")

    sums = halves.agg(F.count("_u").alias("_n"), F.count_if(~fits).alias("_wide"), total("_h").alias("_sh"), total("_l").alias("_sl"),
                      total("_h * _h").alias("_hh"), total("_h * _l").alias("_hl"), total("_l * _l").alias("_ll"),
                      F.avg("_x").alias("_avg"), F.stddev_samp("_x").alias("_dev"), *more)
    # the sum of all units, its mean without the fraction and what is left of it
    s = sums.withColumn("_s", F.expr(f"cast(_sh * {HALF} + _sl as decimal(38,0))"))
    s = s.withColumn("_m", F.expr("case when _n > 0 then _s div _n end")).withColumn("_r", F.expr("cast(_s - cast(_m as decimal(20,0)) * _n as double)"))
    s = s.withColumns({"_mh": F.expr(f"cast(_m div {HALF} as decimal(10,0))"), "_ml": F.expr(f"cast(_m % {HALF} as decimal(10,0))"),
                       "_c": F.expr("cast(_n as decimal(18,0))")})
    # squares and products around that mean, exact
    s = s.withColumns({
        "_chh": F.expr("cast(_hh - cast(2 * _mh as decimal(11,0)) * _sh + _mh * _mh * _c as decimal(38,0))"),
        "_chl": F.expr("cast(_hl - _mh * _sl - _ml * _sh + _mh * _ml * _c as decimal(38,0))"),
        "_cll": F.expr("cast(_ll - cast(2 * _ml as decimal(11,0)) * _sl + _ml * _ml * _c as decimal(38,0))")})
    big = f"cast({HALF} as decimal(10,0))"
    exact = f"cast(try_add(try_add(try_multiply(try_multiply(_chh, {big}), {big}), try_multiply(try_multiply(_chl, {big}), cast(2 as decimal(1,0)))), _cll) as double)"
    wide = f"cast(_chh as double) * {HALF}D * {HALF}D + 2D * {HALF}D * cast(_chl as double) + cast(_cll as double)"   # beyond 38 digits
    s = s.withColumn("_d", F.expr(f"coalesce({exact}, {wide})"))
    mean = (F.col("_m").cast("double") + F.col("_r") / F.col("_n")) / F.lit(float(UNITS))
    dev = F.sqrt(F.greatest(F.col("_d") - F.col("_r") * F.col("_r") / F.col("_n"), F.lit(0.0)) / (F.col("_n") - 1)) / F.lit(float(UNITS))
    kept = sums.columns[sums.columns.index("_dev") + 1:]
    engine = F.col("_wide") > 0
    return s.select(F.when(engine, F.col("_avg")).when(F.col("_n") > 0, mean).alias("_mu"),
                    F.when(engine, F.col("_dev")).when(F.col("_n") > 1, dev).alias("_sd"), *kept)


def min_max_scale(df: DataFrame, col: str = "amount", out: str = "amount_normalized") -> DataFrame:
    """(x - min) / (max - min); NULL when max = min."""
    stats = df.agg(F.min(col).alias("_min"), F.max(col).alias("_max"))
    return (_with_global(df, stats)
            .withColumn(out, F.try_divide(F.col(col) - F.col("_min"), F.col("_max") - F.col("_min")))
            .withColumn(out, F.when(F.col("_max") == F.col("_min"), F.lit(None).cast("double")).otherwise(F.col(out)))
            .drop("_min", "_max"))


def z_score(df: DataFrame, col: str = "amount", out: str | None = None) -> DataFrame:
    """(x - mean) / sample std (ddof = 1); NULL for one row or a constant column."""
    out = out or f"{col}_zscore"
    stats = moments(df, col)
    sd = F.col("_sd")
    return (_with_global(df, stats)
            .withColumn(out, F.when(sd.isNull() | (sd == 0), F.lit(None).cast("double"))
                        .otherwise((F.col(col) - F.col("_mu")) / sd))
            .drop("_mu", "_sd"))


def scale_and_flag(df: DataFrame, threshold: float = Z_THRESHOLD, col: str = "amount") -> DataFrame:
    """N1 + N2 + N3 with one statistics aggregate (min, max, mean, sample std in one scan)
    instead of one scan per statistic pair."""
    stats = moments(df, col, F.min(col).alias("_min"), F.max(col).alias("_max"))
    x, lo, hi, sd = F.col(col), F.col("_min"), F.col("_max"), F.col("_sd")
    z = F.when(sd.isNull() | (sd == 0), F.lit(None).cast("double")).otherwise((x - F.col("_mu")) / sd)
    return (_with_global(df, stats)
            .withColumn("amount_normalized" if col == "amount" else f"{col}_normalized",
                        F.when(hi == lo, F.lit(None).cast("double")).otherwise(F.try_divide(x - lo, hi - lo)))
            .withColumn(f"{col}_zscore", z)
            .withColumn("is_anomaly", F.coalesce(F.abs(F.col(f"{col}_zscore")) > F.lit(threshold),
                                                 F.lit(False)).cast("int"))
            .drop("_min", "_max", "_mu", "_sd"))


def flag_anomalies(df: DataFrame, threshold: float = Z_THRESHOLD, col: str = "amount") -> DataFrame:
    """Z-score, then is_anomaly = |z| > threshold (NULL z -> 0)."""
    z = f"{col}_zscore"
    return (z_score(df, col, z)
            .withColumn("is_anomaly", F.coalesce(F.abs(F.col(z)) > F.lit(threshold), F.lit(False)).cast("int")))


def flag_failed_rate(df: DataFrame, threshold: float = FAILED_RATE_THRESHOLD) -> DataFrame:
    """Rows whose sender's failed_rate (A1) exceeds ``threshold``.

    The wallet table is grouped, so it is as large as the number of senders; the join is left to
    Spark's size checks, and a hot sender on the row side is split by AQE's skew join.
    """
    risky = (wallet_stats(df).where(F.col("failed_rate") > F.lit(threshold))
             .select(F.col("wallet_address").alias("sender"), "failed_rate"))
    return (df.join(risky, "sender", "left")
            .withColumn("high_failed_rate", F.col("failed_rate").isNotNull().cast("int")))


def flag_rapid_repeats(df: DataFrame, seconds: float = RAPID_REPEAT_SECONDS,
                       num_ranges: int | None = None) -> DataFrame:
    """Gap to the previous transaction of the same (sender, receiver) pair < ``seconds``.

    ``lag`` over (sender, receiver) alone would put a hot pair in one task. Rows are range-partitioned
    on (pair, time, tx_id) and written, so a pair's burst, even one inside a single second, is split
    like anything else; ``lag`` runs inside a range, and a range's first row takes its previous
    timestamp from the last row of the range before it (a table with one row per range). Rows
    without a timestamp are never flagged. All columns of ``df`` travel along: select those that are needed.
    """
    pair = ["sender", "receiver"]
    # micros since the epoch of the wall-clock (NTZ) value: no session time zone, no DST shifts
    epoch = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `timestamp`)")
    timed = df.withColumn("_t", epoch)
    n = num_ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = stage_table(timed.where(F.col("_t").isNotNull()).repartitionByRange(n, *pair, "_t", "tx_id")
                         .withColumn("_range", F.spark_partition_id()), "rapid-repeats", "zstd")

    last = ranged.groupBy("_range").agg(F.max(F.struct(*pair, "_t")).alias("_last"))
    carry = last.select(F.col("_range").alias("_k_range"), F.lag("_last").over(Window.orderBy("_range")).alias("_carry"))
    w = Window.partitionBy("_range", *pair).orderBy("_t", "tx_id")
    local = ranged.withColumn("_prev_t", F.lag("_t").over(w))
    joined = local.join(carry, local["_range"] == carry["_k_range"], "left")
    # null-safe: as in SQL's window, a NULL sender or receiver still forms one pair
    same_pair = F.col("_carry.sender").eqNullSafe(F.col("sender")) & F.col("_carry.receiver").eqNullSafe(F.col("receiver"))
    before = F.coalesce(F.col("_prev_t"), F.when(same_pair, F.col("_carry._t")))
    flagged = joined.withColumn("gap_seconds", (F.col("_t") - before) / F.lit(1_000_000.0)).withColumn(
        "is_rapid_repeat", F.coalesce(F.col("gap_seconds") < F.lit(float(seconds)), F.lit(False)).cast("int"))
    no_t = (df.where(F.col("timestamp").isNull())
            .withColumn("gap_seconds", F.lit(None).cast("double"))
            .withColumn("is_rapid_repeat", F.lit(0)))
    cols = [*df.columns, "gap_seconds", "is_rapid_repeat"]
    return flagged.select(*cols).unionByName(no_t.select(*cols))
