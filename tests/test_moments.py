"""Mean and deviation against fractions, and their bits over any number of partitions."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.normalize import moments, scale_and_flag


def exact(values):
    xs = [Fraction(round(v * 1e8), 10**8) for v in values if v is not None]
    n = len(xs)
    mean = sum(xs) / n if n else None
    var = sum((x - mean) ** 2 for x in xs) / (n - 1) if n > 1 else None
    return (None if mean is None else float(mean)), (None if var is None else math.sqrt(var))


def rows(spark, values):
    return spark.createDataFrame([(v,) for v in values], "amount double")


CASES = {
    "ordinary": [round(random.Random(1).lognormvariate(3, 2), 8) for _ in range(3000)],
    "negative": [round(random.Random(2).gauss(0, 50), 6) for _ in range(1000)],
    "close to a border of the halves": [9.99999, 10.00001] * 500 + [10.0],
    "large and close": [8_999_999_999.5, 8_999_999_999.25, 8_999_999_998.75] * 300,
    "constant": [12.5] * 40,
    "far apart": [1e-8, 8e9, -8e9, 3.0] * 200,
    "one": [4.25], "none": [], "nulls": [None, None], "some nulls": [None, 1.0, 2.0, None, 4.0],
}


@pytest.mark.parametrize("name", CASES)
def test_moments_equal_fractions(spark, name):
    got = moments(rows(spark, CASES[name]), "amount").first()
    for g, w in zip(got, exact(CASES[name])):
        assert (g is None) == (w is None)
        assert w is None or g == pytest.approx(w, rel=1e-12, abs=1e-14)


def test_bits_do_not_depend_on_partitions(spark):
    df = rows(spark, CASES["ordinary"]).withColumn("tx_id", F.monotonically_increasing_id())
    results = []
    for n in (1, 7, 64):
        scored = scale_and_flag(df.repartition(n))
        results.append(sorted((r.tx_id, r.amount_zscore, r.amount_normalized, r.is_anomaly) for r in scored.collect()))
    assert results[0] == results[1] == results[2]


def test_values_without_units_take_the_engines_doubles(spark):
    got = moments(rows(spark, [1e12, 3e12]), "amount").first()
    assert got._mu == pytest.approx(2e12) and got._sd == pytest.approx(math.sqrt(2) * 1e12)
    assert math.isnan(moments(rows(spark, [float("nan"), 1.0]), "amount").first()._mu)


def test_further_aggregates_come_from_the_same_scan(spark):
    out = moments(rows(spark, [1.0, 5.0]), "amount", F.min("amount").alias("_min"), F.max("amount").alias("_max"))
    assert out.first().asDict() == {"_mu": 3.0, "_sd": pytest.approx(math.sqrt(8)), "_min": 1.0, "_max": 5.0}
    assert out._jdf.queryExecution().executedPlan().toString().count("Scan") <= 2
