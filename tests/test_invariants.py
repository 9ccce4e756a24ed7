"""
test of the distributed median against pandas."""

import math

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.operators import aggregates as A
from ledgerline.operators.clean import dedupe_first
from ledgerline.operators.median import group_median
from ledgerline.operators.quality import observed_rows, split_valid
from ledgerline.plans import queries as Q
from ledgerline.plans.stages import Ledger

from conftest import SF_SMALL


def _ledger(spark):
    if not hasattr(_ledger, "L"):
        _ledger.L = Ledger(spark, SF_SMALL)
    return _ledger.L


def test_valid_and_invalid_partition_the_input(spark):
    L = _ledger(spark)
    valid, invalid = split_valid(L.clean)
    ids = lambda df: {r.tx_id for r in df.select("tx_id").collect()}
    v, i, c = ids(valid), ids(invalid), ids(L.clean)
    assert v.isdisjoint(i) and v | i == c


def test_dedupe_is_idempotent(spark):
    once = dedupe_first(_ledger(spark).raw)
    assert once.exceptAll(dedupe_first(once)).count() == 0 and once.count() == dedupe_first(once).count()


def test_volumes_agree(spark):
    val = _ledger(spark).validated
    daily = A.daily_stats(val).agg(F.sum("daily_volume")).first()[0]
    net = A.volume_by_network(val).agg(F.sum("volume")).first()[0]
    total = A.amount_overview(val).first().total_volume
    assert math.isclose(daily, total, rel_tol=1e-12) and math.isclose(net, total, rel_tol=1e-12)


def test_last_running_volume_is_network_total(spark):
    L = _ledger(spark)
    q3 = Q.q3_running_volume(L.fact, L.dim_date, L.dim_network).collect()
    last = {}
    for r in q3:
        last[r.network] = r.running_volume
    totals = {r.network: r.volume for r in A.volume_by_network(L.validated).collect()}
    assert last.keys() == totals.keys()
    for k in last:
        assert math.isclose(last[k], totals[k], rel_tol=1e-12)


def test_min_max_in_unit_interval(spark):
    r = _ledger(spark).validated.agg(F.min("amount_normalized"), F.max("amount_normalized")).first()
    assert r[0] == 0.0 and r[1] == 1.0


def test_report_rollup_equals_direct(spark):
    val = _ledger(spark).validated
    rolled = A.report_from_rollup(A.report_rollup(val))
    direct = {"volume_by_network": A.volume_by_network(val), "volume_by_type": A.volume_by_type(val),
              "status_counts": A.status_counts(val), "amount_overview": A.amount_overview(val),
              "anomaly_rate": A.anomaly_rate(val), "kpi_summary": A.kpi_summary(val)}
    for name, df in direct.items():
        got = sorted(tuple(r) for r in rolled[name].select(*df.columns).collect())
        want = sorted(tuple(r) for r in df.collect())
        assert got == want, name


def test_observed_rows_without_extra_job(spark, tmp_path):
    df, obs = observed_rows(_ledger(spark).validated, "validated")
    df.write.parquet(str(tmp_path / "v"))
    assert obs.get["rows"] == _ledger(spark).validated.count()


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]),
                          st.one_of(st.none(), st.integers(-5, 5).map(float),
                                    st.floats(-1e6, 1e6, allow_nan=False))), min_size=1, max_size=60),
       st.integers(1, 4), st.integers(2, 8))
def test_median_property(spark, rows, max_rank_rows, buckets):
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.m for r in group_median(df, ["g"], "v", "m", max_rank_rows=max_rank_rows,
                                          buckets=buckets).collect()}
    want = pd.DataFrame(rows, columns=["g", "v"]).groupby("g")["v"].median().dropna().to_dict()
    assert got.keys() == want.keys()
    for g in want:
        assert got[g] == want[g] or math.isclose(got[g], want[g], rel_tol=1e-15)
