"""Inline edge cases (FIXTURES section 3)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import aggregates as A
from ledgerline.operators.clean import clean_transactions, dedupe_first, enrich_with_metadata, normalize_addresses
from ledgerline.operators.features import add_features
from ledgerline.operators.normalize import flag_anomalies, flag_rapid_repeats, min_max_scale
from ledgerline.operators.quality import QualityGateError, assert_quality, split_valid
from ledgerline.operators.star import dim_date
from ledgerline.plans.queries import q5_daily_spike
from ledgerline.schemas import TRANSACTIONS_RAW

H = "0x" + "a" * 64
T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def tx(spark, rows):
    """rows: dicts over the raw columns; missing columns take plain defaults."""
    base = {"tx_id": 1, "tx_hash": H, "block_id": 1, "sender": "0xs", "receiver": "0xr", "amount": 1.0,
            "fee": 0.01, "tx_type": "TRANSFER", "status": "CONFIRMED", "timestamp": T0, "network": "mainnet"}
    full = [{**base, **r} for r in rows]
    return spark.createDataFrame([tuple(r[f.name] for f in TRANSACTIONS_RAW.fields) for r in full], TRANSACTIONS_RAW)


def test_nan_amount_is_imputed(spark):
    df = tx(spark, [{"tx_id": 1, "tx_hash": "h1", "amount": float("nan")},
                    {"tx_id": 2, "tx_hash": "h2", "amount": 4.0}])
    got = {r.tx_id: r.amount for r in clean_transactions(df).collect()}
    assert got == {1: 4.0, 2: 4.0}


def test_all_null_group_and_null_type_dropped(spark):
    df = tx(spark, [{"tx_id": 1, "tx_hash": "h1", "tx_type": "X", "amount": None},
                    {"tx_id": 2, "tx_hash": "h2", "tx_type": None, "amount": None},
                    {"tx_id": 3, "tx_hash": "h3", "amount": 2.0}])
    assert [r.tx_id for r in clean_transactions(df).collect()] == [3]


def test_median_sees_non_positive(spark):
    df = tx(spark, [{"tx_id": 1, "tx_hash": "h1", "amount": -1.0}, {"tx_id": 2, "tx_hash": "h2", "amount": 3.0},
                    {"tx_id": 3, "tx_hash": "h3", "amount": None}])
    got = {r.tx_id: r.amount for r in clean_transactions(df).collect()}
    assert got == {2: 3.0, 3: 1.0}


def test_dedupe_survivor_is_first(spark):
    df = tx(spark, [{"tx_id": 2, "amount": 9.0}, {"tx_id": 1, "amount": 5.0}])
    rows = dedupe_first(df).collect()
    assert [(r.tx_id, r.amount) for r in rows] == [(1, 5.0)]


def test_whitespace_stripped(spark):
    df = tx(spark, [{"sender": "\t 0xABC\n", "receiver": " 0xDEF "}])
    r = normalize_addresses(df).first()
    assert (r.sender, r.receiver) == ("0xabc", "0xdef")


def test_duplicate_metadata_fans_out(spark):
    df = tx(spark, [{"sender": "0xs"}])
    md = spark.createDataFrame([("0xs", True, "IN", 1.0), ("0xs", False, "US", 2.0)],
                               "wallet_address string, kyc_verified boolean, country string, risk_score double")
    assert enrich_with_metadata(df, md).count() == 2


def test_null_sender_passes_rule_and_has_no_group(spark):
    df = tx(spark, [{"sender": None}])
    valid, invalid = split_valid(df)
    assert valid.count() == 1 and invalid.count() == 0
    assert A.wallet_stats(valid).count() == 0


def test_null_hash_quarantined(spark):
    valid, invalid = split_valid(tx(spark, [{"tx_hash": None}]))
    assert valid.count() == 0
    assert invalid.first().failed_rules == "hash_length"


def test_constant_and_single_row_scaling(spark):
    df = tx(spark, [{"tx_id": i, "amount": 5.0} for i in range(3)])
    out = flag_anomalies(min_max_scale(df)).collect()
    assert all(r.amount_normalized is None and r.amount_zscore is None and r.is_anomaly == 0 for r in out)
    one = flag_anomalies(tx(spark, [{"amount": 5.0}])).first()
    assert one.amount_zscore is None and one.is_anomaly == 0


def test_half_even_fee_pct(spark):
    # fee / amount * 100 = 0.00005 -> 0.0 at 4 places (half-even), not 0.0001
    r = add_features(tx(spark, [{"amount": 1.0, "fee": 0.0000005}])).first()
    assert r.fee_pct == 0.0


def test_monday_is_zero(spark):
    d = dim_date(tx(spark, [{"timestamp": dt.datetime(2024, 1, 1, 12)}])).first()
    assert (d.day_of_week, d.is_weekend, d.date_key, d.month_name) == (0, False, 20240101, "January")
    assert add_features(tx(spark, [{"timestamp": dt.datetime(2024, 1, 1, 12)}])).first().day_of_week == 0


def _fact(spark, rows):
    return spark.createDataFrame(rows, "sender_key int, date_key int, status string")


def _dates(spark, keys):
    return spark.createDataFrame([(k, dt.date(2024, 1, k % 100)) for k in keys], "date_key int, full_date date")


def test_lag_uses_previous_present_day(spark):
    fact = _fact(spark, [(1, 20240101, "C")] * 2 + [(1, 20240103, "C")] * 7)
    out = q5_daily_spike(fact, _dates(spark, [20240101, 20240102, 20240103])).collect()
    assert [(r.prev_day_count, r.daily_tx_count, r.pct_change) for r in out] == [(2, 7, 250.0)]


def test_spike_boundary(spark):
    fact = _fact(spark, [(1, 20240101, "C")] * 2 + [(1, 20240102, "C")] * 6)
    assert q5_daily_spike(fact, _dates(spark, [20240101, 20240102])).count() == 0


def test_rapid_repeat(spark):
    rows = [{"tx_id": 1, "timestamp": T0}, {"tx_id": 2, "timestamp": T0 + dt.timedelta(milliseconds=500)},
            {"tx_id": 3, "timestamp": T0 + dt.timedelta(milliseconds=1500)},
            {"tx_id": 4, "timestamp": None}]
    got = {r.tx_id: r.is_rapid_repeat for r in flag_rapid_repeats(tx(spark, rows), seconds=1.0).collect()}
    assert got == {1: 0, 2: 1, 3: 0, 4: 0}


def test_rapid_repeat_across_buckets(spark):
    t = dt.datetime(2024, 1, 1, 10, 59, 59, 800000)
    rows = [{"tx_id": 1, "timestamp": t}, {"tx_id": 2, "timestamp": t + dt.timedelta(milliseconds=300)}]
    got = {r.tx_id: r.is_rapid_repeat for r in flag_rapid_repeats(tx(spark, rows), seconds=1.0).collect()}
    assert got == {1: 0, 2: 1}


def test_quality_gate(spark):
    assert assert_quality(tx(spark, [{"amount": 2.0}]))["bad_amount"] == 0
    with pytest.raises(QualityGateError):
        assert_quality(tx(spark, [{"amount": 0.0}]))


def test_kpi_rounding(spark):
    df = tx(spark, [{"tx_id": i, "amount": 1.00005, "status": "CONFIRMED" if i < 2 else "FAILED"} for i in range(3)])
    r = A.kpi_summary(df).first()
    assert (r.total_transactions, r.total_volume_btc, r.avg_amount, r.confirmed_pct) == (3, 3.0002, 1.00005, 66.67)


def test_scale_and_flag_equals_separate_steps(spark):
    df = tx(spark, [{"tx_id": i, "amount": float(v)} for i, v in enumerate([1, 2, 3, 4, 100, 5, 6])])
    from ledgerline.operators.normalize import scale_and_flag
    a = {r.tx_id: (r.amount_normalized, r.amount_zscore, r.is_anomaly) for r in scale_and_flag(df).collect()}
    b = {r.tx_id: (r.amount_normalized, r.amount_zscore, r.is_anomaly)
         for r in flag_anomalies(min_max_scale(df)).collect()}
    assert a == b


def test_rapid_repeat_ignores_session_time_zone(spark):
    # 2024-03-10 02:30 does not exist in New York; gaps must still come from wall-clock values
    rows = [{"tx_id": 1, "timestamp": dt.datetime(2024, 3, 10, 1, 59, 59, 900000)},
            {"tx_id": 2, "timestamp": dt.datetime(2024, 3, 10, 3, 0, 0, 100000)}]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = {r.tx_id: r.gap_seconds for r in flag_rapid_repeats(tx(spark, rows), seconds=1.0).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == {1: None, 2: 3600.2}


def test_rapid_repeat_null_receiver_pair(spark):
    t = dt.datetime(2024, 1, 1, 10, 0, 59, 800000)
    rows = [{"tx_id": 1, "receiver": None, "timestamp": t},
            {"tx_id": 2, "receiver": None, "timestamp": t + dt.timedelta(milliseconds=300)}]
    got = {r.tx_id: r.is_rapid_repeat for r in flag_rapid_repeats(tx(spark, rows), seconds=1.0).collect()}
    assert got == {1: 0, 2: 1}


def test_rapid_repeat_burst_is_split(spark):
    """One pair, 600 rows within one second, ranges far smaller than the burst: gaps across ranges stay exact."""
    t = dt.datetime(2024, 1, 1, 10, 0, 0)
    rows = [{"tx_id": i, "timestamp": t + dt.timedelta(microseconds=1500 * (i // 2))} for i in range(600)]
    rows += [{"tx_id": 1000 + i, "receiver": None, "sender": None, "timestamp": t + dt.timedelta(seconds=i)} for i in range(3)]
    out = flag_rapid_repeats(tx(spark, rows), seconds=0.001, num_ranges=16)
    got = {r.tx_id: (r.gap_seconds, r.is_rapid_repeat) for r in out.collect()}
    want = {i: (None if i == 0 else 0.0 if i % 2 else 0.0015, int(i % 2)) for i in range(600)}
    want |= {1000: (None, 0), 1001: (1.0, 0), 1002: (1.0, 0)}
    assert got == want and out.count() == len(rows)
    assert flag_rapid_repeats(tx(spark, rows[:1]).where("false")).count() == 0
