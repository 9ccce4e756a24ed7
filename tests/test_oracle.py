"""Every registered query against its DuckDB oracle on the sf0.001 driver tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from ledgerline.plans import catalog

from conftest import SF_SMALL

NAMES = sorted(catalog.queries())


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return v


def _rows(rs):
    return sorted((tuple(_norm(x) for x in r) for r in rs), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("events", "customer"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t + '.parquet')}')")
    return c


def test_every_query_has_oracle():
    assert set(catalog.oracle_sql()) == set(catalog.queries())
    assert set(catalog.queries()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    cols = df.columns
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(cols) == sorted(ocols)
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    oorder = sorted(range(len(ocols)), key=lambda i: ocols[i])
    assert _rows([tuple(r[i] for i in order) for r in got]) == _rows([tuple(r[i] for i in oorder) for r in want])


def test_entry_smoke(spark):
    out = entry.entry(spark)
    assert out.count() == 60
    assert out.columns == ["full_date", "network", "daily_volume", "running_volume", "volume_rank"]
