"""Every registered query against its DuckDB oracle on the smallest tables."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as E
from footfall import oracle, registry
from tests.conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "events"]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return int(v)
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return ([cols[i] for i in order],
            sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=str))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(registry.queries()) == set(oracle.queries())
    assert set(registry.queries()) <= set(E.queries()) and set(oracle.queries()) <= set(E.oracle_sql())


# the optional training-data queries have tests of their own
@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    res = con.execute(E.oracle_sql()[name])
    got = _canon(df.columns, [tuple(r) for r in df.collect()])
    want = _canon([d[0] for d in res.description], res.fetchall())
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["timestamp", "city_id", "district_id", "section_id", "visitor_number"]
    assert df.count() > 0
