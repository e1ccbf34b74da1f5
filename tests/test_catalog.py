"""Every catalog query against its DuckDB oracle on the smallest scale factor."""

import datetime as dt
import decimal
import json
import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from rideflow.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
HAVE_DATA = Path(SF, "lineitem.parquet").exists()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(json.dumps([_norm(r[i]) for i in order], default=str) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    con.execute("SET TimeZone='UTC'")
    return con


def test_every_query_has_a_name_and_most_have_sql():
    qs, sqls = entry.queries(), entry.oracle_sql()
    assert set(sqls) <= set(qs)
    assert set(catalog.queries()) <= set(qs) and len(catalog.oracle_sql()) >= 65


@pytest.mark.skipif(not HAVE_DATA, reason="driver tables not present")
@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    sdf = catalog.queries()[name](spark, SF)
    s_rows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(catalog.oracle_sql()[name])
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    assert sorted(sdf.columns) == sorted(d_cols)
    assert _canon(sdf.columns, s_rows) == _canon(d_cols, d_rows)


@pytest.mark.skipif(not HAVE_DATA, reason="driver tables not present")
def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == [
        "event_id", "ts", "user_id", "event_type", "value", "month", "day_of_week", "day_of_month",
        "event_type_is_click",
    ]
