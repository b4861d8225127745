"""Every registered query against its SQL oracle on the smallest data set."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as entry
from tidemark.plans.registry import load_all
from tidemark.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = load_all()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return repr([_norm(x) for x in v])
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "record_count" in df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF)
    cols = sorted(sdf.columns)
    srows = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=_key)
    res = con.execute(ORACLES[name])
    ocols = [d[0] for d in res.description]
    assert sorted(ocols) == cols
    idx = {c: i for i, c in enumerate(ocols)}
    orows = sorted((tuple(_norm(r[idx[c]]) for c in cols) for r in res.fetchall()), key=_key)
    assert srows == orows
