"""Every registered query against its DuckDB oracle on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from cumulus.plans.registry import all_oracle_sql, all_queries
from cumulus.sources.tables import TABLES
from tests.conftest import SF_SMALL

QUERIES = all_queries()
ORACLE = all_oracle_sql()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "l32" in df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    cols = sorted(sdf.columns)
    srows = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=str)
    rel = con.sql(ORACLE[name])
    dcols = rel.columns
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    drows = sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=str)
    assert srows == drows
