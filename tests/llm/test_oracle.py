"""Queries that SQL can express, against DuckDB on the smallest tables."""

import duckdb
import pytest

from cumulus.llm.queries import ORACLE, QUERIES
from cumulus.sources.tables import TABLES
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    got = QUERIES[name](spark, SF_SMALL)
    cols = sorted(got.columns)
    rel = con.sql(ORACLE[name])
    assert sorted(rel.columns) == cols
    at = [rel.columns.index(c) for c in cols]
    want = sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=str)
    assert sorted((tuple(r[c] for c in cols) for r in got.collect()), key=str) == want
