"""Every registered query against its DuckDB oracle (rows, column names, values) on sf0.001,
and every rows-only query runs and yields a stable schema."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as E
from pricelens.plans.fixtures import RAW_TABLES
from tests.conftest import SF_SMALL, canon_rows

QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in RAW_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "upc" in df.columns


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(ORACLE[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    assert canon_rows(sdf.columns, srows) == canon_rows(rel.columns, rel.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_query_runs(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    n = df.count()
    assert n >= 0
    assert df.schema == QUERIES[name](spark, SF_SMALL).schema
