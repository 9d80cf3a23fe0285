"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as entry
from sectora import registry
from tests.conftest import SMOKE_DIR
from tools.compare import TABLES, norm, rows_of

QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{SMOKE_DIR}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


#: Queries whose rows must come in the oracle's order.
ORDERED = {"list_reports", "list_reports_by_created", "order_catalog", "apply_report_sorts", "read_report"}


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "provider_id"
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SMOKE_DIR)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLE:
        assert rows and all(len(r) == len(df.columns) for r in rows)
        return
    cur = duck.execute(ORACLE[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    expected = cur.fetchall()
    assert rows_of(df.columns, rows) == rows_of(dcols, expected)
    if name in ORDERED:
        at = [dcols.index(c) for c in df.columns]
        assert [norm(r) for r in rows] == [norm(tuple(r[i] for i in at)) for r in expected]
