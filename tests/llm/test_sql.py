"""Queries with a DuckDB oracle."""

import pytest

import __spark_entry__ as entry
from sectora.llm import queries
from tests.conftest import SMOKE_DIR
from tools.compare import TABLES, rows_of


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE_DIR}/{t}.parquet')")
    cur = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    df = entry.queries()[name](spark, SMOKE_DIR)
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, cur.fetchall())


def test_queries_are_registered():
    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in queries.QUERIES}
    assert "pipeline" in entry.queries()
