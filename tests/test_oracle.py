"""Every registered query with a DuckDB twin gives the same rows at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as entry
from scripts.check_oracle import TABLES, digest
from tests.conftest import SF_SMALL

SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_a_callable():
    assert set(SQL) <= set(QUERIES)
    assert len(QUERIES) >= 40


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_matches_oracle(spark, con, key):
    got = digest(QUERIES[key](spark, SF_SMALL).toPandas())
    want = digest(con.sql(SQL[key]).df())
    assert got[1] == want[1], "column names differ"
    assert got[0] == want[0], "row counts differ"
    assert got[2] == want[2], "values differ"


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["query_id", "node_id", "rank", "score"]
    assert all(1 <= r["rank"] <= 5 for r in rows)
