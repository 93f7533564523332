"""Every registered query against its DuckDB oracle on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from pairrank.plans import queries as core

SF = "/root/testdata/sf0.001"
TABLES = ["orders", "lineitem", "events", "customer", "part"]
CORE = core.queries()
SQL = {k: v for k, v in entry.oracle_sql().items() if k in CORE}
QUERIES = {k: v for k, v in entry.queries().items() if k in CORE}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _rows(df):
    df = df[sorted(df.columns)]
    rows = [tuple(None if v is None or v != v else v for v in r) for r in df.itertuples(index=False)]
    return sorted(rows, key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SF).toPandas()
    exp = con.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(exp.columns)
    assert len(got) == len(exp)
    assert _rows(got) == _rows(exp)


def test_every_query_has_rows(spark):
    for name in sorted(set(QUERIES) - set(SQL)):
        assert QUERIES[name](spark, SF).count() > 0, name


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["user_id", "item_id", "score"]
    assert df.where("score IS NULL").count() == 0
