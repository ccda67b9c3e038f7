"""Every registered query against its SQL on the small tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from bibspark.plans.registry import TABLE_NAMES
from tools.check import rows_of

SQL = entry.oracle_sql()
# the queries of the llm folder have tests of their own, and may be missing
QUERIES = {name: fn for name, fn in entry.queries().items() if name in entry.QUERIES}
# no SQL: approximate answers, or a model's output; tested by hand in other files
ROWS_ONLY = {"stats_percentiles_approx", "knn_approximate", "embed_whole_texts"}


@pytest.fixture(scope="session")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLE_NAMES:
        con.sql(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(name, spark, sf_dir, duck):
    df = QUERIES[name](spark, sf_dir)
    got = df.collect()
    if name in ROWS_ONLY:
        assert name not in SQL and got
        return
    rel = duck.sql(SQL[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows_of(got, df.columns) == rows_of(rel.fetchall(), rel.columns)


def test_entry(spark, sf_dir):
    df = entry.entry(spark)
    assert df.columns == ["key", "nation", "count"]
    assert df.count() > 0
