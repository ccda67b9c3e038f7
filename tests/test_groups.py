import random

import pytest
from pyspark.sql import functions as F

from bibspark.functions.paths import leaf
from bibspark.operators import groups as G
from bibspark.operators.quantiles import exact_quantiles


@pytest.fixture(scope="module")
def arrays(spark):
    rows = [(1, None), (2, []), (3, [None]), (4, [None, "a"]), (5, ["a", "a", "b"])]
    return spark.createDataFrame(rows, "id int, tags array<string>")


def pairs(df):
    return sorted((r["key"], r["count"]) for r in df.collect())


def test_documents_are_counted_not_elements(arrays):
    assert pairs(G.group_count(arrays, "tags")) == [("a", 2), ("b", 1)]
    assert pairs(G.group_count(arrays, "tags", unknown="unknown")) == [("a", 2), ("b", 1), ("unknown", 3)]
    assert pairs(G.group_presence(arrays, "tags")) == [("false", 3), ("true", 2)]


def test_continents_count_once(spark):
    table = spark.createDataFrame([("Europe", "FR"), ("Europe", "DE"), ("North America", "US"), ("Asia", "JP")], "continent string, code string")
    df = spark.createDataFrame([(["FR", "DE", "US"],), ([],), (["XX"],)], "codes array<string>")
    assert pairs(G.group_continent(df, "codes", table)) == [("Asia", 0), ("Europe", 1), ("North America", 1), ("unknown", 1)]


def test_group_many_agrees_with_single_facets(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/orders.parquet")
    many = G.group_many(df, ["o_orderstatus", "o_orderpriority"])
    for path in ("o_orderstatus", "o_orderpriority"):
        assert pairs(many.where(F.col("facet") == path)) == pairs(G.group_count(df, path))


def test_year_window():
    assert G.year_window("1") == (1000, 1999)
    assert G.year_window("19") == (1900, 1999)
    assert G.year_window("201") == (2010, 2019)
    assert G.year_window("2020") == (2020, 2020)
    assert G.year_window("x") == (1000, 3000)


def test_zero_fill_stops_at_a_page(spark):
    counts = spark.createDataFrame([("a", 3), ("b", 1)], "key string, count bigint")
    domain = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "key string")
    assert pairs(G.zero_fill(counts, domain, 3)) == [("a", 3), ("b", 1), ("c", 0)]


def test_metrics_count_a_work_once(spark):
    rows = [("e", 1, 10, "gold"), ("e", 1, 10, "gold"), ("e", 2, 30, "closed"), ("f", 1, 10, "gold")]
    df = spark.createDataFrame(rows, "entity string, work int, cites int, status string")
    got = G.metrics(df, "entity", "work", ["cites", "status"], G.measures("work", "cites", None, "status")).orderBy("entity").collect()
    assert [tuple(r) for r in got] == [("e", 2, 40, 0.5), ("f", 1, 10, 1.0)]


def test_filter_counts_zero_for_negated_lists(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    k = leaf(df, "k")
    from bibspark.operators.predicates import eq

    got = G.filter_counts(df, [{"field": "k", "values": {"a": eq(k, "a"), "b": eq(k, "b")}, "negate": True}])
    assert {(r.field, r.value): r["count"] for r in got.collect()} == {("", "all"): 1, ("k", "a"): 0, ("k", "b"): 0}


@pytest.mark.parametrize("shape", ["even", "hot", "wide", "tiny"])
def test_exact_quantiles(spark, shape):
    rng = random.Random(5)
    data = {
        "even": [rng.random() * 1000 for _ in range(3000)],
        "hot": [7.0] * 2000 + [rng.random() for _ in range(1000)],
        "wide": [10.0 ** rng.uniform(-200, 200) for _ in range(2000)],
        "tiny": [3.0, 1.0, 2.0],
    }[shape]
    df = spark.createDataFrame([(v,) for v in data] + [(None,)], "v double")
    got = exact_quantiles(df, ["v"], [0.0, 0.25, 0.5, 0.75, 1.0])
    ordered = sorted(data)
    for p in (0.0, 0.25, 0.5, 0.75, 1.0):
        rank = max(1, -(-int(p * 100) * len(data) // 100))
        assert got["v", p] == ordered[rank - 1]


def test_histogram_empty_frame(spark):
    df = spark.createDataFrame([], "v double")
    assert G.histogram(df, "v", 10, 0).count() == 0
