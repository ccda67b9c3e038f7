import pytest
from pyspark.sql import functions as F

from bibspark.functions.paths import leaf
from bibspark.operators import predicates as P


@pytest.fixture(scope="module")
def arrays(spark):
    rows = [(1, None), (2, []), (3, [None]), (4, [None, "a"]), (5, ["a", "a", "b"]), (6, ["B"])]
    return spark.createDataFrame(rows, "id int, tags array<string>")


@pytest.fixture(scope="module")
def places(spark):
    rows = [
        (1, [(True, 1, ["x"]), (False, 2, None)]),
        (2, [(True, 2, ["y", None])]),
        (3, []),
        (4, None),
        (5, [(None, None, [])]),
    ]
    return spark.createDataFrame(rows, "id int, at array<struct<oa:boolean,v:int,deep:array<string>>>")


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def split_by(df, pred):
    """The predicate and its negation part the rows."""
    yes, no = ids(df.where(pred)), ids(df.where(P.not_(pred)))
    assert sorted(yes + no) == ids(df) and not set(yes) & set(no)
    return yes


def test_any_element_and_document_negation(arrays):
    tags = leaf(arrays, "tags")
    assert split_by(arrays, P.eq(tags, "a")) == [4, 5]
    assert ids(arrays.where(P.not_(P.eq(tags, "a")))) == [1, 2, 3, 6]
    assert split_by(arrays, P.is_in(tags, ["b", "z"])) == [5, 6]
    assert ids(arrays.where(P.none_of(tags, ["a", "b"]))) == [1, 2, 3]
    assert ids(arrays.where(P.all_in(tags, ["a", "b"]))) == [5]


def test_presence_counts_null_elements_as_missing(arrays):
    tags = leaf(arrays, "tags")
    assert ids(arrays.where(P.not_null(tags))) == [4, 5, 6]
    assert ids(arrays.where(P.is_null(tags))) == [1, 2, 3]


def test_case_and_exact(arrays):
    tags = leaf(arrays, "tags")
    assert ids(arrays.where(P.eq(tags, "b", exact=True))) == [5]
    assert ids(arrays.where(P.contains(tags, "B"))) == [5, 6]
    assert ids(arrays.where(P.has_any(tags, ["B", "a"]))) == [4, 5, 6]


def test_correlation(places):
    tests = {"oa": lambda x: x, "v": lambda x: x == 2}
    assert ids(places.where(P.any_where(places, "at", tests))) == [1, 2]
    assert ids(places.where(P.any_where(places, "at", tests, correlated=True))) == [2]


def test_array_in_array(places):
    deep = leaf(places, "at.deep")
    assert ids(places.where(P.eq(deep, "y"))) == [2]
    assert ids(places.where(P.is_null(deep))) == [3, 4, 5]
    got = {r.id: r.d for r in places.select("id", deep.distinct.alias("d")).collect()}
    assert got == {1: ["x"], 2: ["y"], 3: [], 4: [], 5: []}


def test_ranges(spark):
    df = spark.createDataFrame([(i, i) for i in range(1, 10)] + [(10, None)], "id int, n int")
    n = leaf(df, "n")
    assert split_by(df, P.cmp(n, "=", 5)) == [5]
    assert split_by(df, P.cmp(n, ">", 5)) == [6, 7, 8, 9]
    assert split_by(df, P.between(n, 5, 9)) == [5, 6, 7, 8, 9]
    assert split_by(df, P.between(n, None, 5)) == [1, 2, 3, 4, 5]
    assert ids(df.where(P.between(n, 5, 9, negate=True))) == [1, 2, 3, 4, 10]
    assert ids(df.where(P.cmp(n, "!=", 5))) == [1, 2, 3, 4, 6, 7, 8, 9, 10]
    with pytest.raises(ValueError):
        P.between(n)


def test_dates_on_each_type(spark):
    df = spark.sql("select 1 as id, date '2020-01-01' as d, timestamp_ntz '2020-01-01 23:59:59' as n, timestamp '2020-01-01 10:00:00' as t")
    for col in ("d", "n", "t"):
        at = leaf(df, col)
        for op, hit in (("=", 1), ("<=", 1), (">=", 1), ("<", 0), (">", 0)):
            assert df.where(P.date_cmp(at, op, "2020-01-01")).count() == hit, (col, op)
        assert df.where(P.date_cmp(at, "<", "2020-01-02")).count() == 1


def test_only_id_is_not_a_complement(spark):
    df = spark.createDataFrame([(1, "m", None), (2, "m", "p"), (3, None, None)], "id int, mag string, pmid string")
    mag, rest = leaf(df, "mag"), [leaf(df, "pmid")]
    assert ids(df.where(P.only_id(mag, rest))) == [1]
    assert ids(df.where(P.only_id(mag, rest, False))) == [2]


def test_two_paths(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, "a"), (3, "b", "c"), (4, None, None)], "id int, x string, y string")
    x, y = leaf(df, "x"), leaf(df, "y")
    hit = P.either(x, y, lambda v: v == "a")
    assert split_by(df, hit) == [1, 2]
    assert ids(df.where(P.either(x, y))) == [3]
    assert ids(df.where(P.neither_known(x, y))) == [4]


def test_tree_and_unknown_path(arrays):
    node = {"join": "or", "filters": [{"field": "tags", "op": "is", "value": "b"}, {"join": "and", "not": True, "filters": [{"field": "tags", "op": "known", "value": True}]}]}
    assert ids(P.where(arrays, node)) == [1, 2, 3, 5, 6]
    with pytest.raises(ValueError):
        leaf(arrays, "nope")


def test_long_lists_are_refused(arrays):
    with pytest.raises(ValueError):
        P.is_in(leaf(arrays, "tags"), [str(i) for i in range(101)])


def test_in_frame_keeps_nulls_out(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id int, k string")
    listed = spark.createDataFrame([("a",), ("a",), ("z",)], "k string")
    assert ids(P.in_frame(df, "k", listed)) == [1]
    assert ids(P.in_frame(df, "k", listed, "left_anti")) == [2, 3]


def test_filters_reach_the_scan(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/orders.parquet")
    for name, pred in (
        ("o_totalprice", P.between(leaf(df, "o_totalprice"), 400000)),
        ("o_orderdate", P.date_cmp(leaf(df, "o_orderdate"), ">=", "1996-01-01")),
    ):
        plan = df.where(pred).select("o_orderkey")._jdf.queryExecution().executedPlan().toString()
        assert f"GreaterThanOrEqual({name}" in plan
        assert "o_custkey" not in plan


def test_json_and_any_leaf(spark):
    df = spark.createDataFrame([(1, '{"k": 5, "s": {"t": "x"}}'), (2, '{"k": "no"'), (3, "{}")], "id int, j string")
    assert ids(df.where(P.json_cmp(F.col("j"), "$.k", ">=", 5, "int"))) == [1]
    assert ids(df.where(P.json_cmp(F.col("j"), "$.s.t", "=", "x", "string"))) == [1]
