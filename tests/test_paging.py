import pytest
from pyspark.sql import functions as F

from bibspark.operators import paging as S


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, None if i % 7 == 0 else i % 3, None if i % 5 == 0 else "xyz"[i % 3]) for i in range(60)]
    return spark.createDataFrame(data, "id int, a int, b string").repartition(5)


KEYS = [["a", "-b", "id"], ["-a", "b", "-id"], ["-b", "-a", "id"]]


@pytest.mark.parametrize("keys", KEYS)
def test_cursor_pages_are_the_whole_order(rows, keys):
    whole = [r.id for r in S.sort(rows, keys).collect()]
    got, cursor = [], None
    for _ in range(20):
        part = S.after(rows, keys, cursor, 7)
        got += [r.id for r in part.collect()]
        cursor = S.cursor_of(part, keys)
        if cursor is None:
            break
    assert got == whole


@pytest.mark.parametrize("keys", KEYS)
def test_offset_pages_are_the_whole_order(rows, keys):
    whole = [r.id for r in S.sort(rows, keys).collect()]
    got = [r.id for n in range(1, 5) for r in S.page(rows, keys, n, 15).collect()]
    assert got == whole


def test_nulls_last_both_ways(rows):
    for key in ("a", "-a"):
        values = [r.a for r in S.sort(rows, [key, "id"]).collect()]
        assert values[-9:] == [None] * 9 and None not in values[:-9]


def test_limits(rows):
    for number, per_page in ((1, 201), (0, 10), (51, 200), (1, 0)):
        with pytest.raises(ValueError):
            S.page(rows, ["id"], number, per_page)
    with pytest.raises(ValueError):
        S.sample(rows, "id", 10_001)


def test_sample_does_not_depend_on_partitions(rows):
    one = [r.id for r in S.sample(rows, "id", 10, seed=4).collect()]
    assert one == [r.id for r in S.sample(rows.repartition(13), "id", 10, seed=4).collect()]
    assert one != [r.id for r in S.sample(rows, "id", 10, seed=5).collect()]
    assert len(set(one)) == 10


def test_best_per_key_limits_before_the_shuffle(rows):
    plan = S.best_per_key(rows, "a", ["-id"], 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    got = S.best_per_key(rows.where("a is not null"), "a", ["-id"], 2)
    assert sorted((r.a, r.id) for r in got.collect()) == [(0, 54), (0, 57), (1, 55), (1, 58), (2, 53), (2, 59)]


def test_one_random_row_per_band(rows):
    got = S.sample_bands(rows, "id", F.floor(F.col("id") / 10), seed=1).collect()
    assert sorted(r.band for r in got) == list(range(6)) and all(r.id // 10 == r.band for r in got)


def test_inject_prefers_the_first_list(spark):
    a = spark.createDataFrame([(1, 0.9), (2, 0.8)], "id int, s double")
    b = spark.createDataFrame([(2, 0.1), (3, 0.1)], "id int, s double")
    assert sorted(tuple(r) for r in S.inject(a, b, "id").collect()) == [(1, 0.9), (2, 0.8), (3, 0.1)]
