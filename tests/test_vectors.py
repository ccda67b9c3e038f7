import numpy as np
import pytest
from pyspark.sql import functions as F

from bibspark.functions import vectors as V
from bibspark.operators import vectorindex as VI
from bibspark.operators import vectors as S


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    m = rng.normal(size=(200, 8)).round(3)
    m[50:120] = m[49]  # a third are copies
    return m


@pytest.fixture(scope="module")
def corpus(spark, data):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(data)] + [(900, None), (901, [0.0] * 8), (902, [1.0])]
    return spark.createDataFrame(rows, "id int, v array<float>").repartition(5)


def brute(data, q, k):
    unit = data.astype(np.float32).astype(float)
    unit = unit / np.linalg.norm(unit, axis=1, keepdims=True)
    sims = np.round(unit @ (q / np.linalg.norm(q)), 9)
    return sorted(range(len(sims)), key=lambda i: (-sims[i], i))[:k]


@pytest.mark.parametrize("blocks, sides", [(None, 4), (3, 1), (1, 2)])
def test_join_is_brute_force(spark, corpus, data, blocks, sides):
    asked = spark.createDataFrame([(f"q{i}", [float(x) for x in data[i]]) for i in range(0, 60, 7)], "query_id string, vector array<double>")
    got = {}
    for r in S.knn_join(corpus, "id", "v", asked, 6, blocks=blocks, sides=sides).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = r.id
    for i in range(0, 60, 7):
        assert [got[f"q{i}"][n] for n in range(1, 7)] == brute(data, data[i], 6)


def test_threshold_and_unit_scale(corpus, data):
    q = data[0]
    plain = S.knn(corpus, "id", "v", q, 50, 0.3).collect()
    assert all(r.similarity >= 0.3 for r in plain)
    unit = S.knn(corpus, "id", "v", q, 50, 0.65, unit=True).collect()
    assert [r.id for r in unit] == [r.id for r in plain]


def test_approximate_recall(corpus, data):
    want = set(brute(data, data[3], 10))
    got = {r.id for r in S.knn_lsh(corpus.where("id < 900"), "id", "v", data[3], 10, candidates=75).collect()}
    assert len(want & got) >= 7


def test_many_queries_in_one_job(spark, corpus, data):
    rng = np.random.default_rng(5)
    asked = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(5000, 8)).round(3))] + [(-1, None), (-2, [0.0] * 8), (-3, [1.0])], "query_id long, vector array<double>")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    found = S.knn_join(corpus, "id", "v", asked, 2)
    assert not tracker.getJobIdsForGroup("planning")
    got = {(r.query_id, r["rank"]): r.id for r in found.collect()}
    spark.sparkContext.setJobGroup("", "")
    assert len(got) == 10_001 and got[-3, 1] == 902
    for r in asked.where("query_id in (0, 77, 4999)").collect():
        assert [got[r.query_id, n] for n in (1, 2)] == brute(data, np.array(r.vector), 2)


def test_index(spark, tmp_path):
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(20, 16)) * 3
    data = (centres[rng.integers(0, 20, 2000)] + rng.normal(size=(2000, 16))).round(3)
    rows = [(i, [float(x) for x in v], i % 3) for i, v in enumerate(data)] + [(9000, None, 0), (9001, [0.0] * 16, 0), (9002, [float("nan")] * 16, 0)]
    df = spark.createDataFrame(rows, "id int, v array<double>, third int")
    index = VI.build(df, "id", "v", str(tmp_path / "index"), cells=20)
    assert sum(c["n"] for c in index.cells()) == 2000
    hits = 0
    for i in range(0, 2000, 250):
        want = brute(data, data[i], 10)
        got = [r.id for r in VI.search(index, data[i], 10, probes=3).collect()]
        hits += len(set(got) & set(want))
        assert VI.rows_read(index, data[i], 3) < 0.4
        assert [r.id for r in VI.search(index, data[i], 10, probes=1, exact=True).collect()] == want
    assert hits >= 0.9 * 80
    some = VI.search(index, data[0], 5, exact=True, where="third = 1").collect()
    only = data[np.arange(2000) % 3 == 1]
    assert [r.id for r in some] == [3 * j + 1 for j in brute(only, data[0], 5)]
    # more asked for than the nearest cell holds
    assert VI.search(index, data[0], 1500, probes=1).count() == 1500


def test_column_functions(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0])], "a array<float>, b array<float>")
    got = df.select(V.dot(F.col("a"), F.col("b")), V.norm(F.col("a")), V.cosine(F.col("a"), F.col("b"))).first()
    assert tuple(got) == pytest.approx((24.0, 5.0, 0.96))


def test_rerank(spark):
    df = spark.createDataFrame([(0.5, 1000), (0.75, 100), (1.0, 0), (0.4, 100)], "s double, c int")
    got = [r[0] for r in df.select(V.citation_rerank(F.col("s"), F.col("c"))).collect()]
    assert got == pytest.approx([0.5, 0.75 * (1 + 0.5 * 0.5 * 0.5), 1.0, 0.4])


def test_injection(spark):
    found = spark.createDataFrame([(1, 0.9), (2, 0.8), (3, 0.7)], "id int, similarity double")
    titles = spark.createDataFrame([(1, "big cat", 5), (7, "Cat, big!", 3), (8, "cat", 99)], "id int, title string, c int")
    got = {r.id: r.similarity for r in S.short_query_inject(found, titles, "big cat", "id", "title", "c").collect()}
    assert got == {1: 0.9, 2: 0.8, 3: 0.7, 7: 0.8}
    assert S.short_query_inject(found, titles, "one two three four", "id", "title", "c").count() == 3
    none = S.short_query_inject(found.limit(0), titles, "cat", "id", "title", "c").collect()
    assert {r.similarity for r in none} == {0.55}


def test_embedding_uses_the_whole_text(spark):
    long = "x " * 3000
    df = spark.createDataFrame([(1, long + "tail"), (2, long), (3, None)], "id int, t string")
    got = {r.id: r.embedding for r in S.embed(df, "id", "t").collect()}
    assert got[1] != got[2] and set(got[3]) == {0.0}
