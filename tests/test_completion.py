"""The stored completion table against completion over the frame."""

import random

import pytest
from pyspark.sql import functions as F

from bibspark.functions.ids import norm_catalog
from bibspark.operators import completion as C
from bibspark.operators import search as S

SCHEMA = "id int, name string, other array<string>, n int"
LONG = "deep " * 20 + "ocean currents"


def made_rows(seed=7, n=300):
    rng = random.Random(seed)
    words = ["ring", "Ring", "road", "blue", "Éto", "eto", "ringroad", "42", "a", "deep", "customer"]

    def text():
        return rng.choice([None, "", "  ", "-"]) if rng.random() < 0.1 else rng.choice([" ", "-", ", "]).join(rng.choices(words, k=rng.randint(1, 6)))

    rows = [(rng.randint(1, n), text(), rng.choice([None, [], [text()], [text(), None, text()]]), rng.choice([None, 1, 2, rng.randint(0, 99)])) for _ in range(n)]
    rows += [(1000 + i, f"{LONG} {i}", [f"Customer#{i:09d}"], i % 7) for i in range(30)]
    return rows + rows[:20]  # equal rows


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(made_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def table(frame, tmp_path_factory):
    return C.build(frame, ["name", "other"], "id", "name", "n", str(tmp_path_factory.mktemp("completion")), buckets=4)


ASKED = [
    "r", "ring", "RING ", "ring road", "ring-road", "Ring, r", "road", "éto", "eto", "ÉTO r", "42", "", " ", "--", "zzz", "ring road blue", "ring   road", "r     i    ng   ro", "blue-", "customer#00",
    "Customer#000000012", "customer 00000001", "deep deep deep", LONG, LONG + " 2", LONG[5:] + " 12", "ocean currents 3", "a-----------------", "ring, ring, ring, ring",
]


def test_same_answers_as_over_the_frame(spark, frame, table):
    queries = spark.createDataFrame([*enumerate(ASKED), (-1, None)], "query_id int, text string")
    got = {}
    for r in C.complete(table, queries).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["weight"], r["tie"], r["id"]))
    assert -1 not in got
    for i, q in enumerate(ASKED):
        want = [(r["weight"], r["n"], r["id"]) for r in S.autocomplete(frame, q, ["name", "other"], "id", "name", "n").collect()]
        assert got.get(i, []) == want, q


def test_name_outside_the_texts(spark, frame, tmp_path):
    table = C.build(frame, ["other"], "id", "name", "n", str(tmp_path), best=3, buckets=2)
    queries = spark.createDataFrame(list(enumerate(ASKED)), "query_id int, text string")
    got = {}
    for r in C.complete(table, queries, n=3).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["weight"], r["tie"], r["id"]))
    for i, q in list(enumerate(ASKED))[::4]:
        want = [(r["weight"], r["n"], r["id"]) for r in S.autocomplete(frame, q, ["other"], "id", "name", "n", n=3).collect()]
        assert got.get(i, []) == want, q
    with pytest.raises(ValueError):
        C.complete(table, queries)


def test_ids_entities_and_phrases(spark, frame, tmp_path):
    works = frame.select(F.concat(F.lit("W"), "id").alias("id"), F.col("name").alias("display_name"), "n")
    tables = {e: C.build(works, ["display_name"], "id", "display_name", "n", str(tmp_path / e), buckets=2) for e in ("work", "author")}
    asked = spark.createDataFrame([(0, "https://example.org/works/w1003"), (1, "ring")], "query_id int, text string")
    got = C.complete(tables["work"], asked, norm=norm_catalog).collect()
    assert [r["id"] for r in got if r["query_id"] == 0] == ["W1003"] and sum(r["query_id"] == 1 for r in got) == 10
    for q in ("ring", "ring road"):
        one = spark.createDataFrame([(0, q)], "query_id int, text string")
        got = [(r["id"], r["tie"], r["entity_type"]) for r in C.complete_all(tables, one).orderBy("rank").collect()]
        frames = {e: works.withColumnRenamed("n", "c") for e in tables}
        want = [(r["id"], r["c"]) for r in S.autocomplete_all(frames, q, "c").collect()]
        assert [g[:2] for g in got] == want and {g[2] for g in got} <= ({"author"} if q == "ring" else {"work", "author"})
    phrases = spark.createDataFrame([("of the", 9), ("of them", 3), ("off then", 7)], "phrase string, count int")
    table = C.build(phrases, ["phrase"], "phrase", "phrase", "count", str(tmp_path / "phrases"), buckets=2)
    asked = spark.createDataFrame([(0, "of th"), (1, "of"), (2, "off")], "query_id int, text string")
    got = [(r["query_id"], r["phrase"]) for r in C.suggest(table, asked).orderBy("query_id", "rank").collect()]
    assert got == [(0, "of the"), (0, "of them"), (2, "off then")]


def test_frequent_prefixes_have_lists(spark, frame, tmp_path):
    """The answers do not depend on which prefixes have their best records stored; no other has."""
    table = C.build(frame, ["name", "other"], "id", "name", "n", str(tmp_path), buckets=3, often=20)
    heads = table.heads().withColumn("long", F.explode(F.sequence(F.lit(1), F.length("at")))).where("at != ''")
    many = heads.groupBy("kind", F.substring("at", F.lit(1), F.col("long")).alias("prefix")).count().where("count > 20").select("kind", "prefix")
    many = {tuple(r) for r in many.collect()} | {tuple(r) for r in table.heads().where("at = ''").groupBy("kind", "at").count().where("count > 20").select("kind", "at").collect()}
    lists = {tuple(r)[:2]: r["count"] for r in table.part("prefixes").groupBy("kind", "prefix").count().collect()}
    assert set(lists) == many and {len(p) for _, p in many} >= set(range(C.PREFIX + 1)) and max(lists.values()) == C.BEST
    queries = spark.createDataFrame(list(enumerate(ASKED)), "query_id int, text string")
    got = {}
    for r in C.complete(table, queries).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["weight"], r["tie"], r["id"]))
    for i, q in enumerate(ASKED):
        want = [(r["weight"], r["n"], r["id"]) for r in S.autocomplete(frame, q, ["name", "other"], "id", "name", "n").collect()]
        assert got.get(i, []) == want, q


def test_equal_ties_empty_names_and_one_column(spark, tmp_path):
    """A record with many words of one beginning is one record; a name that is the key, and the text, is stored once."""
    rows = [("", 1), ("-", 1), ("a", 1), ("a b", 1), ("A", 1), (None, 1)] + [(f"{' '.join(f'ab{j}' for j in range(70))} {i}", 1) for i in range(15)]
    df = spark.createDataFrame(rows, "name string, n int")
    for often in (2, 1000):
        table = C.build(df, ["name"], "name", "name", "n", str(tmp_path / str(often)), buckets=5, often=often)
        assert not {"name", "phrases"} & set(table.part("records").columns)
        for q in ("", "a", "ab", "-", "ab0 ab1 ab2 a", "a b"):
            want = [(r["name"], r["weight"]) for r in S.autocomplete(df, q, ["name"], "name", "name", "n").collect()]
            asked = spark.createDataFrame([(0, q)], "query_id int, text string")
            assert [(r["id"], r["weight"]) for r in C.complete(table, asked).orderBy("rank").collect()] == want, q


def test_the_table_is_small(spark, tmp_path):
    """No text and no list of beginnings moves or is stored: every word of a text is one narrow row."""
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(1, 9))) for _ in range(3000)]
    lines = [(i, [" ".join(rng.choices(words, k=12)) for _ in range(20)], i % 50) for i in range(400)]
    df = spark.createDataFrame(lines, "id int, lines array<string>, n int").withColumn("name", F.lit("none"))
    table = C.build(df, ["lines"], "id", "name", "n", str(tmp_path), buckets=2)
    text = sum(len(x) for _, xs, _ in lines for x in xs)
    assert table.part("heads").count() < 400 * 242 and table.part("prefixes").count() < 1000
    assert sum(f.stat().st_size for f in tmp_path.rglob("*.parquet")) < 3 * text


def test_phrases_are_stored_once(spark, tmp_path):
    """A phrase of two words is a record of its text and its count, and three narrow rows."""
    rng = random.Random(5)
    pairs = {f"{''.join(rng.choices('abcdefth', k=4))} {''.join(rng.choices('abcdefth', k=rng.randint(3, 9)))}" for _ in range(4000)}
    df = spark.createDataFrame([(p, len(p)) for p in sorted(pairs)], "phrase string, count long")
    table = C.build(df, ["phrase"], "phrase", "phrase", "count", str(tmp_path), buckets=2)
    assert table.part("records").columns == ["id", "tie", "rid", "bucket"] and table.part("heads").count() == 3 * len(pairs) and table.part("prefixes").count() < 1000
    asked = [(i, p[:n]) for i, (p, n) in enumerate(zip(sorted(pairs)[::900], (3, 4, 7, 9, 5), strict=False))]
    got = C.suggest(table, spark.createDataFrame(asked, "query_id int, text string")).orderBy("query_id", "rank").collect()
    for i, q in asked:
        want = [r["phrase"] for r in S.suggest(df, q).collect()]
        assert want and [r["phrase"] for r in got if r["query_id"] == i] == want


def test_empty_table(spark, tmp_path):
    table = C.build(spark.createDataFrame([], SCHEMA), ["name"], "id", "name", "n", str(tmp_path), buckets=2)
    assert C.complete(table, spark.createDataFrame([(0, "r"), (1, "ring road blue")], "query_id int, text string")).count() == 0


def test_few_texts_open_their_folders_only(table):
    found = C.complete(table, ["Ring"])
    assert [r["rank"] for r in found.orderBy("rank").collect()] == list(range(1, 11))
    scans = [x for x in found._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x]
    assert scans and all("PartitionFilters: [bucket" in x or "PartitionFilters: [isnotnull(bucket" in x for x in scans)
    assert [r["query_id"] for r in C.complete(table, ["zzz", "Customer#000000012"]).collect()] == [1]


def test_queries_meet_only_the_names_that_begin_with_them(spark, tmp_path):
    """Names with one beginning do not all meet the queries that share it."""
    rows = spark.createDataFrame([(i, f"Customer#{i:09d}") for i in range(400)], "id int, name string").withColumn("n", F.lit(1))
    table = C.build(rows, ["name"], "id", "name", "n", str(tmp_path), buckets=2)
    asked = C._asked(rows.select(F.col("id").alias("query_id"), F.substring("name", 1, 17).alias("text")))
    asked = asked.select("*", F.lit("any").alias("kind"), F.col("folded").alias("typed"))
    assert C._by_heads(table, asked).count() == 4000
    plan = C._by_heads(table, asked)._jdf.queryExecution().optimizedPlan().toString()
    assert "StartsWith" not in plan and "typed" in next(x for x in plan.splitlines() if "Join Inner" in x)
