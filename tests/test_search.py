import math
import os
import random
import re
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from bibspark.functions import text as X
from bibspark.operators import project
from bibspark.operators import search as S
from bibspark.operators import searchtable as ST
from bibspark.session import portions, settings

DOCS = [
    (1, "The cat sat on the mat", "zoo"),
    (2, "the mat, the CAT", "cat"),
    (3, "cats and dogs; dogs and cats", "zoo"),
    (4, "", None),
    (5, None, "cat mat"),
    (6, "cat x y mat", "farm"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "id int, text string, place string")


def words(s):
    return [w for w in re.split(r"[^\w]+", (s or "").lower()) if w]


def asked(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "query_id int, text string")


def pairs(df):
    return sorted((r.query_id, r.id) for r in df.collect())


@pytest.fixture(scope="module")
def table(docs, tmp_path_factory):
    return ST.add_lookups(ST.build(docs, "id", ["text", "place"], str(tmp_path_factory.mktemp("search")), buckets=4))


def test_match_all_and_phrase(spark, table):
    queries = asked(spark, "cat mat", "the cat", "the the", "cat nowhere", "")
    assert pairs(ST.match_all(table, queries)) == [(0, 1), (0, 2), (0, 5), (0, 6), (1, 1), (1, 2), (2, 1), (2, 2)]
    assert pairs(ST.match_near(table, queries)) == [(0, 5), (1, 1), (1, 2)]
    assert pairs(ST.match_all(table, queries, ["place"])) == [(0, 5)]


def near(doc, query, slop):
    """Brute force: some choice of different places, one per word, shifted by its slot, within the slop."""
    from itertools import product

    have, want = words(doc), words(query)
    places = [[(i - slot, i) for i, w in enumerate(have) if w == q] for slot, q in enumerate(want)]
    return any(max(x for x, _ in c) - min(x for x, _ in c) <= slop and len({i for _, i in c}) == len(c) for c in product(*places)) if want else False


@pytest.mark.parametrize("slop", [0, 1, 2, 4])
def test_match_near_is_brute_force(spark, tmp_path, slop):
    rng = random.Random(slop)
    more = [(100 + i, " ".join(rng.choice(["the", "cat", "mat", "on", "sat"]) for _ in range(rng.randint(1, 9))), None) for i in range(60)]
    queries = ["cat mat", "mat cat", "the mat cat", "dogs and cats", "on sat", "the the", "the cat the", "cat cat the cat"]
    table = ST.build(spark.createDataFrame(DOCS + more, "id int, text string, place string"), "id", ["text"], str(tmp_path), buckets=2)
    got = pairs(ST.match_near(table, asked(spark, *queries), slop))
    assert got == sorted((q, d[0]) for q, text in enumerate(queries) for d in DOCS + more if near(d[1], text, slop))


def test_queries_read_postings_once_and_no_text(spark, table):
    for df in (ST.scores(table, asked(spark, "the cat"), ["text"]), ST.match_near(table, asked(spark, "the cat"), 1)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        read = re.findall(r"Relation \[([^\]]*)", plan)
        assert sum("positions#" in columns for columns in read) == 1 and all("bucket#" in columns for columns in read)


ARRAYS = [
    (1, ["Deep sea", "blue whale song"], [{"name": "Ocean lab"}, {"name": "Sea life"}]),
    (2, ["whale song deep"], [{"name": "lab sea"}]),
    (3, ["sea", "blue"], None),
    (4, [None, "", "Deep blue sea"], [{"name": None}]),
    (5, None, []),
]


def test_arrays_of_texts(spark, tmp_path):
    df = spark.createDataFrame(ARRAYS, "id int, names array<string>, at array<struct<name:string>>")
    table = ST.build(df, "id", ["names", "at.name"], str(tmp_path), buckets=2)
    queries = asked(spark, "deep sea", "sea blue", "whale song", "lab sea")
    # all words of a field, over its elements; phrases inside one element
    assert pairs(ST.match_all(table, queries, ["names"])) == [(0, 1), (0, 4), (1, 1), (1, 3), (1, 4), (2, 1), (2, 2)]
    assert pairs(ST.match_near(table, queries, 3, ["names"])) == [(0, 1), (0, 4), (1, 4), (2, 1), (2, 2)]
    assert pairs(ST.match_near(table, queries, 0, ["names"])) == [(0, 1), (2, 1), (2, 2)]
    assert pairs(ST.match_near(table, queries, 0, ["at.name"])) == [(3, 2)]
    got = {(r.query_id, r.id) for r in ST.scores(table, queries, ["names", "at.name"]).collect()}
    assert got == {(0, 1), (0, 4), (1, 1), (1, 3), (1, 4), (2, 1), (2, 2), (3, 1), (3, 2)}
    assert {r.id: r.score for r in S.match_name(df, ["names", "at.name"], "sea").collect()} == {1: 6, 2: 3, 3: 3, 4: 3}
    assert {r.id: r.score for r in S.match_name(df, ["names"], "sea blue").collect()} == {4: 1}
    complete = S.autocomplete(df.withColumn("n", F.col("id")).withColumn("name", F.get("names", F.lit(0))), "blue", ["names"], "id", "name", "n")
    assert [r.id for r in complete.collect()] == [4, 3, 1]
    near = S.affiliation_search(df, "at.name", "lab sea", F.lit(True), F.lit(True), F.lit(True))
    assert [r.id for r in near.collect()] == [2]


def test_scores_follow_the_formula(spark, table):
    got = {(r.query_id, r.id): r.score for r in ST.scores(table, asked(spark, "the cat"), ["text"]).collect()}
    lists = {d[0]: words(d[1]) for d in DOCS if words(d[1])}
    avg = sum(map(len, lists.values())) / len(lists)

    def idf(w):
        df = sum(w in ws for ws in lists.values())
        return math.log(1 + (len(lists) - df + 0.5) / (df + 0.5))

    def bm25(weight, tf, n):
        return weight * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * n / avg))

    want = {}
    for i in (1, 2):
        ws = lists[i]
        hits = sum(ws[k : k + 2] == ["the", "cat"] for k in range(len(ws)))
        score = sum(bm25(idf(w), ws.count(w), len(ws)) for w in ("the", "cat"))
        want[0, i] = score + 2 * bm25(idf("the") + idf("cat"), hits, len(ws))
    assert got == pytest.approx(want)


def test_span(table):
    post = ST.word_rows(table, ["the", "cat", "mat", "sat"]).where("field = 'text'")
    span = lambda *a, **k: sorted(r.id for r in S.match_span(post, *a, **k).collect())
    assert span("the cat", "mat", 3) == [1]
    assert span("the cat", "mat", 2) == []
    assert span("cat", "the mat", 2) == [1]
    assert span("the sat", "mat", 5) == [] and span("the sat", "mat", 5, loose=True) == [1]


def test_tree(docs):
    ids = docs.select("id")
    post = S.postings(docs, "id", ["text"])
    got = lambda node: sorted(r.id for r in S.match_tree(ids, post, node).collect())
    assert got({"and": ["cat", {"not": "sat"}]}) == [2, 6]
    assert got({"not": "cat"}) == [3, 4, 5]
    assert got({"or": ["the mat", "dogs"]}) == [1, 2, 3]
    assert got({"and": [{"or": ["cat", "cats"]}, {"not": {"or": ["the cat", "x"]}}]}) == [3]


def test_wildcards(table):
    assert sorted(r.id for r in ST.with_patterns(table, ["cat*"], field="text").collect()) == [1, 2, 3, 6]
    assert sorted(r.id for r in ST.with_patterns(table, ["cat?", "d?gs"]).collect()) == [3]
    words = lambda *p: sorted((r.pattern, r.term) for r in ST.wildcard_words(table, list(p), 0).collect())
    assert words("*a*") == [("*a*", w) for w in ("and", "cat", "cats", "farm", "mat", "sat")]
    assert words("?at") == [("?at", "cat"), ("?at", "mat"), ("?at", "sat")] and words("*at*", "z?o") == [("*at*", w) for w in ("cat", "cats", "mat", "sat")] + [("z?o", "zoo")]
    assert words("*") == [("*", r.term) for r in sorted(table.part("vocabulary").where("term != ''").select("term").distinct().collect())]
    for bad in ("ca*", "*cat", "?at"):
        with pytest.raises(ValueError):
            S.wildcard_pattern(bad)
    assert S.wildcard_pattern("a.b?c")[1] == r"^a\.b.c$"


def edits(a, b):
    """Distance with swaps of neighbours, unrestricted."""
    last, big = {}, len(a) + len(b)
    d = {(-1, -1): big}
    for i in range(len(a) + 1):
        d[i, -1], d[i, 0] = big, i
    for j in range(len(b) + 1):
        d[-1, j], d[0, j] = big, j
    for i in range(1, len(a) + 1):
        at = 0
        for j in range(1, len(b) + 1):
            k, m = last.get(b[j - 1], 0), at
            same = a[i - 1] == b[j - 1]
            at = j if same else at
            d[i, j] = min(d[i - 1, j - 1] + (not same), d[i, j - 1] + 1, d[i - 1, j] + 1, d[k - 1, m - 1] + (i - k - 1) + 1 + (j - m - 1))
        last[a[i - 1]] = i
    return d[len(a), len(b)]


@pytest.mark.parametrize("distance", [1, 2])
def test_fuzzy_is_brute_force(spark, tmp_path, distance):
    rng = random.Random(7)
    made = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 6))) for _ in range(80)} | {"a" * n + "bc" for n in (30, 31, 32, 33, 40)} | {"ca", "abc", "their"})
    table = ST.add_lookups(ST.build(spark.createDataFrame([(i, w) for i, w in enumerate(made)], "id int, text string"), "id", ["text"], str(tmp_path), buckets=2))
    wanted = ["ca", "abcab", "b", "thier", "thie", "a" * 31 + "cb", "a" * 39 + "bc", "nothing", "ABC"]
    words = spark.createDataFrame([(w,) for w in wanted], "word string")
    got = sorted((r.word, r.term) for r in ST.fuzzy_words(table, words, distance).collect())
    assert got == sorted((w, t) for w in {x.lower() for x in wanted} for t in made if edits(w, t) <= distance)
    assert ("thier", "their") in got
    assert ST.with_words(table, ST.fuzzy_words(table, words, distance)).count() == len({t for _, t in got})


def test_fold_and_tokens(spark):
    df = spark.createDataFrame([("Torres-Córdoba, Rafael",), ("Café ÑANDÚ",)], "s string")
    assert [r[0] for r in df.select(X.fold(F.col("s"))).collect()] == ["torres-cordoba, rafael", "cafe nandu"]
    assert [r[0] for r in df.select(S.match_tokens(F.col("s"), "rafael TORRES córdoba")).collect()] == [True, False]
    assert [r[0] for r in df.select(X.tokens(F.col("s"))).collect()][0] == ["torres", "córdoba", "rafael"]


def test_names(spark):
    df = spark.createDataFrame([(1, "Rafael Torres Córdoba", None), (2, "Córdoba Rafael", "R. Torres"), (3, "Maria", "Rafael Cordoba")], "id int, a string, b string")
    got = {r.id: r.score for r in S.match_name(df, ["a", "b"], "rafael cordoba").collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def test_stems(spark):
    df = spark.createDataFrame([(w,) for w in ("queries", "glasses", "buses", "cats", "class", "bus", "toes", "dies")], "w string")
    assert [r[0] for r in df.select(X.stem(F.col("w"))).collect()] == ["query", "glasse", "buse", "cat", "class", "bus", "toe", "dy"]


def test_boosts(spark):
    df = spark.createDataFrame([(0,), (1,), (2,), (10,), (100,), (None,)], "c int")
    got = df.select(S.citation_boost(F.lit(1.0), F.col("c")), S.citation_boost(F.lit(1.0), F.col("c"), "log")).collect()
    assert [r[0] for r in got] == pytest.approx([0.5, 2, 1 + math.sqrt(2), 1 + math.sqrt(10), 11, 0.5])
    assert [r[1] for r in got] == pytest.approx([0.5, 0.5, 1 + math.log(2), 1 + math.log(10), 1 + math.log(100), 0.5])


def test_highlight_covers_the_whole_text(spark):
    text = " ".join(f"w{i}" for i in range(400)) + " needle " + "x" * 700 + " Needle, needles"
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(S.highlight(F.col("t"), ["needle"])).first()[0]
    assert sum(g.count(">>") for g in got) == 2 and ">>Needle<<, needles" in got[-1]


def test_completion(spark):
    df = spark.createDataFrame([(1, "Ring", 5), (2, "Ring road", 9), (3, "Blue ring", 99), (4, "String", 100)], "id int, name string, n int")
    got = [r.id for r in S.autocomplete(df, "ring", ["name"], "id", "name", "n").collect()]
    assert got == [1, 2, 3]
    phrases = spark.createDataFrame([("of the", 9), ("of them", 3), ("off then", 7)], "phrase string, count int")
    assert [r.phrase for r in S.suggest(phrases, "of th").collect()] == ["of the", "of them"]
    assert S.suggest(phrases, "of").count() == 0


def test_ngrams_short_texts(docs):
    got = {(r.id, r.ngram): r["count"] for r in S.ngrams(docs, "id", "text", 3).collect()}
    assert got[3, "dogs and cats"] == 1 and (4, "") not in got and all(k[0] not in (4, 5) for k in got)


def test_abstract_round_trip(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, "one"), (3, "x  y")], "id int, t string")
    index = project.index_from_text(df, "id", "t")
    back = {r.id: r.t for r in index.select("id", project.text_from_index(F.col("index")).alias("t")).collect()}
    assert back == {1: "a b a", 2: "one", 3: "x  y"}
    empty = spark.sql("select cast(null as map<string,array<int>>) as i union all select map()")
    assert [r[0] for r in empty.select(project.text_from_index(F.col("i"))).collect()] == [None, None]


def test_name_hints(spark):
    rows = [(["a", "b"],), (["a", "b", "c"],), (["a", "b", "c", "d"],), ([None, "a"],), ([],), (None,)]
    df = spark.createDataFrame(rows, "n array<string>")
    got = [r[0] for r in df.select(project.name_hint(F.col("n"))).collect()]
    assert got == ["a, b", "a, b, c", "a, b, c, et al.", "a", "authors unknown", "authors unknown"]


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_words_are_grouped_inside_the_record(spark):
    rows = [(1, "a b a"), (2, "b"), (None, "c a"), (3, None), (4, " ")]
    once = spark.createDataFrame(rows, "id int, t string")
    post = S.postings(once, "id", ["t"])
    assert exchanges(post) == exchanges(project.word_positions(once, "id", "t")) == exchanges(project.index_from_text(once, "id", "t")) == 0
    got = sorted(((r.id, r.term, r.tf, r.positions) for r in post.collect()), key=repr)
    assert got == sorted([(1, "a", 2, [0, 2]), (1, "b", 1, [1]), (2, "b", 1, [0]), (None, "c", 1, [0]), (None, "a", 1, [1])], key=repr)


def test_words_of_records_that_share_a_key_meet(spark, tmp_path):
    rows = [(1, "a b a"), (1, "a b a"), (2, "b"), (None, "c"), (None, "c"), (1, None)]
    df = spark.createDataFrame(rows, "id int, t string")
    want = [(1, "a", 4, [0, 0, 2, 2], 3), (1, "b", 2, [1, 1], 3), (2, "b", 1, [0], 1), (None, "c", 2, [0, 0], 1)]
    got = [(r.id, r.term, r.tf, r.positions, r.doc_len) for r in S.postings(df, "id", ["t"]).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    kept = ST.build(df, "id", ["t"], str(tmp_path), buckets=2).part("postings").collect()
    assert sorted([(r.id, r.term, r.tf, r.positions, r.doc_len) for r in kept if r.term], key=repr) == sorted(want, key=repr)
    assert sorted((repr(r.id), r.tf, r.positions) for r in kept if not r.term) == [("1", 3, []), ("2", 1, []), ("None", 1, [])]
    words = [(r.id, r.word, r.positions) for r in project.word_positions(df, "id", "t").collect()]
    assert sorted(words, key=repr) == sorted([w[:2] + w[3:4] for w in want], key=repr)
    index = {r.id: r["index"] for r in project.index_from_text(df, "id", "t").collect()}
    assert index == {1: {"a": [0, 0, 2, 2], "b": [1, 1]}, 2: {"b": [0]}, None: {"c": [0, 0]}}


def test_words_asked_for_are_broadcast(spark, table):
    """The folders' postings are not shuffled to meet a few words, however these were found."""
    words = ST.wildcard_words(table, ["cat*"]).select("term")
    for found in (table.of_keys("postings", "term", words), ST.word_rows(table, ["the", "cat"]), table.of_keys("vocabulary", "term", S.query_terms(asked(spark, "the cat")))):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_table_is_written_where_its_records_are(spark, tmp_path, monkeypatch):
    """Postings and the keys of likenesses are sorted and written by the task that makes them, never moved by word."""
    plans = {}
    written = ST._written

    def seen(rows, path, key, buckets):
        plans[path.rsplit("/", 1)[1]] = rows._jdf.queryExecution().executedPlan().toString()
        written(rows, path, key, buckets)

    monkeypatch.setattr(ST, "_written", seen)
    docs = spark.createDataFrame([(i, f"the cat {i} the mat") for i in range(50)], "id int, text string").repartition(3)
    stored_docs = docs.write.parquet(str(tmp_path / "docs")) or spark.read.parquet(str(tmp_path / "docs"))
    table = ST.build(stored_docs, "id", ["text"], str(tmp_path / "table"), buckets=4)
    assert "Exchange" not in plans["postings"]
    assert {(r.term, r.df, r.words) for r in table.part("vocabulary").where("term in ('', 'the', '7')").collect()} == {("", 50, 250), ("the", 50, 100), ("7", 1, 1)}
    # each lookup is stored for itself, and the words alone move for it
    ST.add_lookups(table, "grams")
    assert "deletes" not in plans and plans["grams"].count("Exchange") == 1
    assert {r.term for r in ST.wildcard_words(table, ["*at"], 0).collect()} == {"cat", "mat"}
    ST.add_lookups(table, "deletes")
    assert plans["deletes"].count("Exchange") == 1
    assert table.part("deletes").groupBy("variant", "term").count().where("count > 1").isEmpty()


def test_portions_by_file_size(spark, tmp_path):
    spark.range(0, 1 << 19, 1, 1).selectExpr("id", "sha2(cast(id as string), 256) as text").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    dealt = portions(df, 1 << 20)
    assert dealt.rdd.getNumPartitions() > 16 and dealt.count() == df.count()
    assert portions(spark.range(10)).rdd.getNumPartitions() == spark.range(10).rdd.getNumPartitions()


def test_only_records_with_the_rarest_word_move(spark, tmp_path):
    """Null and repeated ids included; queries of frequent words only take all records of their words."""
    rows = [(i, f"the cat {i} on the mat", "the zoo") for i in range(60)] + [(None, "the mat 7", None), (None, "cat", None), (7, "the end", "mat")]
    table = ST.build(spark.createDataFrame(rows, "id int, text string, place string"), "id", ["text", "place"], str(tmp_path), buckets=4)
    rare, plain = asked(spark, "the cat 7", "mat 7", "cat 8 on", "the end", "the nowhere"), asked(spark, "the cat", "zoo the")
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in (ST.matches(table, rare), ST.matches(table, plain))]
    assert ["led_id" in p for p in plans] == [True, False]
    found = lambda df: sorted(((r.query_id, r.id) for r in df.collect()), key=repr)
    want = [(0, 7), (0, None), (1, 7), (1, None), (2, 8), (3, 7)]
    assert found(ST.match_all(table, rare)) == sorted(want, key=repr)
    # the texts of records that share an id lie over each other, as in the postings
    assert found(ST.match_near(table, rare)) == sorted([(0, 7), (1, None), (2, 8), (3, 7)], key=repr)
    assert found(ST.match_all(table, plain)) == sorted([(0, i) for i in [*range(60), None]] + [(1, i) for i in range(60)], key=repr)
    scored = ST.scores(table, rare, ["text", "place"])
    assert found(scored) == sorted(want, key=repr)


def test_words_alone_move_where_places_do_not_count(table, spark):
    plan = ST.match_all(table, asked(spark, "the cat"))._jdf.queryExecution().optimizedPlan().toString()
    assert "positions" not in "".join(line for line in plan.splitlines() if "Aggregate" in line)


def test_tables_are_stored_from_their_files(spark, sf_dir, monkeypatch):
    """No text moves before the table deals it out itself."""
    from bibspark.operators import searchtable
    from bibspark.plans import QUERIES, Tables

    plans, build = [], searchtable.build

    def seen(df, *args, **more):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return build(df, *args, **more)

    monkeypatch.setattr(searchtable, "build", seen)
    for name in ("search_array_field", "list_search"):
        QUERIES[name][0](Tables(spark, sf_dir))
    assert len(plans) == 2 and not any("Exchange" in p for p in plans)


SMALL_MEMORY = """
import glob, json, os, sys
os.environ["PYSPARK_SUBMIT_ARGS"] = "--driver-memory 1g --conf spark.memory.fraction={share} --conf spark.buffer.pageSize=1m --conf spark.eventLog.enabled=true --conf spark.eventLog.dir=file://{at}/events --conf spark.eventLog.compress=false --conf spark.eventLog.rolling.enabled=false pyspark-shell"
os.makedirs("{at}/events")
sys.path.insert(0, "{root}")
from bibspark.operators import searchtable as ST
from bibspark.session import local_session
spark = local_session(1, shuffle=1, memory="1g", shared="{at}/shared")
text = "array_join(transform(sequence(0, 399), i -> {word}), ' ') as text"
table = ST.add_lookups(ST.build(spark.range(0, {n}, 1, 1).selectExpr("id", text), "id", ["text"], "{at}/table", buckets=4), "deletes")
print("rows", table.part("postings").count(), table.part("deletes").select("term").distinct().count())
spark.stop()
ends = [x for f in glob.glob("{at}/events/*") for x in map(json.loads, open(f)) if x["Event"] == "SparkListenerTaskEnd"]
print("spilled", len(ends) > 0, sum(x["Task Metrics"]["Memory Bytes Spilled"] for x in ends))
"""


def spilled_in_small_memory(tmp_path, **given):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    run = subprocess.run([sys.executable, "-c", SMALL_MEMORY.format(at=tmp_path, root=root, **given)], cwd=tmp_path, capture_output=True, text=True, timeout=200)
    return run.stdout, run.stdout + run.stderr[-2000:]


def test_postings_take_no_memory_to_be_written(tmp_path):
    """A task's postings are several times what its memory holds; none are spilled."""
    out, log = spilled_in_small_memory(tmp_path, share=0.1, n=2000, word="concat('w', (i * 7 + id) % 3000)")
    assert f"rows {2000 * 401} 3000\nspilled True 0\n" in out, log


def test_keys_of_words_fit_a_task(tmp_path):
    """The keys of 160,000 different words, in two tasks, are sorted in some 250 MB."""
    out, log = spilled_in_small_memory(tmp_path, share=0.35, n=400, word="concat('word', id * 400 + i)")
    assert f"rows {400 * 401} 160000\nspilled True 0\n" in out, log


def test_settings_hold_for_a_block(spark, tmp_path):
    """Storing a table leaves the session's settings as they were, also where it fails."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    ST.build(spark.createDataFrame(DOCS, "id int, text string, place string"), "id", ["text"], str(tmp_path), buckets=4)
    assert spark.conf.get(key) == before
    with pytest.raises(ZeroDivisionError), settings(spark, {key: "3", "bibspark.none": "1"}):
        assert spark.conf.get(key) == "3"
        raise ZeroDivisionError
    assert spark.conf.get(key) == before and spark.conf.get("bibspark.none", None) is None
