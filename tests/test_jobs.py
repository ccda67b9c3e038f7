"""Upkeep, sources, merges, trees, streams, bibliometrics."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bibspark.operators import bibliometrics as B
from bibspark.operators import joins as J
from bibspark.operators import overlap, trees, upkeep
from bibspark.session import local_frame, scratch
from bibspark.sources import exports, snapshot
from bibspark.streaming import streams


def test_merge_chains_end_and_cycles_drop_out(spark):
    pairs = [("A", "B"), ("B", "C"), ("C", "D"), ("X", "Y"), ("Y", "X"), ("Z", "X"), *[(f"n{i}", f"n{i + 1}") for i in range(20)]]
    got = {r.id: r.merge_into_id for r in J.resolve_merges(spark.createDataFrame(pairs, "id string, merge_into_id string")).collect()}
    assert got == {"A": "D", "B": "D", "C": "D", **{f"n{i}": "n20" for i in range(20)}}


def test_multi_get_keeps_order(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    assert [(r.asked, r.v) for r in J.multi_get(df, "id", [2, 9, 1]).collect()] == [("2", "b"), ("9", None), ("1", "a")]
    with pytest.raises(ValueError):
        J.multi_get(df, "id", list(range(101)))


def test_closure_on_a_graph_with_a_cycle(spark):
    edges = spark.createDataFrame([("b", "a"), ("c", "b"), ("d", "b"), ("d", "a"), ("a", "d")], "child string, parent string")
    got = {r.node: r.descendants for r in trees.descendants(edges).collect()}
    assert got == {"a": 3, "b": 3, "d": 3}


def test_lineage_excludes_super_systems(spark):
    edges = spark.createDataFrame([("b", "a"), ("c", "b")], "child string, parent string")
    got = sorted(tuple(r) for r in trees.lineage(edges, spark.createDataFrame([("b",)], "id string")).collect())
    assert got == [("a", "a"), ("b", "a"), ("c", "a"), ("c", "c")]


def test_latest_and_duplicates(spark):
    rows = [("a", 1, "x"), ("a", 2, "y"), ("b", 5, "z"), ("b", None, "n"), ("c", 1, "p"), ("c", 2, "q"), ("c", 3, "r")]
    df = spark.createDataFrame(rows, "k string, ts int, v string")
    assert sorted(r.v for r in upkeep.latest_by(df, "k", "ts").collect()) == ["r", "y", "z"]
    assert sorted(r.v for r in upkeep.remove_duplicates(df, "k", "ts").collect()) == ["p", "q", "r", "y", "z"]
    assert sorted(r.v for r in upkeep.remove_duplicates(df, "k", "ts", only_pairs=False).collect()) == ["r", "y", "z"]


def test_merge_log(spark):
    s = "id string, merge_into_id string"
    log = spark.createDataFrame([("a", "b"), ("c", "d")], s)
    out = upkeep.merge_log(log, spark.createDataFrame([("a", "z"), ("e", "f")], s), spark.createDataFrame([("c",)], "id string"))
    assert sorted(tuple(r) for r in out.collect()) == [("a", "z"), ("e", "f")]


def test_landing_keeps_rejects(spark):
    lines = spark.createDataFrame([('{"id": "a", "n": 1}',), ('{"id": "b"',), ("",), ('{"n": 1}',)], "value string")
    good, bad = snapshot.land(lines)
    assert [r.id for r in good.collect()] == ["a"] and bad.count() == 3


def test_load_new_is_incremental(spark):
    root, ledger, out = (scratch(spark, n) for n in ("in", "ledger", "out"))
    df = spark.range(20).selectExpr("cast(id as string) as id", "date '2024-01-01' + cast(id % 4 as int) as d")
    snapshot.write_snapshot(df.where("d < date '2024-01-03'"), f"{root}/one", "works", "d")
    assert snapshot.load_new(spark, root, ledger, out) > 0
    assert snapshot.load_new(spark, root, ledger, out) == 0
    snapshot.write_snapshot(df.where("d >= date '2024-01-03'"), f"{root}/two", "works", "d")
    assert snapshot.load_new(spark, root, ledger, out) > 0
    assert spark.read.parquet(out).where("kind = 'good'").select("id").distinct().count() == 20
    assert spark.read.parquet(out).count() == 20


def test_export_groups_pads_the_shorter_list(spark):
    a = spark.createDataFrame([("x", 3), ("y", 1)], "key string, count bigint")
    b = spark.createDataFrame([("p", 9)], "key string, count bigint")
    got = exports.export_groups({"a": a, "b": b}).orderBy("row").collect()
    assert [tuple(r) for r in got] == [(1, "x", 3, "", "p", 9, ""), (2, "y", 1, "", None, None, None)]


def test_h_index(spark):
    rows = [("p", c) for c in (10, 8, 5, 4, 3)] + [("q", 0), ("r", 100)] + [("s", 2)] * 50
    df = spark.createDataFrame(rows, "a string, c int")
    assert {r.a: r.h_index for r in B.h_index(df, "a", "c").collect()} == {"p": 4, "q": 0, "r": 1, "s": 2}


def related_brute(works, k):
    out = {}
    for i, terms, _ in works:
        others = [(len(set(terms) & set(o)), a, j) for j, o, a in works if j != i and set(terms) & set(o)]
        out[i] = [(j, n) for n, a, j in sorted(others, key=lambda x: (-x[0], -x[1], x[2]))[:k]]
    return out


def related_found(df, k, hot):
    got = {}
    for r in B.related_works(df, "terms", "at", k, hot=hot).collect():
        got.setdefault(r.id, {})[r["rank"]] = (r.related_id, r.shared)
    return {i: [found[n] for n in sorted(found)] for i, found in got.items()}


@pytest.mark.parametrize("hot", [128, 5, 1])
def test_related_is_brute_force(spark, hot):
    rng = random.Random(11)
    # a third of the records share one set
    works = [(i, ["hub"] if i % 3 == 0 else rng.sample("abcdefg", rng.randint(0, 4)) + ["hub"] * (i % 2), rng.randint(1, 20)) for i in range(120)]
    df = spark.createDataFrame(works, "id int, terms array<string>, at int")
    got = related_found(df, 4, hot)
    assert {i: got.get(i, []) for i, *_ in works} == related_brute(works, 4)


def test_related_with_many_terms(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    near = rng.sample(words, 30)
    works = [(i, rng.sample(words, rng.randint(5, 40)), rng.randint(1, 20)) for i in range(60)]
    # near copies: each lacks one term of thirty and has one of its own
    works += [(100 + i, near[:i] + near[i + 1 :] + [f"own{i}"], rng.randint(1, 20)) for i in range(30)]
    df = spark.createDataFrame(works, "id int, terms array<string>, at int")
    got = related_found(df, 3, 16)
    assert {i: got.get(i, []) for i, *_ in works} == related_brute(works, 3)


def test_related_by_rare_terms_compares_no_sets(spark, monkeypatch):
    """Sets of rare members meet as numbers that are counted; only frequent members are compared."""
    rng = random.Random(8)
    works = [(i, [f"w{x}" for x in rng.sample(range(60), rng.randint(1, 12))], rng.choice([None, *range(1, 9)])) for i in range(90)]
    asked = []
    compared = overlap._compared

    def seen(pairs, sets):
        asked.append(pairs.count())
        return compared(pairs, sets)

    monkeypatch.setattr(overlap, "_compared", seen)
    # batches of a few rows, so that a set's rows go over several
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        df = spark.createDataFrame(works, "id int, terms array<string>, at int")
        got = related_found(df, 3, 128)
        assert sum(asked) == 0
        assert {i: got.get(i, []) for i, *_ in works} == related_brute([(i, t, a or 0) for i, t, a in works], 3)
        # a term of all records beside the rare ones
        hub = [(i, [*t, "hub"], a) for i, t, a in works]
        got = related_found(spark.createDataFrame(hub, "id int, terms array<string>, at int"), 3, 40)
        assert {i: got.get(i, []) for i, *_ in hub} == related_brute([(i, t, a or 0) for i, t, a in hub], 3)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_percentiles_match_windows(spark):
    rng = random.Random(2)
    df = spark.createDataFrame([(i, "g" if i % 3 else "h", int(rng.paretovariate(1))) for i in range(300)], "id int, g string, c int")
    from pyspark.sql import Window

    w = Window.partitionBy("g").orderBy("c")
    want = {r.id: (r.p, r.c1) for r in df.select("id", F.percent_rank().over(w).alias("p"), F.cume_dist().over(w).alias("c1")).collect()}
    got = {r.id: r.percentile for r in B.norm_percentile(df, ["g"], "c").collect()}
    assert got == pytest.approx({i: p for i, (p, _) in want.items()})
    top = {r.id: r["max"] for r in B.year_percentile(df, "g", "c").collect()}
    assert top == {i: int(100 * c + 1e-9) for i, (_, c) in want.items()}


def test_open_access_status(spark):
    df = spark.createDataFrame([(True, False, True, True, True), (True, True, True, True, True), (False, False, True, True, True), (False, False, True, False, True), (False, False, False, False, True), (False, False, False, False, False)], "j boolean, a boolean, f boolean, l boolean, r boolean")
    got = [r[0] for r in df.select(B.oa_status(*[F.col(c) for c in "jaflr"])).collect()]
    assert got == ["diamond", "gold", "hybrid", "bronze", "green", "closed"]


def _incoming(spark, parts):
    path = scratch(spark, "in")
    for rows in parts:
        spark.createDataFrame(rows, "k string, ver int, cell string, n int").coalesce(1).write.mode("append").parquet(path)
    return streams.read_files(spark, path, spark.read.parquet(path).schema, "parquet", 1)


PARTS = [
    [("a", 3, "x", 10), ("b", 1, "y", 1)],
    [("a", 2, "z", 99), ("c", 1, "x", 5)],  # a late, lower version of a
    [("b", 4, "x", 7), ("c", 1, "x", 5)],  # b moves cell; c comes again
]


def test_stream_state_is_the_batch_result(spark):
    out, mark = scratch(spark, "out"), scratch(spark, "mark")
    streams.stream_upsert(_incoming(spark, PARTS), "k", "ver", out, mark)
    got = sorted(tuple(r) for r in streams.read_latest(spark, out).collect())
    assert got == [("a", 3, "x", 10), ("b", 4, "x", 7), ("c", 1, "x", 5)]


def test_stream_cube_moves_cells(spark):
    state, cells, mark = (scratch(spark, n) for n in ("state", "cells", "mark"))
    streams.stream_cube(_incoming(spark, PARTS), "k", "ver", ["cell"], {"n": F.col("n")}, state, cells, mark)
    assert sorted(tuple(r) for r in streams.read_cube(spark, cells).collect()) == [("x", 3, 22)]


def test_state_work_is_flat_and_replays_change_nothing(spark, tmp_path, monkeypatch):
    from bibspark.operators.upkeep import latest_by
    from bibspark.streaming.state import KeyedState

    state = KeyedState(spark, str(tmp_path / "state"), "k", 16)
    merge = lambda rows: latest_by(rows, "k", "ver", [])
    read, plain = [], KeyedState.rows

    def counted(self, versions):
        found = plain(self, versions)
        if versions and len(versions) < 16:
            read.append(found.count())
        return found

    rng, want = random.Random(1), {}
    frame = lambda rows: local_frame(spark, k=pa.array([r[0] for r in rows], pa.int32()), ver=pa.array([r[1] for r in rows], pa.int32()), v=pa.array([r[2] for r in rows], pa.string()))
    state.apply(0, frame([(k, 0, "x") for k in range(400)]), merge)
    want = {k: (0, "x") for k in range(400)}
    monkeypatch.setattr(KeyedState, "rows", counted)
    for batch in range(1, 51):
        rows = [(rng.randrange(400), rng.randrange(100), rng.choice("abc")) for _ in range(3)]
        rows = list({(k, v): (k, v, x) for k, v, x in rows}.values())
        for k, v, x in rows:
            want[k] = (v, x) if v > want[k][0] else want[k]
        times = 2 if batch % 10 == 0 else 1  # some batches run again
        for _ in range(times):
            state.apply(batch, frame(rows), merge)
    assert len(read) == 55 and max(read) <= 400 * 3 / 16 * 2 and abs(sum(read[:10]) - sum(read[-10:])) < 200
    monkeypatch.undo()
    got = {r.k: r.ver for r in state.read().collect()}
    assert got == {k: v for k, (v, _) in want.items()} and state.read().count() == 400
    # versions that nothing names are gone
    assert len(list((tmp_path / "state" / "data").glob("version=*/bucket=*"))) <= 16 + 6
    # a batch that died before its manifest is as if it had not been
    state.apply(51, frame([(0, 1000, "z")]), merge)
    state.apply(51, frame([(0, 1000, "z")]), merge)
    state.apply(52, frame([]), merge)
    assert state.read().where("k = 0").first().v == "z" and state.read().count() == 400


def test_stream_reads_each_file_once(spark):
    path, out, mark = (scratch(spark, n) for n in ("in", "out", "mark"))
    spark.range(5).write.parquet(path)
    run = lambda: streams.stream_flatten(streams.read_files(spark, path, "id bigint"), {"id": "id"}, out, mark)
    run()
    run()
    spark.range(5, 8).write.mode("append").parquet(path)
    run()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(8))


def test_missing_group_keys_keep_their_records(spark):
    from bibspark.operators import bibliometrics as B

    df = spark.createDataFrame([(1, "a", 4), (2, "a", 2), (3, None, 5), (4, "b", None)], "id int, type string, received int")
    got = {r["id"]: r["fwci"] for r in B.fwci(df, ["type"]).collect()}
    assert got[3] is None and abs(got[1] - 4 / 3) < 1e-12 and len(got) == 4
    assert {r["id"]: r["percentile"] for r in B.norm_percentile(df, ["type"], "received").collect()} == {1: 1.0, 2: 0.0, 3: None, 4: None}
    assert {r["id"] for r in B.year_percentile(df, "type", "received").collect()} == {1, 2, 3, 4}


def test_quantiles_of_values_that_are_not_finite(spark):
    from bibspark.operators.quantiles import exact_quantiles

    inf = float("inf")
    values = [-inf, 1.0, 2.0, 3.0, inf, float("nan"), None, 1e308, -1e308]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = exact_quantiles(df, ["v"], [0.0, 0.25, 0.5, 0.75, 0.875, 1.0])
    assert [got["v", p] for p in (0.0, 0.25, 0.5, 0.75, 0.875)] == [-inf, -1e308, 2.0, 1e308, inf] and got["v", 1.0] != got["v", 1.0]


def test_late_versions_are_kept(spark, tmp_path):
    import datetime as dt

    from bibspark.streaming import streams

    day = lambda n: dt.datetime(2024, 1, n)
    for i, row in enumerate([("a", day(20)), ("c", day(25)), ("b", day(1)), ("a", day(2))]):
        spark.createDataFrame([row], "k string, ts timestamp").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = streams.read_files(spark, str(tmp_path / "in"), "k string, ts timestamp", "parquet", 1)
    streams.version_guard(stream, "k", "ts", str(tmp_path / "out"), str(tmp_path / "mark"))
    got = streams.read_latest(spark, str(tmp_path / "out")).collect()
    assert {(r["k"], r["ts"]) for r in got} == {("a", day(20)), ("c", day(25)), ("b", day(1))}


def test_export_of_all_groups(spark):
    from bibspark.sources import exports

    df = spark.createDataFrame([(f"k{i:03}", 1 + i // 100) for i in range(350)], "key string, count long")
    got = exports.export_groups({"a": df}).orderBy("row").collect()
    assert [r["row"] for r in got] == list(range(1, 351))
    assert [r["a_name"] for r in got][:2] == ["k300", "k301"] and got[-1]["a_name"] == "k099"
