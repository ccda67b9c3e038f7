"""Conversation repair and the prefix trie against brute-force versions."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from bibspark.llm import queries, repair, trie

COLUMNS = "conv_id long, turn long, role string, text string, slice int, pos int"


def frame(spark, rows):
    queries.small_batches(spark)
    return spark.createDataFrame([(*r, 1, 2) for r in rows], COLUMNS)


@pytest.fixture(scope="module", autouse=True)
def several_slices(spark):
    """Small tables in as many slices as large ones."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        out += [] if code == 0 else [(conv, turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
    return out


MOVES = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
NEW = {0: (2, "user"), 1: (2, "user"), 2: (3, "assistant"), 3: (2, "user")}


def least(rows):
    """(cost, audit, repaired) by a plain programme over whole audits, from the last message on."""

    def inserted(best):
        for _ in range(4):
            best = [min(best[p], (best[NEW[p][0]][0] + 2, "I" + best[NEW[p][0]][1], ((NEW[p][1], ""), *best[NEW[p][0]][2]))) for p in range(4)]
        return best

    never = (10**9, "", ())
    best = inserted([(0, "", ()), never, never, (0, "", ())])
    for role, text, fault in reversed(rows):
        before = []
        for p in range(4):
            options = [(best[p][0] + 3, "D" + best[p][1], best[p][2])]
            if fault < 2:
                q = MOVES.get(role[:1], {}).get(p)
                if q is not None:
                    options.append((best[q][0] + fault, "K" + best[q][1], ((role, text), *best[q][2])))
                q, new = NEW[p]
                options.append((best[q][0] + 2 + fault, "R" + best[q][1], ((new, text), *best[q][2])))
            before.append(min(options))
        best = inserted(before)
    return best[0]


def brute_repair(original, rows):
    out = []
    for conv in {r[0] for r in original}:
        own = sorted([r for r in rows if r[0] == conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.md5(r[3].encode()).hexdigest()))
        seen, messages, counts = set(), [], [0, 0, 0]
        for _, _, role, text in own:
            cut = text.rstrip(" \t\n\x0b\f\r")
            fault = 0 if not cut else 1 if (role, text) in seen else 2 if cut[-1] not in ".!?" else None
            if fault is not None:
                counts[fault] += 1
            seen.add((role, text))
            messages.append((role, text, {None: 0, 2: 1}.get(fault, 2)))
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        turns = [r[1] for r in own if r[1] is not None]
        cost, audit, said = least(messages)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def damaged_rows():
    rng = random.Random(2)
    roles = ["user", "assistant", "system", "user", "assistant", None, "tool", ""]
    texts = ["Hi.", "ok", "", None, "Why?", " \n", "a. \n", "b!", "x", "y.", "é" * 20_000]
    rows = []
    for conv in [*range(40), None, -5]:
        for turn in range(rng.randint(1, 14)):
            text = rng.choice(texts)
            text = text if text is None or rng.random() < 0.3 else f"{text}{turn}{rng.choice(['', '.'])}"
            rows.append((conv, rng.choice([turn, turn, turn, turn + 3, None]), rng.choice(roles), text))
    rows += [rows[3], rows[3], rows[9]]
    # a third of all rows: one conversation, with long runs and copies, over several slices
    return rows + [(1000, turn, rng.choice(roles[:3]) if turn % 50 < 25 else "user", rng.choice(["m", "m.", "", "ha "]) + str(turn // 9)) for turn in range(150)] + [(1000, 151, "user", "x.")] * 30


def test_repair(spark, damaged_rows):
    df = frame(spark, damaged_rows)
    got = sorted(map(tuple, repair.report(df, repair.damaged(df)).collect()), key=repr)
    assert got == brute_repair(damaged_rows, damage(damaged_rows))
    assert len(repair.border(repair.messages(repair.damaged(df)))) > 1


def test_repaired_messages(spark, damaged_rows):
    out = repair.repaired(frame(spark, damaged_rows)).collect()
    per = {}
    for r in sorted(out, key=lambda r: (r["slice"], r["place"])):
        assert (r["edit"] == "D") == (r["role"] is None) == (r["text"] is None)
        if r["edit"] != "D":
            per.setdefault(r["conv_id"], []).append(r["role"])
    for roles in per.values():
        assert re.fullmatch("s?(ua)+", "".join(r[0] for r in roles))
    filled = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in damaged_rows]
    want = {r[0]: r[7] for r in brute_repair(filled, filled)}
    audits = {}
    for r in sorted(out, key=lambda r: (r["slice"], r["place"])):
        audits[r["conv_id"]] = audits.get(r["conv_id"], "") + r["edit"]
    assert audits == want


def test_runs_by_powers():
    rng = random.Random(4)
    powers = repair.Powers()
    symbols = [(i, f) for i in ("s", "u", "a", "t") for f in (0, 1)] + [repair.GONE]
    for _ in range(200):
        runs = [(rng.choice(symbols), rng.choice([1, 2, 3, 17])) for _ in range(rng.randint(1, 4))]
        values = tuple(rng.randint(0, 9) for _ in range(4))
        plain = values
        for symbol, n in reversed(runs):
            for _ in range(n):
                plain = repair.applied(repair.one(symbol), plain)
        assert repair.applied(powers.product(runs), values) == plain
    for n in (60, 900):
        edits, state = powers.unrolled([(("u", 0), n)], repair.END, 0)
        assert "".join(e for e, _ in edits + repair.ending(state)) == least([("user", "x.", 0)] * n)[1]


def test_no_conversations(spark):
    none = frame(spark, []).limit(0)
    assert queries.op12(none).collect() == [] and queries.op13(none).collect() == [] and repair.repaired(none).collect() == []
    # a conversation whose only row is dropped
    lost = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    (row,) = queries.op12(frame(spark, [(lost, 0, "user", "x.")])).collect()
    assert tuple(row) == (lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def brute_trie(rows):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", hashlib.md5((text or "").encode()).hexdigest(), text or ""))
    own = {c: [(r[2], r[4]) for r in sorted(v)] for c, v in turns.items()}
    path = {}
    for conv, mine in own.items():
        h = zlib.crc32(str(conv).encode()) % 6
        rest = conv % 100 if conv >= 0 else -(-conv % 100)
        path[conv] = tuple(own.get(conv - rest, [])[:h] + mine[h:])
    members, children = {}, {}
    for conv, p in path.items():
        for d in range(len(p) + 1):
            members.setdefault(p[:d], []).append(conv)
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)

    def under(node):
        found = [under(c) for c in children.get(node, [])]
        return sum(n for n, _ in found) or 1, sum(s for _, s in found) + ((len(members[node]) - 1) * len(node[-1][1]) if node else 0)

    out = []
    for node, convs in members.items():
        ends = ",".join(map(str, sorted(c for c in convs if len(path[c]) == len(node))))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children.get(node, [])), *under(node), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def talk():
    rng = random.Random(6)
    rows = [(c, rng.choice([t, t, t, None]), rng.choice(["user", "assistant", None]), rng.choice(["a", "é b", None, "c"])) for c in [*range(60), None, -5, -100, 300, 301, 400] for t in range(rng.randint(1, 8))]
    # many copies, a shared beginning, one long conversation
    rows += [(c, t, "user", "x" if t < 5 or c % 3 else str(c)) for c in range(1000, 1060) for t in range(7)]
    return rows + [(2000, t, "user", "y" * 3000 if t == 5 else str(t)) for t in range(300)] + rows[:2]


@pytest.mark.parametrize("burst", [trie.BURST, 200, 20])
def test_trie(spark, talk, burst):
    got = sorted(map(tuple, trie.trie(trie.rebuilt(frame(spark, talk)), burst).collect()), key=repr)
    assert got == brute_trie(talk)


def test_numbered_turns(spark, talk):
    out = trie.turns(frame(spark, talk)).groupBy("conv_id").agg(F.min("pos").alias("a"), F.max("pos").alias("b"), F.count("*").alias("n"), F.count_distinct("pos").alias("d")).collect()
    assert all(r["a"] == 1 and r["b"] == r["n"] == r["d"] for r in out)


def test_containers_are_shuffled_whole(spark, talk, monkeypatch):
    """The sweep reads whole containers: its shuffle is not left to joins that may become broadcasts."""
    plans, checkpointed = [], trie.checkpointed

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return checkpointed(df)

    monkeypatch.setattr(trie, "checkpointed", seen)
    trie.nodes(trie.rebuilt(frame(spark, talk)), 200)
    (plan,) = [p for p in plans if "MapInArrow sweep" in p]
    assert "REPARTITION_BY_COL" in plan[: plan.index("Union")]
