"""Benchmark decontamination against a brute-force version."""

import hashlib
import math
import random
import re

import pytest

from bibspark.llm import decontaminate as D
from bibspark.llm import queries

LOWERED_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return LOWERED_WORD.findall(text.translate({i: i + 32 for i in range(65, 91)})) if text else []


def brute(docs, items, length=10, coverage=1.0):
    windows = {}
    for item, text in items:
        w = words(text)
        k = min(length, max(1, math.ceil(coverage * len(w))))
        for a in range(len(w) - k + 1 if w else 0):
            windows.setdefault(tuple(w[a : a + k]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, met = words(text), set(), set()
        for k in {len(x) for x in windows}:
            for a in range(len(w) - k + 1):
                if tuple(w[a : a + k]) in windows:
                    hit.update(range(a, a + k))
                    met |= windows[tuple(w[a : a + k])]
        met.discard(None)
        out.append((doc, len(w), len(hit), len(met), hashlib.sha256(",".join(sorted(map(str, met))).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def tables(spark):
    queries.small_batches(spark)
    rng = random.Random(3)
    vocabulary = ["a", "B", "c", "dé", "é9", "Ä"]
    text = lambda least, most: rng.choice([" ", "-", "\n"]).join(rng.choice(vocabulary) for _ in range(rng.randint(least, most)))
    items = [(rng.choice([None, 1, 2, 3, 10, 11]), text(0, 14)) for _ in range(12)] + [(9, None), (8, " .. "), (7, "a B c a B c a B c a B c"), (7, "A"), (6, "q " * 40)]
    docs = [(i, text(0, 60)) for i in range(120)] + [(500, None), (501, ""), (502, "x " * 30_000 + items[14][1] + " x" * 30_000), (503, "q " * 9), (503, "q " * 9), (None, "q " * 10)]
    return (docs, items, spark.createDataFrame([(*d, "n", 1) for d in docs], "doc_id long, text string, items string, n_words int"),
            spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, part int"))


def test_report(tables):
    docs, items, d, b = tables
    got = sorted(map(tuple, D.report(d, b).collect()), key=repr)
    assert got == brute(docs, items)
    assert sum(r[5] for r in got) > 30 and not all(r[5] for r in got)


@pytest.mark.parametrize("length, coverage, block, sent", [(10, 0.5, 25, 12_000), (3, 0.3, 1000, 1 << 20)])
def test_blocks_and_rounds(tables, length, coverage, block, sent):
    docs, items, d, b = tables
    found = D.matched(d.drop("items", "n_words"), b, ["doc_id"], length, coverage, block, sent).collect()
    ids = lambda r: hashlib.sha256(",".join(sorted(map(str, r["items"]))).encode()).hexdigest()
    got = [(r["doc_id"], r["n_words"], sum(x["stop"] - x["start"] for x in r["spans"]), len(r["items"]), ids(r), bool(r["spans"])) for r in found]
    assert sorted(got, key=repr) == brute(docs, items, length, coverage)
    for r in found:
        at = [x["start"] for x in r["spans"]] + [x["stop"] for x in r["spans"]]
        assert sorted(at) == sorted(set(at)) and r["items"] == sorted(r["items"])


def test_cleaned(spark):
    item = "One two three four five six seven eight nine ten eleven"
    docs = [(1, f"before it, {item.upper()}! And after it there are more words than were hit by far, so it stays here."), (2, item), (3, "clean text"), (4, None), (5, "one two three")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    out = {r["doc_id"]: r["text"] for r in D.cleaned(d, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    assert out == {1: "before it, ! And after it there are more words than were hit by far, so it stays here.", 3: "clean text", 4: None, 5: "one two three"}


def test_none(tables):
    docs, items, d, b = tables
    assert D.report(d.limit(0), b).collect() == []
    assert sorted(map(tuple, D.report(d, b.limit(0)).collect()), key=repr) == brute(docs, [])


def test_automaton_holds_every_run():
    rng = random.Random(1)
    for _ in range(30):
        texts = ["".join(rng.choice("ab ") for _ in range(rng.randint(0, 25))) for _ in range(4)]
        made = D.Automaton([(i, 1, " ".join(t.replace(" ", "")).encode()) for i, t in enumerate(texts)])
        runs = {w[a:b] for w in (t.replace(" ", "") for t in texts) for a in range(len(w)) for b in range(a + 1, len(w) + 1)}
        probe = "".join(rng.choice("ab") for _ in range(40))
        state = length = 0
        for at, letter in enumerate(probe, 1):
            state, length = made.step(state, length, made.number.get(letter.encode(), 0))
            assert length == max([n for n in range(at + 1) if probe[at - n : at] in runs or n == 0])
