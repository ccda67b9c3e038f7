"""The operators against brute force, on small tables with nulls, empty and long texts, ties, repeats,
clashing columns and no rows at all."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from bibspark.llm import ann, chat, lang, mixing, omh, packing, quality, queries, secret_scan, simhash, tokens
from bibspark.llm.common import DOCUMENT

SCHEMA = ", ".join(f"{c} {t}" for c, t in DOCUMENT.items()) + ", size int, score string, spans string, part int, row int, mark string, length int"
A, B, C = "the first tale of two towns and the river between them", "ein zweiter Text mit Wörtern und der Straße", "la tercera historia de los ríos"
TEXTS = [A, B, C, None, "", "  \n\t ", A, A + " again", "12 34 !!", A.upper(), " ".join([B] * 300), "be be be be be be be be", "x", "ünï" * 4000, C + "\x0b" + A]


@pytest.fixture(scope="module")
def docs(spark):
    queries.small_batches(spark)
    rows = [(i, t, ("en", "de", "es", None)[i % 4], (None, "a", "b", "a")[i % 4], None, 1, "s", "p", 1, 1, "m", 3) for i, t in enumerate(TEXTS)]
    rows += [rows[0], rows[2], (None, A, None, None, None, 1, "s", "p", 1, 1, "m", 3), (5, "other text", "en", "a", 4, 1, "s", "p", 1, 1, "m", 3)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def real(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module", params=["made", "real"])
def some(request, docs, real):
    return docs if request.param == "made" else real


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_no_rows(spark, docs):
    none = docs.limit(0)
    for name in ("op1", "op2", "op3", "op5", "op6", "op7", "op9", "op10"):
        assert getattr(queries, name)(none).collect() == []
    assert queries.op4(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []
    assert queries.op8(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none.select(*DOCUMENT), "").collect() == []


def test_language(docs, real):
    out = {r["doc_id"]: r for r in queries.op1(real).collect()}
    truth = {r["doc_id"]: r["lang"] for r in real.select("doc_id", "lang").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in out.items())
    held = [truth[i] == r["lang_pred"] for i, r in out.items() if r["held_out"]]
    assert len(held) > 20 and np.mean(held) > 0.95
    assert all(0 <= r["score"] <= 1 for r in out.values())
    made = queries.op1(docs).collect()
    assert len(made) == docs.count()
    assert {r["lang_pred"] for r in made if r["doc_id"] in (3, 4, 8)} == {"und"}
    assert rows(queries.op1(docs)) == rows(queries.op1(docs.repartition(3)))
    unlearned = queries.op1(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in unlearned} == {"und"}



def test_every_language_is_learned(spark):
    names = [f"x{i:02d}" for i in range(70)]
    word = lambda i: "".join(chr(0x4E00 + 40 * i + j) for j in range(12))
    made = [(100 * i + j, " ".join([word(i)] * (j + 2)), name, "s", 1) for i, name in enumerate(names) for j in range(8 if i else 3)]
    docs = spark.createDataFrame(made, ", ".join(f"{c} {t}" for c, t in DOCUMENT.items())).repartition(4).cache()
    assert {r["lang"] for r in lang.sample(docs, 4).select("lang").collect()} == {n for i, n, *_ in [(r[0], r[2]) for r in made]}
    model = lang.train(docs, bits=10, per_language=4, width=8)
    assert model.langs == names and model.groups and sum(map(len, model.pairs.values())) < 70 * 69 / 4
    assert np.mean([model.predict(t)[0] == name for _, t, name, *_ in made]) > 0.9
    assert {model.predict(t)[0] for _, t, *_ in made} > set(names[64:])


def test_language_families():
    w = {("", "germanic", "romance"): np.r_[np.zeros(1 << 12), 1.0], ("germanic", "de", "en"): np.r_[np.zeros(1 << 12), -1.0]}
    model = lang.Model(["en", "de", "fr"], {k: v.astype(np.float32) for k, v in w.items()}, 12)
    assert model.predict("some text")[0] == "en" and model.predict("²³")[0] == "und"


def test_language_stage(spark, real):
    kept = corpus_pipeline.language_id(spark, real, "").count()
    assert kept == sum(any(map(str.isalpha, r["text"] or "")) for r in real.collect())


def test_quality(real, sf_dir, spark, docs):
    out = queries.op2(real)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    both = out.join(labels, "doc_id").select("score", "keep", "quality").collect()
    good = [r["score"] for r in both if r["quality"] == 1]
    bad = [r["score"] for r in both if r["quality"] == 0]
    assert np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad]) > 0.9
    assert np.mean([r["keep"] for r in both if r["quality"] == 1]) > 0.95
    assert queries.op2(docs).count() == docs.count()


def test_em_finds_accuracies():
    rng = np.random.default_rng(1)
    y = rng.random(20000) < 0.8
    right = [0.9, 0.8, 0.7, 0.6]
    v = np.stack([np.where(rng.random(len(y)) < a, y, ~y) * 2 - 1 for a in right], axis=1)
    patterns, counts = np.unique(v, axis=0, return_counts=True)
    found = quality.Labellers(list("abcd"), patterns, counts.astype(float))
    assert np.allclose(list(found.accuracy().values()), right, atol=0.04)


def test_token_ids_match_the_tokenizer(real):
    runs = tokens.Runs()
    chars = "".join(f"a{chr(c)}b {chr(c)}'s " for c in range(1, 0x260) if not 0xD800 <= c < 0xE000)
    for text in [*TEXTS, *[chr(c) for c in range(1, 0x250)], chars, "it's 'Re we'LL 's'", "<|endoftext|> x", "ΑΣ ς", "é é", *[r["text"] for r in real.limit(40).collect()]]:
        assert runs.text(text) == (runs.direct(text) if text else b""), text


def test_histogram(some):
    out = queries.op3(some).collect()
    runs = tokens.Runs()
    lengths = sorted(len(runs.text(r["text"])) // 4 for r in some.collect())
    assert sorted(x for r in out for x in [r["length"]] * r["docs"]) == lengths
    for r in out:
        assert r["truncated"] == sum(min(n, r["length"]) for n in lengths) and r["total"] == sum(lengths)
        assert r["docs_upto"] == sum(n <= r["length"] for n in lengths) and r["docs_above"] == sum(n > r["length"] for n in lengths)
    limits = [0, 3, 1024, 10**6]
    for r in tokens.at_limits(queries.op3(some), limits).collect():
        assert (r["longer"], r["truncated"]) == (sum(n > r["limit"] for n in lengths), sum(min(n, r["limit"]) for n in lengths))
    half = tokens.quantile_lengths(queries.op3(some), [0.5]).first()["length"]
    assert half == lengths[-(-len(lengths) // 2) - 1]


def test_neighbours(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/embeddings.parquet")
    out = queries.op4(table).collect()
    ids, v = zip(*[(r["vec_id"], np.array(r["embedding"], float)) for r in table.orderBy("vec_id").collect()])
    v, found, all_ = np.stack(v), 0, 0
    for q in range(0, len(ids), 50):
        cosine = v @ v[q] / np.linalg.norm(v, axis=1) / np.linalg.norm(v[q])
        cosine[q] = -2
        best = set(np.argsort(-cosine)[:5])
        mine = [r for r in out if r["query_id"] == ids[q]]
        assert sorted(r["rank"] for r in mine) == [1, 2, 3, 4, 5]
        assert all(abs(r["score"] - cosine[ids.index(r["vec_id"])]) < 1e-12 for r in mine)
        found, all_ = found + len(best & {ids.index(r["vec_id"]) for r in mine}), all_ + 5
    assert found / all_ >= 0.9


def test_odd_vectors(spark):
    made = [(0, [1.0, 0.0]), (50, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]),
            (None, [1.0, 1.0]), (7, [1.0, 2.0, 3.0]), (8, [-1.0, 0.0]), (8, [-1.0, 0.0]), (100, [0.0, 0.0])]
    out = rows(queries.op4(spark.createDataFrame([(*r, "x") for r in made], "vec_id long, embedding array<double>, rank string")))
    assert out == [(0, 1, 1, 1.0), (0, 2, 50, 1.0), (0, 3, 8, -1.0), (50, 1, 0, 1.0), (50, 2, 1, 1.0), (50, 3, 8, -1.0)]


def test_vectors_of_several_lengths_and_rows(spark):
    made = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (50, [1.0, 0.0, 0.0]), (51, [1.0, 1.0, 0.0]), (52, [0.0, 1.0, 0.0]), (100, [0.0, 1.0]), (100, [1.0, 0.0]), (1, [0.0, 1.0])]
    out = {(r["query_id"], r["rank"]): (r["vec_id"], round(r["score"], 6)) for r in queries.op4(spark.createDataFrame(made, "vec_id long, embedding array<double>")).collect()}
    assert out == {(0, 1): (100, 1.0), (0, 2): (1, 0.707107), (50, 1): (51, 0.707107), (50, 2): (52, 0.0), (100, 1): (0, 1.0), (100, 2): (1, 1.0)}


def test_recall_on_ten_thousand():
    rng = np.random.default_rng(8)
    vectors = rng.standard_normal((10_000, 32)) + 2 * rng.standard_normal((50, 32))[rng.integers(0, 50, 10_000)]
    index = ann.Index(np.arange(10_000), vectors, ann.PROJECTIONS, ann.SEED)
    asked = np.arange(0, 10_000, 250)
    found, verified = index.search(asked, vectors[asked], 5, ann.THRESHOLD, ann.WIDEN, ann.FIRST, ann.SURE)
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    hits = 0
    for q, (at, _) in zip(asked, found):
        cosine = unit @ unit[q]
        cosine[q] = -2
        hits += len(set(at) & set(np.argsort(-cosine)[:5]))
    assert hits / (5 * len(asked)) >= 0.9 and verified.mean() < 5_000


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(some):
    table = [(r["doc_id"], brute_fingerprint(r["text"])) for r in some.collect()]
    out = queries.op5(some).collect()
    assert sorted([(r["doc_id"], r["fingerprint"]) for r in out], key=repr) == sorted([(i, f"{f:016x}") for i, f in table], key=repr)
    prints = sorted({f for _, f in table})
    top = {f: f for f in prints}

    def root(f):
        while top[f] != f:
            f = top[f]
        return f

    for i, a in enumerate(prints):
        for b in prints[i + 1 :]:
            if (a ^ b).bit_count() <= 2:
                top[root(a)] = root(b)
    least = {}
    for i, f in table:
        if i is not None:
            least[root(f)] = min(least.get(root(f), i), i)
    assert all(r["component_id"] == least.get(root(int(r["fingerprint"], 16))) for r in out)
    kept = [r["doc_id"] for r in simhash.deduplicated(some).collect()]
    assert sorted(kept) == sorted(least.values())


def test_close_pairs():
    rng = np.random.default_rng(3)
    for n, radius in ((1, 2), (64, 2), (200, 0), (333, 5), (700, 3)):
        base = rng.integers(0, 2**63, 20, dtype=np.uint64)
        fps = base[rng.integers(0, 20, n)]
        for _ in range(radius + 2):
            fps = fps ^ (np.uint64(1) << rng.integers(0, 64, n, dtype=np.uint64)) * rng.integers(0, 2, n, dtype=np.uint64)
        want = {(i, j) for i in range(n) for j in range(i + 1, n) if (int(fps[i]) ^ int(fps[j])).bit_count() <= radius}
        assert set(zip(*(x.tolist() for x in simhash.close_pairs(fps, radius)))) == want


def test_links_in_cells(spark):
    centre = 0x0123456789ABCDEF
    values = sorted({centre} | {centre ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a)})
    df = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp long")
    from bibspark.llm.graph import components

    found = components(simhash.links(df, 2, cell=100))
    assert found.count() == len(values) and found.select("root").distinct().count() == 1


def test_packing(some):
    out = queries.op6(some).collect()
    runs = tokens.Runs()
    want = []
    for r in some.collect():
        ids = np.frombuffer(runs.text(r["text"]), "<u4").tolist() + [1]
        want += [(r["doc_id"], k, 4096 * k, len(p), zlib.crc32(np.array(p, "<u4").tobytes())) for k in range(-(-len(ids) // 4096)) for p in [ids[4096 * k : 4096 * (k + 1)]]]
    assert sorted([tuple(r)[:5] for r in out], key=repr) == sorted(want, key=repr)
    by = {}
    for r in out:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:])) and sum(parts[-1]) <= 4096
    assert len(by) <= 1.05 * sum(r["length"] for r in out) / 4096 + 1


def test_packing_limits():
    sizes = np.random.default_rng(5).integers(1, 500, 900)
    for rule in ("norm", "dot"):
        sequence, offset = packing.best_fit(sizes, 1000, 5, 300_000.0, rule=rule)
        for s in set(sequence):
            inside = np.sort(offset[sequence == s]), sizes[sequence == s]
            assert inside[1].sum() <= 1000 and len(inside[1]) <= 5 and (inside[1].astype(float) ** 2).sum() <= 300_000 and inside[0][0] == 0
    assert len(set(packing.best_fit(np.array([600, 400, 300, 700]), 1000, 9, 1e9)[0])) == 2


def brute_base(text):
    text = text or ""
    spans = []
    pattern = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    spans += [(m.start(), 0, "assign", m.end()) for m in re.finditer(pattern, text, re.I | re.A) if len(m[2]) >= 6]
    spans += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(spans)]


KEY, HEX, MIXED = "AKIA" + "Z9" * 8, "0123456789abcdef" * 2, "aB3" * 14
SECRETS = [
    None, "", f"é𝄞 token = \"abcdefgh\" {KEY} and {HEX}", "secret: token:abcdef token=abc password=123456", f"{KEY}{KEY} AKIASHORT AKIA{KEY}", f"Token: '{HEX}'",
    f"{KEY} near {MIXED} see https://host/x", f"{KEY}\n\n{MIXED} https://host/x", f"{MIXED} alone, https://host/x", f"user_name=alice then {HEX}", f"user_name=alice {MIXED}",
    f"{KEY} {'w ' * 300} {MIXED}", f"{MIXED}\n{KEY}\npassword={MIXED}", f"{HEX}{HEX}", ("token=abcdef " + KEY + "\n\n") * 200,
]


def test_secrets(spark, some):
    made = spark.createDataFrame([(i, t, "x") for i, t in enumerate(SECRETS)] + [(2, SECRETS[2], "x"), (None, SECRETS[2], "x")], "doc_id long, text string, spans string")
    for table in (made, some):
        texts = {}
        for r in table.collect():
            texts.setdefault(r["doc_id"], []).append(r["text"])
        out = queries.op7(table).collect()
        assert len(out) == table.count()
        for r in out:
            bases = [brute_base(t) for t in texts[r["doc_id"]]]
            digests = [hashlib.sha256(",".join(b).encode()).hexdigest() for b in bases]
            assert r["base_sha256"] in digests
            base = bases[digests.index(r["base_sha256"])]
            for kind in ("assign", "access", "hex"):
                assert r[f"n_{kind}"] == sum(b.startswith(kind) for b in base)
            assert set(base) <= set(r["spans"].split(",")) | {""}
    weak = {r["doc_id"]: [s.split(":")[0] for s in r["spans"].split(",") if s.split(":")[0] in secret_scan.WEAK] for r in queries.op7(made).collect()}
    assert weak[6] == ["secret", "endpoint"] and weak[7] == weak[8] == [] and weak[9] == ["identifier"] and weak[11] == ["secret"]
    assert weak[10] == ["identifier", "secret"] and weak[12] == ["secret"]


def test_masked(spark):
    made = spark.createDataFrame([(i, t, None, "s", None) for i, t in enumerate(SECRETS)], ", ".join(f"{c} {t}" for c, t in DOCUMENT.items()))
    out = {r["doc_id"]: r for r in secret_scan.masked(made).collect()}
    assert len(out) == len(SECRETS) and out[0]["text"] is None
    assert out[2]["text"] == 'é𝄞 [SECRET]" [SECRET] and [SECRET]' and out[2]["n_chars"] == len(out[2]["text"])
    assert out[6]["text"] == "[SECRET] near [SECRET] see [SECRET]" and out[8]["text"] == SECRETS[8]
    assert not any(brute_base(r["text"]) for r in out.values())


def test_scopes_bound_the_links(spark):
    """Parts of one scope meet at any distance; a weak part goes only where base spans cover it wholly."""
    far = "w " * 3000
    made = [
        f"user_name=alice {far} {MIXED}", f"user_name=alice {far}\n \n{MIXED}", "jdbc:postgresql://host/db?login=alice1&password=hunter22 end", f"user_name={MIXED}",
        f"aws_access_key_id={KEY} and password=hunter22", f"token={MIXED} {KEY}", f"user_name=alice\n{far}\nhttps://h.example/x?token=abcdef1 tail {HEX}",
    ]
    table = spark.createDataFrame([(i, t, None, "s", None) for i, t in enumerate(made)], ", ".join(f"{c} {t}" for c, t in DOCUMENT.items()))
    got = {r["doc_id"]: [(k, made[r["doc_id"]][int(a) : int(b)]) for k, a, b in (s.split(":") for s in r["spans"].split(",") if s)] for r in queries.op7(table).collect()}
    assert got[0] == [("identifier", "user_name=alice"), ("secret", MIXED)] and got[1] == []
    assert got[2] == [("endpoint", "postgresql://host/db?login=alice1&password=hunter22"), ("identifier", "login=alice1"), ("assign", "password=hunter22")]
    assert got[3] == [] and got[5] == [("assign", f"token={MIXED}"), ("access", KEY)]
    assert got[4] == [("identifier", f"access_key_id={KEY}"), ("access", KEY), ("assign", "password=hunter22")]
    assert [k for k, _ in got[6]] == ["identifier", "endpoint", "assign", "hex"]
    text = {r["doc_id"]: r["text"] for r in secret_scan.masked(table).collect()}
    assert text[2] == "jdbc:[SECRET] end" and text[4] == "aws_[SECRET] and [SECRET]" and text[3] == made[3]


def test_named_pairs(spark):
    plain, padded, url_safe, asia = "wJalrXUtnFEMI/K7MDENG/bPxRfiCYzEXAMPLEKEY", "aB3+" * 10 + "==", "aB3_x-" * 7, "ASIA" + "Z9" * 8
    pairs = [
        (f"aws_access_key_id={asia}\naws_secret_access_key={plain}", [asia, plain]), (f"AWS_ACCESS_KEY_ID={asia}\nAWS_SECRET_ACCESS_KEY={plain}", [asia, plain]),
        (f"azure_client_id: app-12345\nazure_storage_key={padded}", ["app-12345", padded]), (f"clientId='app-12345' signing={url_safe}", ["app-12345", url_safe]),
        (f'"awsAccessKeyId": "{asia}", "awsSecretAccessKey": "{plain}"', [asia, plain]), (f"{asia} {url_safe}", [asia, url_safe]),
        (f"aws_access_key_id = {asia}\naws_secret_access_key = {plain}", [asia, plain]),
    ]
    lone = [f"export DATA={plain}", f"aws_access_key_id={asia}", f"mylogin={plain}", f"client_id=app-12345 {'long_name_' * 4}2B={'x' * 8}"]
    made = spark.createDataFrame([(i, t, None, "s", None) for i, t in enumerate([t for t, _ in pairs] + lone)], ", ".join(f"{c} {t}" for c, t in DOCUMENT.items()))
    spans = {r["doc_id"]: r["spans"] for r in queries.op7(made).collect()}
    text = {r["doc_id"]: r["text"] for r in secret_scan.masked(made).collect()}
    for i, (t, values) in enumerate(pairs):
        found = [s.split(":") for s in spans[i].split(",")]
        assert [k for k, *_ in found] == ["identifier", "secret"]
        assert all(t[int(a) : int(b)].endswith(v) for (_, a, b), v in zip(found, values)) and not any(v in text[i] for v in values)
    assert all(spans[len(pairs) + i] == "" and text[len(pairs) + i] == t for i, t in enumerate(lone))


def test_mix(some):
    out = queries.op9(some).collect()
    assert len(out) == some.count() and rows(queries.op9(some)) == rows(queries.op9(some.repartition(5)))
    by = {}
    for r in out:
        by.setdefault(r["source"], []).append(r)
    names = sorted((s for s in by if s is not None)) + [None] * (None in by)
    size = {s: sum(r["size"] for r in by[s]) for s in names}
    weight = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(names)}
    total, full, target = 1.5 * sum(size.values()), set(), {}
    while True:  # reshare by weight until none is above
        rest, w = total - sum(2 * size[s] for s in full), sum(weight[s] for s in names if s not in full)
        target = {s: 2.0 * size[s] if s in full else rest * weight[s] / w for s in names}
        above = {s for s in names if s not in full and target[s] > 2 * size[s]}
        if not above:
            break
        full |= above
    for s in names:
        assert all(r["source_size"] == size[s] and abs(r["target"] - target[s]) < 1e-6 for r in by[s])
        assert all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in by[s])
        assert abs(sum(r["taken"] for r in by[s]) - target[s]) <= max((r["size"] for r in by[s]), default=0) / 2 + 1e-6
    texts = mixing.Mix(some).texts()
    assert texts.columns == list(DOCUMENT)
    assert sum(len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in texts.collect()) == sum(r["taken"] for r in out)




def test_fingerprints(some, spark):
    for span in (omh.ROWS_PER_RANGE, 3):
        out = omh.fingerprints(some, rows_per_range=span).select("doc_id", "n_chars", "edited_sha256", omh.written(F.col("signature")).alias("f"), "near_edited", "near_next").collect()
        ordered = sorted(((r["doc_id"], r["text"] or "") for r in some.collect()), key=lambda r: (r[0] is None, -(r[0] or 0), r[1].encode()))
        want = []
        for (i, t), (_, nxt) in zip(ordered, ordered[1:] + ordered[:1]):
            edit = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
            want.append((i, len(t), hashlib.sha256(edit.encode()).hexdigest()))
        assert sorted([tuple(r)[:3] for r in out], key=repr) == sorted(want, key=repr)
        assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in out)
    text = {}
    for r in some.collect():
        text.setdefault(r["text"] or "", set()).add(r["doc_id"])
    prints = {}
    for r in out:
        prints.setdefault(r["doc_id"], set()).add(r["f"])
    for ids in text.values():
        assert len(set.intersection(*[prints[i] for i in ids])) >= 1


def test_order_counts(spark):
    a, b = (" ".join(f"w{i}" for i in range(s, s + 200)) for s in (0, 200))
    df = spark.createDataFrame([(0, f"{a} {b}"), (1, f"{b} {a}"), (2, f"{a} {b} tail"), (3, "go " * 50), (4, "go " * 80), (5, f"{a} {b}")], "id int, text string").repartition("id")
    s = {r["id"]: r["signature"] for r in omh.signatures(df, ["id"]).collect()}
    near = lambda x, y: np.mean([p == q for p, q in zip(s[x], s[y]) if p is not None or q is not None])
    assert near(0, 5) == 1 and near(0, 2) > 0.8 and near(0, 1) < 0.75 and 0 < near(3, 4) < 1


def brute_occurrences(text, k=3):
    words = text.split()
    kmers = [tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    seen, out = {}, []
    for x in kmers:
        seen[x] = seen.get(x, 0) + 1
        out.append((x, seen[x]))
    return out


def test_signature_by_brute_force(spark):
    texts = ["a b c a b c a b c d", "be " * 9, "one", "one two", "p q r s t"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition("id")
    got = {r["id"]: r["signature"] for r in omh.signatures(df, ["id"], tuples=4).collect()}

    def xx(*values):
        seed = 42
        for v in values:
            seed = xxhash.xxh64_intdigest(v.encode() if isinstance(v, str) else int(v).to_bytes(8 if isinstance(v, np.int64) else 4, "little", signed=True), seed)
        return np.int64(np.uint64(seed).astype(np.int64))

    for i, t in enumerate(texts):
        bins = {}
        for place, (kmer, nth) in enumerate(brute_occurrences(t)):
            code = xx(np.int64(int(xx(*kmer)) & ~omh.MASK), nth)
            least = (int(code) & ~omh.MASK) | place
            b = int(code) % 8
            bins[b] = min(bins.get(b, least), least)
        want = []
        for j in range(4):
            pair = sorted((bins[b] & omh.MASK, b, bins[b] >> omh.PLACE_BITS) for b in (2 * j, 2 * j + 1) if b in bins)
            want.append(int(xx(*[np.int64(h) for *_, h in pair])) & 0xFFFFFFFF if pair else None)
        assert got[i] == want


def test_order_of_short_texts(spark):
    words = [f"w{i}" for i in range(20)]
    moved = words[10:] + words[:10]
    texts = [" ".join(words), " ".join(moved), "a b c d", "b c d a", "a b c", "be " * 9, "be " * 12, "a b c a b c a b c d", ""]
    made = spark.createDataFrame([(len(texts) - i, t, None, "s", None) for i, t in enumerate(texts)], ", ".join(f"{c} {t}" for c, t in DOCUMENT.items()))
    out = {len(texts) - r["doc_id"]: r for r in omh.fingerprints(made).collect()}
    seed = lambda values: xxhash_chain(*values)
    for i, t in enumerate(texts):
        found = out[i]["signature"]
        if not t.split():
            assert found == [None] * omh.TUPLES
            continue
        kmers = brute_occurrences(t)
        want = []
        for j in range(omh.TUPLES):
            codes = [(int(seed((np.int64(seed((np.int64(int(seed(x)) & ~omh.MASK), n))), j))), place) for place, (x, n) in enumerate(kmers)]
            low, high = (min((c & ~omh.MASK) | p for c, p in ((turn(c), p) for c, p in codes)) for turn in (lambda c: c, lambda c: ~c))
            pair = sorted((e & omh.MASK, s, e >> omh.PLACE_BITS) for s, e in enumerate((low, high)))
            assert len(kmers) == 1 or pair[0][0] != pair[1][0]
            want.append(int(seed(tuple(np.int64(h) for *_, h in pair))) & 0xFFFFFFFF)
        assert found == want
    # of 18 numbered k-mers 16 stay, and half of their pairs turn round: a set likeness would be near 0.8
    share = np.mean([p == q for p, q in zip(out[0]["signature"], out[1]["signature"])])
    assert share < 0.6 and abs(out[0]["near_next"] - share**0.5) < 1e-9


def xxhash_chain(*values):
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(v.encode() if isinstance(v, str) else int(v).to_bytes(8 if isinstance(v, np.int64) else 4, "little", signed=True), seed)
    return np.int64(np.uint64(seed).astype(np.int64))


def test_chat(spark):
    made = [
        (1, 0, "user", "How do I sort a list?\nIt is long."), (1, 1, "assistant", "Use sorted."), (1, 2, "user", "Unrelated."),
        (1, 3, "user", "On Monday bob wrote:\n> how do i  sort a list?\n> It is long.\nStill open."), (1, 4, "assistant", "> > How do I sort a list?\n> Still open.\nDone."),
        (1, 5, "user", "> never said\nWhat?"), (2, 0, "user", "> Unrelated.\nNo."), (2, 1, None, None), (None, 0, "user", "> x\ny"), (2, None, "user", "lost"), (1, 2, "user", "Unrelated."),
    ]
    df = spark.createDataFrame([(*r, "c") for r in made], "conv_id long, turn long, role string, text string, content string")
    out = chat.conversations(df)
    got = {(r["conv_id"], r["turn"]): r for r in out.collect()}
    assert out.count() == len(made)
    assert [got[1, t]["parent_turn"] for t in range(6)] == [None, None, None, 0, 3, None]
    assert [got[1, t]["thread_turn"] for t in range(6)] == [0, 1, 2, 0, 0, 5]
    assert got[1, 3]["content"] == "Still open." and got[1, 4]["content"] == "Done." and got[1, 4]["levels"] == 2 and got[1, 4]["linked"] == 2
    assert got[2, 0]["parent_turn"] is None and got[2, 0]["passages"] == 1 and got[2, 1]["content"] == "" and got[None, 0]["content"] == "y"
    order = [r["turn"] for r in out.where("conv_id = 1").orderBy("position").collect()]
    assert order == [0, 3, 4, 1, 2, 2, 5]


def brute_threads(rows):
    """parent turn and thread turn of every message of one conversation whose quotes are single lines of level one."""
    parent = {}
    for turn, text in rows:
        quoted = [" ".join(line[1:].split()) for line in text.split("\n") if line.startswith(">")]
        for line in quoted:
            origins = [t for t, x in rows if t < turn and line in [" ".join(y.split()) for y in x.split("\n") if not y.startswith(">")]]
            if origins:
                parent[turn] = min(origins)
                break

    def top(turn):
        return top(parent[turn]) if turn in parent else turn

    return {turn: (parent.get(turn), top(turn)) for turn, _ in rows}


def test_threads_are_brute_force(spark):
    rng = np.random.default_rng(3)
    made = {}
    for conv in range(12):
        rows_ = []
        for turn in range(int(rng.integers(1, 9))):
            own = f"w{rng.integers(0, 4)} said {rng.integers(0, 3)}"
            quote = f"> w{rng.integers(0, 4)} said {rng.integers(0, 3)}\n" if rng.random() < 0.6 else ""
            rows_.append((turn, quote + own))
        made[conv] = rows_
    # a third of all messages answer one
    made[99] = [(0, "the first")] + [(t, f"> the first\nno {t}") for t in range(1, 60)]
    table = spark.createDataFrame([(c, t, "user", x) for c, all_ in made.items() for t, x in all_], "conv_id long, turn long, role string, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    out = chat.conversations(table).collect()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for conv, all_ in made.items():
        mine = [r for r in out if r["conv_id"] == conv]
        assert {r["turn"]: (r["parent_turn"], r["thread_turn"]) for r in mine} == brute_threads(all_)
        order = [r["turn"] for r in sorted(mine, key=lambda r: r["position"])]
        assert order == sorted(order, key=lambda t: (brute_threads(all_)[t][1], t)) and sorted(r["position"] for r in mine) == list(range(1, len(mine) + 1))


def test_any_number_of_quote_marks(spark):
    made = [(1, 0, "user", "hello"), (1, 1, "user", ">" * 200_000 + " hello\nyes"), (1, 2, "user", "> " * 100_000 + "hello\nno"), (1, 3, "user", " \t" * 100_000 + "> hello\nmaybe")]
    out = {r["turn"]: r for r in chat.conversations(spark.createDataFrame(made, "conv_id long, turn long, role string, text string")).collect()}
    assert [out[t]["levels"] for t in range(4)] == [0, 200_000, 100_000, 1]
    assert [out[t]["parent_turn"] for t in range(4)] == [None, 0, 0, 0] and [out[t]["content"] for t in (1, 2, 3)] == ["yes", "no", "maybe"]


def test_stages(spark, real, sf_dir):
    docs = real
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == list(DOCUMENT)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    runs = tokens.Runs()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    pieces = packed.collect()
    # the sequences hold the ids of all texts of the stage before, each piece where its row says
    whole = {r["sequence_id"]: r["ids"] for r in packing.sequences(spark.createDataFrame(pieces, packed.schema)).collect()}
    texts = Counter((r["doc_id"], runs.text(r["text"]) + (1).to_bytes(4, "little")) for r in docs.collect())
    assert max(texts.values()) > 1 and sum(map(len, whole.values())) == 4 * sum(r["length"] for r in pieces)
    read, parts = Counter(), {}
    for r in pieces:
        ids = bytes(whole[r["sequence_id"]][4 * r["offset"] : 4 * (r["offset"] + r["length"])])
        assert zlib.crc32(ids) == r["ids_crc32"] and ids == bytes(r["ids"])
        parts.setdefault((r["doc_id"], r["start"]), []).append(ids)
    for d in {d for d, _ in parts}:  # copies of a document have equal pieces
        own = sorted((start, ids) for (e, start), ids in parts.items() if e == d)
        assert all(len(set(ids)) == 1 for _, ids in own)
        read[d, b"".join(ids[0] for _, ids in own)] += len(own[0][1])
    assert read == texts
    assert sum(r["length"] for r in pieces) == sum(len(runs.text(r["text"])) // 4 + 1 for r in docs.collect())
    assert not any(brute_base(r["text"]) for r in docs.collect())


def test_stages_on_odd_rows(spark, docs):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "").count() > 0
