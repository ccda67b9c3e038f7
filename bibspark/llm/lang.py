"""Language identification, family first.

Features are hashed character n-grams of a text's letters. Linear support vector machines, one for each two
families, choose the family; within it, one for each two languages chooses the language. The most duels won decide
(ties: the larger sum of margins). Families come from a table of language codes; a code it does not know is a family of
its own. Where a choice has more than ``WIDTH`` names, they are dealt in order of name into ``WIDTH`` groups, chosen
between first, and so on within a group; duels then grow with the languages and not with their square. Every language is learned.
Each machine is trained by one task on a bounded sample: ``PER_LANGUAGE`` documents of each language, chosen by a hash of
their ids among the documents to learn from; a group takes as many in all, and at least one of each of its languages.

The score is the least probability, by a logistic curve over the margins, of the duels that the chosen language and family
had: 0.5 or more unless duels go round in a circle.

Cases. Empty table: no rows. Null text or no letter: ``und``, score 0. Nothing to learn from: ``und``, score 0, for all. One
language: that one, score 1. Repeated rows: the same answer. Null lang: not learned from. Null doc_id: answered, not learned
from, not held out. Extra columns are ignored.
"""

import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from bibspark.llm import hashed
from bibspark.llm.common import DOCUMENT, checkpointed, documents, drawn, likely, lookup
from bibspark.session import ship

BITS = 12
PER_LANGUAGE = 400
WIDTH = 64
MIN_SCORE = 0.5
UNKNOWN = "und"
# fixed values: language codes by family
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "an ast ca co es fr fur gl it la lmo oc pt rm ro sc scn vec wa",
    "slavic": "be bg bs cs cu hr mk pl rue ru sh sk sl sr szl uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd gv kw",
    "uralic": "et fi hu se",
    "turkic": "az ba kk ky tk tr tt ug uz",
    "iranian": "ckb fa ku os ps tg",
    "indic": "as bn gu hi mr ne or pa sa sd si ur",
    "dravidian": "kn ml ta te",
    "semitic": "am ar arz he mt",
    "malay": "ceb id jv mg ms su tl war",
}
FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}


def family(lang: str) -> str:
    code = lang.lower().replace("_", "-").split("-")[0]
    return FAMILY.get(code, f"only {lang}")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, per_language: int) -> DataFrame:
    """lang and text of the documents to learn from. Chosen by id alone, so texts move only once chosen; ids of frequent
    languages are thinned where they are read."""
    ids = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    found = ids.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("ids"))
    found = checkpointed(found.select(F.col("lang").alias("l_lang"), "ids"))
    ids = lookup(ids.select("doc_id", "lang"), found, F.col("lang") == F.col("l_lang"), "inner")
    ids = ids.where(likely(F.col("doc_id"), F.col("ids"), per_language)).select("doc_id", "lang").distinct()
    order = W.partitionBy("lang").orderBy(drawn(F.col("doc_id")), "doc_id")
    chosen = ids.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= per_language)
    chosen = checkpointed(chosen.select(F.col("doc_id").alias("c_id"), F.col("lang").alias("c_lang")))
    rows = lookup(docs.select("doc_id", "lang", "text"), chosen, (F.col("doc_id") == F.col("c_id")) & (F.col("lang") == F.col("c_lang")), "inner", limit=WIDTH * per_language)
    return rows.groupBy("doc_id", "lang").agg(F.min("text").alias("text")).select("lang", "text")


def duels(names) -> list[tuple[str, str]]:
    return list(itertools.combinations(sorted(names), 2))


def choices(langs: list[str], width: int) -> tuple[dict[str, dict[str, list[str]]], set[str]]:
    """Per choice the names it has, each with its languages, and which names are groups. The first choice is ""; a
    family and a group are choices of their own name."""
    levels: dict[str, dict[str, list[str]]] = {}
    groups: set[str] = set()

    def split(level: str, names: dict[str, list[str]]) -> None:
        if len(names) <= width:
            levels[level] = names
            return
        order = sorted(names)
        ends = [len(order) * i // width for i in range(width + 1)]
        levels[level] = {}
        for i, (a, b) in enumerate(itertools.pairwise(ends)):
            group = f"\0{level}/{i:06d}"
            groups.add(group)
            levels[level][group] = [x for name in order[a:b] for x in names[name]]
            split(group, {name: names[name] for name in order[a:b]})

    members: dict[str, list[str]] = {}
    for lang in sorted(langs):
        members.setdefault(family(lang), []).append(lang)
    split("", members)
    for f, names in members.items():
        split(f, {x: [x] for x in names})
    return levels, groups


class Model:
    """Duels and their weights."""

    def __init__(self, langs: list[str], weights: dict, bits: int, width: int = WIDTH):
        self.bits, self.langs = bits, sorted(langs)
        levels, self.groups = choices(langs, width)
        self.levels = {level: sorted(names) for level, names in levels.items()}
        self.pairs = {level: [p for p in duels(names) if (level, *p) in weights] for level, names in self.levels.items()}
        none = np.zeros(((1 << bits) + 1, 0), np.float32)
        self.weights = {level: np.array([weights[level, *p] for p in ps], np.float32).T if ps else none for level, ps in self.pairs.items()}

    def choose(self, level: str, x: np.ndarray) -> tuple[str, float]:
        names, margins = self.levels[level], x @ self.weights[level][:-1] + self.weights[level][-1]
        won, total = dict.fromkeys(names, 0), dict.fromkeys(names, 0.0)
        lost_by = dict.fromkeys(names, 1.0)
        for (a, b), m in zip(self.pairs[level], margins.tolist()):
            for name, own in ((a, m), (b, -m)):
                won[name] += own > 0
                total[name] += own
                lost_by[name] = min(lost_by[name], 1 / (1 + np.exp(-2 * np.clip(own, -20, 20))))
        best = min(names, key=lambda x: (-won[x], -total[x], x))
        return best, lost_by[best]

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.langs or not text or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        x = hashed.unit(hashed.grams(text, self.bits))
        chosen, score = "", 1.0
        for _ in ("family", "language"):
            chosen, own = self.choose(chosen, x)
            score = min(score, own)
            while chosen in self.groups:
                chosen, own = self.choose(chosen, x)
                score = min(score, own)
        return chosen, float(score)


def train(docs: DataFrame, bits: int = BITS, per_language: int = PER_LANGUAGE, width: int = WIDTH) -> Model:
    """Only the weights of the machines come to the driver."""
    ship(hashed.__name__)
    ship(__name__)

    def features(batches):
        for batch in batches:
            cells = [hashed.unit(hashed.grams(t.as_py(), bits)).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(cells, pa.binary())], ["lang", "cells"])

    rows = checkpointed(sample(docs, per_language).where(F.col("text").rlike(r"\p{L}")).repartition(8, "text").mapInArrow(features, "lang string, cells binary"))
    langs = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    levels, groups = choices(langs, width)

    def most(name: str, of: list[str]) -> int:
        """Rows of each language that a side takes."""
        return max(1, per_language // len(of) if name in groups else min(per_language, per_language * width // len(of)))

    plan = [
        (lang, level, a, b, side, most(name, names[name]))
        for level, names in levels.items() for a, b in duels(names) for side, name in ((1, a), (-1, b)) for lang in names[name]
    ]
    if not plan:
        return Model(langs, {}, bits, width)
    spark = docs.sparkSession
    duel = spark.createDataFrame(plan, "lang string, level string, a string, b string, side int, most int")
    if any(p[-1] < per_language for p in plan):
        rows = checkpointed(rows.withColumn("nth", F.row_number().over(W.partitionBy("lang").orderBy(F.xxhash64("cells"), "cells"))))
        met = rows.join(F.broadcast(duel), "lang").where("nth <= most").drop("nth")
    else:
        met = rows.join(F.broadcast(duel), "lang")

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["side", "cells"])
        x = np.stack([np.frombuffer(c, np.float32) for c in part["cells"]])
        w = hashed.linear_svm(x, part["side"].to_numpy(float))
        head = part.iloc[0]
        return pd.DataFrame({"level": [head["level"]], "a": [head["a"]], "b": [head["b"]], "w": [w.astype(np.float32).tobytes()]})

    trained = met.drop("most").groupBy("level", "a", "b").applyInPandas(fit, "level string, a string, b string, w binary")
    weights = {(r["level"], r["a"], r["b"]): np.frombuffer(r["w"], np.float32) for r in trained.collect()}
    return Model(langs, weights, bits, width)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score of every document, from its text alone."""
    ship(hashed.__name__)
    ship(__name__)

    def run(batches):
        for batch in batches:
            found = [model.predict(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], ["doc_id", "lang_pred", "score"]
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, lang_pred string, score double")


def identify(docs: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score. The model is trained on the same table."""
    docs = documents(docs)
    return predict(docs, train(docs, **options)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def accepted(docs: DataFrame, min_score: float = MIN_SCORE, **options) -> DataFrame:
    """documents without those rejected: text null or without a letter, or a language chosen with a score
    below ``min_score``. Where there is nothing to learn from, only the first reason holds."""
    ship(hashed.__name__)
    ship(__name__)
    docs = documents(docs)
    model = train(docs, **options)
    names = list(DOCUMENT)

    def run(batches):
        for batch in batches:
            keep = []
            for t in batch.column("text"):
                text = t.as_py()
                lang, score = model.predict(text)
                keep.append(score >= min_score if model.langs and lang != UNKNOWN else not model.langs and any(map(str.isalpha, text or "")))
            yield batch.select(names).filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
