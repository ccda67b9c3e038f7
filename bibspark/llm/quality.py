"""Quality by weak labels.

Labellers are rules that vote good (1), bad (-1) or not at all (0). Expectation-maximisation finds how often each
one votes what on good and on bad documents, and the share of good ones, without any label. It runs over counts of
vote patterns, of which there are at most 3 to the number of labellers, counted over all documents; so it is exact
for the whole corpus. Posteriors label a bounded sample (``SAMPLE`` documents, by a hash of their ids), on which a
linear scorer over hashed character n-grams and a few shape cells is trained; it scores every text.

Cases. Empty table: no rows. Null text: empty; labellers vote on it as on any short text, and the score comes from
its shape cells. Repeated rows: the same answer. Only one class found: all scores follow the prior. Null doc_id: scored, not
learned from. Extra columns are ignored.
"""

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bibspark.llm import hashed
from bibspark.llm.common import checkpointed, documents, drawn, likely, lookup, whole
from bibspark.session import ship

BITS = 11
STEPS = 16
SHAPE = 8 * STEPS
SAMPLE = 3000
KEEP = 0.5
# fixed values: frequent function words of four languages
FUNCTION_WORDS = "the of and to in a is that for it on with as are der die das und ist von mit den ein zu le la les des et est un une que en de el los y se del las con por"


FUNCTION = frozenset(w.encode() for w in FUNCTION_WORDS.split())
SYMBOLS = b"#$%&*|<>{}[]\\^~_=+@`"
CAPITALS = bytes(range(65, 91))
LABELLERS = ["symbols", "symbol_ends", "capitals", "variety", "runs", "lines", "sentences", "function_words"]


def vote(good: bool, bad: bool) -> int:
    return -1 if bad else int(good)


def measure(text: str | None) -> tuple[list[int], list[int]]:
    """Votes of the labellers in their order, and cells of the text's shape for the scorer."""
    raw = (text or "").encode()
    words = raw.lower().split()
    n, size = max(1, len(words)), max(1, len(raw))
    long = len(words) >= 30
    symbols = (len(raw) - len(raw.translate(None, SYMBOLS))) / n
    capitals = (len(raw) - len(raw.translate(None, CAPITALS))) / size
    variety = len(set(words)) / math.sqrt(n)
    lines = raw.split(b"\n")
    different = len(set(lines))
    ends = sum(w.endswith((b".", b"!", b"?")) for w in words) / n
    function = sum(map(FUNCTION.__contains__, words)) / n
    runs = sum(map(bytes.__eq__, words, words[1:])) / n
    odd = sum(w[-1] in SYMBOLS for w in words) / n
    found = [
        vote(symbols < 0.02, symbols > 0.15),
        vote(odd < 0.02, odd > 0.15),
        vote(capitals < 0.1, capitals > 0.3),
        vote(variety > 2 or not long, long and variety < 1.5),
        vote(runs < 0.05, runs > 0.3),
        vote(different > 0.9 * len(lines), len(lines) >= 4 and different < 0.5 * len(lines)),
        vote(0.01 <= ends <= 0.4, long and (ends == 0 or ends > 0.6)),
        vote(function > 0.05, long and function < 0.02),
    ]
    steps = (len(words).bit_length(), 2 * variety, 10 * symbols, 30 * capitals, 10 * different / len(lines), 10 * ends, 30 * function, 20 * runs)
    return found, [STEPS * k + min(STEPS - 1, int(x)) for k, x in enumerate(steps)]


def patterns(docs: DataFrame) -> DataFrame:
    """doc_id and the votes on it as one number in base 3."""

    def run(batches):
        for batch in batches:
            found = [sum((v + 1) * 3**k for k, v in enumerate(measure(t.as_py())[0])) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.int32())], ["doc_id", "pattern"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, pattern int")


class Labellers:
    """What EM found: the share of good documents and, per labeller and vote, the log odds it gives."""

    def __init__(self, names: list[str], patterns: np.ndarray, counts: np.ndarray, rounds: int = 200):
        self.names, m = names, len(names)
        n = max(1.0, float(counts.sum()))
        p = np.where((patterns < 0).any(1), 0.1, 0.9)  # a first guess: any vote against raises doubt
        one = np.stack([patterns == v for v in (-1, 0, 1)], axis=2).astype(float)  # pattern, labeller, vote
        for _ in range(rounds):
            self.prior = float(np.clip((p * counts).sum() / n, 1e-6, 1 - 1e-6))
            good = np.einsum("p,pjv->jv", p * counts, one) + 0.1
            bad = np.einsum("p,pjv->jv", (1 - p) * counts, one) + 0.1
            self.good, self.bad = good / good.sum(1, keepdims=True), bad / bad.sum(1, keepdims=True)
            self.odds = np.log(self.good / self.bad)
            logit = math.log(self.prior / (1 - self.prior)) + np.einsum("pjv,jv->p", one, self.odds)
            new = 1 / (1 + np.exp(-np.clip(logit, -50, 50)))
            if len(p) and np.abs(new - p).max() < 1e-9:
                break
            p = new

    def accuracy(self) -> dict[str, float]:
        """Share of right votes among the votes each labeller gives."""
        right = self.prior * self.good[:, 2] + (1 - self.prior) * self.bad[:, 0]
        wrong = self.prior * self.good[:, 0] + (1 - self.prior) * self.bad[:, 2]
        return dict(zip(self.names, right / (right + wrong)))

    def log_odds(self, votes: list[int]) -> float:
        return math.log(self.prior / (1 - self.prior)) + sum(odds[v + 1] for odds, v in zip(self.odds, votes))

    def posterior(self, votes: list[int]) -> float:
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, self.log_odds(votes)))))


def unpacked(pattern: int) -> list[int]:
    return [pattern // 3**k % 3 - 1 for k in range(len(LABELLERS))]


def label(voted: DataFrame) -> Labellers:
    """EM over the counts of patterns, at most 3 ** labellers of them."""
    rows = voted.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).orderBy("pattern").collect()
    return Labellers(LABELLERS, np.array([unpacked(r["pattern"]) for r in rows], int).reshape(-1, len(LABELLERS)), np.array([r["n"] for r in rows], float))


def cells(text: str | None, shape: list[int], bits: int) -> np.ndarray:
    """Hashed n-grams of the text as written, and a cell for each measure of its shape."""
    extra = np.zeros(SHAPE, np.float32)
    extra[shape] = 0.3
    return np.concatenate([hashed.unit(hashed.grams(text or "", bits, letters=False)), extra])


def scorer(docs: DataFrame, voted: DataFrame, labels: Labellers, sample: int, bits: int) -> np.ndarray:
    """Weights of the scorer. Sampled by id first; features and training stay in tasks."""
    ids = voted.where("doc_id is not null")
    many = ids.agg(F.approx_count_distinct("doc_id")).first()[0]
    ids = ids.where(likely(F.col("doc_id"), F.lit(many), sample)).select("doc_id").distinct()
    chosen = checkpointed(ids.orderBy(drawn(F.col("doc_id")), "doc_id").limit(sample).select(F.col("doc_id").alias("c_id")))
    rows = lookup(docs.select("doc_id", "text"), chosen, F.col("doc_id") == F.col("c_id"), "inner", limit=sample)
    rows = rows.groupBy("doc_id").agg(F.min(whole(F.col("text"))).alias("text"))

    def features(batches):
        for batch in batches:
            texts = [t.as_py() for t in batch.column("text")]
            seen = [measure(t) for t in texts]
            made = [cells(t, shape, bits).tobytes() for t, (_, shape) in zip(texts, seen)]
            yield pa.RecordBatch.from_arrays([pa.array([labels.posterior(v) for v, _ in seen]), pa.array(made, pa.binary())], ["posterior", "cells"])

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["posterior", "cells"])
        w = hashed.logistic(np.stack([np.frombuffer(c, np.float32) for c in part["cells"]]), part["posterior"].to_numpy(float))
        return pd.DataFrame({"w": [w.astype(np.float64).tobytes()]})

    made = rows.repartition(8, "text").mapInArrow(features, "posterior double, cells binary").withColumn("one", F.lit(0))
    trained = made.groupBy("one").applyInPandas(fit, "w binary").collect()
    return np.frombuffer(trained[0]["w"]) if trained else np.zeros((1 << bits) + SHAPE + 1)


def quality(docs: DataFrame, sample: int = SAMPLE, bits: int = BITS, keep: float = KEEP) -> DataFrame:
    """Per document: doc_id, posterior (of the labellers), score (of the text), keep (score at least ``keep``)."""
    ship(hashed.__name__)
    ship(__name__)
    docs = documents(docs)
    voted = checkpointed(patterns(docs))
    labels = label(voted)
    w = scorer(docs, voted, labels, sample, bits)

    def run(batches):
        for batch in batches:
            texts = [t.as_py() for t in batch.column("text")]
            seen = [measure(t) for t in texts]
            z = np.array([cells(t, shape, bits) @ w[:-1] + w[-1] for t, (_, shape) in zip(texts, seen)], float)
            score = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([labels.posterior(v) for v, _ in seen]), pa.array(score)], ["doc_id", "posterior", "score"])

    rows = docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, posterior double, score double")
    return rows.withColumn("keep", F.col("score") >= keep)
