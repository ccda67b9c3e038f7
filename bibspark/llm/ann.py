"""Approximate nearest neighbours by collision counting over sorted projections.

Vectors are dealt into blocks. In a block every random projection is an array of the block's vectors, sorted by
value. A query opens a window around its own value in every array, and each round widens all windows by the factor
``WIDEN`` (virtual rehashing: the arrays serve every width). A vector that lies in at least ``THRESHOLD`` of a query's
windows is verified by its exact cosine. At distance d a vector lies in a window of half-width w with probability
P(|N(0,1)| <= w/d), so the rounds stop when one as near as the k-th best so far would have been verified
with probability ``SURE``, or when all have been. There is no limit on candidates; until k are found the windows
go on to cover the whole block. Each block gives its k best, and the best k of all blocks are the answer.

Queries are dealt into blocks too; a task meets one block of vectors and one of queries, both of bounded size.

Cases. Empty table or no valid vector: no rows. Vectors that are null, zero, or hold null or non-finite components
take no part; nor do null ids. Vectors of each length meet their own kind only. An id may have several vectors: exact repeats count
once, each of the others is asked and found, a pair of ids has its best score, and an id is no neighbour of itself. Ties: smaller id first. Fewer than k candidates: all. Extra columns are ignored.
"""

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bibspark.session import ship

PROJECTIONS = 64
THRESHOLD = 0.85
WIDEN = 1.3
FIRST = 0.3
SURE = 0.95
SEED = 17
VECTORS_PER_BLOCK = 32_768
QUERIES_PER_BLOCK = 512


def valid(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """id and v (doubles): the valid vectors, exact repeats once."""
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    big = F.lit(float("inf"))
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < big)) & F.exists("v", lambda x: x != 0)
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull()).where(F.coalesce(good, F.lit(False)))
    return rows.groupBy("id", "v").agg(F.lit(0).alias("_")).drop("_")


class Index:
    """One block of vectors under every projection."""

    def __init__(self, ids, vectors, projections: int, seed: int):
        self.ids, self.vectors = ids, vectors
        self.norms = np.sqrt((vectors * vectors).sum(1))
        unit = vectors / self.norms[:, None]
        # the same directions in every block: they depend on the seed and the dimension only
        self.directions = np.random.default_rng(seed).standard_normal((vectors.shape[1], projections))
        values = unit @ self.directions
        self.order = np.argsort(values, axis=0, kind="stable").T.copy()
        self.sorted = np.take_along_axis(values.T, self.order, axis=1)

    def search(self, asked: np.ndarray, queries: np.ndarray, k: int, threshold: float, widen: float, first: float, sure: float):
        """Per query the positions and cosines of the k best found, and how many vectors were verified. A round looks up the
        window ends of all queries that are not done, one projection at a time, then counts what the windows gained."""
        n, m = len(self.ids), len(self.order)
        need, flat, base = math.ceil(threshold * m), self.order.ravel(), np.arange(m) * n
        norms = np.sqrt((queries * queries).sum(1))
        centres = (queries / norms[:, None]) @ self.directions
        left = np.stack([np.searchsorted(s, c) for s, c in zip(self.sorted, centres.T)], 1)
        right = left.copy()
        hits = np.zeros((len(asked), n), np.uint16)
        done = self.ids[None, :] == asked[:, None]
        found = [(np.empty(0, np.int64), np.empty(0)) for _ in asked]
        verified = np.zeros(len(asked), np.int64)
        active, width = np.arange(len(asked)), first
        while len(active):
            lo = np.stack([np.searchsorted(s, c - width) for s, c in zip(self.sorted, centres[active].T)], 1)
            hi = np.stack([np.searchsorted(s, c + width, "right") for s, c in zip(self.sorted, centres[active].T)], 1)
            more = []
            for at, q in enumerate(active):
                low, high = np.minimum(lo[at], left[q]), np.maximum(hi[at], right[q])
                # what the wider windows add on either side
                hits[q] += np.bincount(flat[ranges(np.concatenate([base + low, base + right[q]]), np.concatenate([left[q] - low, high - right[q]]))], minlength=n).astype(np.uint16)
                left[q], right[q] = low, high
                new = np.flatnonzero((hits[q] >= need) & ~done[q])
                best, score = found[q]
                if len(new):
                    done[q, new] = True
                    verified[q] += len(new)
                    cosine = (self.vectors[new] * queries[q]).sum(1) / (self.norms[new] * norms[q])
                    best, score = np.concatenate([best, new]), np.concatenate([score, cosine])
                    top = np.lexsort((self.ids[best], -score))[:k]
                    best, score = found[q] = best[top], score[top]
                if not (done[q].all() or len(best) == k and self.safe(width, float(score[-1]), m, need, sure)):
                    more.append(q)
            active, width = np.array(more, np.int64), width * widen
        return found, verified

    @staticmethod
    def safe(width: float, cosine: float, m: int, need: int, sure: float) -> bool:
        """Would a vector as near as this have been verified? By a normal approximation of the number of windows it lies in."""
        distance = math.sqrt(max(0.0, 2.0 - 2.0 * cosine))
        p = math.erf(width / distance / math.sqrt(2)) if distance else 1.0
        return m * p - need + 0.5 >= math.sqrt(m * p * (1 - p)) * quantile(sure)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers from each start on, as many as its length."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1])


def quantile(p: float) -> float:
    from statistics import NormalDist

    return NormalDist().inv_cdf(p)


def search(df: DataFrame, queries: DataFrame, k: int = 5, projections: int = PROJECTIONS, threshold: float = THRESHOLD, widen: float = WIDEN, first: float = FIRST,
           sure: float = SURE, seed: int = SEED, vectors_per_block: int = VECTORS_PER_BLOCK, queries_per_block: int = QUERIES_PER_BLOCK) -> DataFrame:
    """Both frames hold (id, v) as ``valid`` gives them; returns query_id, rank, vec_id, score (cosine)."""
    ship(__name__)
    blocks = max(1, -(-df.count() // vectors_per_block))
    sides = max(1, -(-queries.count() // queries_per_block))
    every = lambda n: F.sequence(F.lit(0), F.lit(n - 1))
    own = lambda n: F.pmod(F.xxhash64("id", "v"), F.lit(n)).cast("int")
    left = df.select(F.size("v").alias("width"), own(blocks).alias("block"), F.explode(every(sides)).alias("side"), "id", "v")
    right = queries.select(F.size("v").alias("width"), F.explode(every(blocks)).alias("block"), own(sides).alias("side"), "id", "v")

    def run(vectors: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(vectors) and len(asked):
            index = Index(vectors["id"].to_numpy(), np.stack(vectors["v"].to_numpy()).astype(float), projections, seed)
            ids, wanted = asked["id"].to_numpy(), np.stack(asked["v"].to_numpy()).astype(float)
            for query_id, (at, score) in zip(ids, index.search(ids, wanted, k, threshold, widen, first, sure)[0]):
                out.extend((query_id, int(index.ids[a]), float(s)) for a, s in zip(at, score))
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    found = left.groupBy("width", "block", "side").cogroup(right.groupBy("width", "block", "side")).applyInPandas(run, "query_id bigint, vec_id bigint, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
