"""Vector search.

The exact search for one vector is one scan: each task multiplies its Arrow batches with it and keeps its
own best ``k``, so that only ``k`` rows per task are shuffled. Many queries meet the corpus block by block, through the
shuffle. Filters go on the corpus before the call and reach the scan. ``vectorindex`` stores a corpus by cells.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from bibspark.functions.text import fold, tokens
from bibspark.operators.paging import best_per_key, inject
from bibspark.session import ship, stored

ship(__name__)

BLOCK = 1024
SIDES = 4
ROWS = 4096
# fixed values: similarity of injected matches when the vector search finds none, and their number
NO_RESULT_SCORE, INJECTED, SHORT_WORDS = 0.55, 20, 3


def _matrix(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the right width as a unit-length matrix, and their places."""
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    good = np.flatnonzero(lengths == dim)
    flat = pc.list_flatten(column.take(pa.array(good))).to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(good), dim)
    size = np.linalg.norm(rows, axis=1)
    keep = np.isfinite(size) & (size > 0)
    return rows[keep] / size[keep, None], good[keep]


def _scanner(query_ids: list, query_type: pa.DataType, block: np.ndarray, k: int, min_sim: float | None, unit: bool):
    dim = block.shape[1]

    def scan(batches):
        best = [[] for _ in query_ids]
        floor = np.full(len(query_ids), -np.inf)
        types = None
        for whole in batches:
            types = whole.schema.field(0).type
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                rows, places = _matrix(batch.column(1), dim)
                if not len(places):
                    continue
                # rounded, so that equal vectors tie whatever the batch they come in
                sims = np.round(block @ rows.T, 12)
                if unit:
                    sims = (1 + sims) / 2
                if min_sim is not None:
                    sims = np.where(sims >= min_sim, sims, -np.inf)
                ids = batch.column(0)
                top = sims.max(axis=1)
                for q in np.flatnonzero((top >= floor) & (top > -np.inf)):
                    line = sims[q]
                    bar = floor[q]
                    if len(line) > k:
                        bar = max(bar, np.partition(line, -k)[-k])
                    at = np.flatnonzero((line >= bar) & (line > -np.inf))
                    found = best[q] + [(-line[i], ids[int(places[i])].as_py()) for i in at]
                    best[q] = sorted(found)[:k]
                    if len(best[q]) == k:
                        floor[q] = -best[q][-1][0]
        rows = [(qid, key, -s) for qid, hits in zip(query_ids, best, strict=True) for s, key in hits]
        if rows:
            q, key, s = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(q, type=query_type), pa.array(key, type=types), pa.array(s, type=pa.float64())], ["query_id", "id", "similarity"]
            )

    return scan


def knn_join(corpus: DataFrame, key: str, vector: str, queries: DataFrame, k: int = 10, min_sim: float | None = None, unit: bool = False, blocks: int | None = None,
             sides: int = SIDES) -> DataFrame:
    """For each row of ``queries(query_id, vector)`` its ``k`` nearest records by cosine: (query_id, id,
    similarity, rank). ``unit`` puts similarity and threshold on the scale 0 to 1. Exact; equal
    similarities go by id. Records are dealt into ``blocks`` (as many as shuffle partitions), queries into ``sides``, and each pair of a block
    and a side meets in one task, which keeps the best ``k`` per query: one job, in which the corpus is read once."""
    blocks = blocks or int(corpus.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    own = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    left = corpus.select(own(key, blocks).alias("__block"), every(sides).alias("__side"), F.col(key).alias("__id"), F.col(vector).alias("__vector"))
    right = queries.where("vector is not null").select(every(blocks).alias("__block"), own("query_id", sides).alias("__side"), "query_id", F.col("vector").cast("array<double>").alias("vector"))
    id_type, query_type = (to_arrow_type(f.dataType) for f in (corpus.schema[key], queries.schema["query_id"]))
    out = pa.schema([("query_id", query_type), ("id", id_type), ("similarity", pa.float64())])

    def run(records: pa.Table, asked: pa.Table) -> pa.Table:
        found = []
        rows = records.select(["__id", "__vector"])
        for start in range(0, asked.num_rows if rows.num_rows else 0, BLOCK):
            part = asked.slice(start, BLOCK).select(["query_id", "vector"])
            ids, vectors = part.column("query_id").to_pylist(), part.column("vector").to_pylist()
            # queries of one length together
            for dim in sorted({len(v) for v in vectors}):
                picked = [i for i, v in enumerate(vectors) if len(v) == dim]
                matrix = np.array([vectors[i] for i in picked], dtype=np.float64).reshape(len(picked), dim)
                size = np.linalg.norm(matrix, axis=1)
                keep = np.isfinite(size) & (size > 0)
                if keep.any():
                    scan = _scanner([ids[i] for i, ok in zip(picked, keep, strict=True) if ok], query_type, matrix[keep] / size[keep, None], k, min_sim, unit)
                    found.extend(scan(rows.to_batches()))
        return pa.Table.from_batches([b.cast(out) for b in found], out)

    schema = f"query_id {queries.schema['query_id'].dataType.simpleString()}, id {corpus.schema[key].dataType.simpleString()}, similarity double"
    met = left.groupBy("__block", "__side").cogroup(right.groupBy("__block", "__side")).applyInArrow(run, schema)
    return best_per_key(met, "query_id", ["-similarity", "id"], k, "rank")


def knn(corpus: DataFrame, key: str, vector: str, query: list[float], k: int = 10, min_sim: float | None = 0.5, unit: bool = False) -> DataFrame:
    """Nearest records of one vector: (id, similarity), best first. One scan: each task keeps its own best ``k``, and only those move."""
    at = np.asarray(query, dtype=np.float64)
    schema = f"query_id int, id {corpus.schema[key].dataType.simpleString()}, similarity double"
    scan = _scanner([0], pa.int32(), (at / np.linalg.norm(at))[None, :], k, min_sim, unit)
    found = corpus.select(key, vector).mapInArrow(scan, schema)
    return found.select("id", "similarity").orderBy(F.desc("similarity"), "id").limit(k)


def knn_lsh(corpus: DataFrame, key: str, vector: str, query: list[float], k: int = 10, candidates: int = 75, tables: int = 4, width: float = 2.0, seed: int = 42) -> DataFrame:
    """Approximate search: candidates from random projections, ranked again by exact cosine. Vectors are
    scaled to unit length first, so that near in distance is near in angle."""
    size = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x * x))
    unit_rows = corpus.where(size > 0).select(F.col(key).alias("id"), array_to_vector(F.transform(vector, lambda x: x / size)).alias("v"))
    at = np.asarray(query, dtype=np.float64)
    at = at / np.linalg.norm(at)
    model = BucketedRandomProjectionLSH(inputCol="v", outputCol="hashes", numHashTables=tables, bucketLength=width, seed=seed).fit(unit_rows)
    near = model.approxNearestNeighbors(unit_rows, Vectors.dense(at), candidates, distCol="distance")
    # for unit vectors the cosine is 1 - d^2 / 2
    return near.select("id", (1 - F.col("distance") * F.col("distance") / 2).alias("similarity")).orderBy(F.desc("similarity"), "id").limit(k)


def short_query_inject(found: DataFrame, titles: DataFrame, q: str, key: str, title: str, cited: str, n: int = INJECTED) -> DataFrame:
    """For queries of up to three words, add the most cited records with all words in the title, at the
    median similarity of the vector results. ``found`` is a ranked list (id, similarity)."""
    if len(q.split()) > SHORT_WORDS:
        return found
    found = stored(found)
    # the middle of the list, best first
    best_first = F.sort_array(F.collect_list("similarity"), asc=False)
    median = F.coalesce(found.agg(F.get(best_first, F.floor(F.size(best_first) / 2).cast("int"))).scalar(), F.lit(NO_RESULT_SCORE))
    words = tokens(fold(F.lit(q)))
    hits = titles.where(F.size(F.array_except(words, tokens(fold(F.col(title))))) == 0)
    top = hits.orderBy(F.desc_nulls_last(cited), key).limit(n).select(F.col(key).alias("id"), median.alias("similarity"))
    return inject(found.select("id", "similarity"), top, "id")


def hashed_features(dim: int = 64):
    """A stand-in model: signed counts of hashed words, scaled to unit length."""
    from zlib import crc32

    def encode(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dim), dtype=np.float32)
        for i, text in enumerate(texts):
            for word in (text or "").lower().split():
                h = crc32(word.encode())
                out[i, h % dim] += 1.0 if (h >> 16) & 1 else -1.0
        size = np.linalg.norm(out, axis=1, keepdims=True)
        return np.divide(out, size, out=out, where=size > 0)

    return encode


def embed(df: DataFrame, key: str, text: str, model=None, max_chars: int | None = None) -> DataFrame:
    """(key, embedding) by an injected model, called once per batch with a list of texts. The whole text
    is used unless the model's own input limit is given as ``max_chars``."""
    encode = model or hashed_features()

    def run(batches):
        for pdf in batches:
            texts = [t if max_chars is None or t is None else t[:max_chars] for t in pdf[text]]
            yield pdf[[key]].assign(embedding=list(encode(texts)))

    return df.select(key, text).mapInPandas(run, f"{key} {df.schema[key].dataType.simpleString()}, embedding array<float>")


def similarity_order(df: DataFrame, score: Column, key: str, k: int) -> DataFrame:
    return df.withColumn("score", score).orderBy(F.desc("score"), key).limit(k)
