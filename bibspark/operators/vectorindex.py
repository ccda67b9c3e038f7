"""A stored index for vector search.

Vectors are written once, in a folder per cell. The cells are those of k-means centres, fitted on unit-length vectors of a bounded sample
(the ``SAMPLE`` rows with the least key hashes, about); every row is assigned to its nearest centre. A query reads the folders of the
nearest centres only. A cell's radius is the largest distance of its vectors from the centre, so no vector of a cell is
nearer to a query than its centre's distance less the radius: with ``exact`` the search goes on, in rounds of doubling size, until no
unread cell can hold one of the best ``k``. Fewer than ``k`` found also goes on. Centres and radii, one row a cell, come to the driver.
"""

from dataclasses import dataclass

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bibspark.operators.vectors import knn

CELLS, SAMPLE, PROBES = 64, 100_000, 8


@dataclass(frozen=True)
class VectorIndex:
    spark: SparkSession
    path: str
    key: str
    vector: str

    def cells(self) -> list:
        """(cell, centre, radius, n) of every cell that holds rows."""
        return self.spark.read.parquet(f"{self.path}/cells").orderBy("cell").collect()

    def rows(self, cells: list[int]) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/rows").where(F.col("cell").isin(cells))


def build(corpus: DataFrame, key: str, vector: str, path: str, cells: int = CELLS, sample: int = SAMPLE, seed: int = 7) -> VectorIndex:
    """Store a corpus by cells; rows without a vector of finite, nonzero length are left out. Other columns are kept, for filters."""
    size = F.sqrt(F.aggregate(F.col(vector).cast("array<double>"), F.lit(0.0), lambda s, x: s + x * x))
    unit = F.transform(F.col(vector).cast("array<double>"), lambda x: x / size)
    rows = corpus.where((size > 0) & (size < float("inf"))).withColumn("__unit", array_to_vector(unit))
    drawn = F.pmod(F.xxhash64(F.lit(seed), F.col(key).cast("string")), F.lit(1 << 40)) / float(1 << 40)
    fitted = rows.where(drawn < min(1.0, sample / max(1, rows.count()))).select("__unit")
    model = KMeans(featuresCol="__unit", predictionCol="cell", k=cells, seed=seed, maxIter=10).fit(fitted)
    spark = corpus.sparkSession
    assigned = model.transform(rows).withColumn("__unit", vector_to_array("__unit"))
    centres = spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())], "cell int, centre array<double>")
    # a cell is spread over tasks by its keys
    dealt = assigned.withColumn("__salt", F.pmod(F.xxhash64(key), F.lit(8))).repartition("cell", "__salt").drop("__salt")
    dealt.write.mode("overwrite").partitionBy("cell").parquet(f"{path}/rows")
    gaps = F.zip_with("__unit", "centre", lambda x, c: (x - c) * (x - c))
    far = F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda s, x: s + x))
    found = spark.read.parquet(f"{path}/rows").select("cell", "__unit").join(F.broadcast(centres), "cell")
    found = found.groupBy("cell").agg(F.max("centre").alias("centre"), F.max(far).alias("radius"), F.count("*").alias("n"))
    found.coalesce(1).write.mode("overwrite").parquet(f"{path}/cells")
    return VectorIndex(spark, path, key, vector)


def search(index: VectorIndex, query: list[float], k: int = 10, min_sim: float | None = None, probes: int = PROBES, exact: bool = False, where=None) -> DataFrame:
    """(id, similarity): the nearest records, best first, from the ``probes`` nearest cells; with ``exact``, and where fewer than ``k`` are
    found, from as many as it takes. ``where`` filters rows by their own columns."""
    at = np.asarray(query, dtype=np.float64)
    at = at / np.linalg.norm(at)
    cells = index.cells()
    away = np.array([np.linalg.norm(at - np.asarray(c["centre"])) for c in cells])
    least = away - np.array([c["radius"] for c in cells])
    order = list(np.argsort(away, kind="stable"))
    found, done = None, 0
    while done < len(order):
        step = order[done : done + max(probes, done)]
        rows = index.rows([cells[i]["cell"] for i in step])
        part = knn(rows if where is None else rows.where(where), index.key, index.vector, query, k, min_sim)
        done += len(step)
        found = part if found is None else found.unionByName(part).orderBy(F.desc("similarity"), "id").limit(k)
        if done >= len(order):
            break
        # at most k rows
        best = found.collect()
        found = index.spark.createDataFrame(best, found.schema)
        last = best[-1]["similarity"] if len(best) == k else None
        if last is not None and (not exact or least[order[done:]].min() > np.sqrt(max(0.0, 2 - 2 * last)) + 1e-9):
            break
        if min_sim is not None and least[order[done:]].min() > np.sqrt(max(0.0, 2 - 2 * min_sim)) + 1e-9:
            break
    return found


def rows_read(index: VectorIndex, query: list[float], probes: int = PROBES) -> float:
    """Share of the rows in the nearest cells."""
    at = np.asarray(query, dtype=np.float64)
    at = at / np.linalg.norm(at)
    cells = sorted(index.cells(), key=lambda c: float(np.linalg.norm(at - np.asarray(c["centre"]))))
    return sum(c["n"] for c in cells[:probes]) / sum(c["n"] for c in cells)
