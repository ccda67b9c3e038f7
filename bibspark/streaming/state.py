"""Keyed state in folders.

A table of state is cut into buckets by a hash of its key. A version of a bucket is a folder, written once by the batch of that
number; a manifest per batch names the version of every bucket. A batch reads the buckets it touches, merges its rows into them, writes
their new versions, and last its manifest. So its work follows what it touches, not the batches before it, and a bucket is always one
compact version. A batch that died left no manifest; run again it starts from the manifest before it and writes the same folders
anew. What only manifests before the last two name is removed.
"""

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bibspark.session import exists, local_frame, remove

BUCKETS = 32
MANIFEST = "bucket int, version bigint"


class KeyedState:
    def __init__(self, spark: SparkSession, path: str, key, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self.key = [key] if isinstance(key, str) else list(key)

    def manifests(self) -> dict[int, dict[int, int]]:
        """By batch, the version of each bucket: the last three batches, at most ``buckets`` entries each."""
        if not exists(self.spark, f"{self.path}/manifest"):
            return {}
        found: dict[int, dict[int, int]] = {}
        for r in self.spark.read.schema(f"{MANIFEST}, batch bigint").parquet(f"{self.path}/manifest").collect():
            held = found.setdefault(r["batch"], {})
            if r["bucket"] >= 0:
                held[r["bucket"]] = r["version"]
        return found

    def manifest(self) -> dict[int, int]:
        found = self.manifests()
        return found[max(found)] if found else {}

    def rows(self, versions: dict[int, int]) -> DataFrame | None:
        """The rows of some versions of buckets."""
        paths = [f"{self.path}/data/version={v}/bucket={b}" for b, v in sorted(versions.items())]
        return self.spark.read.parquet(*paths) if paths else None

    def read(self) -> DataFrame | None:
        """All rows; None where no batch had any."""
        return self.rows(self.manifest())

    def apply(self, batch: int, new: DataFrame, merge: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame | None]:
        """Merge the rows of a batch in; ``merge`` reduces rows of one schema by key, old ones and new. Returns the batch's rows and
        the rows held before for its keys (None: none held); a null key is held, but not given back."""
        bucket = F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")
        incoming = f"{self.path}/incoming/batch={batch}"
        merge(new).withColumn("bucket", bucket).write.mode("overwrite").parquet(incoming)
        new = self.spark.read.parquet(incoming)
        earlier = {n: m for n, m in self.manifests().items() if n < batch}
        held = earlier[max(earlier)] if earlier else {}
        touched = [r["bucket"] for r in new.select("bucket").distinct().collect()]
        old = self.rows({b: held[b] for b in touched if b in held})
        columns = [c for c in new.columns if c != "bucket"]
        fresh = new.select(*columns)
        if touched:
            rows = merge(fresh if old is None else old.select(*columns).unionByName(fresh)).withColumn("bucket", bucket)
            # a bucket is spread over tasks by its keys
            rows = rows.withColumn("salt", F.pmod(F.xxhash64(F.lit(1), *self.key), F.lit(8))).repartition("bucket", "salt").drop("salt")
            rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/data/version={batch}")
        self._commit(batch, earlier, held, touched)
        return fresh, None if old is None else old.select(*columns).join(fresh.select(*self.key), self.key, "left_semi")

    def _commit(self, batch: int, earlier: dict[int, dict[int, int]], held: dict[int, int], touched: list[int]) -> None:
        now = held | dict.fromkeys(touched, batch)
        # a batch without rows says so by a bucket that does not exist
        rows = sorted(now.items()) or [(-1, batch)]
        frame = local_frame(self.spark, bucket=pa.array([b for b, _ in rows], pa.int32()), version=pa.array([v for _, v in rows], pa.int64()))
        frame.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/batch={batch}")
        for old in sorted(earlier)[:-1]:
            for b, v in earlier[old].items():
                if held.get(b) != v and now.get(b) != v:
                    remove(self.spark, f"{self.path}/data/version={v}/bucket={b}")
            for name in ("manifest", "incoming"):
                remove(self.spark, f"{self.path}/{name}/batch={old}")
