"""Incremental jobs.

Rows that are only added go to a folder per micro-batch, ``batch=N``, which a replay overwrites. Rows that replace others, or add up,
are keyed state (see ``state``): a batch works on the buckets it touches. Either way a lost executor or a restart changes nothing.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bibspark.operators.upkeep import flatten, latest_by
from bibspark.streaming.state import BUCKETS, KeyedState


def read_files(spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_batch: int | None = None) -> DataFrame:
    """A stream of files, each read once; the checkpoint of the query is the ledger."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def _run(stream: DataFrame, each, checkpoint: str) -> StreamingQuery:
    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def _batch(path: str, batch: int) -> str:
    return f"{path}/batch={batch}"


def stream_flatten(stream: DataFrame, mapping: dict, out: str, checkpoint: str) -> StreamingQuery:
    """Flatten what arrives; every file once."""
    return _run(stream, lambda df, n: flatten(df, mapping).write.mode("overwrite").parquet(_batch(out, n)), checkpoint)


def stream_upsert(stream: DataFrame, key, version: str, out: str, checkpoint: str, tie: list[str] = (), buckets: int = BUCKETS) -> StreamingQuery:
    """Keep the highest version per key; a late, lower version loses when it comes. A batch reads and writes the buckets of its keys."""
    state = KeyedState(stream.sparkSession, out, key, buckets)
    return _run(stream, lambda df, n: state.apply(n, df, lambda rows: latest_by(rows, key, version, tie)), checkpoint)


def read_latest(spark: SparkSession, out: str) -> DataFrame:
    """The state as of the last whole batch: one row per key."""
    return KeyedState(spark, out, ()).read().drop("bucket")


def stream_cube(stream: DataFrame, key, version: str, keys: list[str], sums: dict, state: str, cells: str, checkpoint: str, tie: list[str] = (), buckets: int = BUCKETS) -> StreamingQuery:
    """Keep a cube of the latest versions. For the keys a batch touches, the cells of the version that
    held before are taken out and those of the new one put in, so a correction moves a record from cell
    to cell. Records and cells are both keyed state."""
    spark = stream.sparkSession
    records, cube = KeyedState(spark, state, key, buckets), KeyedState(spark, cells, keys, buckets)
    held = F.count("*").alias("doc_count")

    def latest(rows):
        return latest_by(rows, key, version, tie)

    def measured(df, sign):
        rows = df.groupBy(*keys).agg(held, *[F.sum(c).alias(n) for n, c in sums.items()])
        return rows.select(*keys, *[(F.col(c) * sign).alias(c) for c in rows.columns if c not in keys])

    def summed(rows):
        return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in rows.columns if c not in keys])

    def each(df, n):
        new, before = records.apply(n, df, latest)
        change = measured(new, 1) if before is None else measured(latest(before.unionByName(new)), 1).unionByName(measured(before, -1))
        cube.apply(n, change, summed)

    return _run(stream, each, checkpoint)


def read_cube(spark: SparkSession, cells: str) -> DataFrame:
    return KeyedState(spark, cells, ()).read().drop("bucket").where("doc_count <> 0")


def version_guard(stream: DataFrame, key, version: str, out: str, checkpoint: str, tie: list[str] = ()) -> StreamingQuery:
    """Upsert for versions out of order: the highest version wins, however late it or a lower one comes.
    Repeats of a version are harmless to that, so nothing is dropped on arrival and no watermark is kept."""
    return stream_upsert(stream, key, version, out, checkpoint, tie)
