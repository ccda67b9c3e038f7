"""Snapshot folders: ``root/<entity>/updated_date=YYYY-MM-DD/part*.gz`` of JSON Lines."""

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def list_files(spark: SparkSession, root: str, pattern: str = "*.gz") -> DataFrame:
    """(entity, path, length) of every data file under a root; only file names are read."""
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(root)
        .select("path", "length")
    )
    inside = F.split_part("path", F.lit(f"{root.rstrip('/')}/"), F.lit(-1))
    return found.select(F.split_part(inside, F.lit("/"), F.lit(1)).alias("entity"), "path", "length")


def read_lines(spark: SparkSession, paths, tasks: int | None = None) -> DataFrame:
    """Raw lines. A gzip file is one task, so ``tasks`` spreads the lines for heavy work after it."""
    lines = spark.read.text(paths)
    return lines.repartition(tasks) if tasks else lines


def read_snapshot(spark: SparkSession, root: str, entity: str, schema: T.StructType | str, since: str | None = None) -> DataFrame:
    """Records of one entity with a declared schema. ``since`` keeps later ``updated_date`` folders,
    by partition pruning."""
    df = spark.read.schema(schema).option("mode", "PERMISSIVE").json(f"{root.rstrip('/')}/{entity}")
    if since is not None and "updated_date" in df.columns:
        df = df.where(F.col("updated_date").cast("date") > F.lit(since).cast("date"))
    return df


def write_snapshot(df: DataFrame, root: str, entity: str, date_col: str | None = None) -> str:
    """Write gzip JSON Lines, in ``updated_date`` folders if a date column is named."""
    path = f"{root.rstrip('/')}/{entity}"
    if date_col:
        # rebalancing gives few files per folder, and splits a day that holds much of the data
        df = df.withColumn("updated_date", F.date_format(date_col, "yyyy-MM-dd")).hint("rebalance", "updated_date")
    writer = df.write.mode("overwrite").option("compression", "gzip")
    (writer.partitionBy("updated_date") if date_col else writer).json(path)
    return path


def land_all(lines: DataFrame, id_path: str = "$.id", col: str = "value") -> DataFrame:
    """(id, raw, line, kind) of all lines in one pass; ``line`` is kept for rejects only."""
    parsed = lines.select(col, F.try_parse_json(col).alias("raw"))
    keyed = parsed.withColumn("id", F.try_variant_get("raw", id_path, "string"))
    kind = F.when(F.col("id").isNull(), "reject").otherwise("good")
    return keyed.select("id", "raw", F.when(F.col("id").isNull(), F.col(col)).alias("line"), kind.alias("kind"))


def land(lines: DataFrame, id_path: str = "$.id", col: str = "value") -> tuple[DataFrame, DataFrame]:
    """Landing rows ``(id, raw)`` and, apart, the lines that hold no parsable record with an id."""
    rows = land_all(lines, id_path, col)
    return rows.where("kind = 'good'").select("id", "raw"), rows.where("kind = 'reject'").select("line")


def load_new(spark: SparkSession, root: str, ledger: str, out: str, id_path: str = "$.id", pattern: str = "*.gz", tasks: int | None = None) -> int:
    """Land the lines of files that no earlier load read; returns their number. A file stream reads each file once, and its checkpoint, the
    folder ``ledger``, names those that it has read, so no list of files is kept here. A gzip file is one task only while it is
    read: ``tasks`` spreads its lines for the work after it. The rows go to one folder per load, good and rejected apart, so a
    load that died is written again."""
    lines = spark.readStream.format("text").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    counted = []

    def each(df: DataFrame, load: int) -> None:
        seen = Observation()
        rows = df.repartition(tasks or df.sparkSession.sparkContext.defaultParallelism).observe(seen, F.count(F.lit(1)).alias("n"))
        land_all(rows, id_path).write.mode("overwrite").partitionBy("kind").parquet(f"{out}/load={load}")
        counted.append(seen.get["n"])

    query = lines.writeStream.foreachBatch(each).option("checkpointLocation", ledger).trigger(availableNow=True).start()
    query.awaitTermination()
    return sum(counted)


def profile(df: DataFrame, col: str) -> DataFrame:
    """Top-level keys of JSON text with their type, count and one example (the least)."""
    raw = df.select(F.try_parse_json(col).alias("raw")).where("raw is not null")
    cells = raw.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("raw").outer()))
    return cells.groupBy(F.col("key"), F.schema_of_variant("value").alias("type")).agg(
        F.count("*").alias("n"), F.min(F.col("value").cast("string")).alias("example")
    )


def profile_schema(df: DataFrame, col: str) -> DataFrame:
    """One merged schema for all JSON text of a column."""
    return df.agg(F.schema_of_variant_agg(F.try_parse_json(col)).alias("schema"))
