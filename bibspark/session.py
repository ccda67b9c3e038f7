"""Session helpers: SQL settings that fit skewed data, scratch space and size-checked broadcast."""

import contextlib
import sys
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key's partition even where that costs one more shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # top-k per key is limited on the map side up to this k
    "spark.sql.optimizer.windowGroupLimitThreshold": "10000",
    "spark.sql.session.timeZone": "UTC",
}


def ship(module: str) -> None:
    """Send a module's functions to the tasks by value, so that executors need not have the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings the operators count on."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Runtime SQL settings for the jobs of a block; what held before holds again."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def local_session(cpus: int | str = "*", shuffle: int = 8, memory: str = "8g", shared: str | None = None) -> SparkSession:
    """A session for tests and the bench; on a cluster the caller brings its own. ``shared`` becomes
    ``spark.checkpoint.dir``."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bibspark")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.driver.memory", memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_OWN: dict = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or a temporary one in local mode."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        # the setting cannot be changed in a running session
        base = _OWN.get(spark.sparkContext.applicationId) or tempfile.mkdtemp(prefix="bibspark-")
        _OWN[spark.sparkContext.applicationId] = base
    return base


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage through reliable storage."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """Written to the shared folder and read again: cuts the lineage like a checkpoint, computes the rows once, and
    tells the optimizer their size. Partitioning and order are not kept."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _files(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def portions(df: DataFrame, size: int = 16 << 20) -> DataFrame:
    """Records dealt evenly into tasks that read about ``size`` bytes of files each, where the scan has fewer: rows made of them then fit
    a task's memory. Short input, from 1 MB, is dealt to the cores; a frame of no files is left as it is."""
    found = [_files(df.sparkSession, path) for path in df.inputFiles()]
    total = sum(files.getFileStatus(at).getLen() for at, files in found)
    tasks = max(-(-total // size), min(df.sparkSession.sparkContext.defaultParallelism, total >> 20))
    return df.repartition(tasks) if tasks > df.rdd.getNumPartitions() else df


def exists(spark: SparkSession, path: str) -> bool:
    at, files = _files(spark, path)
    return files.exists(at)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a written folder, wherever it lies; nothing happens where there is none."""
    at, files = _files(spark, path)
    files.delete(at, True)


def local_frame(spark: SparkSession, **columns: pa.Array) -> DataFrame:
    """A short list from the caller as a frame. It goes in through Arrow as a local relation, whose size
    the optimizer knows, so it can decide on a broadcast before anything is shuffled."""
    return spark.createDataFrame(pa.table(columns))
