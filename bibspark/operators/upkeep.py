"""Jobs that keep tables clean: latest version, deltas, merges, duplicates, backfill, flattening."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bibspark.functions.paths import leaf


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def latest_by(df: DataFrame, key, version: str, tie: list[str] = ()) -> DataFrame:
    """One row per key: the highest version, ties settled by further columns. An aggregate with map-side
    combine, so that a hot key never meets in one task."""
    best = F.max_by(F.struct(*df.columns), F.struct(version, *tie)).alias("__row")
    return df.groupBy(*[F.col(k).alias(f"__k_{k}") for k in _keys(key)]).agg(best).select("__row.*")


def changed_since(df: DataFrame, date_col: str, day: str) -> DataFrame:
    return df.where(F.col(date_col) > F.lit(day).cast("date").cast(df.schema[date_col].dataType))


def apply_delta(base: DataFrame, delta: DataFrame, key, version: str, tie: list[str] = ()) -> DataFrame:
    return latest_by(base.unionByName(delta), key, version, tie)


def drop_merged(df: DataFrame, key: str, merged: DataFrame) -> DataFrame:
    """Remove records whose id was merged away; ``merged`` has a column ``id``."""
    return df.join(merged.select(F.col("id").alias(key)), key, "left_anti")


def merge_log(log: DataFrame, add: DataFrame | None = None, remove: DataFrame | None = None) -> DataFrame:
    """Ledger ``(id, merge_into_id)`` with pairs added and, for an unmerge, ids taken out."""
    out = log
    if add is not None:
        out = out.join(add.select("id"), "id", "left_anti").unionByName(add)
    if remove is not None:
        out = out.join(remove.select("id"), "id", "left_anti")
    return out


def remove_duplicates(df: DataFrame, key, ts: str, tie: list[str] = (), only_pairs: bool = True) -> DataFrame:
    """Keep the newer record of a key that occurs twice; ``only_pairs=False`` keeps the newest of any
    number. Counting is done before any row moves, and keys left alone keep all their rows."""
    if not only_pairs:
        return latest_by(df, key, ts, tie)
    keys = _keys(key)
    sizes = df.groupBy(*keys).agg(F.count("*").alias("__n"))
    pairs = sizes.where("__n = 2").select(*keys)
    return df.join(pairs, keys, "left_anti").unionByName(latest_by(df.join(pairs, keys, "left_semi"), key, ts, tie))


def remove_empty(df: DataFrame, id_col: str, needed: str) -> DataFrame:
    return df.where(~(F.col(id_col).isNull() & F.col(needed).isNull()))


def clear_field(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, F.lit(None).cast(df.schema[col].dataType))


def seed(df: DataFrame, pred: Column, out: str | None = None, sort: list[str] = (), partition: list[str] = ()) -> DataFrame:
    """The subset a predicate picks. With ``out`` it is written, sorted within files for min/max
    pruning, and read back."""
    picked = df.where(pred)
    if out is None:
        return picked
    if partition:
        # few files per folder, and a large folder still from many tasks
        picked = picked.hint("rebalance", *partition)
    if sort:
        picked = picked.sortWithinPartitions(*sort)
    writer = picked.write.mode("overwrite")
    (writer.partitionBy(*partition) if partition else writer).parquet(out)
    return df.sparkSession.read.parquet(out)


def flatten(df: DataFrame, mapping: dict[str, str | Column]) -> DataFrame:
    """Typed wide rows: each output column is an expression, or a dotted path whose values become a
    scalar or, through arrays, an array of distinct non-null values."""

    def cell(source):
        if isinstance(source, Column):
            return source
        at = leaf(df, source)
        return at.distinct if at.many else at.col

    return df.select(*[cell(source).alias(name) for name, source in mapping.items()])


def stale_partitions(raw: DataFrame, flat: DataFrame, part: str, key: str, tolerance: int = 10) -> DataFrame:
    """Partitions whose distinct keys fall short of the raw table by more than the tolerance."""

    def counts(df, name):
        return df.groupBy(part).agg(F.count_distinct(key).alias(name))

    both = counts(raw, "n_raw").join(counts(flat, "n_flat"), part, "left")
    both = both.select(part, "n_raw", F.coalesce("n_flat", F.lit(0)).cast("bigint").alias("n_flat"))
    return both.where(F.col("n_raw") - F.col("n_flat") > tolerance)


def normalise(df: DataFrame, key: str, children: dict[str, str]) -> dict[str, DataFrame]:
    """Relational tables out of nested records: the scalar root, and per array of structs a child table
    ``(key, position, fields)``."""
    arrays = {p.split(".")[0] for p in children.values()}
    tables = {"root": df.drop(*arrays)}
    for name, path in children.items():
        rows = df.select(key, F.posexplode(leaf(df, path).col).alias("position", "__item"))
        tables[name] = rows.select(key, "position", "__item.*")
    return tables


def first_related(array: Column, test, field: str) -> Column:
    """A field of the first element that passes, NULL if none does."""
    return F.get(F.filter(array, test), F.lit(0)).getField(field)
