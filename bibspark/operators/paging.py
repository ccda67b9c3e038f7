"""Order, pages, cursors and samples. Sort keys are names, with a leading minus for descending; missing
values come last either way."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bibspark.session import stored

MAX_PER_PAGE = 200
MAX_WINDOW = 10_000
MAX_SAMPLE = 10_000


def _split(key: str) -> tuple[str, bool]:
    return key.lstrip("-"), key.startswith("-")


def sort_columns(keys: list[str]) -> list[Column]:
    cols = []
    for key in keys:
        name, desc = _split(key)
        cols.append(F.col(name).desc_nulls_last() if desc else F.col(name).asc_nulls_last())
    return cols


def sort(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.orderBy(*sort_columns(keys))


def page(df: DataFrame, keys: list[str], number: int = 1, per_page: int = 25) -> DataFrame:
    """One page of the sorted rows; deeper reading takes a cursor."""
    if not 1 <= per_page <= MAX_PER_PAGE:
        raise ValueError(f"a page holds 1 to {MAX_PER_PAGE} rows")
    if number < 1 or number * per_page > MAX_WINDOW:
        raise ValueError(f"pages reach to row {MAX_WINDOW}; use a cursor")
    return sort(df, keys).offset((number - 1) * per_page).limit(per_page)


def numbered(df: DataFrame, keys: list[str], name: str = "row") -> DataFrame:
    """Rows numbered from 1 in the order of the keys, which end in a unique one. The sorted rows are cut into even slices, whatever
    values repeat; a slice numbers its own and starts behind all before it, so no task meets the whole list."""
    order = sort_columns(keys)
    rows = stored(df.repartitionByRange(*order).withColumn("__slice", F.spark_partition_id()), "numbered")
    sizes = rows.groupBy("__slice").agg(F.count("*").alias("__n"))
    # one row a slice
    before = F.sum("__n").over(Window.orderBy("__slice")) - F.col("__n")
    inside = F.row_number().over(Window.partitionBy("__slice").orderBy(*order))
    rows = rows.withColumn("__inside", inside).join(sizes.select("__slice", before.alias("__before")), "__slice")
    return rows.withColumn(name, F.col("__before") + F.col("__inside")).drop("__slice", "__inside", "__before")


def total(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("count"))


def after(df: DataFrame, keys: list[str], cursor: list | None, n: int = 25) -> DataFrame:
    """The next ``n`` rows behind the sort values of a last row, NULLs among them. The keys must end in
    a unique one."""
    if cursor is None:
        return sort(df, keys).limit(n)
    ties, later = [], []
    for key, v in zip(keys, cursor, strict=True):
        name, desc = _split(key)
        col = F.col(name)
        if v is None:
            same = col.isNull()
        else:
            value = F.lit(v)
            past = col < value if desc else col > value
            later.append(reduce(lambda a, b: a & b, [*ties, past | col.isNull()]))
            same = col == value
        ties.append(same)
    if not later:
        return df.limit(0)
    return sort(df.where(reduce(lambda a, b: a | b, later)), keys).limit(n)


def cursor_of(rows: DataFrame, keys: list[str]) -> list | None:
    """Sort values of the last row of a page, to go on from; None past the end."""
    last = rows.select(*[_split(k)[0] for k in keys]).tail(1)
    return list(last[0]) if last else None


def order_hash(ids: Column, seed) -> Column:
    """A random but fixed order: the same on any number of tasks, and in any engine with md5."""
    return F.md5(F.concat_ws(":", ids.cast("string"), F.lit(str(seed))))


def sample(df: DataFrame, key: str, n: int, seed=0) -> DataFrame:
    """``n`` records at random, the same for the same seed."""
    if not 1 <= n <= MAX_SAMPLE:
        raise ValueError(f"a sample holds 1 to {MAX_SAMPLE} rows")
    return df.orderBy(order_hash(F.col(key), seed), key).limit(n)


def sample_bands(df: DataFrame, key: str, band: Column, seed=0) -> DataFrame:
    """One random record per band, picked with map-side combine."""
    rank = F.struct(order_hash(F.col(key), seed), F.col(key))
    return df.groupBy(band.alias("band")).agg(F.min_by(F.struct(*df.columns), rank).alias("__row")).select("band", "__row.*")


def top_k(df: DataFrame, keys: list[str], k: int) -> DataFrame:
    return sort(df, keys).limit(k)


def best_per_key(df: DataFrame, key, keys: list[str], k: int = 1, rank: str | None = None) -> DataFrame:
    """The first ``k`` rows per key. The rank limit also runs on the map side, so at most ``k`` rows of a
    hot key leave any task."""
    by = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*by).orderBy(*sort_columns(keys))
    out = df.withColumn("__rank", F.row_number().over(w)).where(F.col("__rank") <= k)
    return out.withColumnRenamed("__rank", rank) if rank else out.drop("__rank")


def inject(first: DataFrame, extra: DataFrame, key) -> DataFrame:
    """Both candidate lists, each id once; the first list wins."""
    by = [key] if isinstance(key, str) else list(key)
    return first.unionByName(extra.join(first.select(*by), by, "left_anti"), allowMissingColumns=True)
