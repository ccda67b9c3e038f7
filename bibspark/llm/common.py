"""Helpers the operators of this folder share."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bibspark.session import checkpointed  # noqa: F401

DOCUMENT = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}
# a word, as all contracts on words read it
WORD = r"[^\x20\x09-\x0D]+"
# rows up to which a per-group table is sent to every task; beyond it the join shuffles and adaptive
# execution splits hot keys
SMALL_ROWS = 20_000


def documents(df: DataFrame) -> DataFrame:
    """The five columns of documents, typed, whatever else the input has."""
    return df.select(*[F.col(f"`{c}`").cast(t).alias(c) for c, t in DOCUMENT.items()])


def whole(text: Column) -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(text, F.lit(""))


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def likely(key: Column, n: Column, most: int) -> Column:
    """True for about twice ``most`` of ``n`` different keys, those with the least hashes by ``drawn``; for all
    where n is not more. A sample of the ``most`` least then sorts a bounded number of rows, however many there are."""
    return drawn(key) * (n / F.lit(2.0**40)) < 2 * most


def drawn(key: Column) -> Column:
    """A number below 2**40 from the key's hash."""
    return F.pmod(F.xxhash64(key), F.lit(1 << 40))


def lookup(left: DataFrame, small: DataFrame, on: Column, how: str = "left", limit: int = SMALL_ROWS) -> DataFrame:
    """Join a per-group table whose size is only known at run time: counted first, broadcast up to
    ``limit`` rows, else left to a shuffle join. ``small`` should be cheap to count (checkpointed)."""
    return left.join(F.broadcast(small) if small.count() <= limit else small, on, how)


def sliced(rows: DataFrame, *order: str) -> DataFrame:
    """The rows sorted over the whole table by ``order`` and stored, with a column ``slice``: the number of the partition, in
    the same order. Slices end anywhere, inside a hot key too, so tasks of mapInArrow read even shares. The last of
    ``order`` should tell equal rows apart, and all should be short: a sample of them marks the slices."""
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return checkpointed(sorted_rows.withColumn("slice", F.spark_partition_id()))
