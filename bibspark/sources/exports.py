"""Exports: facet lists side by side, one row per location, sparse scores as columns."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bibspark.operators.paging import numbered


def export_groups(groups: dict[str, DataFrame], n: int | None = None) -> DataFrame:
    """Facet lists ``(key, count)`` side by side, a blank column after each, most first; all groups, or
    the first ``n`` of each."""
    blocks = []
    for name, df in groups.items():
        ranked = numbered(df if n is None else df.orderBy(F.desc("count"), "key").limit(n), ["-count", "key"])
        blocks.append(ranked.select(F.col("row").cast("int").alias("row"), F.col("key").alias(f"{name}_name"), F.col("count").alias(f"{name}_count"), F.lit("").alias(f"{name}_blank")))
    return reduce(lambda a, b: a.join(b, "row", "full_outer"), blocks)


def export_locations(df: DataFrame, id_col: str, urls: Column, id_pattern: str) -> DataFrame:
    """One row per (number of the id, url); records whose id does not fit the pattern are left out."""
    number = F.nullif(F.regexp_extract(F.col(id_col), id_pattern, 1), F.lit(""))
    return df.select(number.alias("id"), urls.alias("urls")).where("id is not null").select("id", F.explode("urls").alias("url"))


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", "true").csv(path)
    return path


def pivot_scores(df: DataFrame, key: str, name: str, score: str, names: list) -> DataFrame:
    """One row per key, one column per listed name with its top score."""
    return df.groupBy(key).agg(*[F.max(F.when(F.col(name) == F.lit(n), F.col(score))).alias(f"{score}_{n}") for n in names])
