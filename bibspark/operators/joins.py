"""Joins over entity, bridge and citation tables.

Bridges are tested with semi and anti joins, which never multiply rows. No side is forced into a
broadcast: the optimizer does that below its own size limit, and adaptive execution splits hot keys.
"""

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bibspark.session import checkpointed, local_frame, stored


def entity_works(entity: DataFrame, bridge: DataFrame, works: DataFrame, entity_on: tuple[str, str], work_on: tuple[str, str]) -> DataFrame:
    """Entity with bridge with works, inner; each ``on`` is (column, bridge column)."""
    first = entity.join(bridge, F.col(entity_on[0]) == F.col(entity_on[1]))
    return first.join(works, F.col(work_on[0]) == F.col(work_on[1]))


def left_attach(df: DataFrame, dim: DataFrame, left_key: str, right_key: str) -> DataFrame:
    return df.join(dim, F.col(left_key) == F.col(right_key), "left")


def by_repetition(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame | None]:
    """The rows whose key stands once, and those whose key repeats, if there are any; null is a key like others. Only keys are counted
    for it, so rows that stand alone need not move to meet their group."""
    counts = df.select(F.col(key).alias("__key")).groupBy("__key").agg(F.count("*").alias("__n"))
    again = stored(counts.where("__n > 1").select("__key"), "again")
    if again.isEmpty():
        return df, None
    same = F.col(key).eqNullSafe(F.col("__key"))
    return df.join(again, same, "left_anti"), df.join(again, same, "left_semi")


def co_members(bridge: DataFrame, member: str, work: str, x) -> DataFrame:
    """Members that share a work with ``x``, with the number of shared works; ``x`` itself left out."""
    own = bridge.where(F.col(member) == F.lit(x)).select(work).distinct()
    shared = bridge.where(F.col(member) != F.lit(x)).join(own, work, "left_semi")
    return shared.groupBy(member).agg(F.count_distinct(work).alias("shared"))


def exists_in(df: DataFrame, bridge: DataFrame, key: str, bridge_key: str, pred: Column | None = None) -> DataFrame:
    rows = bridge if pred is None else bridge.where(pred)
    return df.join(rows.select(F.col(bridge_key).alias(key)), key, "left_semi")


def not_in(df: DataFrame, bridge: DataFrame, key: str, bridge_key: str, pred: Column | None = None) -> DataFrame:
    rows = bridge if pred is None else bridge.where(pred)
    return df.join(rows.select(F.col(bridge_key).alias(key)), key, "left_anti")


def with_names(groups: DataFrame, dims: list[tuple[DataFrame, str, str]], default: str | None = None) -> DataFrame:
    """Add ``key_display_name`` by key; several dimensions are looked up as one."""
    parts = [d.select(F.col(k).cast("string").alias("__key"), F.col(n).alias("key_display_name")) for d, k, n in dims]
    names = reduce(DataFrame.unionByName, parts)
    out = groups.join(names, F.col("key").cast("string") == F.col("__key"), "left").drop("__key")
    return out if default is None else out.fillna({"key_display_name": default})


def cites(works: DataFrame, edges: DataFrame, target, key: str = "id") -> DataFrame:
    """Works that cite the target (edges are ``citing, cited``)."""
    return exists_in(works, edges, key, "citing", F.col("cited") == F.lit(target))


def cited_by(works: DataFrame, edges: DataFrame, source, key: str = "id") -> DataFrame:
    """Works that the source cites."""
    return exists_in(works, edges, key, "cited", F.col("citing") == F.lit(source))


def related_to(works: DataFrame, related: DataFrame, source, key: str = "id") -> DataFrame:
    """Works listed as related to the source (``related`` is ``id, related_id``)."""
    return exists_in(works, related, key, "related_id", F.col("id") == F.lit(source))


def hydrate(ranked: DataFrame, df: DataFrame, key: str) -> DataFrame:
    """Full records for a short ranked list, best first; ids without a record fall out."""
    return ranked.join(df, key).orderBy(F.desc("score"), key)


def multi_get(df: DataFrame, key: str, ids: list, max_ids: int = 100) -> DataFrame:
    """Records for a short list of ids in the order asked, with NULLs for ids that are absent."""
    if not 1 <= len(ids) <= max_ids:
        raise ValueError(f"ask for 1 to {max_ids} ids")
    names = [str(i) for i in ids]
    asked = local_frame(df.sparkSession, position=pa.array(range(len(names)), pa.int32()), asked=pa.array(names))
    # ids of the column's own type reach the scan
    hit = df.where(F.col(key).isin([F.lit(n).try_cast(df.schema[key].dataType) for n in names]))
    return asked.join(hit, F.col("asked") == F.col(key).cast("string"), "left").orderBy("position")


def resolve_merges(merged: DataFrame) -> DataFrame:
    """Follow ``(id, merge_into_id)`` chains to their end. Each round doubles the distance covered, and
    a finite chain with open ids settles some in every round; so once their number stands still, the
    open ids lie on or lead into cycles. These have no end and are left out."""
    step = merged.select("id", F.col("merge_into_id").alias("to")).distinct()
    open_before = None
    while True:
        ahead = step.select(F.col("id").alias("to"), F.col("to").alias("next"))
        moved = step.join(ahead, "to", "left").select("id", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("open"))
        moved = checkpointed(moved)
        step = moved.select("id", "to")
        open_now = moved.where("open").count()
        if open_now in (0, open_before):
            break
        open_before = open_now
    ends = step.join(merged.select(F.col("id").alias("to")), "to", "left_anti")
    return ends.select("id", F.col("to").alias("merge_into_id"))


def lookup(df: DataFrame, key: str, asked: DataFrame, norm, merged: DataFrame | None = None) -> DataFrame:
    """Records by any spelling of their id: ``asked`` has one column ``asked``, ``norm`` gives the bare
    id. Merged ids lead to the record they became."""
    wanted = asked.select("asked", norm(F.col("asked")).alias("__id"))
    if merged is not None:
        ends = resolve_merges(merged).withColumnRenamed("id", "__id")
        wanted = wanted.join(ends, "__id", "left").select("asked", F.coalesce("merge_into_id", "__id").alias("__id"))
    return wanted.join(df.withColumn("__id", norm(F.col(key).cast("string"))), "__id", "left").drop("__id")


def present_in(ids: DataFrame, key: str, tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per table: how many of the ids it holds, and how many it lacks."""

    def row(name, df, col):
        known = df.select(F.col(col).alias(key), F.lit(1).alias("__hit")).distinct()
        both = ids.join(known, key, "left")
        return both.agg(F.lit(name).alias("table"), F.count("__hit").alias("present"), F.count_if(F.col("__hit").isNull()).alias("absent"))

    return reduce(DataFrame.unionByName, [row(n, df, c) for n, (df, c) in tables.items()])
