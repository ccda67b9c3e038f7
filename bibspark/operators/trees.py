"""Hierarchies as parent edges: closure, lineage, counts of descendants, parents one level up."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bibspark.session import checkpointed


def closure(edges: DataFrame) -> DataFrame:
    """(ancestor, node) over ``child, parent`` edges, each pair once. Every round joins the pairs to
    themselves, which doubles the distance covered; the pairs are a finite set, so cycles end too. Each
    round is cut through the checkpoint folder."""
    pairs = checkpointed(edges.select(F.col("parent").alias("ancestor"), F.col("child").alias("node")).distinct())
    size = pairs.count()
    while True:
        above, below = pairs.toDF("ancestor", "via"), pairs.toDF("via", "node")
        grown = checkpointed(pairs.unionByName(above.join(below, "via").select("ancestor", "node")).distinct())
        grown_size = grown.count()
        if grown_size == size:
            return grown
        pairs, size = grown, grown_size


def descendants(edges: DataFrame) -> DataFrame:
    """Number of distinct descendants of each node that has any."""
    pairs = closure(edges).where("ancestor <> node")
    return pairs.groupBy(F.col("ancestor").alias("node")).agg(F.count("*").alias("descendants"))


def lineage(edges: DataFrame, exclude: DataFrame | None = None) -> DataFrame:
    """(node, ancestor) with each node in its own lineage; excluded ancestors are left out, but paths
    through them are followed."""
    up = closure(edges).where("ancestor <> node").select("node", "ancestor")
    nodes = edges.select(F.col("child").alias("node")).unionByName(edges.select(F.col("parent").alias("node"))).distinct()
    out = up.unionByName(nodes.select("node", F.col("node").alias("ancestor")))
    if exclude is not None:
        gone = exclude.select(F.col(exclude.columns[0]).alias("ancestor"))
        out = out.join(gone, "ancestor", "left_anti").select("node", "ancestor")
    return out


def parents(ancestors: Column, level: Column, field: str = "id") -> Column:
    """The ancestors one level up, as a comma list in order; NULL where there are none."""
    up = F.array_sort(F.transform(F.filter(ancestors, lambda a: a["level"] == level - 1), lambda a: a[field].cast("string")))
    return F.nullif(F.array_join(up, ","), F.lit(""))
