"""Connected components of a graph too large for one machine."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bibspark.llm.common import checkpointed


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); the root is the component's smallest node.

    Large-star and small-star rounds: each node links its neighbours to the smallest it knows, first the
    larger ones, then the smaller ones, until each component is a star. Minima are reduced before the
    shuffle, and adaptive execution splits hub nodes in the joins. Rounds are cut by checkpoints."""
    edges = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = checkpointed(edges)
    seen = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(joined.select("a", F.col("m").alias("b")))
        edges = checkpointed(small.distinct())
        # xor of hashes tells whether the set of edges has changed
        state = tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())
        if state == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select("b", "b").distinct())
        seen = state
