"""Vector columns inside the JVM, and the re-ranking curves."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: saturation pivot, highest boost and similarity floor of the citation re-rank
PIVOT, MAX_BOOST, FLOOR = 100, 0.5, 0.5


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (norm(a) * norm(b))


def unit(similarity: Column) -> Column:
    """Cosine on the scale 0 to 1."""
    return (1 + similarity) / 2


def citation_rerank(similarity: Column, cited: Column, pivot=PIVOT, boost=MAX_BOOST, floor=FLOOR) -> Column:
    """Similarity raised by citations that saturate, the more the further it lies above the floor."""
    signal = F.when(cited > 0, cited / (cited + pivot)).otherwise(0.0)
    strength = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (similarity - floor) / (1.0 - floor)))
    return similarity * (1.0 + boost * strength * signal)


def log_rerank(similarity: Column, cited: Column) -> Column:
    return similarity * F.when(F.coalesce(cited, F.lit(0)) <= 1, 0.5).otherwise(1 + F.log(cited))
