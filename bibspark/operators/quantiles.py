"""Quantiles. The approximate form is one pass. The exact form narrows a value interval per target:
each pass is one partial aggregation whose result holds at most ``BINS`` rows per target, so neither a
task nor the driver ever meets all values."""

from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 1024


def approx_quantiles(df: DataFrame, col: str, pcts: list[float], accuracy: int = 10_000) -> DataFrame:
    return df.agg(F.percentile_approx(col, [float(p) for p in pcts], accuracy).alias("quantiles"))


def exact_quantiles(df: DataFrame, cols: list[str], pcts: list[float]) -> dict[tuple[str, float], float]:
    """Nearest-rank quantiles: the value at rank ceil(p * n), NULLs left out. Infinite values count at the
    ends, NaN above them all."""
    inf = float("inf")
    asked = {}
    for i, c in enumerate(cols):
        v = F.col(c).cast("double")
        finite = F.when((F.abs(v) < inf) & ~F.isnan(v), v)
        for name, e in (("n", F.count(finite)), ("lo", F.min(finite)), ("hi", F.max(finite)), ("below", F.count_if(v == -inf)), ("above", F.count_if(v == inf)), ("nan", F.count_if(F.isnan(v)))):
            asked[f"{name}_{i}"] = e
    ends = df.agg(*[e.alias(name) for name, e in asked.items()]).first()
    found, open_ = {}, {}
    for i, c in enumerate(cols):
        n, lo, hi, below, above, nan = (ends[f"{name}_{i}"] for name in ("n", "lo", "hi", "below", "above", "nan"))
        total = below + n + above + nan
        for p in pcts:
            rank = max(1, ceil(p * total))
            if total == 0:
                found[c, p] = None
            elif rank <= below:
                found[c, p] = -inf
            elif rank > below + n:
                found[c, p] = inf if rank <= below + n + above else float("nan")
            elif lo == hi:
                found[c, p] = lo
            else:
                open_[c, p] = (rank - below, lo, hi)
    while open_:
        targets = list(open_.items())
        cells = []
        for i, ((c, _), (_, lo, hi)) in enumerate(targets):
            v = F.col(c).cast("double")
            bin_ = F.least(F.lit(BINS - 1), F.floor((v / 2 - lo / 2) / (hi / 2 - lo / 2) * BINS)).cast("int")
            cells.append(F.when(v.between(lo, hi), F.struct(F.lit(i).alias("target"), bin_.alias("bin"), v.alias("v"))))
        rows = df.select(F.explode(F.array_compact(F.array(*cells))).alias("c")).select("c.*")
        bins = rows.groupBy("target", "bin").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        by_target = {}
        for r in bins.collect():
            by_target.setdefault(r.target, []).append((r.bin, r.n, r.lo, r.hi))
        for i, (name, (rank, _, _)) in enumerate(targets):
            for _, n, lo, hi in sorted(by_target[i]):
                if rank <= n:
                    break
                rank -= n
            if lo == hi:
                found[name] = lo
                del open_[name]
            else:
                open_[name] = (rank, lo, hi)
    return found
