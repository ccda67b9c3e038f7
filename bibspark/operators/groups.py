"""Facet counts and metrics. Every operator counts with map-side combine, and normalises keys before it
groups, so that hot keys shrink before they move."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bibspark.functions.paths import Leaf, leaf
from bibspark.operators.joins import with_names
from bibspark.operators.predicates import MAX_CODES, has, in_codes, is_null, matches, not_, where
from bibspark.operators.quantiles import exact_quantiles

MAX_GROUPS = 200

# fixed values: statuses counted as open, and statuses whose charge counts as paid
OPEN_STATUSES = ("gold", "hybrid", "green")
PAID_STATUSES = ("gold", "hybrid")

# fixed values: labels of the missing group
UNKNOWN = "unknown"
UNKNOWN_NUMBER = "-111"


def _bound(df: DataFrame, at) -> Leaf:
    return at if isinstance(at, Leaf) else leaf(df, at)


def facet(df: DataFrame, at: str | Leaf, unknown: str | None = None, name: str = "key") -> DataFrame:
    """One row per record and distinct value, as ``key``; records without a value give ``unknown`` if
    that is named, else nothing."""
    at = _bound(df, at)
    if not at.many:
        key = at.col if unknown is None else F.coalesce(at.col.cast("string"), F.lit(unknown))
        return df.select(key.alias(name)).where(F.col(name).isNotNull())
    if unknown is None:
        return df.select(F.explode(at.distinct).alias(name))
    return df.select(F.explode_outer(at.distinct).alias(name)).select(F.coalesce(F.col(name).cast("string"), F.lit(unknown)).alias(name))


def order_groups(groups: DataFrame, sort: str = "count", desc: bool = True) -> DataFrame:
    first = F.col(sort).desc() if desc else F.col(sort).asc()
    return groups.orderBy(first, *([] if sort == "key" else [F.col("key").asc()]))


def all_groups(df: DataFrame, at: str | Leaf, unknown: str | None = None) -> DataFrame:
    """``(key, count)`` of records per distinct value, unordered and whole."""
    return facet(df, at, unknown).groupBy("key").agg(F.count("*").alias("count"))


def group_count(df: DataFrame, at: str | Leaf, n: int = MAX_GROUPS, unknown: str | None = None, sort: str = "count", desc: bool = True) -> DataFrame:
    """The first ``n`` groups by count or key."""
    return order_groups(all_groups(df, at, unknown), sort, desc).limit(n)


def group_classes(df: DataFrame, classes: dict[str, Column]) -> DataFrame:
    """Counts of classes that may overlap, in one pass; zeros are kept."""
    names = list(classes)
    one = df.agg(*[F.count_if(matches(p)).alias(f"c{i}") for i, p in enumerate(classes.values())])
    return one.select(F.inline(F.array(*[F.struct(F.lit(n).alias("key"), F.col(f"c{i}").alias("count")) for i, n in enumerate(names)])))


def group_flag(df: DataFrame, yes: Column, no: Column) -> DataFrame:
    """Two counts by two predicates, which need not part the records."""
    return group_classes(df, {"true": yes, "false": no})


def group_presence(df: DataFrame, at: str | Leaf) -> DataFrame:
    at = _bound(df, at)
    return group_flag(df, has(at), is_null(at))


def lookup_map(table: DataFrame, key: str, name: str) -> Column:
    """A small table as one map: a scalar subquery, evaluated once. Its size is checked."""
    got = F.collect_set(F.struct(key, name))
    checked = F.when(F.size(got) <= MAX_CODES, got).otherwise(F.raise_error(F.lit(f"more than {MAX_CODES} codes; join the table instead")))
    return table.where(F.col(key).isNotNull()).agg(F.map_from_entries(checked).alias("names")).scalar()


def group_continent(df: DataFrame, at: str | Leaf, table: DataFrame, unknown: bool = True) -> DataFrame:
    """Records per continent, each counted once for each; all continents are kept, and records with no
    code form the unknown group. The (continent, code) table becomes a map, so nothing is joined."""
    at = _bound(df, at)
    rows = df.select(at.values.alias("codes"), lookup_map(table, "code", "continent").alias("names"))
    places = F.array_distinct(F.array_compact(F.transform("codes", lambda c: F.try_element_at("names", c))))
    marked = F.when(F.size("codes") == 0, F.array(F.lit(UNKNOWN))).otherwise(places) if unknown else places
    counts = rows.select(F.explode(marked).alias("key")).groupBy("key").agg(F.count("*").alias("count"))
    domain = table.select(F.col("continent").alias("key")).distinct()
    return zero_fill(counts, domain, keep_others=True)


def zero_fill(groups: DataFrame, domain: DataFrame, n: int | None = None, keep_others: bool = True) -> DataFrame:
    """Add the known keys that have no records, with count 0; ``n`` stops at a page's length."""
    out = groups.join(domain.select("key"), "key", "full_outer" if keep_others else "right").fillna({"count": 0})
    return out if n is None else order_groups(out).limit(n)


def keep_prefix(groups: DataFrame, prefix: str, unknown: str = UNKNOWN) -> DataFrame:
    key = F.col("key").cast("string")
    return groups.where(key.startswith(prefix) | (key == unknown))


def require_name(groups: DataFrame, dim: DataFrame, key: str, name: str) -> DataFrame:
    """Groups whose key has a display name."""
    return with_names(groups, [(dim, key, name)]).where("key_display_name is not null")


def group_many(df: DataFrame, paths: list[str], n: int = MAX_GROUPS, unknown: str | None = None) -> DataFrame:
    """Several facets in one scan and one shuffle: ``(facet, key, count)``, the first ``n`` of each."""

    def cells(path):
        at = leaf(df, path)
        got = at.distinct.cast("array<string>")
        if unknown is not None:
            got = F.when(F.size(got) == 0, F.array(F.lit(unknown))).otherwise(got)
        return F.transform(got, lambda v: F.struct(F.lit(path).alias("facet"), v.alias("key")))

    rows = df.select(F.explode(F.concat(*[cells(p) for p in paths])).alias("c")).select("c.*")
    counts = rows.groupBy("facet", "key").agg(F.count("*").alias("count"))
    # the rank limit is applied on the map side too, so a facet of many keys stays spread out
    w = Window.partitionBy("facet").orderBy(F.desc("count"), "key")
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n).drop("rank")


def facet_search(groups: DataFrame, q: str, all_words: bool = False, col: str = "key_display_name") -> DataFrame:
    name = F.lower(F.col(col))
    words = q.lower().split() if all_words else [q.lower()]
    return groups.where(reduce(lambda a, b: a & b, [name.contains(w) for w in words]))


def year_window(q: str) -> tuple[int, int]:
    """First digits of a year as a span: 19 is 1900 to 1999."""
    if not q.isdigit() or len(q) > 4:
        return 1000, 3000
    if len(q) == 1 and q not in "12":
        return 1000, 3000
    scale = 10 ** (4 - len(q))
    return int(q) * scale, int(q) * scale + scale - 1


def facet_prefilter(df: DataFrame, at: str | Leaf, q: str, kind: str = "text", names: DataFrame | None = None) -> DataFrame:
    """Narrow the records before a facet search: by prefix, by first digits of a year, or by the names
    of coded values (``names`` is code, name)."""
    at = _bound(df, at)
    if kind == "year":
        lo, hi = year_window(q)
        return df.where(at.any(lambda x: x.between(lo, hi)))
    if kind == "name":
        return df.where(in_codes(at, names.where(F.upper(F.col(names.columns[1])).startswith(q.upper()))))
    return df.where(at.any(lambda x: F.lower(x).startswith(q.lower())))


def group_page(groups: DataFrame, after=None, n: int = MAX_GROUPS) -> DataFrame:
    """A page of groups in key order, after the last key of the page before."""
    rest = groups if after is None else groups.where(F.col("key") > F.lit(after))
    return rest.orderBy("key").limit(n)


def meta_sums(df: DataFrame, listed: str, paid: str, status: str, citations: str, paid_statuses=PAID_STATUSES) -> DataFrame:
    """Sums of list charges, of paid charges where the status means a charge, and of citations."""
    return df.agg(
        F.sum(listed).alias("apc_list_sum"),
        F.sum(F.when(F.col(status).isin(*paid_statuses), F.col(paid))).alias("apc_paid_sum"),
        F.sum(citations).alias("cited_by_count_sum"),
    )


def stats(df: DataFrame, cols: list[str], pcts=(0.25, 0.5, 0.75), exact: bool = False) -> DataFrame:
    """Per column: percentiles cut to whole numbers, and the sum."""
    found = exact_quantiles(df, cols, list(pcts)) if exact else None
    aggs = []
    for i, c in enumerate(cols):
        aggs.append(F.sum(F.col(c).cast("double")).alias(f"s{i}"))
        if not exact:
            aggs.append(F.percentile_approx(c, [float(p) for p in pcts]).alias(f"q{i}"))
    one = df.agg(*aggs)

    def row(i, c):
        at = [F.lit(found[c, p]) if exact else F.col(f"q{i}")[j] for j, p in enumerate(pcts)]
        cells = [v.cast("bigint").alias(f"p{round(p * 100)}") for v, p in zip(at, pcts, strict=True)]
        return F.struct(F.lit(c).alias("column"), *cells, F.col(f"s{i}").alias("sum"))

    return one.select(F.inline(F.array(*[row(i, c) for i, c in enumerate(cols)])))


def histogram(df: DataFrame, col: str, interval: float = 500, min_count: int = 15) -> DataFrame:
    """Counts per fixed-width bin, named by its lower end; ``min_count=0`` also shows the empty bins
    between the first and the last."""
    bins = df.where(F.col(col).isNotNull()).groupBy(F.floor(F.col(col) / interval).alias("bin")).agg(F.count("*").alias("count"))
    if min_count:
        bins = bins.where(F.col("count") >= min_count)
    else:
        span = bins.agg(F.min("bin").alias("a"), F.max("bin").alias("b")).where("a is not null")
        bins = span.select(F.explode(F.sequence("a", "b")).alias("bin")).join(bins, "bin", "left").fillna({"count": 0})
    return bins.select((F.col("bin") * interval).alias("key"), "count")


# metrics over relations


def measures(work: str, citations: str | None = None, impact: str | None = None, status: str | None = None, open_statuses=OPEN_STATUSES) -> list[Column]:
    """The metric columns: works, citations, mean impact and open share from 0 to 1."""
    out = [F.count(work).alias("works_count")]
    if citations:
        out.append(F.sum(citations).alias("citations_sum"))
    if impact:
        out.append(F.avg(impact).alias("impact_mean"))
    if status:
        out.append((F.count_if(F.col(status).isin(*open_statuses)) / F.count(work)).alias("open_share"))
    return out


def metrics(pairs: DataFrame, entity, work: str, cols: list[str], aggs: list[Column]) -> DataFrame:
    """Metrics per entity over its distinct works: a work counts once however many rows tie them. ``cols``
    are the columns of the work that the metrics read."""
    keys = [entity] if isinstance(entity, str) else list(entity)
    return pairs.select(*keys, work, *cols).distinct().groupBy(*keys).agg(*aggs)


def having(rows: DataFrame, node: dict) -> DataFrame:
    """Metric rows that pass a filter tree on the metric columns."""
    return where(rows, node)


def summary(works: DataFrame, aggs: list[Column]) -> DataFrame:
    return works.agg(*aggs)


def underlying(pairs: DataFrame, entity: str, work: str) -> DataFrame:
    """The works behind an aggregate, with the number of its entities on each."""
    return pairs.groupBy(work).agg(F.count_distinct(entity).alias("entity_count"))


def distinct_entities(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*cols).distinct()


def cube(df: DataFrame, keys: list, sums: dict[str, Column]) -> DataFrame:
    """Additive cells per key combination; a boolean measure counts its records."""
    return df.groupBy(*keys).agg(F.count("*").alias("doc_count"), *[F.sum(c).alias(n) for n, c in sums.items()])


def merge_cubes(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    both = a.unionByName(b)
    return both.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in a.columns if c not in keys])


def type_rollup(df: DataFrame, at: str | Leaf, citations: str, prefix: str) -> DataFrame:
    """Citation sums per type, missing as unknown, for types by prefix."""
    at = _bound(df, at)
    key = F.coalesce(at.col, F.lit(UNKNOWN))
    return df.groupBy(key.alias("display_name")).agg(F.sum(citations).alias("cited_by_count")).where(F.col("display_name").startswith(prefix))


def country_rollup(df: DataFrame, code: str, citations: str, names: DataFrame, q: str, n: int = 10) -> DataFrame:
    """Countries with a word of their name that starts with q, by citations; ``names`` is (code, name)."""
    sums = df.groupBy(code).agg(F.sum(citations).alias("cited_by_count")).where(F.col("cited_by_count") > 0)
    words = F.split(F.upper("name"), " ")
    hits = names.where(F.exists(words, lambda w: w.startswith(q.upper())))
    out = sums.join(hits.withColumnRenamed("code", code), code)
    return out.select(F.col(code).alias("id"), F.col("name").alias("display_name"), "cited_by_count").orderBy(F.desc("cited_by_count"), "id").limit(n)


def entity_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [df.agg(F.lit(n).alias("entity"), F.count("*").alias("count")) for n, df in tables.items()])


def coverage(df: DataFrame, year: Column, pred: Column) -> DataFrame:
    """Per year: records with the feature, and all."""
    return df.groupBy(year.alias("year")).agg(F.count_if(matches(pred)).alias("with_feature"), F.count("*").alias("total"))


def filter_counts(df: DataFrame, filters: list[dict]) -> DataFrame:
    """For each value of each filter, the records that pass it together with all other filters, and the
    count of the whole query; one scan. A filter is ``{"field", "values": {label: predicate}, "negate"}``.
    The values of a negated list have no count of their own and show 0."""

    def whole(f):
        some = reduce(lambda a, b: a | b, [matches(p) for p in f["values"].values()])
        return not_(some) if f.get("negate") else some

    alls = [whole(f) for f in filters]
    query = reduce(lambda a, b: a & b, alls)
    classes = {("", "all"): query}
    for i, f in enumerate(filters):
        rest = [p for j, p in enumerate(alls) if j != i]
        for label, pred in f["values"].items():
            if len(f["values"]) == 1:
                one = query
            else:
                one = F.lit(False) if f.get("negate") else reduce(lambda a, b: a & b, [*rest, matches(pred)])
            classes[f["field"], str(label)] = one
    one = df.agg(*[F.count_if(p).alias(f"c{i}") for i, p in enumerate(classes.values())])
    cells = [F.struct(F.lit(f).alias("field"), F.lit(v).alias("value"), F.col(f"c{i}").alias("count")) for i, (f, v) in enumerate(classes)]
    return one.select(F.inline(F.array(*cells)))
