"""Predicates on leaves.

A predicate is a boolean Column that is NULL or false where a record does not match. Negation is a
statement on the record: true where no value matches, so also where the value is missing. Only
``not_`` needs to say so; plain comparisons stay bare and reach the parquet scan.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bibspark.functions.paths import Leaf, leaf
from bibspark.functions.text import normal_phrase, tokens

MAX_LIST = 100

# fixed values: continent names with their Wikidata ids
CONTINENTS = {
    "africa": "Q15",
    "antarctica": "Q51",
    "asia": "Q48",
    "europe": "Q46",
    "north_america": "Q49",
    "oceania": "Q55643",
    "south_america": "Q18",
}

# fixed values: the versions each best-open-version class takes in
OPEN_VERSIONS = {
    "any": ["submittedVersion", "acceptedVersion", "publishedVersion"],
    "acceptedorpublished": ["acceptedVersion", "publishedVersion"],
    "published": ["publishedVersion"],
}


def matches(pred: Column) -> Column:
    """A predicate as plain true or false."""
    return F.coalesce(pred, F.lit(False))


def not_(pred: Column) -> Column:
    return ~matches(pred)


def any_of(*preds: Column) -> Column:
    return reduce(lambda a, b: a | b, preds)


def all_of(*preds: Column) -> Column:
    return reduce(lambda a, b: a & b, preds)


def _is_text(at: Leaf) -> bool:
    return isinstance(at.dtype, T.StringType)


def eq(at: Leaf, v, exact: bool = False) -> Column:
    """Equality; text ignores case unless ``exact`` (for columns folded at load, where the
    comparison can be pushed down)."""
    if exact or not _is_text(at):
        return F.array_contains(at.col, F.lit(v)) if at.many else at.col == F.lit(v)
    return at.any(lambda x: F.lower(x) == F.lit(str(v).lower()))


def is_in(at: Leaf, vs, exact: bool = False, max_values: int = MAX_LIST) -> Column:
    """One of a short list. Longer lists belong in a DataFrame, see ``in_frame``."""
    vs = list(vs)
    if not 1 <= len(vs) <= max_values:
        raise ValueError(f"a list holds 1 to {max_values} values; use in_frame for more")
    if exact or not _is_text(at):
        return at.any(lambda x: x.isin(vs))
    return at.any(lambda x: F.lower(x).isin([str(v).lower() for v in vs]))


def none_of(at: Leaf, vs, **kw) -> Column:
    return not_(is_in(at, vs, **kw))


def all_in(at: Leaf, vs, exact: bool = False) -> Column:
    """Every listed value occurs in the record."""
    return all_of(*[eq(at, v, exact) for v in vs])


def in_frame(df: DataFrame, path: str, listed: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows whose scalar ``path`` is in the one column of ``listed``, whatever its length; with
    ``left_anti`` the others, missing values among them."""
    other = listed.select(F.col(listed.columns[0]).alias("__v"))
    return df.join(other, leaf(df, path).col == F.col("__v"), how)


def not_null(at: Leaf) -> Column:
    return F.exists(at.col, lambda x: x.isNotNull()) if at.many else at.col.isNotNull()


def is_null(at: Leaf) -> Column:
    return not_(not_null(at))


def has(at: Leaf, wanted: bool = True) -> Column:
    return not_null(at) if wanted else is_null(at)


_COMPARE = {
    "=": lambda x, n: x == n,
    "<": lambda x, n: x < n,
    "<=": lambda x, n: x <= n,
    ">": lambda x, n: x > n,
    ">=": lambda x, n: x >= n,
}


def cmp(at: Leaf, op: str, n) -> Column:
    if op == "!=":
        return not_(cmp(at, "=", n))
    return at.any(lambda x: _COMPARE[op](x, F.lit(n)))


def between(at: Leaf, lo=None, hi=None, negate: bool = False) -> Column:
    """Closed range; either end may be open."""
    if lo is None and hi is None:
        raise ValueError("a range needs at least one end")

    def test(x):
        ends = ([x >= F.lit(lo)] if lo is not None else []) + ([x <= F.lit(hi)] if hi is not None else [])
        return all_of(*ends)

    return not_(at.any(test)) if negate else at.any(test)


def date_cmp(at: Leaf, op: str, day: str) -> Column:
    """Compare by calendar day, ``day`` as YYYY-MM-DD. The column itself stays uncast: the day becomes
    a half-open span of instants, so that the comparison can be pushed down."""
    start = F.lit(day).cast("date")
    if isinstance(at.dtype, T.DateType):
        return cmp(at, op, start)
    first = start.cast(at.dtype)
    after = F.date_add(start, 1).cast(at.dtype)
    spans = {
        "=": lambda x: (x >= first) & (x < after),
        "<": lambda x: x < first,
        "<=": lambda x: x < after,
        ">": lambda x: x >= after,
        ">=": lambda x: x >= first,
    }
    return at.any(spans[op])


def ts_cmp(at: Leaf, op: str, moment: str) -> Column:
    """Compare with an ISO-8601 instant; a zone in it is turned to UTC."""
    stamp = F.try_to_timestamp(F.lit(moment))
    if isinstance(at.dtype, T.TimestampNTZType):
        zone = F.current_timezone()
        stamp = F.convert_timezone(zone, F.lit("UTC"), stamp.cast("timestamp_ntz"))
    return cmp(at, op, stamp)


def is_bool(at: Leaf, wanted: bool) -> Column:
    return cmp(at, "=", wanted)


def any_where(df: DataFrame, array: str, tests: dict, correlated: bool = False) -> Column:
    """Conditions on several fields of an array of structs. Uncorrelated: each may hold on another
    element. Correlated: one element must pass them all."""
    if correlated:
        return F.exists(leaf(df, array).col, lambda e: all_of(*[t(e.getField(f)) for f, t in tests.items()]))
    return all_of(*[leaf(df, f"{array}.{f}").any(t) for f, t in tests.items()])


def only_id(present: Leaf, absent: list[Leaf], wanted: bool = True) -> Column:
    """The one id present and all others absent. ``wanted=False`` asks for any of the others, which
    is not the complement: a record with no id at all is in neither."""
    if wanted:
        return all_of(not_null(present), *[is_null(a) for a in absent])
    return any_of(*[not_null(a) for a in absent])


def starts_with(at: Leaf, s: str, min_len: int = 3, exact: bool = False) -> Column:
    if len(s) < min_len:
        raise ValueError(f"a prefix needs {min_len} characters or more")
    if exact:
        return at.any(lambda x: x.startswith(s))
    return at.any(lambda x: F.lower(x).startswith(s.lower()))


def starts_any(at: Leaf, prefixes) -> Column:
    return at.any(lambda x: any_of(*[x.startswith(p) for p in prefixes]))


# most codes that travel as one value
MAX_CODES = 100_000


def code_set(codes: DataFrame, dtype=None) -> Column:
    """The first column of a small table as one array: a scalar subquery, evaluated once. Its size is checked."""
    got = F.collect_set(F.col(codes.columns[0]).cast(dtype) if dtype is not None else F.col(codes.columns[0]))
    checked = F.when(F.size(got) <= MAX_CODES, got).otherwise(F.raise_error(F.lit(f"more than {MAX_CODES} codes; join the table instead")))
    return codes.agg(checked.alias("codes")).scalar()


def in_codes(at: Leaf, codes: DataFrame) -> Column:
    """Some value of a path, through arrays too, is in the first column of a table. Rows are not multiplied, so negation by ``not_`` stays
    about the record: true where no value is in it, missing ones included."""
    return F.arrays_overlap(at.values, code_set(codes, at.dtype))


def in_region(df: DataFrame, path: str, region: DataFrame, wanted: bool = True) -> DataFrame:
    """Rows with a code, or with none, in the one column of a region table."""
    pred = in_codes(leaf(df, path), region)
    return df.where(pred if wanted else not_(pred))


def continent_codes(table: DataFrame, continent: str) -> DataFrame:
    """Codes of a continent, given by name or Wikidata id, from a ``(continent, code)`` table."""
    name = continent.strip().lower().replace(" ", "_")
    by_id = {q.lower(): n for n, q in CONTINENTS.items()}
    name = by_id.get(name, name)
    known = F.lower(F.replace(F.col("continent"), F.lit(" "), F.lit("_")))
    return table.where(known == name).select("code")


def in_continent(df: DataFrame, path: str, table: DataFrame, continent: str, wanted: bool = True) -> DataFrame:
    return in_region(df, path, continent_codes(table, continent), wanted)


def either(one: Leaf, two: Leaf, test=None) -> Column:
    """A condition on two paths to the same kind of entity. Without ``test``: known on *both*.
    Negation by ``not_`` needs neither to match; ``neither_known`` is the null form."""
    if test is None:
        return not_null(one) & not_null(two)
    return matches(one.any(test)) | matches(two.any(test))


def neither_known(one: Leaf, two: Leaf) -> Column:
    return is_null(one) & is_null(two)


def typed_ref(at: Leaf, kind_at: Leaf, kind: str, v=None, known: bool | None = None) -> Column:
    """A reference together with its kind, e.g. a source that is a repository. ``known`` asks for
    presence (or absence) of the reference in place of a value."""
    ref = eq(at, v) if known is None else has(at, known)
    return ref & eq(kind_at, kind, exact=True)


def in_lineage(lineage: Leaf, entity, letter: str | None = None) -> Column:
    """The entity or any descendant; ``letter`` checks the kind of id given."""
    if letter and not str(entity).upper().startswith(letter.upper()):
        raise ValueError(f"needs an id that starts with {letter}")
    return eq(lineage, entity, exact=True)


def open_version(at: Leaf, cls: str, classes: dict | None = None) -> Column:
    classes = classes or OPEN_VERSIONS
    if cls.lower() not in classes:
        raise ValueError(f"class must be one of {', '.join(classes)}")
    return is_in(at, classes[cls.lower()], exact=True)


def version(at: Leaf, v: str | None) -> Column:
    """A version by name in any case; None stands for records with none known."""
    return is_null(at) if v is None else eq(at, v)


def hide(df: DataFrame, path: str, blocked) -> DataFrame:
    """Drop a short, configured list of ids from the output."""
    return df.where(none_of(leaf(df, path), blocked, exact=True))


def without_blocked(vs, blocked) -> list:
    """A list of wanted ids less the blocked ones."""
    gone = set(blocked)
    return [v for v in vs if v not in gone]


def contains(at: Leaf, s: str, negate: bool = False) -> Column:
    """Substring in any case; the text is literal, with no wildcards."""
    found = at.any(lambda x: F.lower(x).contains(s.lower()))
    return not_(found) if negate else found


def has_any(at: Leaf, vs) -> Column:
    return F.arrays_overlap(at.values, F.array(*[F.lit(v) for v in vs]).cast(T.ArrayType(at.dtype)))


def elem_contains(at: Leaf, s: str) -> Column:
    return contains(at, s)


def json_cmp(col: Column, path: str, op: str, v, dtype: str) -> Column:
    """Compare a typed value inside JSON text; NULL where the path or the cast fails."""
    raw = F.try_parse_json(col)
    return _COMPARE[op](F.try_variant_get(raw, path, dtype), F.lit(v))


def any_leaf(df: DataFrame, v, under: list[str] | None = None) -> Column:
    """Some leaf of the record's nested tree equals the value, exactly."""

    def paths(dtype, prefix):
        while isinstance(dtype, T.ArrayType):
            dtype = dtype.elementType
        if isinstance(dtype, T.StructType):
            return [p for f in dtype for p in paths(f.dataType, prefix + [f.name])]
        return [".".join(prefix)]

    found = [p for f in df.schema if not under or f.name in under for p in paths(f.dataType, [f.name])]
    leaves = [leaf(df, p) for p in found]
    like = [at for at in leaves if _is_text(at) == isinstance(v, str)]
    return any_of(*[matches(eq(at, v, exact=True)) for at in like])


def in_label(df: DataFrame, pairs: DataFrame, key: str, item: str, label: DataFrame, mode: str = "any") -> DataFrame:
    """Rows of ``df`` tied, through ``pairs(key, item)``, to any or every item of a saved list."""
    listed = label.select(F.col(label.columns[0]).alias(item))
    hits = pairs.join(listed, item, "left_semi")
    if mode == "any":
        return df.join(hits.select(key), key, "left_semi")
    size = listed.agg(F.count_distinct(item).alias("__size"))
    full = hits.groupBy(key).agg(F.count_distinct(item).alias("__n")).join(F.broadcast(size), F.col("__n") == F.col("__size"))
    return df.join(full.select(key), key, "left_semi")


def phrase(at: Leaf, q: str) -> Column:
    """The words of the query stand in a row in some value."""
    whole = F.concat(normal_phrase(F.lit(q)), F.lit(" "))
    return at.any(lambda x: F.concat(normal_phrase(x), F.lit(" ")).contains(whole))


def all_words(at: Leaf, q: str) -> Column:
    """Some value has all words of the query."""
    want = tokens(F.lit(q))
    return at.any(lambda x: F.size(F.array_except(want, tokens(x))) == 0)


OPS = {
    "phrase": phrase,
    "search": all_words,
    "is": eq,
    "is not": lambda at, v: not_(eq(at, v)),
    "in": is_in,
    "not in": none_of,
    "contains": contains,
    "does not contain": lambda at, v: contains(at, v, negate=True),
    "between": lambda at, v: between(at, *v),
    "starts with": starts_with,
    "known": lambda at, v: has(at, v),
    **{op: (lambda at, v, op=op: cmp(at, op, v)) for op in ("=", "!=", "<", "<=", ">", ">=")},
}


def tree(df: DataFrame, node: dict) -> Column:
    """Fold a nested ``{"join": "and"|"or", "filters": [...]}`` tree with leaves
    ``{"field", "op", "value"}`` into one predicate. ``"not": True`` negates a node."""
    if "filters" in node:
        parts = [tree(df, f) for f in node["filters"]]
        pred = all_of(*parts) if node.get("join", "and") == "and" else any_of(*parts)
    else:
        pred = OPS[node.get("op", "is")](leaf(df, node["field"]), node.get("value"))
    return not_(pred) if node.get("not") else pred


def where(df: DataFrame, node: dict) -> DataFrame:
    return df.where(tree(df, node))
