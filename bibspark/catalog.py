"""Field catalogue and list queries.

Most fields follow from a table's schema: every leaf is a field, named by its path, and its type fixes
its kind. An entity adds what a schema cannot say: other names for a path, fields that test presence,
filters with a rule of their own, the default sort and the fields that search looks at.
"""

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bibspark.functions import ids
from bibspark.functions.paths import leaf
from bibspark.operators import groups, paging, project, search, searchtable
from bibspark.operators import predicates as P
from bibspark.session import local_frame, scratch


@dataclass(frozen=True)
class FieldDef:
    name: str
    path: str
    kind: str  # boolean, range, date, datetime, id or term


def kind_of(path: str, dtype: T.DataType) -> str:
    if isinstance(dtype, T.BooleanType):
        return "boolean"
    if isinstance(dtype, T.DateType):
        return "date"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return "datetime"
    if isinstance(dtype, T.NumericType):
        return "range"
    return "id" if path.split(".")[-1] in ("id", "lineage", "referenced_works", "related_works") else "term"


def fields_of(schema: T.StructType, prefix: str = "") -> dict[str, FieldDef]:
    """All leaves of a schema, through structs and arrays."""
    out = {}
    for f in schema:
        dtype, path = f.dataType, f"{prefix}{f.name}"
        while isinstance(dtype, T.ArrayType):
            dtype = dtype.elementType
        if isinstance(dtype, T.StructType):
            out |= fields_of(dtype, f"{path}.")
        else:
            out[path] = FieldDef(path, path, kind_of(path, dtype))
    return out


@dataclass(frozen=True)
class EntityDef:
    name: str
    key: str = "id"
    default_sort: tuple = ("-works_count", "id")
    search_sort: tuple = ("-score", "-works_count", "id")
    search_fields: tuple = ("display_name",)
    search_boosts: tuple | None = None
    citations: str | None = "cited_by_count"
    aliases: dict = field(default_factory=dict)
    presence: dict = field(default_factory=dict)
    special: dict[str, Callable[[DataFrame, object], Column]] = field(default_factory=dict)
    defaults: tuple = ()
    # how ids are stored: bare for "", else under this URL
    base: str = ""

    def field(self, df: DataFrame, name: str) -> FieldDef:
        path = self.aliases.get(name, name)
        at = leaf(df, path)
        return FieldDef(name, path, kind_of(path, at.dtype))

    def predicate(self, df: DataFrame, name: str, op: str, value=None) -> Column:
        """One filter: ``op`` is a key of ``predicates.OPS``, or "from" and "to" for dates."""
        if name in self.special:
            pred = self.special[name](df, value)
            return P.not_(pred) if op == "is not" else pred
        if name in self.presence:
            return P.has(leaf(df, self.presence[name]), bool(value))
        found = self.field(df, name)
        at = leaf(df, found.path)
        if op == "known":
            return P.has(at, value)
        if found.kind in ("date", "datetime"):
            op = {"from": ">=", "to": "<=", "is": "="}.get(op, op)
            compare = P.date_cmp if len(str(value)) == 10 else P.ts_cmp
            return compare(at, op, str(value))
        if found.kind == "id" and op in ("is", "is not", "in", "not in"):
            return self._id(at, op, value)
        return P.OPS[op](at, value)

    def _id(self, at, op: str, value) -> Column:
        """Ids in any spelling are turned into the stored one, by constants that reach the scan."""
        listed = list(value) if op in ("in", "not in") else [value]
        if len(listed) > P.MAX_LIST:
            raise ValueError(f"a list holds {P.MAX_LIST} values or fewer")
        keys = [F.coalesce(F.concat(F.lit(self.base), ids.norm_catalog(F.lit(str(v)))), F.lit(str(v))) for v in listed]
        pred = at.any(lambda x: reduce(lambda a, b: a | b, [x == k for k in keys]))
        return P.not_(pred) if op in ("is not", "not in") else pred

    def sort_keys(self, keys) -> list[str]:
        out = []
        for key in keys:
            sign, name = ("-", key[1:]) if key.startswith("-") else ("", key)
            out.append(sign + self.aliases.get(name, name))
        return out


def _open_with(versions):
    def test(df, wanted):
        pred = P.any_where(df, "locations", {"is_oa": lambda x: x, "version": lambda x: x.isin(versions)})
        return pred if wanted else P.not_(pred)

    return test


def _two_paths(one: str, two: str, fix: Callable = lambda v: v):
    def test(df, value):
        a, b = leaf(df, one), leaf(df, two)
        if value is None:
            return P.neither_known(a, b)
        return P.either(a, b, lambda x: F.lower(x) == F.lit(str(fix(value)).lower()))

    return test


def _of_kind(path: str, kind_path: str, kind: str):
    return lambda df, v: P.typed_ref(leaf(df, path), leaf(df, kind_path), kind, v)


def _lineage(path: str, letter: str):
    return lambda df, v: P.in_lineage(leaf(df, path), v, letter)


def _mag_only(df, wanted):
    return P.only_id(leaf(df, "ids.mag"), [leaf(df, f"ids.{k}") for k in ("pmid", "pmcid", "doi", "arxiv")], wanted)


# fixed values: names that stand for another path
WORK_ALIASES = {
    "author.id": "authorships.author.id",
    "author.orcid": "authorships.author.orcid",
    "cites": "referenced_works",
    "concept.id": "concepts.id",
    "doi": "ids.doi",
    "institution.id": "authorships.institutions.id",
    "institutions.id": "authorships.institutions.id",
    "is_corresponding": "authorships.is_corresponding",
    "is_oa": "open_access.is_oa",
    "mag": "ids.mag",
    "oa_status": "open_access.oa_status",
    "pmid": "ids.pmid",
    "pmcid": "ids.pmcid",
    "from_created_date": "created_date",
    "to_created_date": "created_date",
    "from_publication_date": "publication_date",
    "to_publication_date": "publication_date",
    "from_updated_date": "updated_date",
    "to_updated_date": "updated_date",
}

# fixed values: fields that are true where a path is present
WORK_PRESENCE = {
    "has_abstract": "abstract_inverted_index",
    "has_doi": "ids.doi",
    "has_embeddings": "vector_embedding",
    "has_orcid": "authorships.author.orcid",
    "has_pmid": "ids.pmid",
    "has_pmcid": "ids.pmcid",
    "has_references": "referenced_works",
    "has_pdf_url": "locations.pdf_url",
    "has_raw_affiliation_strings": "authorships.raw_affiliation_strings",
    "locations.source.has_issn": "locations.source.issn",
    "primary_location.source.has_issn": "primary_location.source.issn",
}

WORK_SPECIAL = {
    "has_oa_accepted_or_published_version": _open_with(["acceptedVersion", "publishedVersion"]),
    "has_oa_submitted_version": _open_with(["submittedVersion"]),
    "has_old_authors": lambda df, v: P.starts_any(leaf(df, "authorships.author.id"), ["A1", "A2", "A3", "A4"]),
    "mag_only": _mag_only,
    "best_open_version": lambda df, v: P.open_version(leaf(df, "locations.version"), v),
    "version": lambda df, v: P.version(leaf(df, "locations.version"), v),
    "doi_starts_with": lambda df, v: P.starts_with(leaf(df, "ids.doi"), v),
    "repository": _of_kind("locations.source.id", "locations.source.type", "repository"),
    "journal": _of_kind("primary_location.source.id", "primary_location.source.type", "journal"),
    "locations.source.host_institution_lineage": _lineage("locations.source.host_organization_lineage", "I"),
    "locations.source.publisher_lineage": _lineage("locations.source.host_organization_lineage", "P"),
    "primary_location.source.host_institution_lineage": _lineage("primary_location.source.host_organization_lineage", "I"),
    "primary_location.source.publisher_lineage": _lineage("primary_location.source.host_organization_lineage", "P"),
    **{
        f"authorships.institutions.{f}": _two_paths(f"authorships.institutions.{f}", f"institution_assertions.{f}")
        for f in ("id", "lineage", "ror", "country_code", "type")
    },
}

ENTITIES = {
    e.name: e
    for e in (
        EntityDef(
            "works",
            default_sort=("-cited_by_percentile_year.max", "-cited_by_count", "id"),
            search_sort=("-score", "publication_date", "id"),
            search_fields=("display_name", "abstract", "fulltext"),
            aliases=WORK_ALIASES,
            presence=WORK_PRESENCE,
            special=WORK_SPECIAL,
            defaults=(("is_xpac", "=", False),),
        ),
        EntityDef("authors", search_fields=("display_name", "display_name_alternatives"), presence={"has_orcid": "ids.orcid"}),
        EntityDef("sources", search_fields=("display_name", "alternate_titles", "abbreviated_title"), presence={"has_issn": "issn"}),
        EntityDef(
            "institutions",
            search_fields=("display_name", "display_name_alternatives", "display_name_acronyms"),
            search_boosts=(*search.BOOSTS[3][:2], search.ACRONYM_BOOST),
            presence={"has_ror": "ror"},
        ),
        EntityDef("funders", search_fields=("display_name", "alternate_titles", "description")),
        EntityDef("publishers", search_fields=("display_name", "alternate_titles")),
        EntityDef("concepts", search_fields=("display_name", "description"), presence={"has_wikidata": "wikidata"}),
        EntityDef("topics", search_fields=("display_name", "description", "keywords")),
        EntityDef(
            "awards",
            default_sort=("-funded_outputs_count", "id"),
            search_sort=("-score", "id"),
            search_fields=("display_name", "description"),
            citations=None,
        ),
        EntityDef("locations", key="native_id", default_sort=("work_id", "native_id")),
        *[
            EntityDef(n)
            for n in (
                "subfields", "fields", "domains", "continents", "countries", "institution-types", "keywords",
                "languages", "licenses", "oa-statuses", "sdgs", "source-types", "work-types",
            )
        ],
    )
}


def with_places(entity: EntityDef, paths: dict[str, str], south: DataFrame, continents: DataFrame) -> EntityDef:
    """The entity with filters by region. ``paths`` names the path of country codes behind each prefix, arrays or not; ``<prefix>.is_global_south``
    is true or false, ``<prefix>.continent`` a name or Wikidata id. ``south`` is a table of codes, ``continents`` of (continent, code)."""

    def flag(path):
        def test(df, wanted):
            pred = P.in_codes(leaf(df, path), south)
            return pred if wanted else P.not_(pred)

        return test

    def continent(path):
        return lambda df, name: P.in_codes(leaf(df, path), P.continent_codes(continents, name))

    more = {f"{p}.is_global_south": flag(path) for p, path in paths.items()} | {f"{p}.continent": continent(path) for p, path in paths.items()}
    return replace(entity, special=entity.special | more)


@dataclass(frozen=True)
class Spec:
    """A list query: filters are ``(name, op, value)`` and all hold; ``tree`` is a nested filter tree. ``search`` is a text, all of whose words a
    field must have, or one of ``{"phrase": text}``, ``{"near": text, "slop": n}``, ``{"tree": node}`` (see ``search.match_tree``), ``{"wildcards":
    patterns}``, ``{"fuzzy": word, "distance": n}``, ``{"span": (first, second, distance)}``."""

    filters: tuple = ()
    tree: dict | None = None
    search: str | dict | None = None
    group_by: str | None = None
    unknown: bool = False
    sort: tuple = ()
    sample: int | None = None
    seed: object = 0
    page: int = 1
    per_page: int | None = None  # 25 records or 200 groups
    after: tuple | None = None
    cursor: bool = False
    select: tuple = ()


# the public name of the score in a sort
RELEVANCE = "relevance_score"


def filtered(df: DataFrame, entity: EntityDef, spec: Spec) -> DataFrame:
    named = {f[0] for f in spec.filters}
    extra = [f for f in entity.defaults if f[0] not in named and f[0] in df.columns]
    preds = [entity.predicate(df, *f) for f in (*spec.filters, *extra)]
    if spec.tree:
        preds.append(P.tree(df, spec.tree))
    return df.where(P.all_of(*preds)) if preds else df


def search_table(df: DataFrame, entity: EntityDef, path: str | None = None) -> searchtable.SearchTable:
    """Store the search table of an entity's search fields, for many list queries."""
    fields = [f for f in entity.search_fields if f.split(".")[0] in df.columns]
    return searchtable.build(df, entity.key, fields, path or scratch(df.sparkSession, f"search-{entity.name}"))


def found_ids(df: DataFrame, entity: EntityDef, form: dict, table: searchtable.SearchTable) -> DataFrame:
    """(id): records with a field that matches a search form."""

    def asked(text):
        return local_frame(df.sparkSession, query_id=pa.array([0], pa.int32()), text=pa.array([text]))

    if "phrase" in form or "near" in form:
        found = searchtable.match_near(table, asked(form.get("phrase", form.get("near"))), form.get("slop", 0))
    elif "tree" in form:
        post = searchtable.word_rows(table, search.tree_words(form["tree"]))
        found = search.match_tree(df.select(F.col(entity.key).alias("id")), post, form["tree"])
    elif "wildcards" in form:
        found = searchtable.with_patterns(searchtable.add_lookups(table, "grams"), list(form["wildcards"]))
    elif "fuzzy" in form:
        word = local_frame(df.sparkSession, word=pa.array([form["fuzzy"]]))
        found = searchtable.with_words(table, searchtable.fuzzy_words(searchtable.add_lookups(table, "deletes"), word, form.get("distance", 2)))
    elif "span" in form:
        first, second, distance = form["span"]
        found = search.match_span(searchtable.word_rows(table, [*first.lower().split(), *second.lower().split()]), first, second, distance)
    else:
        raise ValueError(f"unknown search form {', '.join(form)}")
    return found.select("id").distinct()


def searched(rows: DataFrame, df: DataFrame, entity: EntityDef, text: str | dict, table: searchtable.SearchTable | None = None) -> DataFrame:
    """Those of ``rows``, some rows of ``df``, that match, with their score raised by citations. Scores come from the statistics of all of ``df``,
    whatever the filter left; a match of a search form counts 1."""
    fields = [f for f in entity.search_fields if f.split(".")[0] in df.columns]
    boosts = list(entity.search_boosts or search.BOOSTS[len(entity.search_fields)])[: len(fields)]
    table = table or search_table(df, entity)
    if isinstance(text, dict):
        found = found_ids(df, entity, text, table).select(F.col("id").alias(entity.key), F.lit(1.0).alias("score"))
    else:
        asked = local_frame(df.sparkSession, query_id=pa.array([0], pa.int32()), text=pa.array([text]))
        found = searchtable.scores(table, asked, fields, boosts).select(F.col("id").alias(entity.key), "score")
    out = rows.join(found, entity.key)
    if entity.citations and entity.citations in df.columns:
        out = out.withColumn("score", search.citation_boost(F.col("score"), F.col(entity.citations)))
    return out


def run(df: DataFrame, entity: EntityDef, spec: Spec, table: searchtable.SearchTable | None = None) -> DataFrame:
    """Filter, search, then group or order, and cut a page. A search reads ``table``; without one it is stored first."""
    rows = filtered(df, entity, spec)
    if spec.search:
        rows = searched(rows, df, entity, spec.search, table)
    if spec.group_by:
        path = entity.aliases.get(spec.group_by, spec.group_by)
        if spec.group_by in entity.presence:
            return groups.group_presence(rows, entity.presence[spec.group_by])
        key = spec.sort[0] if spec.sort else "-count"
        if key.lstrip("-") not in ("count", "key"):
            raise ValueError(f"groups are sorted by count or key, not by {key}")
        found = groups.all_groups(rows, path, groups.UNKNOWN if spec.unknown else None)
        keys = [key] if key.lstrip("-") == "key" else [key, "key"]
        size = spec.per_page or groups.MAX_GROUPS
        if spec.cursor:
            return paging.after(found, keys, list(spec.after) if spec.after else None, size)
        return paging.page(found, keys, spec.page, size)
    default = list(entity.search_sort if spec.search else entity.default_sort)
    asked = [k.replace(RELEVANCE, "score") if k.lstrip("-") == RELEVANCE else k for k in entity.sort_keys(spec.sort)]
    unknown = [k for k in asked if k.lstrip("-").split(".")[0] not in rows.columns]
    if unknown:
        raise ValueError(f"cannot sort by {', '.join(unknown)}")
    keys = asked or [k for k in default if k.lstrip("-").split(".")[0] in rows.columns]
    # a unique last key: ties neither repeat nor vanish between pages
    keys = keys if entity.key in [k.lstrip("-") for k in keys] else [*keys, entity.key]
    size = spec.per_page or 25
    if spec.sample:
        # pages of a sample go by its own order
        rows = paging.sample(rows, entity.key, spec.sample, spec.seed)
        rows = rows.withColumn("__order", paging.order_hash(F.col(entity.key), spec.seed))
        rows = paging.page(rows, ["__order", entity.key], spec.page, size).drop("__order")
    elif spec.cursor:
        rows = paging.after(rows, keys, list(spec.after) if spec.after else None, size)
    else:
        rows = paging.page(rows, keys, spec.page, size)
    rows = project.drop_heavy(rows)
    return project.select(rows, list(spec.select)) if spec.select else rows
