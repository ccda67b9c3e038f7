"""Identifier normalisers as column functions. Each gives NULL for text that holds no such id.

Every host is an argument or is ignored by the pattern, so one column can mix spellings.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the patterns that define each identifier
ID_PATTERNS = {
    "catalog": r"([WAICFVPSTG]\d{2,})",
    "doi": r"(10\.\d+/[^\s]+)",
    "orcid": r"(\d{4}-\d{4}-\d{4}-\d{3}[\dX])",
    "ror": r"([a-z\d]*)$",
    "issn": r"([\dx]{4}-[\dx]{4})",
    "wikidata": r"(Q\d*)",
    "pmid": r"(\d+)",
    "pmcid": r"(\d+)",
    "scopus": r"authorid=(\d+)",
}

# fixed values: canonical URL prefixes of outside identifiers
URL_PREFIXES = {
    "doi": "https://doi.org/",
    "orcid": "https://orcid.org/",
    "ror": "https://ror.org/",
    "pmid": "https://pubmed.ncbi.nlm.nih.gov/",
    "pmcid": "https://www.ncbi.nlm.nih.gov/pmc/articles/",
    "wikidata": "https://www.wikidata.org/wiki/",
}

# fixed values: entity name by first letter of a catalogue id
ENTITY_OF_LETTER = {
    "w": "works",
    "a": "authors",
    "i": "institutions",
    "c": "concepts",
    "f": "funders",
    "p": "publishers",
    "s": "sources",
    "t": "topics",
    "g": "awards",
}

# fixed values: id scheme by provenance of a location
SCHEME_OF_PROVENANCE = {
    "crossref": "doi",
    "datacite": "doi",
    "pubmed": "pmid",
    "mag": "mag",
    "repo": "pmh",
    "repo_backfill": "pmh",
}

_UPPER = {"catalog", "orcid", "wikidata"}


def norm(kind: str, col: Column) -> Column:
    """The bare id of a kind out of any spelling."""
    text = F.trim(col)
    text = F.upper(text) if kind in _UPPER else F.lower(text)
    found = F.nullif(F.regexp_extract(text, ID_PATTERNS[kind], 1), F.lit(""))
    if kind == "scopus":
        # plain text is taken as the id itself
        return F.when(text.startswith("http"), found).otherwise(F.nullif(text, F.lit("")))
    return found


def norm_catalog(col: Column, letter: str | None = None) -> Column:
    """A catalogue id such as W123, optionally of one entity kind only."""
    found = norm("catalog", col)
    return F.when(found.startswith(letter.upper()), found) if letter else found


def norm_doi(col: Column) -> Column:
    return norm("doi", col)


def norm_orcid(col: Column) -> Column:
    return norm("orcid", col)


def norm_ror(col: Column) -> Column:
    return norm("ror", col)


def norm_issn(col: Column) -> Column:
    return norm("issn", col)


def norm_wikidata(col: Column) -> Column:
    return norm("wikidata", col)


def norm_pmid(col: Column) -> Column:
    return norm("pmid", col)


def norm_pmcid(col: Column) -> Column:
    return norm("pmcid", col)


def norm_scopus(col: Column) -> Column:
    return norm("scopus", col)


def as_url(kind: str, col: Column) -> Column:
    """Canonical URL form of an outside id."""
    return F.concat(F.lit(URL_PREFIXES[kind]), norm(kind, col))


def ext_id(col: Column, entity: str) -> Column:
    """Bare key of a small vocabulary from ``en``, ``languages/en`` or a full URL; lower case."""
    return F.nullif(F.regexp_extract(F.lower(F.trim(col)), rf"^(?:https?://[^/]+/)?(?:{entity}/)?([^/]+)$", 1), F.lit(""))


def short_id(col: Column, style: str = "short", base: str = "") -> Column:
    """A catalogue id as ``W1``, as ``works/W1`` or as a URL under ``base``; other text of the form
    ``URL/kind/key`` becomes ``kind/key`` in the entity style."""
    bare = F.nullif(F.regexp_extract(F.upper(F.trim(col)), r"(?:^|/)([WAICFPSTG]\d+)$", 1), F.lit(""))
    if style == "short":
        return bare
    if style == "url":
        return F.concat(F.lit(base), bare)
    letters = F.create_map(*[F.lit(x) for kv in ENTITY_OF_LETTER.items() for x in kv])
    outside = F.nullif(F.regexp_extract(F.trim(col), r"([^/]+/[^/]+)$", 1), F.lit(""))
    entity = F.try_element_at(letters, F.lower(F.substring(bare, 1, 1)))
    return F.coalesce(F.concat(entity, F.lit("/"), bare), outside)


def location_id(provenance: Column, native: Column) -> Column:
    """``scheme:native`` by provenance; NULL where either is missing or the provenance is unknown."""
    schemes = F.create_map(*[F.lit(x) for kv in SCHEME_OF_PROVENANCE.items() for x in kv])
    return F.when(native != "", F.concat(F.try_element_at(schemes, provenance), F.lit(":"), native))
