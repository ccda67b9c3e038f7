"""Projection: checked select, heavy columns, abstracts, short lists, links and hints."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bibspark.functions.paths import leaf
from bibspark.functions.text import by_word
from bibspark.operators.joins import by_repetition

# fixed values: columns too heavy for lists
HEAVY = ("abstract", "abstract_inverted_index", "fulltext", "authorships_full", "embeddings", "vector_embedding", "text", "embedding", "html")

# fixed values: display names that differ from the country table
COUNTRY_SHORT = {"us": "USA", "gb": "UK"}


def select(df: DataFrame, cols: list[str]) -> DataFrame:
    """Top-level columns, each of which must exist."""
    unknown = [c for c in cols if c not in df.columns]
    if unknown:
        raise ValueError(f"not a column: {', '.join(unknown)}; columns are {', '.join(df.columns)}")
    return df.select(*cols)


def drop_heavy(df: DataFrame, heavy=HEAVY) -> DataFrame:
    return df.drop(*heavy)


def text_from_index(index: Column) -> Column:
    """Text out of a word -> positions map; NULL for a missing or empty index."""
    places = F.flatten(F.transform(F.map_entries(index), lambda e: F.transform(e["value"], lambda p: F.struct(p.alias("p"), e["key"].alias("w")))))
    text = F.array_join(F.transform(F.array_sort(places), lambda s: s["w"]), " ")
    return F.when(F.size(index) > 0, text)


def unwrap_index(wrapped: Column) -> Column:
    """The map itself where it is stored under the key ``InvertedIndex`` of a struct."""
    return wrapped.getField("InvertedIndex")


def _places(text: str) -> Column:
    """(term, positions) of the words of a text."""
    return by_word(F.transform(F.split(text, " "), lambda w, i: F.struct(w.alias("term"), i.alias("position"))))


def word_positions(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, word, positions). Words are grouped inside the record; only records that share a key meet in a shuffle."""

    def in_row(rows):
        return rows.select(key, F.explode(_places(text)).alias("w")).select(key, F.col("w.term").alias("word"), "w.positions")

    once, again = by_repetition(df.select(key, text), key)
    if again is None:
        return in_row(once)
    merged = in_row(again).groupBy(key, "word").agg(F.array_sort(F.flatten(F.collect_list("positions"))).alias("positions"))
    return in_row(once).unionByName(merged)


def index_from_text(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, index map) for each record. A group is one record's own words."""
    once, again = by_repetition(df.select(key, text).where(F.col(text).isNotNull()), key)
    index = once.select(key, F.map_from_entries(_places(text)).alias("index"))
    if again is None:
        return index
    words = again.select(key, F.explode(_places(text)).alias("w")).groupBy(key, "w.term").agg(F.array_sort(F.flatten(F.collect_list("w.positions"))).alias("positions"))
    return index.unionByName(words.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("term", "positions"))).alias("index")))


def truncate_list(df: DataFrame, path: str, n: int = 100) -> DataFrame:
    """The first ``n`` elements of an array column, and a flag where that cut something."""
    arr = leaf(df, path).col
    return df.withColumn(f"is_{path}_truncated", F.coalesce(F.size(arr) > n, F.lit(False))).withColumn(path, F.slice(arr, 1, n))


def content_urls(short: Column, has_pdf: Column, has_xml: Column, base: str) -> Column:
    """Struct of download links by flag; NULL if neither is set."""

    def link(flag, ext):
        return F.when(flag, F.concat(F.lit(f"{base}/works/"), short, F.lit(ext)))

    both = F.struct(link(has_pdf, ".pdf").alias("pdf"), link(has_xml, ".grobid-xml").alias("grobid_xml"))
    return F.when(F.coalesce(has_pdf, F.lit(False)) | F.coalesce(has_xml, F.lit(False)), both)


def name_hint(names: Column, n: int = 3) -> Column:
    """Up to ``n`` names, then "et al."; "authors unknown" where there are none."""
    known = F.array_compact(names)
    # "et al." stands for anything in the list after the n-th name, named or not
    nth = F.filter(F.transform(names, lambda x, i: F.when(x.isNotNull(), i)), lambda i: i.isNotNull())
    more = F.size(names) > F.coalesce(F.get(nth, F.lit(n - 1)) + 1, F.size(names))
    shown = F.concat(F.slice(known, 1, n), F.when(more, F.array(F.lit("et al."))).otherwise(F.array().cast("array<string>")))
    return F.when(F.coalesce(F.size(known), F.lit(0)) == 0, F.lit("authors unknown")).otherwise(F.array_join(shown, ", "))


def country_label(code: Column, name: Column) -> Column:
    short = F.create_map(*[F.lit(x) for kv in COUNTRY_SHORT.items() for x in kv])
    return F.when(code.isNotNull(), F.coalesce(F.try_element_at(short, F.lower(code)), name))


def place_hint(city: Column, country: Column) -> Column:
    """"City, Country", or the country alone; NULL without a country."""
    return F.when(country.isNotNull(), F.concat_ws(", ", city, country))


def host_hint(host: Column) -> Column:
    return F.coalesce(host, F.lit("host organization unknown"))
