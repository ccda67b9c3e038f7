import pytest
from pyspark.sql import functions as F

from bibspark.functions import ids

CASES = {
    "catalog": [("W123", "W123"), ("w123", "W123"), ("https://example.org/W123", "W123"), ("works/W123", "W123"), ("junk", None), ("", None), ("W1", None)],
    "doi": [("10.1/X", "10.1/x"), ("https://doi.org/10.1/x", "10.1/x"), ("doi:10.1/x", "10.1/x"), ("none", None)],
    "orcid": [("https://orcid.org/0000-0001-2345-678x", "0000-0001-2345-678X"), ("0000", None)],
    "issn": [("issn:1234-567X", "1234-567x"), ("12345678", None)],
    "ror": [("https://ror.org/03VEK6S52", "03vek6s52"), ("", None)],
    "pmid": [("https://pubmed.ncbi.nlm.nih.gov/77", "77"), ("x", None)],
    "wikidata": [("wikidata:q42", "Q42"), ("42", None)],
    "scopus": [("7004185909", "7004185909"), ("http://www.scopus.com/inward/authorDetails.url?authorID=7&x", "7"), ("http://nope", None)],
}


@pytest.mark.parametrize("kind", list(CASES))
def test_norm(spark, kind):
    df = spark.createDataFrame([(a,) for a, _ in CASES[kind]] + [(None,)], "s string")
    got = [r[0] for r in df.select(ids.norm(kind, F.col("s"))).collect()]
    assert got == [b for _, b in CASES[kind]] + [None]


def test_short_ids(spark):
    df = spark.createDataFrame([("https://example.org/W12",), ("a7",), ("https://x.org/keywords/rain",), ("junk",), (None,)], "s string")
    s = F.col("s")
    got = df.select(ids.short_id(s), ids.short_id(s, "entity"), ids.short_id(s, "url", "https://b.org/")).collect()
    assert [tuple(r) for r in got] == [
        ("W12", "works/W12", "https://b.org/W12"),
        ("A7", "authors/A7", "https://b.org/A7"),
        (None, "keywords/rain", None),
        (None, None, None),
        (None, None, None),
    ]


def test_ext_id(spark):
    df = spark.createDataFrame([("en",), ("languages/EN",), ("https://x.org/languages/en",), ("other/en",)], "s string")
    assert [r[0] for r in df.select(ids.ext_id(F.col("s"), "languages")).collect()] == ["en", "en", "en", None]


def test_location_id(spark):
    df = spark.createDataFrame([("crossref", "10.1/x"), ("repo", "oai:1"), ("other", "x"), ("mag", ""), (None, "x")], "p string, n string")
    assert [r[0] for r in df.select(ids.location_id(F.col("p"), F.col("n"))).collect()] == ["doi:10.1/x", "pmh:oai:1", None, None, None]
