import pytest
from pyspark.sql import functions as F

from bibspark import catalog as C

SCHEMA = """
id string, display_name string, publication_year int, publication_date date, is_xpac boolean, cited_by_count int,
ids struct<doi:string,mag:string,pmid:string,pmcid:string,arxiv:string>, open_access struct<is_oa:boolean,oa_status:string>,
authorships array<struct<author:struct<id:string,orcid:string>,institutions:array<struct<id:string,country_code:string>>>>,
institution_assertions array<struct<id:string,country_code:string>>,
locations array<struct<is_oa:boolean,version:string,source:struct<id:string,type:string>>>, referenced_works array<string>
"""

ROWS = [
    ("W100", "Deep cats", 2020, None, False, 5, ("10.1/a", "1", None, None, None), (True, "gold"), [(("A111", None), [("I11", "US")])], None, [(True, "publishedVersion", ("S11", "journal"))], ["W200"]),
    ("W200", "Deep dogs", 2019, None, False, 50, (None, "2", None, None, None), (False, "closed"), [(("A222", "o"), [("I22", "FR")])], [("I11", "US")], [(True, None, None), (False, "submittedVersion", ("S22", "repository"))], []),
    ("W300", "Cats deep", 2018, None, True, 1, (None, None, None, None, None), (None, None), None, None, [], None),
    ("W400", "Birds", None, None, False, 0, ("10.2/b", None, "p", None, None), (True, "green"), [], [("I33", None)], None, ["W100", "W200"]),
]


@pytest.fixture(scope="module")
def works(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


CASES = [
    (("cites", "is", "https://example.org/w200"), ["W100", "W400"]),
    (("has_doi", "is", True), ["W100", "W400"]),
    (("has_references", "is", False), ["W200"]),
    (("has_orcid", "is", True), ["W200"]),
    (("publication_year", ">", 2018), ["W100", "W200"]),
    (("publication_year", "!=", 2020), ["W200", "W400"]),
    (("publication_year", "known", False), ["W400"]),
    (("oa_status", "in", ["GOLD", "green"]), ["W100", "W400"]),
    (("author.id", "is not", "A111"), ["W200", "W400"]),
    (("authorships.institutions.country_code", "is", "us"), ["W100", "W200"]),
    (("authorships.institutions.country_code", "is not", "us"), ["W400"]),
    (("mag_only", "is", True), ["W200"]),
    (("mag_only", "is", False), ["W100", "W400"]),
    (("has_oa_submitted_version", "is", True), ["W200"]),
    (("has_oa_submitted_version", "is", False), ["W100", "W400"]),
    (("best_open_version", "is", "published"), ["W100"]),
    (("version", "is", None), ["W400"]),
    (("repository", "is", "S22"), ["W200"]),
    (("is_oa", "=", True), ["W100", "W400"]),
    (("is_xpac", "=", True), ["W300"]),
    (("doi_starts_with", "is", "10.2"), ["W400"]),
    (("display_name", "search", "CATS deep"), ["W100"]),
    (("display_name", "phrase", "deep cats"), ["W100"]),
    (("has_old_authors", "is", True), ["W100", "W200"]),
]


@pytest.mark.parametrize("case, want", CASES, ids=[c[0][0] + "-" + str(i) for i, c in enumerate(CASES)])
def test_filters(works, case, want):
    got = C.run(works, C.ENTITIES["works"], C.Spec(filters=(case,), sort=("id",)))
    assert [r.id for r in got.collect()] == want


def test_search_ranks_by_score_and_citations(works):
    got = C.run(works.drop("publication_date"), C.ENTITIES["works"], C.Spec(search="deep"))
    assert [r.id for r in got.collect()] == ["W200", "W100"]


def test_fields_follow_from_the_schema(works):
    fields = C.fields_of(works.schema)
    assert fields["authorships.institutions.id"].kind == "id"
    assert fields["publication_year"].kind == "range" and fields["locations.is_oa"].kind == "boolean"


def test_groups_select_and_sample(works):
    e = C.ENTITIES["works"]
    got = C.run(works, e, C.Spec(group_by="oa_status", unknown=True))
    assert sorted((r.key, r["count"]) for r in got.collect()) == [("closed", 1), ("gold", 1), ("green", 1)]
    got = C.run(works, e, C.Spec(group_by="has_doi"))
    assert {r.key: r["count"] for r in got.collect()} == {"true": 2, "false": 1}
    assert C.run(works, e, C.Spec(select=("id",))).columns == ["id"]
    with pytest.raises(ValueError):
        C.run(works, e, C.Spec(select=("nope",)))
    assert C.run(works, e, C.Spec(sample=2)).count() == 2


def test_cursor_walks_all(works):
    e, seen, after = C.ENTITIES["works"], [], None
    for _ in range(5):
        part = C.run(works, e, C.Spec(sort=("-cited_by_count",), cursor=True, after=after, per_page=2)).collect()
        if not part:
            break
        seen += [r.id for r in part]
        after = (part[-1].cited_by_count, part[-1].id)
    assert seen == ["W200", "W100", "W400"]


def test_groups_are_paged_and_bad_sorts_fail(spark):
    import pytest

    from bibspark.catalog import EntityDef, Spec, run

    entity = EntityDef("things", default_sort=("id",))
    df = spark.createDataFrame([(i, f"g{i:03}") for i in range(500)], "id int, g string")
    pages = [run(df, entity, Spec(group_by="g", page=p)).collect() for p in (1, 2, 3)]
    assert [len(p) for p in pages] == [200, 200, 100] and len({r["key"] for p in pages for r in p}) == 500
    assert run(df, entity, Spec(group_by="g", per_page=10)).count() == 10
    last = run(df, entity, Spec(group_by="g", cursor=True, after=(1, "g498"))).collect()
    assert [r["key"] for r in last] == ["g499"]
    for bad in (("-nothing",), ("relevance_score",)):
        with pytest.raises(ValueError):
            run(df, entity, Spec(sort=bad))


def test_highlight_takes_words_as_they_are(spark):
    from pyspark.sql import functions as F

    from bibspark.functions import ids
    from bibspark.operators.search import highlight

    row = spark.createDataFrame([("c and c++ and a.b axb", "https://x.org/G12")], "t string, i string").select(highlight(F.col("t"), ["c++", "a.b"])[0], ids.short_id(F.col("i"))).first()
    assert row[0] == "c and >>c++<< and >>a.b<< axb" and row[1] == "G12"
