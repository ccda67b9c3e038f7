"""Filters and predicates."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from bibspark.catalog import EntityDef, Spec, run, with_places
from bibspark.functions import ids
from bibspark.functions.paths import leaf, value
from bibspark.operators import predicates as P
from bibspark.plans.registry import query, with_works

_CUST = "select c_custkey, c_mktsegment from customer where "
_ORD = "select o_orderkey, o_orderstatus from orders where "


@query("filter_term_equality", _CUST + "lower(c_mktsegment) = 'building'")
def term_equality(t):
    df = t.customer
    return df.where(P.eq(leaf(df, "c_mktsegment"), "BuilDing")).select("c_custkey", "c_mktsegment")


@query("filter_term_equality_folded_key", "select c_custkey, lower(c_mktsegment) as segment_lc from customer where lower(c_mktsegment) = 'building'")
def term_equality_folded(t):
    df = t.customer.select("c_custkey", F.lower("c_mktsegment").alias("segment_lc"))
    return df.where(P.eq(leaf(df, "segment_lc"), "building", exact=True))


@query("filter_value_list", "select c_custkey, c_nationkey from customer where c_nationkey in (1, 3, 5, 7, 9)")
def value_list(t):
    df = t.customer
    return df.where(P.is_in(leaf(df, "c_nationkey"), [1, 3, 5, 7, 9])).select("c_custkey", "c_nationkey")


@query("filter_value_list_long", "select o_orderkey, o_custkey from orders where o_custkey in (select c_custkey from customer where c_acctbal > 5000)")
def value_list_long(t):
    rich = t.customer.where("c_acctbal > 5000").select("c_custkey")
    return P.in_frame(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", rich)


@query("filter_any_of_ranges", "select o_orderkey, o_totalprice from orders where o_totalprice between 1000 and 20000 or o_totalprice > 450000")
def any_of_ranges(t):
    df = t.orders
    price = leaf(df, "o_totalprice")
    return df.where(P.any_of(P.between(price, 1000, 20000), P.cmp(price, ">", 450000))).select("o_orderkey", "o_totalprice")


@query("filter_negated_list", "select o_orderkey, nullif(o_orderstatus, 'P') as status from orders where not coalesce(nullif(o_orderstatus, 'P') in ('F', 'X'), false)")
def negated_list(t):
    df = t.orders.select("o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"))
    return df.where(P.none_of(leaf(df, "status"), ["f", "x"]))


@query("filter_all_values_in_array", with_works("""
select id, lang from works where len(list_filter(sentences, lambda s: s.opener = 'the')) > 0
  and len(list_filter(sentences, lambda s: s.opener = 'of')) > 0"""))
def all_values(t):
    df = t.works
    return df.where(P.all_in(leaf(df, "sentences.opener"), ["the", "of"])).select("id", "lang")


@query("filter_negation_on_array", with_works("""
select id from works where len(list_filter(sentences, lambda s: s.mark = ',')) = 0"""))
def negation_on_array(t):
    df = t.works
    return df.where(P.not_(P.eq(leaf(df, "sentences.mark"), ","))).select("id")


@query("filter_null_and_not_null", with_works("""
select id, case when len(list_filter(sentences, lambda s: s.mark is not null)) > 0 then 'known' else 'missing' end as marks,
  source.name is null as no_name from works"""))
def null_not_null(t):
    df = t.works
    marks, name = leaf(df, "sentences.mark"), leaf(df, "source.name")
    known = df.where(P.not_null(marks)).select("id", F.lit("known").alias("marks"), P.is_null(name).alias("no_name"))
    missing = df.where(P.is_null(marks)).select("id", F.lit("missing").alias("marks"), P.is_null(name).alias("no_name"))
    return known.unionByName(missing)


_RANGES = {
    "eq": ("o_totalprice = 1013.7", lambda p: P.cmp(p, "=", 1013.7)),
    "lt": ("o_totalprice < 50000", lambda p: P.cmp(p, "<", 50000)),
    "gt": ("o_totalprice > 400000", lambda p: P.cmp(p, ">", 400000)),
    "le": ("o_totalprice <= 50000", lambda p: P.cmp(p, "<=", 50000)),
    "ge": ("o_totalprice >= 400000", lambda p: P.cmp(p, ">=", 400000)),
    "closed": ("o_totalprice between 50000 and 400000", lambda p: P.between(p, 50000, 400000)),
    "open_low": ("o_totalprice <= 50000", lambda p: P.between(p, None, 50000)),
    "open_high": ("o_totalprice >= 400000", lambda p: P.between(p, 400000)),
    "not_eq": ("not coalesce(o_totalprice = 1013.7, false)", lambda p: P.cmp(p, "!=", 1013.7)),
    "not_closed": ("not coalesce(o_totalprice between 50000 and 400000, false)", lambda p: P.between(p, 50000, 400000, negate=True)),
}


@query("filter_numeric_ranges", "select " + ", ".join(f"cast(count(*) filter (where {s}) as bigint) as n_{k}" for k, (s, _) in _RANGES.items()) + " from (select nullif(o_totalprice, 499978.59) as o_totalprice from orders)")
def numeric_ranges(t):
    df = t.orders.select(F.nullif(F.col("o_totalprice"), F.lit(499978.59)).alias("o_totalprice"))
    price = leaf(df, "o_totalprice")
    return df.agg(*[F.count_if(f(price)).alias(f"n_{k}") for k, (_, f) in _RANGES.items()])


@query("filter_numeric_range_rows", "select o_orderkey, o_totalprice from orders where o_totalprice >= 400000")
def numeric_range_rows(t):
    df = t.orders
    return df.where(P.between(leaf(df, "o_totalprice"), 400000)).select("o_orderkey", "o_totalprice")


@query("filter_dates", """
select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as day from orders
where (cast(o_orderdate as date) >= date '1996-03-01' and cast(o_orderdate as date) <= date '1996-05-31')
  or cast(o_orderdate as date) = date '1999-01-16' or cast(o_orderdate as date) < date '1995-01-10'
  or cast(o_orderdate as date) > date '2001-07-20'""")
def dates(t):
    df = t.orders
    day = leaf(df, "o_orderdate")
    span = P.date_cmp(day, ">=", "1996-03-01") & P.date_cmp(day, "<=", "1996-05-31")
    pred = P.any_of(span, P.date_cmp(day, "=", "1999-01-16"), P.date_cmp(day, "<", "1995-01-10"), P.date_cmp(day, ">", "2001-07-20"))
    return df.where(pred).select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


@query("filter_timestamps", """
select event_id, event_type from events
where ts > timestamp '2024-01-05 10:00:00' and ts <= timestamp '2024-01-09 22:30:00'""")
def timestamps(t):
    df = t.events
    ts = leaf(df, "ts")
    pred = P.ts_cmp(ts, ">", "2024-01-05T12:00:00+02:00") & P.ts_cmp(ts, "<=", "2024-01-09T22:30:00Z")
    return df.where(pred).select("event_id", "event_type")


@query("filter_boolean", "select o_orderkey, o_orderstatus = 'F' as is_final from orders where o_orderstatus = 'F'")
def boolean(t):
    df = t.orders.select("o_orderkey", (F.col("o_orderstatus") == "F").alias("is_final"))
    return df.where(P.is_bool(leaf(df, "is_final"), True))


@query("filter_presence", with_works("""
select id, len(list_filter(sentences, lambda s: s.mark is not null)) > 0 as has_mark from works"""))
def presence(t):
    df = t.works
    marks = leaf(df, "sentences.mark")
    yes = df.where(P.has(marks, True)).select("id", F.lit(True).alias("has_mark"))
    return yes.unionByName(df.where(P.has(marks, False)).select("id", F.lit(False).alias("has_mark")))


@query("filter_uncorrelated_and_correlated", with_works("""
select id, len(list_filter(sentences, lambda s: s.words > 15)) > 0 and len(list_filter(sentences, lambda s: s.mark = ',')) > 0 as loose,
  len(list_filter(sentences, lambda s: s.words > 15 and s.mark = ',')) > 0 as tight
from works where len(list_filter(sentences, lambda s: s.words > 15)) > 0 and len(list_filter(sentences, lambda s: s.mark = ',')) > 0"""))
def uncorrelated(t):
    df = t.works
    tests = {"words": lambda x: x > 15, "mark": lambda x: x == ","}
    loose = P.any_where(df, "sentences", tests)
    tight = P.any_where(df, "sentences", tests, correlated=True)
    return df.where(loose).select("id", F.lit(True).alias("loose"), P.matches(tight).alias("tight"))


_PART_IDS = """(select p_partkey, nullif(p_type, 'SMALL') as mag, nullif(p_brand, 'Brand#2') as pmid,
  case when p_size > 25 then p_name end as doi from part)"""


@query("filter_only_one_id", f"""
select p_partkey, case when mag is not null and pmid is null and doi is null then 'only' when pmid is not null or doi is not null then 'others' else 'neither' end as ids
from {_PART_IDS}""")
def only_one_id(t):
    df = t.part.select(
        "p_partkey",
        F.nullif(F.col("p_type"), F.lit("SMALL")).alias("mag"),
        F.nullif(F.col("p_brand"), F.lit("Brand#2")).alias("pmid"),
        F.when(F.col("p_size") > 25, F.col("p_name")).alias("doi"),
    )
    present, absent = leaf(df, "mag"), [leaf(df, "pmid"), leaf(df, "doi")]
    kind = F.when(P.only_id(present, absent), "only").when(P.only_id(present, absent, False), "others").otherwise("neither")
    return df.select("p_partkey", kind.alias("ids"))


@query("filter_prefix_set", "select p_partkey, p_type from part where p_type like 'S%' or p_type like 'PRO%'")
def prefix_set(t):
    df = t.part
    return df.where(P.starts_any(leaf(df, "p_type"), ["S", "PRO"])).select("p_partkey", "p_type")


@query("filter_prefix", "select p_partkey, p_name from part where lower(p_name) like 'blu%'")
def prefix(t):
    df = t.part
    return df.where(P.starts_with(leaf(df, "p_name"), "Blu")).select("p_partkey", "p_name")


@query("filter_region_flag", """
select c_custkey, c_nationkey in (select n_nationkey from nation join region on n_regionkey = r_regionkey where r_name in ('AFRICA', 'ASIA')) as in_south from customer""")
def region_flag(t):
    south = t.nation.join(t.region.where(F.col("r_name").isin("AFRICA", "ASIA")), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey")
    df = t.customer.select("c_custkey", "c_nationkey")
    yes = P.in_region(df, "c_nationkey", south, True).select("c_custkey", F.lit(True).alias("in_south"))
    return yes.unionByName(P.in_region(df, "c_nationkey", south, False).select("c_custkey", F.lit(False).alias("in_south")))


def continent_table(t):
    """(continent, code) out of the nation and region tables."""
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("r_name").alias("continent"), F.col("n_nationkey").alias("code"))


@query("filter_continent", """
select s_suppkey, s_nationkey from supplier where s_nationkey in (select n_nationkey from nation join region on n_regionkey = r_regionkey where r_name = 'EUROPE')
union all
select s_suppkey, s_nationkey from supplier where s_nationkey in (select n_nationkey from nation join region on n_regionkey = r_regionkey where r_name = 'ASIA')""")
def continent(t):
    df = t.supplier.select("s_suppkey", "s_nationkey")
    places = continent_table(t)
    return P.in_continent(df, "s_nationkey", places, "Q46").unionByName(P.in_continent(df, "s_nationkey", places, "asia"))


_CODES = "cs as (select c_custkey, case when c_acctbal < 0 then [] when c_acctbal < 1000 then [null] else [c_nationkey, c_nationkey // 2, null] end as codes from customer)"
_SOUTH = "south as (select list(n_nationkey) as all_codes from nation join region on n_regionkey = r_regionkey where r_name in ('AFRICA', 'ASIA'))"


def coded(t):
    """Customers with an array of nation codes: none, a missing one, or two and a missing one."""
    two = F.array("c_nationkey", F.floor(F.col("c_nationkey") / 2).cast(t.customer.schema["c_nationkey"].dataType), F.lit(None))
    codes = F.when(F.col("c_acctbal") < 0, F.array().cast("array<bigint>")).when(F.col("c_acctbal") < 1000, F.array(F.lit(None).cast("bigint"))).otherwise(two.cast("array<bigint>"))
    return t.customer.select(F.col("c_custkey").alias("id"), F.struct(codes.alias("country_code")).alias("at"))


@query("filter_region_of_arrays", f"""
with {_CODES}, {_SOUTH} select c_custkey as id, true as in_south from cs, south where list_has_any(codes, all_codes) union all select c_custkey, false from cs, south where not list_has_any(codes, all_codes)""")
def region_arrays(t):
    """A region flag over arrays of codes; its negation keeps records without codes."""
    south = t.nation.join(t.region.where(F.col("r_name").isin("AFRICA", "ASIA")), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey")
    df = coded(t)
    yes = P.in_region(df, "at.country_code", south, True).select("id", F.lit(True).alias("in_south"))
    return yes.unionByName(P.in_region(df, "at.country_code", south, False).select("id", F.lit(False).alias("in_south")))


@query("filter_places_in_list_query", f"""
with {_CODES}, {_SOUTH}, europe as (select list(n_nationkey) as europe_codes from nation join region on n_regionkey = r_regionkey where r_name = 'EUROPE')
select c_custkey as id from cs, south, europe where not list_has_any(codes, all_codes) and list_has_any(codes, europe_codes) order by id limit 150""")
def places_in_list(t):
    south = t.nation.join(t.region.where(F.col("r_name").isin("AFRICA", "ASIA")), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey")
    entity = with_places(EntityDef("customers", default_sort=("id",), citations=None), {"at": "at.country_code"}, south, continent_table(t))
    spec = Spec(filters=(("at.is_global_south", "=", False), ("at.continent", "is", "Q46")), per_page=150, select=("id",))
    return run(coded(t), entity, spec)


@query("filter_two_paths", with_works("""
select id, coalesce(source.name, '') = 'src5' or len(list_filter(sentences, lambda s: s.opener = 'the')) > 0 as hit,
  source.name is not null and len(sentences) > 0 and len(list_filter(sentences, lambda s: s.mark is not null)) > 0 as both_known,
  source.name is null and len(list_filter(sentences, lambda s: s.mark is not null)) = 0 as neither
from works"""))
def two_paths(t):
    df = t.works
    name, opener, mark = leaf(df, "source.name"), leaf(df, "sentences.opener"), leaf(df, "sentences.mark")
    hit = P.any_of(P.matches(P.eq(name, "src5")), P.matches(P.eq(opener, "the")))
    return df.select("id", hit.alias("hit"), P.either(name, mark).alias("both_known"), P.neither_known(name, mark).alias("neither"))


@query("filter_two_paths_same_value", with_works("""
select id, lang from works where source.name = 'src5' or len(list_filter(sentences, lambda s: s.opener = 'src5')) > 0"""))
def two_paths_same(t):
    df = t.works
    return df.where(P.either(leaf(df, "source.name"), leaf(df, "sentences.opener"), lambda x: F.lower(x) == "src5")).select("id", "lang")


@query("filter_typed_reference", "select l_orderkey, l_linenumber, l_suppkey, l_quantity from lineitem where l_suppkey = 7 and l_returnflag = 'R'")
def typed_reference(t):
    df = t.lineitem
    return df.where(P.typed_ref(leaf(df, "l_suppkey"), leaf(df, "l_returnflag"), "R", 7)).select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")


@query("filter_lineage", """
select n_nationkey, n_name from nation where n_regionkey = 2""")
def lineage(t):
    df = t.nation.withColumn("lineage", F.array(F.concat(F.lit("N"), F.col("n_nationkey")), F.concat(F.lit("R"), F.col("n_regionkey"))))
    return df.where(P.in_lineage(leaf(df, "lineage"), "R2", "R")).select("n_nationkey", "n_name")


_CLASSES = {"any": ["A", "R", "N"], "acceptedorpublished": ["A", "R"], "published": ["R"]}


@query("filter_open_version", """
select l_orderkey, max(l_returnflag in ('A','R','N'))::boolean as any_class, max(l_returnflag in ('A','R'))::boolean as accepted, max(l_returnflag = 'R')::boolean as published
from lineitem group by 1""")
def open_version(t):
    df = t.lineitem
    flag = leaf(df, "l_returnflag")
    cls = {"any_class": "any", "accepted": "acceptedOrPublished", "published": "published"}
    return df.groupBy("l_orderkey").agg(*[F.bool_or(P.open_version(flag, c, _CLASSES)).alias(n) for n, c in cls.items()])


@query("filter_version_unknown", with_works("""
select id, len(list_filter(sentences, lambda s: s.mark = ',')) > 0 as comma, len(list_filter(sentences, lambda s: s.mark is not null)) = 0 as unknown from works"""))
def version_unknown(t):
    df = t.works
    mark = leaf(df, "sentences.mark")
    return df.select("id", P.matches(P.version(mark, ",")).alias("comma"), P.version(mark, None).alias("unknown"))


@query("filter_external_id", "select doc_id, lang from documents where lang in ('en', 'fr')")
def external_id(t):
    spelled = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("languages/"), "lang")).when(F.col("doc_id") % 3 == 1, F.concat(F.lit("https://example.org/Languages/"), F.upper("lang"))).otherwise(F.col("lang"))
    df = t.documents.select("doc_id", "lang", spelled.alias("spelled"))
    key = value(ids.ext_id(F.col("spelled"), "languages"))
    return df.where(P.is_in(key, ["en", "fr"], exact=True)).select("doc_id", "lang")


@query("normalise_ids", """
select o_orderkey, 'W' || (o_orderkey + 10) as catalog, '10.5555/x.' || o_orderkey as doi,
  '0000-0002-' || lpad((o_orderkey % 10000)::varchar, 4, '0') || '-000X' as orcid, '0abc' || o_orderkey as ror,
  lpad((o_orderkey % 10000)::varchar, 4, '0') || '-123x' as issn, 'Q' || o_orderkey as wikidata,
  o_orderkey::varchar as pmid, o_orderkey::varchar as pmcid, o_orderkey::varchar as scopus, cast(null as varchar) as junk
from orders""")
def normalise_ids(t):
    k = F.col("o_orderkey")
    four = F.lpad((k % 10000).cast("string"), 4, "0")
    odd = k % 2 == 1

    def spell(a, b):
        return F.when(odd, F.concat(*a)).otherwise(F.concat(*b))

    lit = F.lit
    return t.orders.select(
        k,
        ids.norm_catalog(spell([lit(" https://example.org/w"), k + 10], [lit("works/W"), k + 10]), "W").alias("catalog"),
        ids.norm_doi(spell([lit("https://doi.org/10.5555/X."), k], [lit("doi:10.5555/x."), k, lit(" ")])).alias("doi"),
        ids.norm_orcid(spell([lit("https://orcid.org/0000-0002-"), four, lit("-000x")], [lit("orcid:0000-0002-"), four, lit("-000X")])).alias("orcid"),
        ids.norm_ror(spell([lit("https://ror.org/0ABC"), k], [lit("ror:0abc"), k])).alias("ror"),
        ids.norm_issn(spell([lit("issn:"), four, lit("-123X")], [four, lit("-123x")])).alias("issn"),
        ids.norm_wikidata(spell([lit("https://www.wikidata.org/wiki/q"), k], [lit("wikidata:Q"), k])).alias("wikidata"),
        ids.norm_pmid(spell([lit("https://pubmed.ncbi.nlm.nih.gov/"), k], [lit("pmid:"), k])).alias("pmid"),
        ids.norm_pmcid(spell([lit("https://www.ncbi.nlm.nih.gov/pmc/articles/"), k], [lit("PMC"), k])).alias("pmcid"),
        ids.norm_scopus(spell([lit("http://www.scopus.com/inward/authorDetails.url?authorID="), k, lit("&partnerID=x")], [k])).alias("scopus"),
        ids.norm_doi(F.concat(lit("no id "), k)).alias("junk"),
    )


@query("canonical_ids", "select o_orderkey, 'https://doi.org/10.1/c' || o_custkey as customer from orders where o_custkey = 77")
def canonical_ids(t):
    c = F.col("o_custkey")
    spelled = F.when(c % 2 == 0, F.concat(F.lit("10.1/C"), c)).otherwise(
        F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("doi:10.1/c"), c)).otherwise(F.concat(F.lit("HTTPS://DOI.ORG/10.1/c"), c))
    )
    df = t.orders.select("o_orderkey", ids.as_url("doi", spelled).alias("customer"))
    return df.where(P.eq(leaf(df, "customer"), "https://doi.org/10.1/c77", exact=True))


@query("filter_hidden_ids", "select o_orderkey, o_custkey from orders where o_custkey not in (3, 5, 8)")
def hidden_ids(t):
    return P.hide(t.orders, "o_custkey", [3, 5, 8]).select("o_orderkey", "o_custkey")


@query("filter_hidden_ids_in_list", "select o_orderkey, o_custkey from orders where o_custkey in (1, 2)")
def hidden_in_list(t):
    df = t.orders
    wanted = P.without_blocked([1, 2, 3], [3, 5, 8])
    return df.where(P.is_in(leaf(df, "o_custkey"), wanted)).select("o_orderkey", "o_custkey")


@query("filter_boolean_tree", _ORD + """
(o_totalprice > 300000 and (o_orderstatus in ('F', 'O') or not (o_orderpriority = '1-URGENT' or o_custkey < 500))) and o_orderpriority <> '5-LOW'""")
def boolean_tree(t):
    node = {"join": "and", "filters": [
        {"join": "and", "filters": [
            {"field": "o_totalprice", "op": ">", "value": 300000},
            {"join": "or", "filters": [
                {"field": "o_orderstatus", "op": "in", "value": ["f", "o"]},
                {"join": "or", "not": True, "filters": [
                    {"field": "o_orderpriority", "op": "is", "value": "1-urgent"},
                    {"field": "o_custkey", "op": "<", "value": 500}]}]}]},
        {"field": "o_orderpriority", "op": "is not", "value": "5-LOW"}]}
    return P.where(t.orders, node).select("o_orderkey", "o_orderstatus")


@query("filter_contains", """
select p_partkey, p_name, contains(lower(p_name), 'bolt') as has_bolt from part where contains(lower(p_name), 'bolt') or not contains(lower(p_name), 'e')""")
def contains(t):
    df = t.part
    name = leaf(df, "p_name")
    return df.where(P.any_of(P.contains(name, "BOLT"), P.contains(name, "e", negate=True))).select("p_partkey", "p_name", P.contains(name, "bolt").alias("has_bolt"))


@query("filter_array_has_any", with_works("""
select id, list_has_any(list_transform(sentences, lambda s: s.opener), ['the', 'und']) as opens,
  len(list_filter(flatten(list_transform(sentences, lambda s: s.terms)), lambda x: contains(x, 'tion'))) > 0 as has_tion from works"""))
def array_has_any(t):
    df = t.works
    opener, terms = leaf(df, "sentences.opener"), leaf(df, "sentences.terms")
    return df.select("id", P.has_any(opener, ["the", "und"]).alias("opens"), P.matches(P.elem_contains(terms, "TION")).alias("has_tion"))


@query("filter_json_path", "select event_id, cast(props->>'$.k' as bigint) as k from events where cast(props->>'$.k' as bigint) >= 90")
def json_path(t):
    return t.events.where(P.json_cmp(F.col("props"), "$.k", ">=", 90, "bigint")).select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint").alias("k"))


@query("filter_any_leaf", with_works("""
select id, lang from works where lang = 'un' or source.id = 'un' or coalesce(source.name, '') = 'un'
  or len(list_filter(sentences, lambda s: s.opener = 'un' or coalesce(s.mark, '') = 'un' or list_contains(s.terms, 'un'))) > 0"""))
def any_leaf(t):
    df = t.works
    return df.where(P.any_leaf(df, "un")).select("id", "lang")


_LABEL = "(select p_partkey from part where p_brand = 'Brand#2' and p_size <= 2)"
_LABEL_PAIRS = "(select distinct o_custkey, l_partkey from lineitem join orders on l_orderkey = o_orderkey)"


@query("filter_saved_list_any", f"""
select c_custkey from customer where c_custkey in (select o_custkey from {_LABEL_PAIRS} where l_partkey in {_LABEL})""")
def saved_list_any(t):
    pairs = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_custkey").alias("c_custkey"), "l_partkey")
    label = t.part.where("p_brand = 'Brand#2' and p_size <= 2").select("p_partkey")
    return P.in_label(t.customer.select("c_custkey"), pairs, "c_custkey", "l_partkey", label, "any")


@query("filter_saved_list_every", """
with pairs as (select distinct l_suppkey, cast(floor(l_quantity) as int)::varchar || l_returnflag as kind from lineitem)
select s_suppkey from supplier where s_suppkey in (
  select l_suppkey from pairs group by 1 having count(kind) = (select count(distinct kind) from pairs))""")
def saved_list_every(t):
    kind = F.concat(F.floor("l_quantity").cast("int").cast("string"), "l_returnflag")
    pairs = t.lineitem.select(F.col("l_suppkey").alias("s_suppkey"), kind.alias("kind"))
    return P.in_label(t.supplier.select("s_suppkey"), pairs, "s_suppkey", "kind", pairs.select("kind"), "every")
