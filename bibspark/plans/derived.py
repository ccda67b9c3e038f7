"""Bibliometric columns. Works are orders; an order cites the order whose key is the part key of one of
its lines; authors are customers; year, type and subfield come from date, status and priority."""

from pyspark.sql import functions as F

from bibspark.functions.paths import leaf
from bibspark.operators import bibliometrics as B
from bibspark.plans.joined import EDGES, edges
from bibspark.plans.registry import query, with_works


def works(t):
    return t.orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("author"), F.year("o_orderdate").alias("year"),
        F.col("o_orderstatus").alias("type"), F.col("o_orderpriority").alias("subfield"),
    )


_W = "w as (select o_orderkey as id, o_custkey as author, year(o_orderdate)::integer as year, o_orderstatus as type, o_orderpriority as subfield from orders)"
_CITED = f"with {EDGES}, {_W}, c as (select w.*, cast(count(cited) as bigint) as cited_by_count from w left join edges on cited = id group by all)"


def cited(t):
    return B.cited_by_count(works(t), edges(t))


@query("cited_by_count", _CITED + " select id, cited_by_count from c")
def cited_by_count(t):
    return cited(t).select("id", "cited_by_count")


@query("counts_by_year", _CITED + """
select cited as id, string_agg(year || ':' || n, ' ' order by year desc) as counts from (
 select cited, w.year, count(*) as n from edges join w on w.id = citing where w.year between 1997 and 2001 group by 1, 2) group by 1""")
def counts_by_year(t):
    out = B.counts_by_year(works(t), edges(t), 2001, 5)
    return out.select("id", F.array_join(F.transform("counts_by_year", lambda s: F.concat_ws(":", s["year"], s["cited_by_count"])), " ").alias("counts"))


@query("h_index", _CITED + """
select author, cast(coalesce(max(least(cited_by_count, r)), 0) as bigint) as h_index from (select author, cited_by_count, row_number() over (partition by author order by cited_by_count desc, id) as r from c) group by 1""")
def h_index(t):
    return B.h_index(cited(t), "author", "cited_by_count")


@query("h_index_by_segment", _CITED + """
select c_mktsegment, cast(max(least(cited_by_count, r)) as bigint) as h_index from (select c_mktsegment, cited_by_count, row_number() over (partition by c_mktsegment order by cited_by_count desc) as r from c join customer on author = c_custkey) group by 1""")
def h_index_segment(t):
    return B.h_index(cited(t).join(t.customer, F.col("author") == F.col("c_custkey")), "c_mktsegment", "cited_by_count")


@query("i10_index", _CITED + " select author, cast(count(*) filter (where cited_by_count >= 10) as bigint) as i10_index from c group by 1")
def i10_index(t):
    return B.i10(cited(t), "author", "cited_by_count")


@query("two_year_mean_citedness", _CITED + """
select subfield, round(cast(count(citing) as double) / count(distinct c.id), 6) as mean_citedness from c left join (select citing, cited from edges join w on w.id = citing and w.year = 2000) e on e.cited = c.id
where year in (1998, 1999) group by 1""")
def mean_citedness(t):
    return B.mean_citedness(works(t), edges(t), "subfield", 2001).select("subfield", F.round("mean_citedness", 6).alias("mean_citedness"))


_RECEIVED = _CITED + """, r as (select w.id, w.type, w.year, w.subfield, cast(count(x.id) as bigint) as received from w left join edges on cited = w.id
  left join w x on x.id = citing and x.year - w.year between 0 and 3 group by 1, 2, 3, 4)"""


@query("field_weighted_impact", _RECEIVED + """
select r.id, received, round(case when e > 0 then received / e end, 6) as fwci from r join (select type, year, subfield, avg(received) as e from r group by all) using (type, year, subfield)""")
def fwci(t):
    out = B.fwci(B.citations_received(works(t), edges(t)), ["type", "year", "subfield"])
    return out.select("id", "received", F.round("fwci", 6).alias("fwci"))


@query("normalised_percentile", _RECEIVED + """
select id, round(p, 6) as percentile, p >= 0.99 as is_in_top_1_percent, p >= 0.9 as is_in_top_10_percent from (select id, percent_rank() over (partition by type, year, subfield order by received) as p from r)""")
def norm_percentile(t):
    out = B.norm_percentile(B.citations_received(works(t), edges(t)), ["type", "year", "subfield"], "received")
    return out.select("id", F.round("percentile", 6).alias("percentile"), "is_in_top_1_percent", "is_in_top_10_percent")


@query("percentile_in_year", _CITED + """
select id, cast(floor(100 * percent_rank() over (partition by year order by cited_by_count)) as integer) as min, cast(floor(100 * cume_dist() over (partition by year order by cited_by_count)) as integer) as max from c""")
def year_percentile(t):
    return B.year_percentile(cited(t), "year", "cited_by_count").select("id", "min", "max")


@query("related_works", with_works("""
select id, related_id, shared::integer as shared, rank::integer as rank from (select a.id, b.id as related_id, len(list_intersect(a.terms, b.terms)) as shared,
 row_number() over (partition by a.id order by len(list_intersect(a.terms, b.terms)) desc, b.id desc) as rank from t a join t b on a.id <> b.id and list_has_any(a.terms, b.terms)) where rank <= 5""",
 "t as (select id, list_distinct(list_concat([lang, source.id], list_filter(list_transform(sentences, lambda s: s.mark), lambda m: m is not null))) as terms from works)"))
def related_works(t):
    df = t.works
    docs = df.select("id", F.array_distinct(F.concat(F.array("lang", "source.id"), leaf(df, "sentences.mark").distinct)).alias("terms"), F.col("id").alias("recent"))
    return B.related_works(docs, "terms", "recent", 5)


_PARTS = "t as (select o_custkey as id, list_distinct(list(l_partkey)) as terms, max(o_orderkey) as at from lineitem join orders on l_orderkey = o_orderkey group by 1)"


@query("related_by_many_terms", f"""
with {_PARTS} select id, related_id, shared::integer as shared, rank::integer as rank from (select a.id, b.id as related_id, len(list_intersect(a.terms, b.terms)) as shared,
 row_number() over (partition by a.id order by len(list_intersect(a.terms, b.terms)) desc, b.at desc, b.id) as rank from t a join t b on a.id <> b.id and list_has_any(a.terms, b.terms)) where rank <= 3""")
def related_by_many_terms(t):
    """Customers by the parts they bought: some dozens each."""
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    df = rows.groupBy(F.col("o_custkey").alias("id")).agg(F.collect_set("l_partkey").alias("terms"), F.max("o_orderkey").alias("at"))
    return B.related_works(df, "terms", "at", 3)


def authorships(t):
    """(author, work, date, institution): the suppliers on a customer's orders."""
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.select(F.col("o_custkey").alias("author"), F.col("o_orderkey").alias("work"), F.col("o_orderdate").alias("date"), F.col("l_suppkey").alias("institution"))


_AUTH = "auth as (select o_custkey as author, o_orderkey as work, o_orderdate as date, l_suppkey as institution from lineitem join orders on l_orderkey = o_orderkey)"


@query("last_known_institutions", f"""
with {_AUTH}, l as (select author, arg_max(work, (date, work)) as work from auth group by 1) select distinct author, institution from auth join l using (author, work)""")
def last_institutions(t):
    return B.last_institutions(authorships(t), "author", "work", "date", "institution")


@query("affiliation_years", f"""
with {_AUTH} select author, institution, string_agg(y::varchar, ',' order by y desc) as years from (select distinct author, institution, year(date) as y from auth) group by 1, 2""")
def affiliation_years(t):
    out = B.affiliation_years(authorships(t), "author", "institution", F.year("date"))
    return out.select("author", "institution", F.array_join(F.col("years").cast("array<string>"), ",").alias("years"))


@query("open_access_status", """
select l_orderkey, l_linenumber, l_suppkey, l_partkey, case when oa and not apc then 'diamond' when oa then 'gold' when fr and lic then 'hybrid' when fr then 'bronze' when repo then 'green' else 'closed' end as oa_status
from (select *, l_linenumber = 1 as oa, l_tax > 0.04 as apc, l_returnflag = 'R' as fr, l_linestatus = 'O' as lic, l_quantity > 25 as repo from lineitem)""")
def open_access_status(t):
    status = B.oa_status(F.col("l_linenumber") == 1, F.col("l_tax") > 0.04, F.col("l_returnflag") == "R", F.col("l_linestatus") == "O", F.col("l_quantity") > 25)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", status.alias("oa_status"))


@query("distinct_counts", with_works("""
select id, len(list_distinct(list_transform(sentences, lambda s: s.opener))) as openers, len(list_distinct(flatten(list_transform(sentences, lambda s: s.terms)))) as terms,
 len(list_distinct(list_filter(list_transform(sentences, lambda s: s.mark), lambda m: m is not null))) as marks from works"""))
def distinct_counts(t):
    df = t.works
    return df.select("id", *[F.size(leaf(df, p).distinct).cast("bigint").alias(n) for n, p in (("openers", "sentences.opener"), ("terms", "sentences.terms"), ("marks", "sentences.mark"))])


@query("topic_share", """
with p as (select distinct o_custkey, l_orderkey, p_type from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey),
 c as (select o_custkey, p_type, count(*) as n from p group by 1, 2), o as (select o_custkey, count(distinct l_orderkey) as own from p group by 1), a as (select p_type, count(distinct l_orderkey) as al from p group by 1)
select o_custkey, p_type, cast(n as bigint) as count, round(n / own, 6) as share, round(n / al, 6) as value, rank::integer as rank from (
 select *, row_number() over (partition by o_custkey order by n desc, p_type) as rank from c join o using (o_custkey) join a using (p_type)) where rank <= 3""")
def topic_share(t):
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    out = B.topic_share(rows, "o_custkey", "l_orderkey", "p_type", 3)
    return out.select("o_custkey", "p_type", "count", F.round("share", 6).alias("share"), F.round("value", 6).alias("value"), "rank")


@query("concept_scores", """
with p as (select l_suppkey, l_orderkey, p_brand, max(l_quantity / 50) as s from lineitem join part on l_partkey = p_partkey group by 1, 2, 3),
 c as (select l_suppkey, p_brand, sum(s) as s from p group by 1, 2), o as (select l_suppkey, count(distinct l_orderkey) as own from p group by 1)
select l_suppkey, p_brand, round(round(100 * s / own, 9), 1) as score from c join o using (l_suppkey)""")
def concept_scores(t):
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).withColumn("s", F.col("l_quantity") / 50)
    return B.concept_scores(rows, "l_suppkey", "l_orderkey", "p_brand", "s", 25).select("l_suppkey", "p_brand", "score")
