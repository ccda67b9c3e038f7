"""Facets, statistics, relational metrics, cubes and trees."""

from pyspark.sql import functions as F

from bibspark.functions import ids
from bibspark.functions.paths import leaf, value
from bibspark.operators import groups as G
from bibspark.operators import joins as J
from bibspark.operators import predicates as P
from bibspark.operators import trees
from bibspark.plans.filters import _CODES, coded, continent_table
from bibspark.plans.joined import line_orders
from bibspark.plans.registry import TABLE_NAMES, query, with_works
from bibspark.session import stored

_N = "cast(count(*) as bigint) as count"


@query("flagship_lines_by_year", f"""
select key, n_name as nation, {_N} from (
  select coalesce(case when l_returnflag = 'N' then null else year(l_shipdate)::varchar end, 'unknown') as key, n_name
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
  where lower(n_name) = 'nation_3' and l_quantity >= 5) group by 1, 2 order by 3 desc, 1 limit 10""")
def flagship(t):
    nation = t.nation.where(P.eq(leaf(t.nation, "n_name"), "nation_3"))
    buyers = t.customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey")
    own = t.orders.join(buyers, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey")
    lines = t.lineitem.where(P.between(leaf(t.lineitem, "l_quantity"), 5)).join(own, F.col("l_orderkey") == F.col("o_orderkey"))
    lines = lines.select(F.when(F.col("l_returnflag") != "N", F.year("l_shipdate")).alias("year"))
    counts = G.group_count(lines, "year", n=10, unknown=G.UNKNOWN)
    return counts.select("key", F.lit("NATION_3").alias("nation"), "count")


@query("group_by_scalar", f"select c_mktsegment as key, {_N} from customer group by 1 order by 2 desc, 1 limit 200")
def group_scalar(t):
    return G.group_count(t.customer, "c_mktsegment")


@query("group_by_many_keys_top", f"select l_partkey as key, {_N} from lineitem group by 1 order by 2 desc, 1 limit 200")
def group_many_keys(t):
    return G.group_count(t.lineitem, "l_partkey")


@query("group_by_array", with_works(f"select key, {_N} from (select unnest(list_distinct(list_transform(sentences, lambda s: s.opener))) as key from works) group by 1 order by 2 desc, 1 limit 200"))
def group_array(t):
    return G.group_count(t.works, "sentences.opener")


@query("group_by_array_with_unknown", with_works(f"""
select key, {_N} from (select unnest(case when len(m) = 0 then ['unknown'] else m end) as key from (
  select list_distinct(list_filter(list_transform(sentences, lambda s: s.mark), lambda x: x is not null)) as m from works)) group by 1 order by 2 desc, 1 limit 200"""))
def group_array_unknown(t):
    return G.group_count(t.works, "sentences.mark", unknown=G.UNKNOWN)


@query("group_by_scalar_with_unknown", f"select coalesce(nullif(l_returnflag, 'N'), 'unknown') as key, {_N} from lineitem group by 1")
def group_scalar_unknown(t):
    return G.group_count(t.lineitem.select(F.nullif(F.col("l_returnflag"), F.lit("N")).alias("flag")), "flag", unknown=G.UNKNOWN)


@query("group_by_sorted_by_key", f"select c_nationkey as key, {_N} from customer group by 1 order by 1 desc limit 10")
def group_sorted(t):
    return G.group_count(t.customer, "c_nationkey", n=10, sort="key")


@query("group_by_sorted_by_count_up", f"select c_nationkey as key, {_N} from customer group by 1 order by 2, 1 limit 10")
def group_sorted_up(t):
    return G.group_count(t.customer, "c_nationkey", n=10, desc=False)


@query("group_by_presence", with_works("""
select case when has_mark then 'true' else 'false' end as key, cast(count(*) as bigint) as count from (
  select len(list_filter(sentences, lambda s: s.mark is not null)) > 0 as has_mark from works) group by 1"""))
def group_presence(t):
    return G.group_presence(t.works, "sentences.mark")


@query("group_by_flag", """
select 'true' as key, cast(count(*) filter (where o_totalprice > 300000) as bigint) as count from orders union all
select 'false', cast(count(*) filter (where o_totalprice < 100000) as bigint) from orders""")
def group_flag(t):
    price = leaf(t.orders, "o_totalprice")
    return G.group_flag(t.orders, P.cmp(price, ">", 300000), P.cmp(price, "<", 100000))


@query("group_by_continent", f"""
with places as (select n_nationkey as code, r_name as continent from nation join region on n_regionkey = r_regionkey),
 cells as (select l_orderkey, nullif(s_nationkey, 5) as code from lineitem join supplier on l_suppkey = s_suppkey)
select continent as key, cast(count(code) as bigint) as count from (select r_name as continent from region) left join (select l_orderkey, code, continent as c from cells join places using (code)) on c = continent group by 1
union all select 'unknown', cast(count(*) as bigint) from cells where code is null having count(*) > 0""")
def group_continent(t):
    cells = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(F.nullif(F.col("s_nationkey"), F.lit(5)).alias("code"))
    return G.group_continent(cells, "code", continent_table(t))


@query("group_by_continent_of_arrays", """
with places as (select n_nationkey as code, r_name as continent from nation join region on n_regionkey = r_regionkey),
 cells as (select distinct c_custkey, continent from (select c_custkey, unnest(case when c_acctbal < 0 then [] when c_acctbal < 1000 then [c_nationkey] else [c_nationkey, c_nationkey // 2, c_nationkey // 3] end) as code from customer) join places using (code))
select r_name as key, cast(count(c_custkey) as bigint) as count from region left join cells on continent = r_name group by 1
union all select 'unknown', cast(count(*) as bigint) from customer where c_acctbal < 0 having count(*) > 0""")
def group_continent_arrays(t):
    k = F.col("c_nationkey")
    codes = F.when(F.col("c_acctbal") < 0, F.array().cast("array<int>")).when(F.col("c_acctbal") < 1000, F.array(k)).otherwise(F.array(k, (k / 2).cast("int"), (k / 3).cast("int")))
    return G.group_continent(t.customer.select(codes.alias("codes")), "codes", continent_table(t))


@query("group_by_classes", with_works("""
select 'any' as key, cast(count(*) filter (where len(list_filter(sentences, lambda s: s.mark is not null)) > 0) as bigint) as count from works
union all select 'comma', cast(count(*) filter (where len(list_filter(sentences, lambda s: s.mark = ',')) > 0) as bigint) from works
union all select 'unknown', cast(count(*) filter (where len(list_filter(sentences, lambda s: s.mark is not null)) = 0) as bigint) from works"""))
def group_classes(t):
    mark = leaf(t.works, "sentences.mark")
    return G.group_classes(t.works, {"any": P.not_null(mark), "comma": P.version(mark, ","), "unknown": P.version(mark, None)})


@query("group_by_zero_filled", "select n_nationkey as key, cast(count(s_suppkey) as bigint) as count from nation left join supplier on n_nationkey = s_nationkey and s_acctbal > 9000 group by 1")
def group_zero_filled(t):
    counts = G.all_groups(t.supplier.where("s_acctbal > 9000"), "s_nationkey")
    return G.zero_fill(counts, t.nation.select(F.col("n_nationkey").alias("key")))


@query("group_by_canonical_key", f"select lower(c_mktsegment) as key, {_N} from customer group by 1")
def group_canonical(t):
    seg = F.col("c_mktsegment")
    spelled = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("https://example.org/segments/"), seg)).when(F.col("c_custkey") % 3 == 1, F.lower(seg)).otherwise(F.concat(F.lit("segments/"), seg))
    return G.group_count(t.customer, value(ids.ext_id(spelled, "segments")))


@query("group_keep_prefix", f"select key, count from (select coalesce(nullif(p_type, 'PROMO'), 'unknown') as key, {_N} from part group by 1) where key like 'S%' or key = 'unknown'")
def group_keep_prefix(t):
    counts = G.all_groups(t.part.select(F.nullif(F.col("p_type"), F.lit("PROMO")).alias("kind")), "kind", unknown=G.UNKNOWN)
    return G.keep_prefix(counts, "S")


@query("group_require_name", f"select l_partkey as key, p_name as key_display_name, {_N} from lineitem join part on l_partkey = p_partkey where p_size > 30 group by 1, 2")
def group_require_name(t):
    return G.require_name(G.all_groups(t.lineitem, "l_partkey"), t.part.where("p_size > 30"), "p_partkey", "p_name")


@query("group_by_several", """
select 'o_orderstatus' as facet, o_orderstatus as key, cast(count(*) as bigint) as count from orders group by 2
union all select 'o_orderpriority', o_orderpriority, cast(count(*) as bigint) from orders group by 2
union all (select 'o_custkey', o_custkey::varchar, cast(count(*) as bigint) as c from orders group by 2 order by 3 desc, 2 limit 20)""")
def group_several(t):
    return G.group_many(t.orders, ["o_orderstatus", "o_orderpriority", "o_custkey"], n=20)


@query("group_by_several_arrays", with_works("""
select 'lang' as facet, lang as key, cast(count(*) as bigint) as count from works group by 2
union all select 'source.name', coalesce(source.name, 'unknown'), cast(count(*) as bigint) from works group by 2
union all (select 'sentences.opener', key, cast(count(*) as bigint) as c from (select unnest(list_distinct(list_transform(sentences, lambda s: s.opener))) as key from works) group by 2 order by 3 desc, 2 limit 25)"""))
def group_several_arrays(t):
    return G.group_many(t.works, ["lang", "source.name", "sentences.opener"], n=25, unknown=G.UNKNOWN)


@query("group_search_by_name", f"select c_nationkey as key, n_name as key_display_name, {_N} from customer join nation on c_nationkey = n_nationkey where contains(lower(n_name), 'on_1') group by 1, 2")
def group_search(t):
    named = J.with_names(G.all_groups(t.customer, "c_nationkey"), [(t.nation, "n_nationkey", "n_name")])
    return G.facet_search(named, "ON_1")


@query("group_search_all_words", f"select l_partkey as key, p_name as key_display_name, {_N} from lineitem join part on l_partkey = p_partkey where contains(lower(p_name), 'bolt') and contains(lower(p_name), 'blue') group by 1, 2")
def group_search_words(t):
    named = G.require_name(G.all_groups(t.lineitem, "l_partkey"), t.part, "p_partkey", "p_name")
    return G.facet_search(named, "bolt BLUE", all_words=True)


@query("group_prefilter", f"""
select 'year' as kind, key, count from (select year(o_orderdate)::varchar as key, {_N} from orders where year(o_orderdate) between 1900 and 1999 group by 1)
union all select 'prefix', key, count from (select p_type as key, {_N} from part where lower(p_type) like 's%' group by 1)
union all select 'name', key, count from (select c_nationkey::varchar as key, {_N} from customer where c_nationkey in (select n_nationkey from nation where upper(n_name) like 'NATION\\_2%' escape '\\') group by 1)""")
def group_prefilter(t):
    years = t.orders.select(F.year("o_orderdate").alias("year"))
    a = G.all_groups(G.facet_prefilter(years, "year", "19", "year"), "year")
    b = G.all_groups(G.facet_prefilter(t.part, "p_type", "S"), "p_type")
    c = G.all_groups(G.facet_prefilter(t.customer, "c_nationkey", "nation_2", "name", t.nation.select("n_nationkey", "n_name")), "c_nationkey")
    parts = [g.select(F.lit(n).alias("kind"), F.col("key").cast("string"), "count") for n, g in (("year", a), ("prefix", b), ("name", c))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("group_prefilter_names_of_arrays", f"""
with {_CODES} select codes[1]::varchar as key, {_N} from cs where list_has_any(codes, (select list(n_nationkey) from nation where upper(n_name) like 'NATION\\_2%' escape '\\')) group by 1""")
def group_prefilter_arrays(t):
    """Records one of whose codes has such a name, through an array."""
    hits = G.facet_prefilter(coded(t), "at.country_code", "nation_2", "name", t.nation.select("n_nationkey", "n_name"))
    return hits.groupBy(F.get("at.country_code", F.lit(0)).cast("string").alias("key")).agg(F.count("*").alias("count"))


@query("group_keyset_pages", f"""
select ((rn - 1) // 30 + 1)::integer as page, key, count from (select l_partkey as key, {_N}, row_number() over (order by l_partkey) as rn from lineitem group by 1) where rn <= 90""")
def group_pages(t):
    counts = G.all_groups(t.lineitem, "l_partkey")
    out, after = None, None
    for page in (1, 2, 3):
        rows = G.group_page(counts, after, 30)
        after = rows.agg(F.max("key")).first()[0]
        rows = rows.select(F.lit(page).alias("page"), "key", "count")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("summary_sums", """
select round(sum(o_totalprice), 2) as apc_list_sum, round(sum(o_totalprice) filter (where o_orderstatus in ('F', 'P')), 2) as apc_paid_sum, cast(sum(o_custkey) as bigint) as cited_by_count_sum from orders""")
def summary_sums(t):
    out = G.meta_sums(t.orders, "o_totalprice", "o_totalprice", "o_orderstatus", "o_custkey", ("F", "P"))
    return out.select(F.round("apc_list_sum", 2).alias("apc_list_sum"), F.round("apc_paid_sum", 2).alias("apc_paid_sum"), "cited_by_count_sum")


def _stats_sql(col):
    cells = ", ".join(f"cast(trunc(quantile_disc({col}, {p / 100})) as bigint) as p{p}" for p in (25, 50, 75))
    return f"select '{col}' as \"column\", {cells}, round(sum({col}), 2) as sum from lineitem"


@query("stats_percentiles_exact", _stats_sql("l_quantity") + " union all " + _stats_sql("l_extendedprice"))
def stats_exact(t):
    out = G.stats(t.lineitem, ["l_quantity", "l_extendedprice"], exact=True)
    return out.withColumn("sum", F.round("sum", 2))


@query("stats_percentiles_approx_bound", "select unnest(['l_quantity', 'l_extendedprice']) as \"column\", true as p25_near, true as p50_near, true as p75_near")
def stats_approx_bound(t):
    """What an approximate percentile keeps: its rank, cut to a whole number, is within a hundredth of the one asked for."""
    found = stored(G.stats(t.lineitem, ["l_quantity", "l_extendedprice"]), "stats")

    def near(c, p):
        at = found.where(F.col("column") == c).select(f"p{p}").scalar()
        below, upto = (F.count_if(x) / F.count(c) for x in (F.col(c) < at, F.col(c) < at + 1))
        return ((below <= p / 100 + 0.01) & (upto >= p / 100 - 0.01)).alias(f"p{p}_near")

    parts = [t.lineitem.agg(F.lit(c).alias("column"), *[near(c, p) for p in (25, 50, 75)]) for c in ("l_quantity", "l_extendedprice")]
    return parts[0].unionByName(parts[1])


@query("stats_percentiles_approx")
def stats_approx(t):
    return G.stats(t.lineitem, ["l_quantity", "l_extendedprice"])


@query("histogram", f"select cast(floor(o_totalprice / 500) * 500 as bigint) as key, {_N} from orders group by 1 having count(*) >= 15")
def histogram(t):
    return G.histogram(t.orders, "o_totalprice")


@query("histogram_with_empty_bins", f"""
with bins as (select cast(floor(o_totalprice / 100) as bigint) as bin, count(*) as n from orders group by 1)
select b * 100 as key, cast(coalesce(n, 0) as bigint) as count from (select unnest(generate_series((select min(bin) from bins), (select max(bin) from bins))) as b) left join bins on b = bin""")
def histogram_empty(t):
    return G.histogram(t.orders, "o_totalprice", 100, min_count=0)


_PAIRS = "(select distinct p_brand, o_orderkey, o_totalprice, o_custkey, o_orderstatus from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey)"
_MEASURES = """cast(count(o_orderkey) as bigint) as works_count, cast(sum(o_custkey) as bigint) as citations_sum, round(avg(o_totalprice), 4) as impact_mean,
 round(count(*) filter (where o_orderstatus in ('F', 'O')) / count(*), 6) as open_share"""


def brand_orders(t):
    return line_orders(t).join(t.part, F.col("l_partkey") == F.col("p_partkey")).select("p_brand", "o_orderkey", "o_totalprice", "o_custkey", "o_orderstatus")


_WORK_COLS = ["o_totalprice", "o_custkey", "o_orderstatus"]


def _measures():
    return G.measures("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", ("F", "O"))


def _rounded(df):
    return df.withColumn("impact_mean", F.round("impact_mean", 4)).withColumn("open_share", F.round("open_share", 6))


@query("entity_metrics", f"select p_brand, {_MEASURES} from {_PAIRS} group by 1")
def entity_metrics(t):
    return _rounded(G.metrics(brand_orders(t), "p_brand", "o_orderkey", _WORK_COLS, _measures()))


@query("entity_metrics_having", f"select p_brand, {_MEASURES} from {_PAIRS} group by 1 having count(*) > 2300 or (avg(o_totalprice) > 252000 and sum(o_custkey) > 1000)")
def entity_metrics_having(t):
    node = {"join": "or", "filters": [
        {"field": "works_count", "op": ">", "value": 2300},
        {"join": "and", "filters": [{"field": "impact_mean", "op": ">", "value": 252000}, {"field": "citations_sum", "op": ">", "value": 1000}]}]}
    return _rounded(G.having(G.metrics(brand_orders(t), "p_brand", "o_orderkey", _WORK_COLS, _measures()), node))


@query("works_summary", f"select {_MEASURES} from orders")
def works_summary(t):
    return _rounded(G.summary(t.orders, _measures()))


@query("works_behind_aggregate", "select o_orderkey, cast(count(distinct l_partkey) as bigint) as entity_count from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey where p_brand = 'Brand#7' group by 1")
def works_behind(t):
    rows = line_orders(t).join(t.part.where("p_brand = 'Brand#7'"), F.col("l_partkey") == F.col("p_partkey"))
    return G.underlying(rows, "l_partkey", "o_orderkey")


@query("distinct_entities", "select distinct p_brand, p_type from lineitem join part on l_partkey = p_partkey")
def distinct_entities(t):
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return G.distinct_entities(rows, ["p_brand", "p_type"])


_CUBE = """cast(count(*) as bigint) as doc_count, round(sum(o_totalprice), 2) as price_sum, cast(count(*) filter (where o_orderstatus = 'F') as bigint) as final_count,
 cast(count(*) filter (where o_orderpriority = '1-URGENT') as bigint) as urgent_count, cast(count(*) filter (where o_totalprice > 400000) as bigint) as top_count"""


def _cube(df):
    def flag(c):
        return c.cast("bigint")

    return G.cube(df, [F.col("c_nationkey"), F.year("o_orderdate").alias("year"), F.col("o_orderpriority")], {
        "price_sum": F.col("o_totalprice"), "final_count": flag(F.col("o_orderstatus") == "F"),
        "urgent_count": flag(F.col("o_orderpriority") == "1-URGENT"), "top_count": flag(F.col("o_totalprice") > 400000)})


_CUBE_SQL = f"select c_nationkey, year(o_orderdate)::integer as year, o_orderpriority, {_CUBE} from orders join customer on o_custkey = c_custkey group by 1, 2, 3"


def _customer_orders(t):
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))


@query("metric_cube", _CUBE_SQL)
def metric_cube(t):
    return _cube(_customer_orders(t)).withColumn("price_sum", F.round("price_sum", 2))


@query("merge_partial_cubes", _CUBE_SQL)
def merge_cubes(t):
    rows = _customer_orders(t)
    first = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    out = G.merge_cubes(_cube(rows.where(first)), _cube(rows.where(~first)), ["c_nationkey", "year", "o_orderpriority"])
    return out.withColumn("price_sum", F.round("price_sum", 2))


@query("type_citation_rollup", "select display_name, cited_by_count from (select coalesce(nullif(p_type, 'SMALL'), 'unknown') as display_name, cast(sum(p_size) as bigint) as cited_by_count from part group by 1) where starts_with(display_name, 'S')")
def type_rollup(t):
    return G.type_rollup(t.part.withColumn("p_type", F.nullif(F.col("p_type"), F.lit("SMALL"))), "p_type", "p_size", "S")


@query("country_citation_rollup", """
select c_nationkey as id, n_name as display_name, cast(sum(c_custkey) as bigint) as cited_by_count from customer join (select n_nationkey, 'Land of ' || n_name as n_name from nation) on c_nationkey = n_nationkey
where starts_with(split_part(upper(n_name), ' ', 3), 'NATION_2') group by 1, 2 order by 3 desc, 1 limit 10""")
def country_rollup(t):
    names = t.nation.select(F.col("n_nationkey").alias("code"), F.concat(F.lit("Land of "), "n_name").alias("name"))
    return G.country_rollup(t.customer, "c_nationkey", "c_custkey", names, "nation_2")


@query("entity_counts", " union all ".join(f"select '{n}' as entity, cast(count(*) as bigint) as count from {n}" for n in TABLE_NAMES))
def entity_counts(t):
    return G.entity_counts({n: getattr(t, n) for n in TABLE_NAMES})


@query("coverage_by_year", "select year(l_shipdate)::integer as year, cast(count(*) filter (where l_returnflag = 'R') as bigint) as with_feature, cast(count(*) as bigint) as total from lineitem group by 1")
def coverage(t):
    return G.coverage(t.lineitem, F.year("l_shipdate"), F.col("l_returnflag") == "R")


_FC = "o_totalprice > 200000 and o_orderstatus in ('F', 'O') and o_orderpriority not in ('5-LOW', '1-URGENT')"


@query("filter_value_counts", f"""
select '' as field, 'all' as value, cast(count(*) as bigint) as count from orders where {_FC}
union all select 'price', '>200000', cast(count(*) as bigint) from orders where {_FC}
union all select 'status', 'F', cast(count(*) as bigint) from orders where {_FC} and o_orderstatus = 'F'
union all select 'status', 'O', cast(count(*) as bigint) from orders where {_FC} and o_orderstatus = 'O'
union all select 'priority', unnest(['5-LOW', '1-URGENT']), cast(0 as bigint)""")
def filter_value_counts(t):
    df = t.orders
    status, priority = leaf(df, "o_orderstatus"), leaf(df, "o_orderpriority")
    return G.filter_counts(df, [
        {"field": "price", "values": {">200000": P.cmp(leaf(df, "o_totalprice"), ">", 200000)}},
        {"field": "status", "values": {v: P.eq(status, v) for v in ("F", "O")}},
        {"field": "priority", "values": {v: P.eq(priority, v) for v in ("5-LOW", "1-URGENT")}, "negate": True}])


def part_edges(t):
    """A tree over parts: the parent of k is k div 4, and key 0 is the root."""
    return t.part.where("p_partkey > 0").select(F.col("p_partkey").alias("child"), F.floor(F.col("p_partkey") / 4).alias("parent"))


PART_TREE = """recursive up(node, ancestor) as (select p_partkey, p_partkey // 4 from part where p_partkey > 0
  union all select node, ancestor // 4 from up where ancestor > 0)"""


@query("descendant_counts", f"with {PART_TREE} select ancestor as node, cast(count(distinct node) as bigint) as descendants from up group by 1")
def descendant_counts(t):
    return trees.descendants(part_edges(t))


@query("tree_lineage", f"with {PART_TREE} select distinct node, ancestor from (select node, ancestor from up union all select p_partkey, p_partkey from part) where ancestor not in (select p_partkey from part where p_type = 'PROMO')")
def tree_lineage(t):
    return trees.lineage(part_edges(t), t.part.where("p_type = 'PROMO'").select("p_partkey"))


@query("parents_one_level_up", """
select p_partkey, case when p_size % 4 > 0 then array_to_string(list_sort(list_distinct([(p_partkey * 10 + p_size % 4 - 1)::varchar, (p_size * 10 + p_size % 4 - 1)::varchar])), ',') end as parents from part""")
def parents_up(t):
    level = F.col("p_size") % 4
    chain = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda v: F.struct((F.col("p_partkey") * 10 + v).alias("id"), v.alias("level")))
    other = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda v: F.struct((F.col("p_size") * 10 + v).cast("bigint").alias("id"), v.alias("level")))
    ancestors = F.array_distinct(F.filter(F.concat(chain, other), lambda a: a["level"] < level))
    return t.part.select("p_partkey", trees.parents(ancestors, level).alias("parents"))
