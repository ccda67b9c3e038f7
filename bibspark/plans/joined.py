"""Joins, bridges, citations and lookups."""

from pyspark.sql import functions as F

from bibspark.functions import ids
from bibspark.operators import groups as G
from bibspark.operators import joins as J
from bibspark.plans.registry import query


def line_orders(t):
    """Lines with their order: the bridge between customers, orders, parts and suppliers."""
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))


@query("join_entity_works", """
select c_custkey, cast(count(*) as bigint) as lines, round(sum(l_quantity), 2) as quantity
from customer join orders on c_custkey = o_custkey join lineitem on o_orderkey = l_orderkey group by 1""")
def entity_works(t):
    rows = J.entity_works(t.customer, t.orders, t.lineitem, ("c_custkey", "o_custkey"), ("o_orderkey", "l_orderkey"))
    return rows.groupBy("c_custkey").agg(F.count("*").alias("lines"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


@query("join_left_attach", "select c_custkey, cast(count(o_orderkey) as bigint) as orders from customer left join orders on c_custkey = o_custkey group by 1")
def left_attach(t):
    return J.left_attach(t.customer, t.orders, "c_custkey", "o_custkey").groupBy("c_custkey").agg(F.count("o_orderkey").alias("orders"))


@query("join_co_members", """
select o_custkey, cast(count(distinct l_partkey) as bigint) as shared from orders join lineitem on o_orderkey = l_orderkey
where o_custkey <> 11 and l_partkey in (select l_partkey from orders join lineitem on o_orderkey = l_orderkey where o_custkey = 11) group by 1""")
def co_members(t):
    return J.co_members(line_orders(t).select("o_custkey", "l_partkey"), "o_custkey", "l_partkey", 11)


_BRAND = "(select l_orderkey from lineitem join part on l_partkey = p_partkey where p_brand = 'Brand#7')"


@query("join_exists_in_bridge", f"select o_orderkey, o_totalprice from orders where o_orderkey in {_BRAND}")
def exists_in(t):
    bridge = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "p_brand")
    return J.exists_in(t.orders, bridge, "o_orderkey", "l_orderkey", F.col("p_brand") == "Brand#7").select("o_orderkey", "o_totalprice")


@query("join_not_in_bridge", f"select o_orderkey, o_totalprice from orders where o_orderkey not in {_BRAND}")
def not_in(t):
    bridge = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "p_brand")
    return J.not_in(t.orders, bridge, "o_orderkey", "l_orderkey", F.col("p_brand") == "Brand#7").select("o_orderkey", "o_totalprice")


@query("join_display_names", "select c_nationkey as key, n_name as key_display_name, cast(count(*) as bigint) as count from customer join nation on c_nationkey = n_nationkey group by 1, 2")
def display_names(t):
    return J.with_names(G.all_groups(t.customer, "c_nationkey"), [(t.nation, "n_nationkey", "n_name")])


@query("join_display_names_two_kinds", """
select k as key, coalesce(c_name, s_name, 'unknown') as key_display_name, cast(count(*) as bigint) as count
from (select case when l_linenumber % 2 = 0 then 'C' || o_custkey else 'S' || l_suppkey end as k from lineitem join orders on l_orderkey = o_orderkey)
left join customer on k = 'C' || c_custkey left join (select * from supplier where s_suppkey <> 3) on k = 'S' || s_suppkey group by 1, 2""")
def display_names_two_kinds(t):
    key = F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("C"), "o_custkey")).otherwise(F.concat(F.lit("S"), "l_suppkey"))
    counts = G.all_groups(line_orders(t).select(key.alias("host")), "host")
    people = t.customer.select(F.concat(F.lit("C"), "c_custkey").alias("id"), "c_name")
    firms = t.supplier.where("s_suppkey <> 3").select(F.concat(F.lit("S"), "s_suppkey").alias("id"), "s_name")
    return J.with_names(counts, [(people, "id", "c_name"), (firms, "id", "s_name")], "unknown")


def edges(t):
    """Citation edges: an order cites the order whose key is the part key of one of its lines."""
    return t.lineitem.select(F.col("l_orderkey").alias("citing"), F.col("l_partkey").alias("cited")).distinct()


EDGES = "edges as (select distinct l_orderkey as citing, l_partkey as cited from lineitem)"


@query("citations_incoming", "select o_orderkey as id, o_custkey from orders where o_orderkey in (select l_orderkey from lineitem where l_partkey = 42)")
def cites(t):
    works = t.orders.select(F.col("o_orderkey").alias("id"), "o_custkey")
    return J.cites(works, edges(t), 42)


@query("citations_outgoing", "select o_orderkey as id, o_custkey from orders where o_orderkey in (select l_partkey from lineitem where l_orderkey = 42)")
def cited_by(t):
    works = t.orders.select(F.col("o_orderkey").alias("id"), "o_custkey")
    return J.cited_by(works, edges(t), 42)


@query("citations_related", "select p_partkey as id, p_name from part where p_partkey in (select l_partkey from lineitem where l_suppkey = 42)")
def related_to(t):
    related = t.lineitem.select(F.col("l_suppkey").alias("id"), F.col("l_partkey").alias("related_id"))
    return J.related_to(t.part.select(F.col("p_partkey").alias("id"), "p_name"), related, 42)


@query("hydrate_ranked", """
select o_orderkey, o_custkey, round(score, 2) as score from (select l_orderkey as k, sum(l_extendedprice) as score from lineitem group by 1 order by 2 desc, 1 limit 50) join orders on k = o_orderkey""")
def hydrate(t):
    ranked = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_extendedprice").alias("score")).orderBy(F.desc("score"), "o_orderkey").limit(50)
    return J.hydrate(ranked, t.orders, "o_orderkey").select("o_orderkey", "o_custkey", F.round("score", 2).alias("score"))


@query("multi_get", """
select position, asked, c_name from (select unnest([0, 1, 2, 3, 4])::integer as position, unnest(['7', '99999999', '3', '12', '1']) as asked) left join customer on asked = c_custkey::varchar""")
def multi_get(t):
    return J.multi_get(t.customer, "c_custkey", ["7", "99999999", "3", "12", "1"]).select("position", "asked", "c_name")


@query("lookup_any_spelling", """
with recursive hop as (select p_partkey as id, p_partkey as cur, 0 as d from part
  union all select id, cur // 2, d + 1 from hop where cur % 4 = 0 and cur > 0)
select spelled as asked, o_orderkey, o_custkey from (
  select case when id % 2 = 0 then 'works/W1000' || id else 'https://example.org/w1000' || id end as spelled, arg_max(cur, d) as e from hop group by id, 1)
left join orders on o_orderkey = e""")
def lookup(t):
    # part keys divisible by four were merged into their half, and so on down the chain
    k = F.col("p_partkey")
    spelled = F.when(k % 2 == 0, F.concat(F.lit("works/W1000"), k)).otherwise(F.concat(F.lit("https://example.org/w1000"), k))
    half = (k / 2).cast("bigint")
    merged = t.part.where("p_partkey % 4 = 0 and p_partkey > 0").select(F.concat(F.lit("W1000"), k).alias("id"), F.concat(F.lit("W1000"), half).alias("merge_into_id"))
    works = t.orders.select(F.concat(F.lit("W1000"), "o_orderkey").alias("id"), "o_orderkey", "o_custkey")
    return J.lookup(works, "id", t.part.select(spelled.alias("asked")), ids.norm_catalog, merged).select("asked", "o_orderkey", "o_custkey")


@query("ids_present_in_tables", """
select 'lineitem' as "table", cast(count(*) filter (where o_orderkey in (select l_orderkey from lineitem)) as bigint) as present, cast(count(*) filter (where o_orderkey not in (select l_orderkey from lineitem)) as bigint) as absent from orders
union all select 'part', cast(count(*) filter (where o_orderkey in (select p_partkey from part)) as bigint), cast(count(*) filter (where o_orderkey not in (select p_partkey from part)) as bigint) from orders""")
def present_in(t):
    return J.present_in(t.orders.select("o_orderkey"), "o_orderkey", {"lineitem": (t.lineitem, "l_orderkey"), "part": (t.part, "p_partkey")})
