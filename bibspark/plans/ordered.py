"""Windows, sorts, pages, samples."""

from pyspark.sql import functions as F

from bibspark.operators import paging as S
from bibspark.plans.registry import query


@query("latest_row_per_key", "select o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) as o_orderkey from orders group by 1")
def latest_row(t):
    return S.best_per_key(t.orders, "o_custkey", ["-o_orderdate", "-o_orderkey"]).select("o_custkey", "o_orderkey")


@query("top_rows_per_key", """
select l_orderkey, l_partkey, l_extendedprice, rank::integer as rank from (
  select *, row_number() over (partition by l_orderkey order by l_extendedprice desc, l_partkey) as rank from lineitem) where rank <= 2""")
def top_rows(t):
    return S.best_per_key(t.lineitem, "l_orderkey", ["-l_extendedprice", "l_partkey"], 2, "rank").select("l_orderkey", "l_partkey", "l_extendedprice", "rank")


@query("sort_nulls_last", "select o_orderkey, nullif(o_totalprice, 499978.59) as price from orders order by 2 desc nulls last, 1")
def sort_nulls_last(t):
    df = t.orders.select("o_orderkey", F.nullif(F.col("o_totalprice"), F.lit(499978.59)).alias("price"))
    return S.sort(df, ["-price", "o_orderkey"])


@query("page_by_offset", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 25 offset 50")
def page_by_offset(t):
    return S.page(t.orders, ["-o_totalprice", "o_orderkey"], 3, 25).select("o_orderkey", "o_totalprice")


@query("page_total", "select cast(count(*) as bigint) as count from orders where o_totalprice > 100000")
def page_total(t):
    return S.total(t.orders.where("o_totalprice > 100000"))


@query("page_by_cursor", """
select o_orderkey, status, day from (select o_orderkey, nullif(o_orderstatus, 'O') as status, strftime(o_orderdate, '%Y-%m-%d') as day from orders)
order by status nulls last, day desc nulls last, o_orderkey limit 50 offset 50""")
def page_by_cursor(t):
    df = t.orders.select("o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("O")).alias("status"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    keys = ["status", "-day", "o_orderkey"]
    first = S.after(df, keys, None, 50)
    return S.after(df, keys, S.cursor_of(first, keys), 50).select("o_orderkey", "status", "day")


@query("page_by_cursor_in_nulls", """
select o_orderkey, status, day from (select o_orderkey, nullif(o_orderstatus, 'O') as status, strftime(o_orderdate, '%Y-%m-%d') as day from orders)
where status is null and (day < '1998-01-01' or (day = '1998-01-01' and o_orderkey > 100)) order by day desc, o_orderkey limit 50""")
def page_by_cursor_nulls(t):
    df = t.orders.select("o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("O")).alias("status"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    return S.after(df, ["status", "-day", "o_orderkey"], [None, "1998-01-01", 100], 50).select("o_orderkey", "status", "day")


@query("random_sample", "select o_orderkey, o_custkey from orders order by md5(o_orderkey || ':7'), o_orderkey limit 100")
def random_sample(t):
    return S.sample(t.orders, "o_orderkey", 100, seed=7).select("o_orderkey", "o_custkey")


@query("random_row_per_band", "select (year(o_orderdate) // 2 * 2)::integer as band, arg_min(o_orderkey, (md5(o_orderkey || ':3'), o_orderkey)) as o_orderkey from orders group by 1")
def random_bands(t):
    band = (F.floor(F.year("o_orderdate") / 2) * 2).cast("int")
    return S.sample_bands(t.orders, "o_orderkey", band, seed=3).select("band", "o_orderkey")


@query("top_k", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 10")
def top_k(t):
    return S.top_k(t.orders, ["-o_totalprice", "o_orderkey"], 10).select("o_orderkey", "o_totalprice")


@query("inject_candidates", """
with a as (select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 40),
 b as (select o_orderkey, o_totalprice from orders where o_orderpriority = '1-URGENT' order by o_totalprice desc, o_orderkey limit 40)
select * from a union all select * from b where o_orderkey not in (select o_orderkey from a)""")
def inject(t):
    df = t.orders.select("o_orderkey", "o_totalprice", "o_orderpriority")
    keys = ["-o_totalprice", "o_orderkey"]
    a = S.top_k(df, keys, 40).select("o_orderkey", "o_totalprice")
    b = S.top_k(df.where("o_orderpriority = '1-URGENT'"), keys, 40).select("o_orderkey", "o_totalprice")
    return S.inject(a, b, "o_orderkey")
