"""Sources, sinks, load jobs and projection."""

from pyspark.sql import functions as F

from bibspark.functions import ids
from bibspark.functions.paths import leaf
from bibspark.operators import predicates as P
from bibspark.operators import project, upkeep
from bibspark.plans.registry import query, with_works
from bibspark.session import scratch
from bibspark.sources import exports, snapshot

_EVENT = "event_id bigint, user_id bigint, event_type string, value double, props string"


@query("snapshot_round_trip", "select event_id, user_id, event_type, round(value, 4) as value, props, strftime(ts, '%Y-%m-%d') as day from events")
def snapshot_round_trip(t):
    root = scratch(t.spark, "snapshot")
    snapshot.write_snapshot(t.events, root, "events", "ts")
    df = snapshot.read_snapshot(t.spark, root, "events", _EVENT + ", updated_date date")
    return df.select("event_id", "user_id", "event_type", F.round("value", 4).alias("value"), "props", F.date_format("updated_date", "yyyy-MM-dd").alias("day"))


@query("snapshot_since_date", "select event_id, strftime(ts, '%Y-%m-%d') as day from events where cast(ts as date) > date '2024-01-20'")
def snapshot_since(t):
    root = scratch(t.spark, "snapshot")
    snapshot.write_snapshot(t.events, root, "events", "ts")
    df = snapshot.read_snapshot(t.spark, root, "events", _EVENT + ", updated_date date", since="2024-01-20")
    return df.select("event_id", F.date_format("updated_date", "yyyy-MM-dd").alias("day"))


@query("snapshot_entities", "select 'events' as entity, cast(count(distinct cast(ts as date)) as bigint) as n_folders from events union all select distinct 'suppliers', cast(1 as bigint) from supplier")
def snapshot_entities(t):
    root = scratch(t.spark, "snapshot")
    snapshot.write_snapshot(t.events, root, "events", "ts")
    snapshot.write_snapshot(t.supplier, root, "suppliers")
    folder = F.regexp_extract("path", "updated_date=([^/]+)", 1)
    return snapshot.list_files(t.spark, root).groupBy("entity").agg(F.count_distinct(folder).alias("n_folders"))


# every fifth record gets a copy cut short in the middle, the way a broken upload would look
_BROKEN = "case when event_id % 5 = 0 then substr(props, 1, length(props) - 1) else '{\"id\": ' || event_id || ', \"p\": ' || props || '}' end"


@query("land_json_good_and_rejects", """
select case when event_id % 5 = 0 then 'reject' else 'good' end as kind, cast(count(*) as bigint) as n,
  min(case when event_id % 5 <> 0 then event_id::varchar end) as first_id from events group by 1""")
def land_json(t):
    good, bad = snapshot.land(t.events.selectExpr(f"{_BROKEN} as value"))
    return good.agg(F.lit("good").alias("kind"), F.count("*").alias("n"), F.min("id").alias("first_id")).unionByName(
        bad.agg(F.lit("reject").alias("kind"), F.count("*").alias("n"), F.lit(None).cast("string").alias("first_id"))
    )


@query("load_only_new_files", """
select case when day(ts) <= 15 then 0 else 1 end as load, cast(count(*) as bigint) as n, cast(count(distinct event_id) as bigint) as ids, cast(0 as bigint) as files_third_time
from events group by 1""")
def load_new_files(t):
    root, ledger, out = (scratch(t.spark, n) for n in ("incoming", "ledger", "landed"))
    first = F.dayofmonth("ts") <= 15
    snapshot.write_snapshot(t.events.where(first), f"{root}/a", "events", "ts")
    snapshot.load_new(t.spark, root, ledger, out, "$.event_id")
    snapshot.write_snapshot(t.events.where(~first), f"{root}/b", "events", "ts")
    snapshot.load_new(t.spark, root, ledger, out, "$.event_id")
    again = snapshot.load_new(t.spark, root, ledger, out, "$.event_id")
    rows = t.spark.read.parquet(out).where("kind = 'good'")
    return rows.groupBy("load").agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids"), F.lit(again).cast("bigint").alias("files_third_time"))


@query("latest_version_per_key", "select user_id, arg_max(event_id, (ts, event_id)) as event_id, arg_max(event_type, (ts, event_id)) as event_type from events group by 1")
def latest_version(t):
    return upkeep.latest_by(t.events, "user_id", "ts", ["event_id"]).select("user_id", "event_id", "event_type")


@query("apply_daily_delta", "select user_id, arg_max(event_id, (ts, event_id)) as event_id, arg_max(round(value, 4), (ts, event_id)) as value from events group by 1")
def daily_delta(t):
    base = t.events.where("ts < timestamp_ntz '2024-01-21'")
    delta = upkeep.changed_since(t.events, "ts", "2024-01-21").unionByName(t.events.where("ts = timestamp_ntz '2024-01-21'"))
    out = upkeep.apply_delta(base, delta, "user_id", "ts", ["event_id"])
    return out.select("user_id", "event_id", F.round("value", 4).alias("value"))


@query("drop_merged_ids", "select o_orderkey, o_custkey from orders where o_orderkey not in (select l_orderkey from lineitem where l_quantity = 50)")
def drop_merged(t):
    merged = t.lineitem.where("l_quantity = 50").select(F.col("l_orderkey").alias("id"))
    return upkeep.drop_merged(t.orders.select("o_orderkey", "o_custkey"), "o_orderkey", merged)


@query("merge_ledger_add_remove", """
select p_partkey as id, case when p_size > 40 then p_size + 100000 else p_size end as merge_into_id from part
where (p_size <= 10 or p_size > 40) and p_brand <> 'Brand#3'""")
def merge_ledger(t):
    pair = [F.col("p_partkey").alias("id"), F.col("p_size").alias("merge_into_id")]
    log = t.part.where("p_size <= 10 or p_size > 45").select(*pair)
    add = t.part.where("p_size > 40").select("p_partkey", (F.col("p_size") + 100000).alias("p_size")).select(*pair)
    return upkeep.merge_log(log, add, t.part.where("p_brand = 'Brand#3'").select(pair[0]))


@query("remove_older_duplicates", """
select event_id, strftime(case when event_type = 'click' then ts + interval 1 hour else ts end, '%Y-%m-%d %H:%M:%S') as ts, cast(1 as bigint) as n from events where event_type <> 'view'
union all select event_id, strftime(ts + to_hours(h), '%Y-%m-%d %H:%M:%S'), cast(1 as bigint) from events, (select unnest([0, 1, 2])::bigint as h) where event_type = 'view'""")
def older_duplicates(t):
    hours = F.when(F.col("event_type") == "click", F.array(F.lit(0), F.lit(1))).when(F.col("event_type") == "view", F.array(F.lit(0), F.lit(1), F.lit(2))).otherwise(F.array(F.lit(0)))
    copies = t.events.select("event_id", "ts", F.explode(hours).alias("h")).select("event_id", (F.col("ts") + F.make_dt_interval(hours="h")).alias("ts"))
    return upkeep.remove_duplicates(copies, "event_id", "ts").select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), F.lit(1).cast("bigint").alias("n"))


@query("remove_all_older_duplicates", "select event_id, strftime(ts + interval 2 hour, '%Y-%m-%d %H:%M:%S') as ts from events")
def all_older_duplicates(t):
    copies = t.events.select("event_id", "ts", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("h")).select("event_id", (F.col("ts") + F.make_dt_interval(hours="h")).alias("ts"))
    return upkeep.remove_duplicates(copies, "event_id", "ts", only_pairs=False).select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"))


@query("remove_empty_records", "select nullif(c_nationkey, 4) as id, nullif(c_mktsegment, 'BUILDING') as name, c_name from customer where not (c_nationkey = 4 and c_mktsegment = 'BUILDING')")
def empty_records(t):
    df = t.customer.select(F.nullif(F.col("c_nationkey"), F.lit(4)).alias("id"), F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("name"), "c_name")
    return upkeep.remove_empty(df, "id", "name")


@query("clear_field", "select p_partkey, cast(null as integer) as p_size from part")
def clear_field(t):
    return upkeep.clear_field(t.part, "p_size").select("p_partkey", "p_size")


@query("seed_subset_table", "select c_custkey, c_nationkey, c_name from customer where c_nationkey = 12 or contains(lower(c_name), '77')")
def seed_subset(t):
    df = t.customer
    pred = P.any_of(P.eq(leaf(df, "c_nationkey"), 12), P.contains(leaf(df, "c_name"), "77"))
    return upkeep.seed(df, pred, scratch(t.spark, "seed"), sort=["c_custkey"]).select("c_custkey", "c_nationkey", "c_name")


@query("flatten_nested_records", with_works("""
select id, lang, coalesce(source.name, 'none') as source_name, cited_by_count, len(sentences) as n_sentences,
  array_to_string(list_sort(list_distinct(list_filter(list_transform(sentences, lambda s: s.mark), lambda m: m is not null))), ' ') as marks,
  len(list_distinct(flatten(list_transform(sentences, lambda s: s.terms)))) as n_terms
from works"""))
def flatten_nested(t):
    flat = upkeep.flatten(t.works, {
        "id": "id", "lang": "lang", "source_name": F.coalesce("source.name", F.lit("none")), "cited_by_count": "cited_by_count",
        "n_sentences": F.size("sentences"), "marks": "sentences.mark", "terms": "sentences.terms"})
    return flat.select("id", "lang", "source_name", "cited_by_count", F.col("n_sentences").cast("bigint"), F.array_join(F.array_sort("marks"), " ").alias("marks"), F.size("terms").cast("bigint").alias("n_terms"))


@query("flatten_json_records", "select event_id, cast(props->>'$.k' as bigint) as k from events")
def flatten_json(t):
    raw = t.events.select("event_id", F.try_parse_json("props").alias("raw"))
    return upkeep.flatten(raw, {"event_id": "event_id", "k": F.try_variant_get("raw", "$.k", "bigint")})


@query("stale_partitions", """
select strftime(ts, '%Y-%m-%d') as day, cast(count(distinct event_id) as bigint) as n_raw, cast(count(distinct event_id) filter (where event_type <> 'click') as bigint) as n_flat
from events where true group by 1 having count(distinct event_id) - count(distinct event_id) filter (where event_type <> 'click') > 10""")
def stale(t):
    df = t.events.select("event_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    return upkeep.stale_partitions(df, df.where("event_type <> 'click'"), "day", "event_id", 10)


@query("normalise_to_tables", with_works("""
select id, s.no - 1 as position, s.words as words, s.opener as opener, coalesce(s.mark, '') as mark from (select id, unnest(sentences) as s from works)"""))
def normalise(t):
    child = upkeep.normalise(t.works, "id", {"sentences": "sentences"})["sentences"]
    return child.select("id", F.col("position").cast("bigint"), F.col("words").cast("bigint"), "opener", F.coalesce("mark", F.lit("")).alias("mark"))


@query("first_related_element", with_works("""
select id, list_filter(sentences, lambda s: s.words > 12)[1].opener as long_opener from works"""))
def first_related(t):
    return t.works.select("id", upkeep.first_related(F.col("sentences"), lambda s: s["words"] > 12, "opener").alias("long_opener"))


@query("export_groups_wide", """
with a as (select o_orderstatus as k, count(*) as n, row_number() over (order by count(*) desc, o_orderstatus) as row from orders group by 1),
 b as (select o_orderpriority as k, count(*) as n, row_number() over (order by count(*) desc, o_orderpriority) as row from orders group by 1)
select coalesce(a.row, b.row)::integer as row, a.k as status_name, a.n::bigint as status_count, case when a.k is not null then '' end as status_blank,
  b.k as priority_name, b.n::bigint as priority_count, case when b.k is not null then '' end as priority_blank from a full join b on a.row = b.row""")
def export_groups_wide(t):
    def counts(col):
        return t.orders.groupBy(F.col(col).alias("key")).agg(F.count("*").alias("count"))

    return exports.export_groups({"status": counts("o_orderstatus"), "priority": counts("o_orderpriority")})


@query("export_locations", """
select page_id::varchar as id, u as url from (select page_id, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) as u from pages where page_id % 7 <> 0)""")
def export_locations(t):
    # some ids are spelled badly and must be left out
    spelled = F.concat(F.when(F.col("page_id") % 7 == 0, F.lit("https://example.org/Wx")).otherwise(F.lit("https://example.org/W")), F.col("page_id"))
    df = t.pages.select(spelled.alias("id"), F.regexp_extract_all("html", F.lit('href="([^"]+)"'), F.lit(1)).alias("urls"))
    return exports.export_locations(df, "id", F.col("urls"), r"^https://example.org/W(\d+)$")


@query("export_scores_wide", "select l_orderkey, " + ", ".join(f"max(l_quantity) filter (where l_linenumber = {n}) as score_{n}" for n in range(1, 8)) + " from lineitem group by 1")
def export_scores(t):
    return exports.pivot_scores(t.lineitem.withColumnRenamed("l_quantity", "score"), "l_orderkey", "l_linenumber", "score", list(range(1, 8)))


@query("json_profile", """
select k as key, 'BIGINT' as type, cast(count(*) as bigint) as n, min(props->>('$.' || k)) as example
from (select props, unnest(json_keys(props)) as k from events) group by 1""")
def json_profile(t):
    return snapshot.profile(t.events, "props")


@query("json_profile_schema", "select 'OBJECT<' || string_agg(k || ': BIGINT', ', ' order by k) || '>' as schema from (select distinct unnest(json_keys(props)) as k from events)")
def json_profile_schema(t):
    return snapshot.profile_schema(t.events, "props")


# projection


@query("select_columns", "select o_orderkey, o_orderstatus, o_totalprice from orders")
def select_columns(t):
    return project.select(t.orders, ["o_orderkey", "o_orderstatus", "o_totalprice"])


@query("drop_heavy_columns", "select doc_id, lang, source, n_chars from documents")
def drop_heavy(t):
    return project.drop_heavy(t.documents)


@query("text_to_index_and_back", "select doc_id, md5(text) as digest, length(text) as n from documents")
def index_round_trip(t):
    index = project.index_from_text(t.documents, "doc_id", "text")
    back = index.select("doc_id", project.text_from_index(F.col("index")).alias("text"))
    return back.select("doc_id", F.md5("text").alias("digest"), F.length("text").cast("bigint").alias("n"))


@query("inverted_index", """
select doc_id, word, array_to_string(list(position order by position), ',') as positions
from (select doc_id, unnest(string_split(text, ' ')) as word, generate_subscripts(string_split(text, ' '), 1) - 1 as position from documents) group by 1, 2""")
def inverted_index(t):
    rows = project.word_positions(t.documents, "doc_id", "text")
    return rows.select("doc_id", "word", F.array_join(F.col("positions").cast("array<string>"), ",").alias("positions"))


@query("truncate_long_lists", with_works("""
select id, len(sentences) > 3 as is_sentences_truncated, array_to_string(list_transform(sentences[1:3], lambda s: s.opener), ' ') as openers from works"""))
def truncate_lists(t):
    return project.truncate_list(t.works, "sentences", 3).select("id", "is_sentences_truncated", F.array_join("sentences.opener", " ").alias("openers"))


@query("location_ids", """
select p_partkey, case p_type when 'SMALL' then 'doi' when 'LARGE' then 'pmid' when 'MEDIUM' then 'mag' when 'PROMO' then 'pmh' end || ':' || nullif(p_name, 'red widget') as location_id from part""")
def location_ids(t):
    provenance = F.element_at(F.create_map(*[F.lit(x) for x in ("SMALL", "crossref", "LARGE", "pubmed", "MEDIUM", "mag", "PROMO", "repo", "ECONOMY", "other", "STANDARD", "none")]), F.col("p_type"))
    native = F.when(F.col("p_name") == "red widget", F.lit("")).otherwise(F.col("p_name"))
    return t.part.select("p_partkey", ids.location_id(provenance, native).alias("location_id"))


@query("content_links", """
select o_orderkey, case when o_orderstatus = 'F' then 'https://content.example.org/works/W' || o_orderkey || '.pdf' end as pdf,
 case when o_orderpriority = '1-URGENT' then 'https://content.example.org/works/W' || o_orderkey || '.grobid-xml' end as xml,
 o_orderstatus = 'F' or o_orderpriority = '1-URGENT' as has_any from orders""")
def content_links(t):
    short = F.concat(F.lit("W"), F.col("o_orderkey"))
    links = project.content_urls(short, F.col("o_orderstatus") == "F", F.col("o_orderpriority") == "1-URGENT", "https://content.example.org")
    df = t.orders.select("o_orderkey", links.alias("links"))
    return df.select("o_orderkey", F.col("links.pdf").alias("pdf"), F.col("links.grobid_xml").alias("xml"), F.col("links").isNotNull().alias("has_any"))


@query("hint_text", with_works("""
select id, array_to_string(list_concat(list_transform(sentences, lambda s: s.opener)[1:3], case when len(sentences) > 3 then ['et al.'] else [] end), ', ') as names,
 coalesce(source.name, 'host organization unknown') as host,
 case lang when 'en' then lang || ', UK' when 'fr' then 'French land' when 'es' then null else lang || ', ' || 'land ' || lang end as place
from works"""))
def hint_text(t):
    country_code = F.when(F.col("lang") == "en", "GB").when(F.col("lang") != "es", F.upper("lang"))
    country_name = F.when(F.col("lang") == "fr", "French land").otherwise(F.concat(F.lit("land "), "lang"))
    place = project.place_hint(F.nullif(F.col("lang"), F.lit("fr")), project.country_label(country_code, country_name))
    return t.works.select("id", project.name_hint(F.col("sentences.opener")).alias("names"), project.host_hint(F.col("source.name")).alias("host"), place.alias("place"))


@query("short_ids", """
select o_orderkey, 'W' || o_orderkey as short, 'works/W' || o_orderkey as entity, 'https://example.org/W' || o_orderkey as url, 'sdgs/' || o_custkey as outside from orders""")
def short_ids(t):
    k = F.col("o_orderkey")
    spelled = F.when(k % 3 == 0, F.concat(F.lit("works/w"), k)).when(k % 3 == 1, F.concat(F.lit("https://example.org/W"), k)).otherwise(F.concat(F.lit("W"), k))
    return t.orders.select(
        k,
        ids.short_id(spelled).alias("short"),
        ids.short_id(spelled, "entity").alias("entity"),
        ids.short_id(spelled, "url", "https://example.org/").alias("url"),
        ids.short_id(F.concat(F.lit("https://metadata.un.org/sdgs/"), "o_custkey"), "entity").alias("outside"),
    )
