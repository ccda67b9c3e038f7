"""The registered queries of this folder and the SQL that checks them; each is thin over its operator."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bibspark.llm import ann, chat, decontaminate, lang, mixing, omh, packing, quality, repair, secret_scan, simhash, tokens, trie
from bibspark.llm.common import checkpointed

QUERIES: dict = {}
SQL: dict = {}


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of few rows: some texts are very long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "256")


def query(name: str, *tables: str, sql: str | None = None):
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            small_batches(spark)
            return fn(*[spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet") for table in tables or ("documents",)])

        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return fn

    return add


@query("op1_language_id")
def op1(docs: DataFrame) -> DataFrame:
    return lang.identify(docs)


@query("op2_quality_classifier")
def op2(docs: DataFrame) -> DataFrame:
    return quality.quality(docs)


@query("op3_token_counts")
def op3(docs: DataFrame) -> DataFrame:
    return tokens.histogram(checkpointed(tokens.lengths(docs)))


@query("op4_nearest_neighbours", "embeddings")
def op4(embeddings: DataFrame) -> DataFrame:
    vectors = checkpointed(ann.valid(embeddings))
    return ann.search(vectors, vectors.where("id % 50 = 0"), k=5)


@query("op5_simhash_dedup")
def op5(docs: DataFrame) -> DataFrame:
    return simhash.groups(docs).select("doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


@query("op6_best_fit_packing")
def op6(docs: DataFrame) -> DataFrame:
    cut = tokens.pieces(docs, packing.TOKENS).select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(cut)


@query("op7_secret_scans")
def op7(docs: DataFrame) -> DataFrame:
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["base"])
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
    return secret_scan.secrets(docs).select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(secret_scan.listed(base), 256).alias("base_sha256"), secret_scan.listed(spans).alias("spans"),
    )


@query("op8_chat_formatting", "conversations")
def op8(conversations: DataFrame) -> DataFrame:
    return chat.conversations(conversations)


# the whole mix in SQL: targets by resharing in closed form, inclusion odds, Pareto order and the cut
MIX_SQL = r"""
with raw as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size from documents),
sizes as (select *, row_number() over (partition by doc_id, source, size) as turn from raw),
per as (select source, sum(size)::bigint as source_size from sizes group by source),
weighed as (select *, [5.0::double, 2.0::double, 1.0::double][1 + (row_number() over (order by source nulls last) - 1) % 3] as weight from per),
levels as (
  select *, (1.5::double * sum(source_size) over () - 2.0::double * coalesce(sum(source_size) over (order by source_size / weight, source nulls last rows between unbounded preceding and 1 preceding), 0))
    / sum(weight) over (order by source_size / weight, source nulls last rows between current row and unbounded following) as level from weighed),
level as (select max(level) as common from levels where level * weight <= 2.0::double * source_size),
goals as (
  select source, source_size, least(2.0::double * source_size, coalesce(common * weight, 2.0::double * source_size)) as target from levels, level),
rests as (
  select *, case when source_size > 0 then floor(target / source_size) else 0 end::bigint as copies from goals),
need as (select *, target - copies * source_size as rest from rests),
cells as (select source, size, count(*) * size as words, (count(*) * size * size)::hugeint as squares from sizes where size > 0 group by source, size),
sums as (
  select *, coalesce(sum(words) over (partition by source order by size desc rows between unbounded preceding and 1 preceding), 0) as above,
    (sum(squares) over (partition by source order by size rows unbounded preceding))::double as below from cells),
scaled as (
  select s.source, s.size, (n.rest - s.above::double) / s.below as scale from sums s join need n on s.source is not distinct from n.source),
opened as (select source, max(size) as open_size, arg_max(scale, size) as scale from scaled where scale * size < 1 group by source),
plan as (
  select n.*, coalesce(o.open_size, -1) as open_size, coalesce(o.scale, 0) as scale from need n left join opened o on n.source is not distinct from o.source),
drawn as (
  select s.doc_id, s.source, s.size, s.turn, p.source_size, p.target, p.copies, p.rest, p.rest > 0 and s.size > p.open_size as sure,
    p.rest > 0 and s.size > 0 and s.size <= p.open_size and p.scale * s.size > 0 as open, p.scale * s.size as p,
    (('0x' || substr(md5('42:' || coalesce(s.doc_id::varchar, 'null') || ':' || s.turn), 1, 12))::bigint + 0.5::double) / 281474976710656.0::double as u
  from sizes s join plan p on s.source is not distinct from p.source),
placed as (select *, case when open then (u / (1.0::double - u)) / (p / (1.0::double - p)) end as q from drawn),
wanted as (select source, max(rest) - coalesce(sum(size) filter (where sure), 0) as need from placed group by source),
run as (
  select p.*, w.need, case when open then sum(size) over (partition by p.source, open order by q, doc_id nulls first, size, turn rows unbounded preceding) end as upto
  from placed p join wanted w on p.source is not distinct from w.source)
select doc_id, size, source_size, target,
  case when size > 0 then size * (copies + case when sure or (open and (upto <= need or (upto - need < need - (upto - size) and upto - size < need))) then 1 else 0 end) else 0 end::bigint as taken,
  source
from run
"""


@query("op9_source_mixing", sql=MIX_SQL)
def op9(docs: DataFrame) -> DataFrame:
    return mixing.Mix(docs).documents().select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source")


@query("op10_order_minhash")
def op10(docs: DataFrame) -> DataFrame:
    return omh.fingerprints(docs).select(
        "doc_id", "n_chars", "edited_sha256", omh.written(F.col("signature")).alias("fingerprint"), omh.written(F.col("edited_signature")).alias("edited_fingerprint"),
        "near_edited", "near_next",
    )


# words of items in windows, words of documents in windows of the same lengths, and the documents' words inside those that meet
LEAKS_SQL = r"""
with items as (
  select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
docs as (
  select row_number() over () as r, doc_id,
    coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as w from documents),
sized as (select *, least(10, len(w)) as k from items where len(w) > 0),
windows as (select distinct item_id, k, array_to_string(w[i:i + k - 1], ' ') as part from (select *, unnest(range(1, len(w) - k + 2)) as i from sized)),
places as (
  select r, k, i, array_to_string(w[i:i + k - 1], ' ') as part
  from (select r, w, k, unnest(range(1, len(w) - k + 2)) as i from docs, (select distinct k from windows) where len(w) >= k)),
met as (select r, p.k, i, item_id from places p join windows v on p.k = v.k and p.part = v.part),
hit as (select r, count(distinct j) as n_hit from (select r, unnest(range(i, i + k)) as j from (select distinct r, i, k from met)) group by r),
listed as (select r, count(*) as n_items, string_agg(item_id::varchar, ',' order by item_id::varchar) as ids from (select distinct r, item_id from met where item_id is not null) group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(ids, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from docs left join hit using (r) left join listed using (r)
"""


@query("op11_benchmark_decontamination", "documents", "benchmark", sql=LEAKS_SQL)
def op11(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return decontaminate.report(docs, benchmark)


# CRC-32 by its table; the programme over rows, least (cost, audit) per state, insertions before each row and at the end
CRC_SQL = """
crc as (select list(list_reduce(list_concat([i], range(8)), lambda c, b: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) as t from range(256) as g(i))
"""
CRC_OF = "xor(list_reduce(list_concat([4294967295::bigint], [ascii(c)::bigint for c in string_split({}, '')]), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"
REPAIR_SQL = (
    "with recursive" + CRC_SQL + """,
coded as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, """ + CRC_OF.format("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')") + r""" % 20 as code
  from conversations, crc),
damaged as (
  select conv_id, turn, case when code = 4 then 'user' else role end as role,
    case when code = 1 then '' when code = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text, unnest(range(case when code = 3 then 2 else 1 end)) as copy
  from coded where code <> 0),
placed as (
  select *, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as cut, row_number() over (partition by conv_id order by turn nulls first, role, md5(text), copy) as i from damaged),
faulty as (
  select *, case when cut = '' then 'blank' when row_number() over (partition by conv_id, role, text order by i) > 1 then 'duplicate' when right(cut, 1) not in ('.', '!', '?') then 'truncated' end as fault,
    left(lag(role) over (partition by conv_id order by i), 1) || left(role, 1) as pair from placed),
counted as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps, count(*) filter (where fault = 'blank') as blank,
    count(*) filter (where fault = 'duplicate') as duplicate, count(*) filter (where fault = 'truncated') as truncated,
    count(*) filter (where pair not in ('su', 'ua', 'au')) as illegal, max(i) as n from faulty group by conv_id),
ins(p, q, w, letters, roles) as (values (0, 0, 0, '', []::varchar[]), (0, 2, 2, 'I', ['user:']), (0, 3, 4, 'II', ['user:', 'assistant:']), (1, 1, 0, '', []), (1, 2, 2, 'I', ['user:']),
  (1, 3, 4, 'II', ['user:', 'assistant:']), (2, 2, 0, '', []), (2, 3, 2, 'I', ['assistant:']), (3, 3, 0, '', []), (3, 2, 2, 'I', ['user:'])),
keeps(p, role, q) as (values (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)),
turns(p, q, role) as (values (0, 2, 'user'), (1, 2, 'user'), (3, 2, 'user'), (2, 3, 'assistant')),
moves as (
  select conv_id, i, p, p as q, 3 as w, 'D' as letter, []::varchar[] as said from faulty, (select unnest(range(4))::int as p)
  union all select f.conv_id, f.i, p, q, (fault is not null)::int, 'K', [f.role || ':' || text] from faulty f join keeps k on left(f.role, 1) = k.role where fault is null or fault = 'truncated'
  union all select conv_id, i, p, q, 2 + (fault is not null)::int, 'R', [t.role || ':' || text] from faulty f, turns t where fault is null or fault = 'truncated'),
run as (
  select conv_id, 0::bigint as i, 0 as q, 0 as w, '' as audit, []::varchar[] as said from counted
  union all
  select conv_id, i, q, best.w, best.audit, best.said from (
    select r.conv_id, m.i, m.q, min({'w': r.w + s.w + m.w, 'audit': r.audit || s.letters || m.letter, 'said': r.said || s.roles || m.said}) as best
    from run r join ins s on r.q = s.p join moves m on m.conv_id is not distinct from r.conv_id and m.i = r.i + 1 and m.p = s.q group by r.conv_id, m.i, m.q)),
ended as (
  select r.conv_id, min({'w': r.w + s.w, 'audit': r.audit || s.letters, 'said': r.said || s.roles}) as best
  from run r join counted c on r.conv_id is not distinct from c.conv_id and r.i = c.n join ins s on r.q = s.p where s.q in (0, 3) group by r.conv_id)
select o.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal,
  coalesce(best.w, 0)::bigint as cost, coalesce(best.audit, '') as audit, sha256(coalesce(array_to_string(best.said, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) o left join counted c on o.conv_id is not distinct from c.conv_id left join ended e on o.conv_id is not distinct from e.conv_id
"""
)


@query("op12_conversation_repair", "conversations", sql=REPAIR_SQL)
def op12(conversations: DataFrame) -> DataFrame:
    return repair.report(conversations, repair.damaged(conversations))


TRIE_SQL = (
    "with" + CRC_SQL + """,
rows as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null),
own as (select conv_id, list({'role': role, 'text': text} order by turn nulls first, role, md5(text)) as path from rows group by conv_id),
drawn as (select conv_id, path, (""" + CRC_OF.format("conv_id::varchar") + """ % 6)::bigint as h from own, crc),
paths as (
  select d.conv_id, list_concat(coalesce(b.path[1:h], []), d.path[h + 1:]) as path from drawn d left join own b on b.conv_id = d.conv_id - d.conv_id % 100),
members as (select conv_id, depth, path[1:depth] as prefix, len(path) = depth as ends from (select *, unnest(range(len(path) + 1)) as depth from paths)),
nodes as (
  select depth, md5(prefix::varchar) as key, any_value(prefix) as prefix, min(conv_id) as conv_id, count(*) as n_convs,
    string_agg(conv_id::varchar, ',' order by conv_id) filter (where ends) as done from members group by depth, prefix),
linked as (select *, case when depth > 0 then md5(prefix[1:depth - 1]::varchar) end as up, case when depth > 0 then (n_convs - 1) * length(prefix[depth].text) else 0 end as saved from nodes),
kids as (select up, depth - 1 as depth, count(*) as n_children from linked where up is not null group by all),
tops as (select l.key, l.saved, k.n_children is null as leaf, unnest(range(l.depth + 1)) as top_depth, l.prefix from linked l left join kids k on k.up = l.key and k.depth = l.depth),
sums as (select top_depth as depth, md5(prefix[1:top_depth]::varchar) as key, count(*) filter (where leaf) as n_leaves, sum(saved) as saved from tops group by all)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(k.n_children, 0) as n_children, s.n_leaves, s.saved::bigint as saved_tokens, sha256(coalesce(n.done, '')) as ends_sha256
from linked n left join linked p on p.key = n.up and p.depth = n.depth - 1 left join kids k on k.up = n.key and k.depth = n.depth join sums s on s.key = n.key and s.depth = n.depth
"""
)


@query("op13_conversation_trie", "conversations", sql=TRIE_SQL)
def op13(conversations: DataFrame) -> DataFrame:
    return trie.trie(trie.rebuilt(conversations))
