"""Vector search."""

from functools import reduce

from pyspark.sql import functions as F

from bibspark.functions import vectors as V
from bibspark.operators import joins as J
from bibspark.operators import predicates as P
from bibspark.operators import vectorindex as VI
from bibspark.operators import vectors as S
from bibspark.plans.registry import query
from bibspark.session import scratch, stored

_COS = "list_cosine_similarity({}::double[], {}::double[])"
_SIMS = f"sims as (select e.vec_id as id, label, {_COS.format('e.embedding', 'z.embedding')} as sim from embeddings e, (select embedding from embeddings where vec_id = 0) z)"


def _first(t):
    return t.embeddings.where("vec_id = 0").first()["embedding"]


def _found(df):
    return df.select("id", F.round("similarity", 6).alias("similarity"))


@query("knn_exact", f"with {_SIMS} select id, round(sim, 6) as similarity from sims order by sim desc, id limit 10")
def knn_exact(t):
    return _found(S.knn(t.embeddings, "vec_id", "embedding", _first(t), 10, None))


@query("knn_threshold_unit_scale", f"with {_SIMS} select id, round((1 + sim) / 2, 6) as similarity from sims where (1 + sim) / 2 >= 0.55 order by sim desc, id limit 50")
def knn_threshold(t):
    return _found(S.knn(t.embeddings, "vec_id", "embedding", _first(t), 50, 0.55, unit=True))


@query("knn_threshold_cosine", f"with {_SIMS} select id, round(sim, 6) as similarity from sims where sim >= 0.5 order by sim desc, id limit 100")
def knn_threshold_cosine(t):
    return _found(S.knn(t.embeddings, "vec_id", "embedding", _first(t), 100, 0.5))


@query("knn_prefiltered", f"with {_SIMS} select id, round(sim, 6) as similarity from sims where label in (1, 3, 5) order by sim desc, id limit 10")
def knn_prefiltered(t):
    return _found(S.knn(t.embeddings.where("label in (1, 3, 5)"), "vec_id", "embedding", _first(t), 10, None))


@query("knn_filter_tree", f"""
with {_SIMS} select id, round(sim, 6) as similarity from sims where (label >= 2 and label <= 7) and not label = 4 and (id < 100 or id > 250) order by sim desc, id limit 50""")
def knn_filter_tree(t):
    node = {"join": "and", "filters": [
        {"field": "label", "op": "between", "value": (2, 7)},
        {"field": "label", "op": "!=", "value": 4},
        {"join": "or", "filters": [{"field": "vec_id", "op": "<", "value": 100}, {"field": "vec_id", "op": ">", "value": 250}]}]}
    return _found(S.knn(P.where(t.embeddings, node), "vec_id", "embedding", _first(t), 50, None))


@query("knn_column_expression", f"with {_SIMS} select id, round(sim, 6) as similarity, round((1 + sim) / 2, 6) as on_unit_scale from sims")
def knn_columns(t):
    at = F.array(*[F.lit(float(x)) for x in _first(t)])
    sim = V.cosine(F.col("embedding"), at)
    return t.embeddings.select(F.col("vec_id").alias("id"), F.round(sim, 6).alias("similarity"), F.round(V.unit(sim), 6).alias("on_unit_scale"))


@query("knn_approximate")
def knn_approximate(t):
    return _found(S.knn_lsh(t.embeddings, "vec_id", "embedding", _first(t), 10))


@query("knn_join_label_centres", f"""
with centres as (select label as query_id, list(m order by p) as v from (select label, p, avg(x) as m from (
  select label, unnest(embedding)::double as x, generate_subscripts(embedding, 1) as p from embeddings) group by 1, 2) group by 1)
select query_id, id, round(sim, 6) as similarity, rank::integer as rank from (
 select query_id, vec_id as id, {_COS.format('embedding', 'v')} as sim, row_number() over (partition by query_id order by {_COS.format('embedding', 'v')} desc, vec_id) as rank from embeddings, centres) where rank <= 10""")
def knn_join_centres(t):
    cells = t.embeddings.select("label", F.posexplode("embedding").alias("p", "x"))
    means = cells.groupBy("label", "p").agg(F.avg(F.col("x").cast("double")).alias("m"))
    # a centre has one entry per dimension
    centres = means.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("p", "m"))), lambda s: s["m"]).alias("vector"))
    found = S.knn_join(t.embeddings, "vec_id", "embedding", centres.select(F.col("label").alias("query_id"), "vector"), 10)
    return found.select("query_id", "id", F.round("similarity", 6).alias("similarity"), "rank")


@query("knn_join_many_queries", f"""
select query_id, id, round(sim, 6) as similarity, rank::integer as rank from (
 select q.vec_id as query_id, e.vec_id as id, {_COS.format('e.embedding', 'q.embedding')} as sim, row_number() over (partition by q.vec_id order by {_COS.format('e.embedding', 'q.embedding')} desc, e.vec_id) as rank
 from embeddings e, embeddings q) where rank = 2""")
def knn_join_many(t):
    """Every vector's nearest other one: as many queries as records, in one job."""
    asked = t.embeddings.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    found = S.knn_join(t.embeddings, "vec_id", "embedding", asked, 2)
    return found.where("rank = 2").select("query_id", "id", F.round("similarity", 6).alias("similarity"), "rank")


@query("knn_stored_index_exact", f"with {_SIMS} select id, round(sim, 6) as similarity from sims order by sim desc, id limit 10")
def knn_index_exact(t):
    """Cells of a stored index, read until no other can hold a better one."""
    index = VI.build(t.embeddings, "vec_id", "embedding", scratch(t.spark, "vectors"), cells=16)
    return _found(VI.search(index, _first(t), 10, probes=2, exact=True))


@query("knn_stored_index_recall", "select true as found_nine_tenths, true as read_under_half")
def knn_index_recall(t):
    """The nearest cells only: recall against the exact search, and the share of rows read, over twenty queries. The records are
    documents by their words, whose vectors lie in groups; those of ``embeddings`` have none, so that no cell could hold a query's neighbours."""
    rows = stored(S.embed(t.documents, "doc_id", "text"), "embedded")
    index = VI.build(rows, "doc_id", "embedding", scratch(t.spark, "vectors"), cells=32)
    some = rows.where(V.norm(F.col("embedding")) > 0).orderBy("doc_id").limit(20)
    asked = some.collect()
    exact = S.knn_join(rows, "doc_id", "embedding", some.select(F.col("doc_id").alias("query_id"), F.col("embedding").alias("vector")), 5)
    parts = [VI.search(index, r["embedding"], 5, probes=6).select(F.lit(r["doc_id"]).alias("query_id"), "id") for r in asked]
    both = exact.join(reduce(lambda a, b: a.unionByName(b), parts), ["query_id", "id"], "left_semi")
    shares = [VI.rows_read(index, r["embedding"], 6) for r in asked]
    return both.agg((F.count("*") >= 90).alias("found_nine_tenths")).withColumn("read_under_half", F.lit(sum(shares) / len(shares) < 0.5))


_UNIT = "(1 + sim) / 2"


def _similar(t):
    """All vectors with their similarity to the first one, and a stand-in citation count."""
    at = F.array(*[F.lit(float(x)) for x in _first(t)])
    similarity = V.unit(V.cosine(F.col("embedding"), at))
    return t.embeddings.select(F.col("vec_id").alias("id"), similarity.alias("similarity"), (F.col("label") * 10).alias("c"))


@query("citation_rerank", f"""
with {_SIMS}, r as (select id, {_UNIT} * (1 + 0.5 * greatest(0, least(1, ({_UNIT} - 0.5) / 0.5)) * (case when label > 0 then label * 10 / (label * 10 + 100) else 0 end)) as score from sims)
select id, round(score, 6) as score from r order by r.score desc, id limit 50""")
def citation_rerank(t):
    return S.similarity_order(_similar(t), V.citation_rerank(F.col("similarity"), F.col("c")), "id", 50).select("id", F.round("score", 6).alias("score"))


@query("citation_rerank_log", f"""
with {_SIMS}, r as (select id, {_UNIT} * case when label * 10 <= 1 then 0.5 else 1 + ln(label * 10) end as score from sims)
select id, round(score, 6) as score from r order by r.score desc, id limit 50""")
def log_rerank(t):
    return S.similarity_order(_similar(t), V.log_rerank(F.col("similarity"), F.col("c")), "id", 50).select("id", F.round("score", 6).alias("score"))


@query("hydrate_vector_results", f"""
with {_SIMS}, top as (select id, sim from sims order by sim desc, id limit 50) select id, round(sim, 6) as score, quality, toxic from top join labels on id = doc_id""")
def hydrate_vectors(t):
    ranked = S.knn(t.embeddings, "vec_id", "embedding", _first(t), 50, None).withColumnRenamed("similarity", "score")
    return J.hydrate(ranked, t.labels.withColumnRenamed("doc_id", "id"), "id").select("id", F.round("score", 6).alias("score"), "quality", "toxic")


@query("short_query_injection", rf"""
with {_SIMS}, top as (select id, sim, row_number() over (order by sim desc, id) as r from sims order by sim desc, id limit 50), med as (select sim from top where r = 26),
 hits as (select doc_id from documents where list_has_all(regexp_extract_all(regexp_replace(strip_accents(lower(text)), '\p{{M}}+', '', 'g'), '[\p{{L}}\p{{N}}]+'), ['the', 'of']) order by n_chars desc, doc_id limit 20)
select id, round(sim, 6) as similarity from top union all select doc_id, round((select sim from med), 6) from hits where doc_id not in (select id from top)""")
def short_query(t):
    found = S.knn(t.embeddings, "vec_id", "embedding", _first(t), 50, None)
    return _found(S.short_query_inject(found, t.documents, "The of", "doc_id", "text", "n_chars"))


@query("embed_whole_texts_bound", "select count(*) as n, true as widths_are_64, true as norms_are_1_or_0 from documents")
def embed_bound(t):
    """What holds for any text: one vector a record, of the model's width and of unit length, or zero where there is no word."""
    rows = S.embed(t.documents, "doc_id", "text").select(F.size("embedding").alias("width"), V.norm(F.col("embedding")).alias("norm"))
    fits = (F.abs(F.col("norm") - 1) < 1e-5) | (F.col("norm") == 0)
    return rows.agg(F.count("*").alias("n"), F.bool_and(F.col("width") == 64).alias("widths_are_64"), F.bool_and(fits).alias("norms_are_1_or_0"))


@query("embed_whole_texts")
def embed_texts(t):
    return S.embed(t.documents, "doc_id", "text").select("doc_id", F.size("embedding").alias("width"), F.round(V.norm(F.col("embedding")), 4).alias("norm"))
