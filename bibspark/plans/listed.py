"""List queries: a spec over the field catalogue, as a reader of the catalogue would ask."""

from functools import reduce

from pyspark.sql import functions as F

from bibspark.catalog import EntityDef, Spec, filtered, run, search_table, searched
from bibspark.functions.paths import leaf
from bibspark.functions.text import ACCENTED
from bibspark.operators import predicates as P
from bibspark.plans.registry import query, with_works

# the nested documents as an entity
PAPERS = EntityDef(
    "papers",
    default_sort=("-cited_by_count", "id"),
    search_sort=("-score", "id"),
    search_fields=("text",),
    aliases={"opener": "sentences.opener", "journal": "source.name"},
    presence={"has_mark": "sentences.mark"},
    special={"long_sentence": lambda df, v: P.cmp(leaf(df, "sentences.words"), ">", v)},
)


@query("list_filter_sort_page", with_works("""
select id, lang, cited_by_count from works where lang in ('en', 'fr') and len(list_filter(sentences, lambda s: s.mark is not null)) > 0
 and len(list_filter(sentences, lambda s: s.words > 12)) > 0 and not coalesce(source.name = 'src1', false) order by cited_by_count desc, id limit 50 offset 50"""))
def list_page(t):
    spec = Spec(filters=(("lang", "in", ["EN", "fr"]), ("has_mark", "is", True), ("long_sentence", "is", 12), ("journal", "is not", "src1")), page=2, per_page=50, select=("id", "lang", "cited_by_count"))
    return run(t.works, PAPERS, spec)


@query("list_group_with_unknown", with_works("""
select coalesce(source.name, 'unknown') as key, cast(count(*) as bigint) as count from works where lang = 'en' group by 1"""))
def list_group(t):
    return run(t.works, PAPERS, Spec(filters=(("lang", "is", "en"),), group_by="journal", unknown=True))


@query("list_sample", with_works("select id, lang from works where cited_by_count >= 100 order by md5(id || ':9'), id limit 40"))
def list_sample(t):
    return run(t.works, PAPERS, Spec(filters=(("cited_by_count", ">=", 100),), sample=40, seed=9, per_page=40, select=("id", "lang")))


_ONE_BYTE = f"translate(w, '{ACCENTED}ß', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ01')"
_FORMS = f"""
with d as (select doc_id as id, lang, ' ' || array_to_string(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+'), ' ') || ' ' as s from documents where coalesce(lang, '') <> 'de')
select 'phrase' as form, id from d where contains(s, ' the of ') union all
select 'near', id from d where regexp_matches(s, ' the ([^ ]+ ){{0,2}}of ') or contains(s, ' of the ') union all
select 'tree', id from d where (contains(s, ' que ') or contains(s, ' of the ')) and not contains(s, ' with ') union all
select 'wildcards', id from d where regexp_matches(s, ' tion[^ ]* ') union all
select 'fuzzy', id from d where len(list_filter(string_split(trim(s), ' '), lambda w: damerau_levenshtein({_ONE_BYTE}, 'that') <= 1)) > 0 union all
select 'span', id from d where regexp_matches(s, ' of the ([^ ]+ ){{0,9}}and ')"""


@query("list_search_forms", _FORMS)
def list_search_forms(t):
    """Every form of a search in a list query, with a filter."""
    df = t.files("documents").select(F.col("doc_id").alias("id"), "text", "lang", F.col("n_chars").alias("cited_by_count"))
    forms = {
        "phrase": {"phrase": "the of"}, "near": {"near": "the of", "slop": 2}, "tree": {"tree": {"and": [{"or": ["que", "of the"]}, {"not": "with"}]}},
        "wildcards": {"wildcards": ["tion*"]}, "fuzzy": {"fuzzy": "that", "distance": 1}, "span": {"span": ("of the", "and", 9)},
    }
    table = search_table(df, PAPERS)
    rows = filtered(df, PAPERS, Spec(filters=(("lang", "is not", "de"),)))
    parts = [searched(rows, df, PAPERS, form, table).select(F.lit(name).alias("form"), "id") for name, form in forms.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("list_cursor", with_works("select id, lang from works where lang > 'en' or (lang = 'en' and cited_by_count < 200) or (lang = 'en' and cited_by_count = 200 and id > 30) order by lang, cited_by_count desc, id limit 60"))
def list_cursor(t):
    return run(t.works, PAPERS, Spec(sort=("lang", "-cited_by_count"), cursor=True, after=("en", 200, 30), per_page=60, select=("id", "lang")))


@query("list_search", r"""
with d as (select doc_id as id, lang, n_chars, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') as words from documents),
 st as (select count(*) as n_docs, avg(len(words)) as avg_len from d where len(words) > 0),
 idf as (select w, ln(1 + (n_docs - df + 0.5) / (df + 0.5)) as idf, avg_len from (select w, count(*) as df from (select unnest(list_distinct(words)) as w from d) where w in ('with', 'from') group by 1), st),
 m as (select *, len(list_filter(range(1, len(words)), lambda i: words[i] = 'with' and words[i + 1] = 'from')) as hits from d where lang = 'en' and list_has_all(words, ['with', 'from'])),
 s as (select id, n_chars, words, hits, idf, avg_len, len(list_filter(words, lambda x: x = idf.w)) as tf from m, idf),
 r as (select id, n_chars, sum(idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(words) / avg_len))) + 2 * sum(idf) * any_value(hits) * 2.2 / (any_value(hits) + 1.2 * (0.25 + 0.75 * any_value(len(words)) / any_value(avg_len))) as score from s group by 1, 2)
select id, round(score * (1 + sqrt(n_chars)), 3) as score from r order by r.score * (1 + sqrt(n_chars)) desc, id limit 100""")
def list_search(t):
    df = t.files("documents").select(F.col("doc_id").alias("id"), "text", "lang", F.col("n_chars").alias("cited_by_count"))
    spec = Spec(filters=(("lang", "is", "en"),), search="With from", per_page=100, select=("id", "score"))
    return run(df, PAPERS, spec).withColumn("score", F.round("score", 3))
