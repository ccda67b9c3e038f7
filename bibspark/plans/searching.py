"""Text search over whole documents."""

import pyarrow as pa
from pyspark.sql import functions as F

from bibspark.functions import text as X
from bibspark.functions.ids import norm_catalog
from bibspark.functions.paths import leaf
from bibspark.operators import completion as C
from bibspark.operators import predicates as P
from bibspark.operators import search as S
from bibspark.operators import searchtable as ST
from bibspark.plans.registry import query
from bibspark.session import local_frame, scratch

_WORDS = r"regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}]+')"
_FOLD = r"regexp_replace(strip_accents(lower({})), '\p{{M}}+', '', 'g')"
DOCS = f"docs as (select doc_id as id, lang, source, n_chars, text, {_WORDS.format('text')} as words from documents)"
ITEMS = f"items as (select item_id as query_id, {_WORDS.format('text')} as words from benchmark)"
TOKENS = "toks as (select id, unnest(words) as term, generate_subscripts(words, 1) - 1 as position from docs)"


def _items(t):
    return t.benchmark.select(F.col("item_id").alias("query_id"), "text")


def _asked(t, *texts):
    return local_frame(t.spark, query_id=pa.array(range(len(texts)), pa.int32()), text=pa.array(texts))


@query("postings", f"with {DOCS}, {TOKENS} select id, term, cast(count(*) as bigint) as tf, array_to_string(list(position order by position), ',') as positions from toks group by 1, 2")
def postings(t):
    post = S.postings(t.documents, "doc_id", ["text"])
    return post.select("id", "term", F.col("tf").cast("bigint"), F.array_join(F.col("positions").cast("array<string>"), ",").alias("positions"))


@query("postings_stored_by_word", f"with {DOCS}, {TOKENS} select id, term, cast(count(*) as bigint) as tf from toks where term in ('und', 'the', 'que') group by 1, 2")
def postings_stored(t):
    found = ST.word_rows(t.search_table(), ["und", "the", "que"]).where("field = 'text'")
    return found.select("id", "term", F.col("tf").cast("bigint"))


_STEM = r"""case when regexp_matches(w, '[^ea]ies$') then regexp_replace(w, 'ies$', 'y') when regexp_matches(w, '[^aeo]es$') then regexp_replace(w, 's$', '')
 when regexp_matches(w, '[^us]s$') then regexp_replace(w, 's$', '') else w end"""
_STOP = ", ".join(f"'{w}'" for w in X.STOP_WORDS)


@query("analysed_words", f"with {DOCS} select stem, cast(count(*) as bigint) as n from (select {_STEM} as stem from (select unnest(words) as w from docs) where w not in ({_STOP})) group by 1")
def analysed_words(t):
    return t.documents.select(F.explode(X.analyze(F.col("text"))).alias("stem")).groupBy("stem").agg(F.count("*").alias("n"))


@query("match_all_words", f"with {DOCS}, {ITEMS} select query_id, id from docs join items on list_has_all(docs.words, items.words)")
def match_all(t):
    return ST.match_all(t.search_table(), _items(t), ["text"])


@query("match_phrase", f"""
with {DOCS}, {ITEMS} select query_id, id from docs join items on contains(' ' || array_to_string(docs.words, ' ') || ' ', ' ' || array_to_string(items.words, ' ') || ' ')""")
def match_phrase(t):
    return ST.match_near(t.search_table(), _items(t), 0, ["text"]).select("query_id", "id")


@query("match_near", f"""
with {DOCS}, {TOKENS}, q as (select * from (values (0, 'the', 'of', 2), (1, 'die', 'und', 2), (2, 'que', 'de', 2)) v(query_id, a, b, n))
select distinct query_id, x.id from q join toks x on x.term = a join toks y on y.term = b and y.id = x.id and abs(y.position - 1 - x.position) <= n""")
def match_near(t):
    return ST.match_near(t.search_table(), _asked(t, "the of", "die und", "que de"), 2, ["text"]).select("query_id", "id")


@query("match_near_repeated_word", f"""
with {DOCS}, {TOKENS} select distinct 0 as query_id, x.id from toks x join toks y on x.term = 'the' and y.term = 'the' and y.id = x.id and y.position > x.position and y.position - 1 - x.position <= 2""")
def match_near_repeated(t):
    """Two equal words of a query take two places of the text."""
    return ST.match_near(t.search_table(), _asked(t, "the the"), 2, ["text"]).select(F.lit(0).alias("query_id"), "id")


_BM25 = "ln(1 + (n_docs - df + 0.5) / (df + 0.5))"


def _scores_sql(fields, boosts, queries):
    """BM25 with boosts, straight from its definition."""
    docs = " union all ".join(f"select doc_id as id, '{f}' as field, {_WORDS.format(f)} as words, {m}::double as wm, {p}::double as wp from documents" for f, (m, p) in zip(fields, boosts))
    return f"""
with d as ({docs}), q as ({queries}),
 st as (select field, count(*) as n_docs, avg(len(words)) as avg_len from d where len(words) > 0 group by 1),
 tf as (select id, field, len(words) as doc_len, term, count(*) as tf from (select id, field, words, unnest(words) as term from d) group by 1, 2, words, 4),
 dfs as (select field, term, count(*) as df from tf group by 1, 2),
 idf as (select field, term, avg_len, {_BM25} as idf from dfs join st using (field)),
 qt as (select distinct query_id, len(list_distinct(words)) as n_terms, unnest(words) as term from q),
 w as (select query_id, id, field, doc_len, avg_len, sum(idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * doc_len / avg_len))) as score, sum(idf) as idf
   from qt join tf using (term) join idf using (field, term) group by query_id, id, field, doc_len, avg_len, n_terms having count(*) = n_terms),
 ph as (select query_id, id, field, len(list_filter(range(0, len(d.words)), lambda i: d.words[i + 1 : i + len(q.words)] = q.words)) as hits, wm, wp from w join d using (id, field) join q using (query_id))
select query_id, id, round(sum(score * wm + wp * idf * hits * 2.2 / (hits + 1.2 * (0.25 + 0.75 * doc_len / avg_len))), 4) as score from w join ph using (query_id, id, field) group by 1, 2"""


@query("score_two_fields", _scores_sql(["text", "source"], S.BOOSTS[2], f"select * from (values (0, ['the', 'of']), (1, ['src3']), (2, ['und', 'der', 'die']), (3, ['de', 'la'])) v(query_id, words)"))
def score_two_fields(t):
    found = ST.scores(t.search_table(), _asked(t, "the of", "src3", "und der die", "de la"), ["text", "source"])
    return found.select("query_id", "id", F.round("score", 4).alias("score"))


@query("score_three_fields", _scores_sql(["text", "source", "lang"], S.BOOSTS[3], f"select item_id as query_id, {_WORDS.format('text')} as words from benchmark union all select -1, ['en']"))
def score_three_fields(t):
    asked = _items(t).unionByName(_asked(t, "en").select((F.col("query_id") - 1).alias("query_id"), "text"))
    found = ST.scores(t.search_table(), asked, ["text", "source", "lang"])
    return found.select("query_id", "id", F.round("score", 4).alias("score"))


@query("search_one_field_exact", f"with {DOCS} select 0 as query_id, id from docs where list_has_all(words, ['this', 'was'])")
def search_exact(t):
    return ST.match_all(t.search_table(), _asked(t, "this was"), ["text"])


@query("search_stemmed", f"""
with {DOCS} select distinct 0 as query_id, id from (select id, list_transform(list_filter(words, lambda x: x not in ({_STOP})), lambda w: {_STEM}) as stems from docs)
where list_contains(stems, 'from') and list_contains(stems, 'th')""")
def search_stemmed(t):
    return ST.match_all(t.search_table(exact=False), _asked(t, "The froms th"), ["text"])


@query("match_boolean_tree", f"""
with {DOCS}, p as (select id, words, ' ' || array_to_string(words, ' ') || ' ' as s from docs)
select id from p where (list_contains(words, 'und') or contains(s, ' of the ') or contains(s, ' que la ')) and not list_contains(words, 'with')""")
def match_tree(t):
    node = {"and": [{"or": ["und", "of the", "que la"]}, {"not": "with"}]}
    ids = t.documents.select(F.col("doc_id").alias("id"))
    return S.match_tree(ids, ST.word_rows(t.search_table(), S.tree_words(node)).where("field = 'text'"), node)


@query("match_boolean_tree_negated", f"with {DOCS} select id from docs where not (list_contains(words, 'the') and list_contains(words, 'of'))")
def match_tree_negated(t):
    node = {"not": {"and": ["the", "of"]}}
    ids = t.documents.select(F.col("doc_id").alias("id"))
    return S.match_tree(ids, ST.word_rows(t.search_table(), S.tree_words(node)).where("field = 'text'"), node)


@query("match_wildcard", rf"with {DOCS}, {TOKENS} select id from toks group by 1 having bool_or(regexp_matches(term, '^the.*$')) and bool_or(regexp_matches(term, '^w.s$'))")
def match_wildcard(t):
    return ST.with_patterns(t.search_table(lookups="grams"), ["the*", "w?s"], field="text")


@query("match_wildcard_vocabulary", rf"with {DOCS}, {TOKENS} select distinct term from toks where regexp_matches(term, '^tio.*n$')")
def match_wildcard_vocabulary(t):
    return ST.wildcard_words(t.search_table(lookups="grams"), ["tio*n"]).select("term")


@query("match_wildcard_inner", rf"with {DOCS}, {TOKENS} select distinct term from toks where regexp_matches(term, '^.*ation.*$') or regexp_matches(term, '^.he$')")
def match_wildcard_inner(t):
    """Wildcards at any place, by the runs of characters a pattern fixes."""
    return ST.wildcard_words(t.search_table(lookups="grams"), ["*ation*", "?he"], min_prefix=0).select("term").distinct()


# the checking engine counts bytes: each accented letter becomes one other byte
_ONE_BYTE = f"translate(term, '{X.ACCENTED}ß', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ01')"


def _word(t, *words):
    return local_frame(t.spark, word=pa.array(words))


@query("match_fuzzy", f"with {DOCS}, {TOKENS} select distinct id from toks where damerau_levenshtein(term, 'there') <= 1")
def match_fuzzy(t):
    """One edit, a swap of neighbours included."""
    return ST.with_words(t.search_table(), ST.fuzzy_words(t.search_table(lookups="deletes"), _word(t, "there"), 1), "text")


@query("fuzzy_words", f"""
with {DOCS}, {TOKENS}, q as (select * from (values ('hte'), ('udn'), ('thwhich'), ('reeua')) v(word))
select distinct word, term from (select distinct term from toks), q where damerau_levenshtein({_ONE_BYTE}, word) <= 2""")
def fuzzy_words(t):
    return ST.fuzzy_words(t.search_table(lookups="deletes"), _word(t, "hte", "udn", "thwhich", "reeua"), 2)


_SPANS = "a as (select x.id, y.position as e from toks x join toks y on y.id = x.id and x.term = 'of' and y.term = 'the' and y.position = x.position + 1)"


@query("match_span", f"with {DOCS}, {TOKENS}, {_SPANS} select distinct a.id from a join toks y on y.id = a.id and y.term = 'and' and y.position - a.e - 1 between 0 and 10")
def match_span(t):
    post = ST.word_rows(t.search_table(), ["of", "the", "and"]).where("field = 'text'")
    return S.match_span(post, "of the", "and", 10).select("id")


@query("match_span_loose", f"""
with {DOCS}, {TOKENS}, a as (select x.id, y.position as e from toks x join toks y on y.id = x.id and x.term = 'in' and y.term = 'the' and y.position - x.position between 1 and 2),
 b as (select x.id, x.position as s from toks x join toks y on y.id = x.id and x.term = 'to' and y.term = 'and'
   where y.position - x.position between 1 and 2)
select distinct a.id from a join b on a.id = b.id and s - e - 1 between 0 and 12""")
def match_span_loose(t):
    post = ST.word_rows(t.search_table(), ["in", "the", "to", "and"]).where("field = 'text'")
    return S.match_span(post, "in the", "to and", 12, loose=True).select("id")


_LINES = f"ls as (select doc_id as id, n_chars, list_transform(string_split(text, chr(10)), lambda l: ' ' || array_to_string({_WORDS.format('l')}, ' ') || ' ') as lines from documents)"


def _lined(docs):
    """Documents with their lines as an array of texts."""
    return docs.select(F.col("doc_id").alias("id"), F.split("text", "\n").alias("lines"), F.struct(F.array("source", "lang").alias("names")).alias("at"), "n_chars")


def _line_table(t):
    return ST.build(_lined(t.files("documents")), "id", ["lines", "at.names"], scratch(t.spark, "lines"))


@query("match_phrase_in_array", f"""
with {_LINES}, q as (select * from (values (0, ' the of '), (1, ' und die '), (2, ' que de ')) v(query_id, phrase))
select query_id, id from ls, q where len(list_filter(lines, lambda l: contains(l, phrase))) > 0""")
def match_phrase_array(t):
    """Phrases inside one text of an array, never over two."""
    return ST.match_near(_line_table(t), _asked(t, "the of", "und die", "que de"), 0, ["lines"]).select("query_id", "id")


@query("score_array_fields", f"""
with d as (select doc_id as id, 'lines' as field, {_WORDS.format('text')} as words, 1.0::double as wm, 2.0::double as wp, list_transform(string_split(text, chr(10)), lambda l: {_WORDS.format('l')}) as lists from documents
  union all select doc_id, 'at.names', {_WORDS.format("source || ' ' || lang")}, 0.1::double, 0.15::double, [{_WORDS.format('source')}, {_WORDS.format('lang')}] from documents),
 q as (select * from (values (0, ['the', 'of']), (1, ['src3', 'en']), (2, ['und', 'die'])) v(query_id, words)),
 st as (select field, count(*) as n_docs, avg(len(words)) as avg_len from d where len(words) > 0 group by 1),
 tf as (select id, field, len(words) as doc_len, term, count(*) as tf from (select id, field, words, unnest(words) as term from d) group by 1, 2, words, 4),
 dfs as (select field, term, count(*) as df from tf group by 1, 2),
 idf as (select field, term, avg_len, {_BM25} as idf from dfs join st using (field)),
 qt as (select distinct query_id, len(list_distinct(words)) as n_terms, unnest(words) as term from q),
 w as (select query_id, id, field, doc_len, avg_len, sum(idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * doc_len / avg_len))) as score, sum(idf) as idf
   from qt join tf using (term) join idf using (field, term) group by query_id, id, field, doc_len, avg_len, n_terms having count(*) = n_terms),
 ph as (select query_id, id, field, list_sum(list_transform(lists, lambda l: len(list_filter(range(0, len(l)), lambda i: l[i + 1 : i + len(q.words)] = q.words)))) as hits, wm, wp
   from w join d using (id, field) join q using (query_id))
select query_id, id, round(sum(score * wm + wp * idf * hits * 2.2 / (hits + 1.2 * (0.25 + 0.75 * doc_len / avg_len))), 4) as score from w join ph using (query_id, id, field) group by 1, 2""")
def score_array_fields(t):
    """Scores over arrays of texts: words of a whole field, phrases of one text."""
    found = ST.scores(_line_table(t), _asked(t, "the of", "src3 en", "und die"), ["lines", "at.names"])
    return found.select("query_id", "id", F.round("score", 4).alias("score"))


@query("match_names_in_array", f"""
with {_LINES} select id, max(case when contains(l, ' the of ') then 3 else 1 end) as score from (select id, unnest(lines) as l from ls) where contains(l, ' the ') and contains(l, ' of ') group by 1""")
def match_names_array(t):
    return S.match_name(_lined(t.documents), ["lines"], "The of").select("id", "score")


@query("search_array_field", "select 0 as query_id, doc_id as id from documents where source = 'src7' and lang = 'en'")
def search_array_field(t):
    return ST.match_all(_line_table(t), _asked(t, "SRC7 en"), ["at.names"])


@query("autocomplete_array", f"""
with {_LINES} select id, n_chars from ls where len(list_filter(lines, lambda l: contains({_FOLD.format('l')}, ' of th'))) > 0 order by n_chars desc, id limit 10""")
def autocomplete_array(t):
    df = _lined(t.documents).withColumn("name", F.lit("none"))
    return S.autocomplete(df, "of th", ["lines"], "id", "name", "n_chars").select("id", "n_chars")


@query("affiliation_search_array", f"""
with {_LINES} select id from ls where len(list_filter(lines, lambda l: contains(l, ' the ') and contains(l, ' with '))) > 0 and n_chars between 100 and 5000""")
def affiliation_array(t):
    df = _lined(t.documents)
    return S.affiliation_search(df, "lines", "With the", F.lit(True), F.lit(True), P.between(leaf(df, "n_chars"), 100, 5000)).select("id")


@query("citation_boosts", """
select doc_id, round(n_chars * case when coalesce(c, 0) = 0 then 0.5 else 1 + sqrt(c) end, 4) as by_sqrt, round(n_chars * case when coalesce(c, 0) <= 1 then 0.5 else 1 + ln(c) end, 4) as by_log
from (select doc_id, n_chars, nullif(n_chars % 100, 6) as c from documents)""")
def citation_boosts(t):
    c = F.nullif(F.col("n_chars") % 100, F.lit(6))
    return t.documents.select(
        "doc_id",
        F.round(S.citation_boost(F.col("n_chars"), c, "sqrt"), 4).alias("by_sqrt"),
        F.round(S.citation_boost(F.col("n_chars"), c, "log"), 4).alias("by_log"),
    )


@query("match_names_folded", rf"""
with n as (select doc_id, {_FOLD.format("text")} as a, {_FOLD.format("source || ' ' || lang")} as b from documents),
 w as (select doc_id, regexp_extract_all(a, '[\p{{L}}\p{{N}}]+') as a, regexp_extract_all(b, '[\p{{L}}\p{{N}}]+') as b from n),
 s as (select doc_id, case when list_has_all(a, ['les', 're']) then 1 + case when contains(' ' || array_to_string(a, ' ') || ' ', ' les re ') then 2 else 0 end else 0 end
  + case when list_has_all(b, ['les', 're']) then 1 else 0 end as score from w)
select doc_id, score from s where score > 0""")
def match_names(t):
    df = t.documents.select("doc_id", "text", F.concat_ws(" ", "source", "lang").alias("other"))
    return S.match_name(df, ["text", "other"], "Les Ré").select("doc_id", "score")


@query("match_folded_tokens", f"select doc_id from documents where contains({_FOLD.format('text')}, 'etion') and contains({_FOLD.format('text')}, 'reau') and contains({_FOLD.format('text')}, 'oue')")
def match_folded_tokens(t):
    return t.documents.where(S.match_tokens(F.col("text"), "ÉTION, réau-oue")).select("doc_id")


_MARK = r"(?i)(^|[^\p{{L}}\p{{N}}{0}])(the|und)([^\p{{L}}\p{{N}}{1}]|$)"
_ONE = _MARK.format("\x01", "\x02")
_PIECES = r"regexp_extract_all(text, '(?s)(\S{301,}|.{1,300})(?:\s+|$)', 1)"


@query("highlight", f"""
select doc_id, pos, replace(replace(marked, chr(1), '>>'), chr(2), '<<') as fragment from (
 select doc_id, generate_subscripts(f, 1) - 1 as pos, unnest(list_transform(f, lambda p: regexp_replace(regexp_replace(p, '{_ONE}', '\\1\x01\\2\x02\\3', 'g'), '{_ONE}', '\\1\x01\\2\x02\\3', 'g'))) as marked
 from (select doc_id, list_filter({_PIECES}, lambda p: regexp_matches(p, '{_ONE}'))[1:5] as f from documents))""")
def highlight(t):
    return t.documents.select("doc_id", F.posexplode(S.highlight(F.col("text"), ["the", "und"])).alias("pos", "fragment")).withColumn("pos", F.col("pos").cast("bigint"))


@query("affiliation_search", f"""
with {DOCS} select id, n_chars from docs where list_has_all(words, ['the', 'with']) and source in ('src1', 'src2', 'src3') and not coalesce(lang in ('de', 'es'), false) and n_chars between 100 and 5000""")
def affiliation_search(t):
    df = t.documents
    hits = S.affiliation_search(df, "text", "With the", P.is_in(leaf(df, "source"), ["src1", "src2", "src3"]), P.none_of(leaf(df, "lang"), ["de", "es"]), P.between(leaf(df, "n_chars"), 100, 5000))
    return hits.select(F.col("doc_id").alias("id"), "n_chars")


@query("search_single_field", "select 0 as query_id, doc_id as id from documents where source = 'src7'")
def search_single_field(t):
    return ST.match_all(t.search_table(), _asked(t, "SRC7"), ["source"])


_GRAMS = f"""{DOCS}, grams as (select id, unnest(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) as ngram from docs)"""


@query("ngram_table", f"with {_GRAMS} select id as doc_id, ngram, 2 as tokens, cast(count(*) as bigint) as count from grams group by 1, 2")
def ngram_table(t):
    return S.ngrams(t.documents, "doc_id", "text", 2)


@query("suggest_phrases", f"with {_GRAMS} select ngram as phrase, cast(count(*) as bigint) as count from grams where contains(' ' || {_FOLD.format('ngram')}, ' of th') group by 1 order by 2 desc, 1 limit 10")
def suggest(t):
    return S.suggest(S.phrase_counts(t.documents, "text", 2), "of th")


@query("autocomplete", """
select p_partkey, p_name, p_size, case when p_name = 'blue bolt' then 1000 when starts_with(p_name, 'blue bolt') then 500 else 1 end as weight
from (select p_partkey, p_name, p_size, p_brand from part) where contains(' ' || p_name, ' blue bolt') or contains(' ' || lower(p_brand), ' blue bolt') order by weight desc, p_size desc, p_partkey limit 10""")
def autocomplete(t):
    return S.autocomplete(t.part, "Blue bolt", ["p_name", "p_brand"], "p_partkey", "p_name", "p_size").select("p_partkey", "p_name", "p_size", "weight")


@query("autocomplete_inner_word", """
select p_partkey, p_name, p_size from part where contains(' ' || p_name, ' bol') order by starts_with(p_name, 'bol') desc, p_size desc, p_partkey limit 10""")
def autocomplete_inner(t):
    return S.autocomplete(t.part, "bol", ["p_name"], "p_partkey", "p_name", "p_size").select("p_partkey", "p_name", "p_size")


@query("autocomplete_by_id", "select 'W100' || p_partkey as id, p_name from part where p_partkey = 42")
def autocomplete_by_id(t):
    parts = t.part.select(F.concat(F.lit("W100"), "p_partkey").alias("id"), "p_name", "p_size")
    return S.autocomplete(parts, "https://example.org/works/w10042", ["p_name"], "id", "p_name", "p_size", norm=norm_catalog).select("id", "p_name")


def _name_frames(t):
    return {
        "part": t.part.select(F.concat(F.lit("P"), "p_partkey").alias("id"), F.col("p_name").alias("display_name"), F.col("p_size").alias("cited_by_count")),
        "customer": t.customer.select(F.concat(F.lit("C"), "c_custkey").alias("id"), F.col("c_name").alias("display_name"), F.col("c_custkey").alias("cited_by_count")),
        "nation": t.nation.select(F.concat(F.lit("N"), "n_nationkey").alias("id"), F.col("n_name").alias("display_name"), F.col("n_nationkey").alias("cited_by_count")),
    }


@query("autocomplete_all_entities", """
select id, display_name, cited_by_count, entity_type from (
 select 'C' || c_custkey as id, c_name as display_name, c_custkey as cited_by_count, 'customer' as entity_type from customer union all
 select 'P' || p_partkey, p_name, p_size, 'part' from part union all select 'N' || n_nationkey, n_name, n_nationkey, 'nation' from nation)
where starts_with(lower(display_name), 'customer') and id <> 'C1499' order by cited_by_count desc, id limit 10""")
def autocomplete_all(t):
    hidden = F.col("id") == "C1499"
    return S.autocomplete_all(_name_frames(t), "custom", "cited_by_count", hidden=hidden).select("id", "display_name", "cited_by_count", "entity_type")


@query("autocomplete_all_short_query", "select 'N' || n_nationkey as id, n_name as display_name, cast(n_nationkey as bigint) as cited_by_count, 'nation' as entity_type from nation order by 3 desc, 1 limit 10")
def autocomplete_short(t):
    return S.autocomplete_all(_name_frames(t), "nat", "cited_by_count", short=("nation",)).select("id", "display_name", "cited_by_count", "entity_type")


# completion from a stored table, many queries at once


def _completion(t, df, cols, key, name, tie):
    return C.build(df, cols, key, name, tie, scratch(t.spark, "completion"))


def _typed(df, text):
    """The different texts typed, each its own query id."""
    return df.select(text.alias("text")).distinct().withColumn("query_id", F.col("text"))


@query("completion_stored", """
with q as (select distinct split_part(p_name, ' ', 1) || ' ' || substr(split_part(p_name, ' ', 2), 1, 2) as query_id from part union select distinct substr(split_part(p_name, ' ', 2), 1, 3) from part),
 h as (select query_id, p_partkey as id, p_size as tie, case when p_name = query_id then 1000 when starts_with(p_name, query_id) then 500 else 1 end as weight
  from q join part on contains(' ' || p_name, ' ' || query_id))
select query_id, id, tie, weight, row_number() over (partition by query_id order by weight desc, tie desc, id) as rank from h qualify rank <= 10""")
def completion_stored(t):
    """Every beginning of a name, and of its second word, completed from the stored table."""
    first, second = F.split_part("p_name", F.lit(" "), F.lit(1)), F.split_part("p_name", F.lit(" "), F.lit(2))
    asked = _typed(t.part, F.concat(first, F.lit(" "), F.substring(second, 1, 2))).unionByName(_typed(t.part, F.substring(second, 1, 3)))
    return C.complete(_completion(t, t.part, ["p_name", "p_brand"], "p_partkey", "p_name", "p_size"), asked).drop("name")


@query("completion_stored_long", """
with q as (select distinct left(c_name, 17) as query_id from customer)
select query_id, c_custkey as id, c_name as name, 500 as weight, row_number() over (partition by query_id order by c_acctbal desc, c_custkey) as rank
from q join customer on starts_with(c_name, query_id) qualify rank <= 10""")
def completion_stored_long(t):
    """Queries longer than the stored prefixes."""
    asked = _typed(t.customer, F.substring("c_name", 1, 17))
    return C.complete(_completion(t, t.customer, ["c_name"], "c_custkey", "c_name", "c_acctbal"), asked).drop("tie")


_NORMAL = rf"array_to_string(regexp_extract_all({_FOLD}, '[\p{{{{L}}}}\p{{{{N}}}}]+'), ' ')"


@query("completion_stored_lines", f"""
with ls as (select doc_id as id, n_chars as tie, list_transform(string_split(text, chr(10)), lambda l: ' ' || {_NORMAL.format('l')}) as lines from documents),
 q as (select distinct rtrim(substr(min({_NORMAL.format("split_part(text, chr(10), 1)")}), 1, 20)) as query_id from documents where text is not null group by source)
select query_id, id, tie, row_number() over (partition by query_id order by tie desc, id) as rank from q join ls on len(list_filter(lines, lambda l: contains(l, ' ' || query_id))) > 0 qualify rank <= 10""")
def completion_stored_lines(t):
    """Arrays of alternative texts: the beginning of a line of each source, within any line."""
    first = F.substring(X.normal_phrase(F.split_part("text", F.lit("\n"), F.lit(1))), 2, 2**31 - 1)
    lines = t.documents.where("text is not null").groupBy("source").agg(F.min(first).alias("line"))
    table = _completion(t, _lined(t.documents).withColumn("name", F.lit("none")), ["lines"], "id", "name", "n_chars")
    return C.complete(table, _typed(lines, F.rtrim(F.substring("line", 1, 20)))).drop("name", "weight")


@query("completion_stored_by_id", "select 'W100' || p_partkey as query_id, 'W100' || p_partkey as id, p_name as name from part")
def completion_stored_by_id(t):
    parts = t.part.select(F.concat(F.lit("W100"), "p_partkey").alias("id"), "p_name", "p_size")
    asked = parts.select(F.col("id").alias("query_id"), F.concat(F.lit("https://example.org/works/"), F.lower("id")).alias("text"))
    found = C.complete(_completion(t, parts, ["p_name"], "id", "p_name", "p_size"), asked, norm=norm_catalog)
    return found.select("query_id", "id", "name")


@query("completion_stored_all_entities", """
with names as (select 'C' || c_custkey as id, c_name as name, c_custkey as tie, 'customer' as entity_type from customer where c_custkey <> 1499 union all
 select 'P' || p_partkey, p_name, p_size, 'part' from part union all select 'N' || n_nationkey, n_name, n_nationkey, 'nation' from nation),
 q as (select distinct lower(left(name, 5)) as query_id from names union select distinct lower(left(name, 8)) from names),
 h as (select query_id, id, tie, entity_type, case when lower(name) = query_id then 1000 when starts_with(lower(name), query_id) then 500 else 1 end as weight
  from q join names on contains(' ' || trim(regexp_replace(lower(name), '[^a-z0-9]+', ' ', 'g')), rtrim(' ' || regexp_replace(query_id, '[^a-z0-9]+', ' ', 'g')))
  where len(query_id) > 5 or entity_type = 'nation')
select query_id, id, tie, entity_type, weight, row_number() over (partition by query_id order by weight desc, tie desc, id) as rank from h qualify rank <= 10""")
def completion_stored_all(t):
    """Over several entities; up to five characters only nations are looked at."""
    frames = _name_frames(t)
    frames["customer"] = frames["customer"].where("id <> 'C1499'")
    tables = {e: _completion(t, df, ["display_name"], "id", "display_name", "cited_by_count") for e, df in frames.items()}
    names = frames["part"].select("display_name").union(frames["customer"].select("display_name")).union(frames["nation"].select("display_name"))
    asked = _typed(names, F.lower(F.substring("display_name", 1, 5))).union(_typed(names, F.lower(F.substring("display_name", 1, 8)))).distinct()
    return C.complete_all(tables, asked, short=("nation",)).drop("name")


@query("suggest_stored", f"""
with {_GRAMS}, p as (select ngram as phrase, ' ' || {_FOLD.format('ngram')} as folded, cast(count(*) as bigint) as count from grams group by 1, 2),
 q as (select distinct left({_FOLD.format('ngram')}, 6) as query_id from grams where ngram like 'th% %')
select query_id, phrase, count, row_number() over (partition by query_id order by count desc, phrase) as rank from q join p on contains(folded, ' ' || rtrim(query_id)) qualify rank <= 10""")
def suggest_stored(t):
    """The most frequent phrases for each beginning of a phrase."""
    table = _completion(t, S.phrase_counts(t.documents, "text", 2), ["phrase"], "phrase", "phrase", "count")
    # the phrases are counted once: these are the stored ones
    asked = _typed(table.part("records").where("id like 'th% %'"), F.substring(X.fold(F.col("id")), 1, 6))
    return C.suggest(table, asked)
