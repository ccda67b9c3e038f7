"""Text search: postings ``(id, field, term, tf, positions, doc_len)``, one row per record, field and
word, so that a hot word is many rows, never one list; phrases, trees and names; completion. ``searchtable`` stores
postings and answers many queries at once from them.
"""

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bibspark.functions.text import analyze, by_word, fold, ngram_list, normal_phrase, placed, texts, tokens
from bibspark.operators.joins import by_repetition

# fixed values: BM25 parameters
K1, B = 1.2, 0.75

# fixed values: boost of (all words, phrase) per field, by the number of fields searched
BOOSTS = {
    1: [(1.0, 2.0)],
    2: [(1.0, 2.0), (0.10, 0.15)],
    3: [(1.5, 3.0), (0.3, 0.5), (0.05, 0.1)],
}
ACRONYM_BOOST = (2.0, 2.0)


def _words(col: Column, exact: bool) -> Column:
    return tokens(col) if exact else analyze(col)


def postings(df: DataFrame, key: str, fields: list[str], exact: bool = True, lengths: bool = False) -> DataFrame:
    """Build postings. A field is a path to one text or an array of texts a record; the texts of an array stand a gap apart. Words
    are grouped inside the record, so no text moves; only the words of records that share a key meet in a shuffle. ``lengths`` adds the empty word, once for every record
    and field with words, with their number as ``tf``."""
    cells = [F.struct(F.lit(f).alias("field"), F.transform(texts(df, f), lambda x: _words(x, exact)).alias("lists")) for f in fields]
    none = F.array().cast("array<bigint>")

    def in_row(rows):
        rows = rows.select(F.col(key).alias("id"), F.explode(F.array(*cells)).alias("c"))
        rows = rows.select("id", "c.field", "c.lists", F.aggregate("c.lists", F.lit(0), lambda n, x: n + F.size(x)).alias("doc_len")).where("doc_len > 0")
        words = by_word(placed(F.col("lists")))
        if lengths:
            words = F.concat(words, F.array(F.struct(F.lit("").alias("term"), none.alias("positions"))))
        rows = rows.select("id", "field", "doc_len", F.explode(words).alias("w")).select("id", "field", "doc_len", "w.term", "w.positions")
        tf = F.when(F.col("term") == "", F.col("doc_len")).otherwise(F.size("positions"))
        return rows.select("id", "field", "term", tf.alias("tf"), "positions", "doc_len")

    once, again = by_repetition(df, key)
    if again is None:
        return in_row(once)
    merged = in_row(again).groupBy("id", "field", "term").agg(F.array_sort(F.flatten(F.collect_list("positions"))).alias("positions"), F.first("doc_len").alias("doc_len"))
    tf = F.when(F.col("term") == "", F.col("doc_len")).otherwise(F.size("positions"))
    return in_row(once).unionByName(merged.select("id", "field", "term", tf.alias("tf"), "positions", "doc_len"))


def query_terms(queries: DataFrame, exact: bool = True) -> DataFrame:
    """(query_id, slot, term, lead, n_terms, n_slots): one row per word of the query; ``lead`` marks the
    first place of a word."""
    words = queries.select("query_id", _words(F.col("text"), exact).alias("words"))
    sizes = [F.size(F.array_distinct("words")).alias("n_terms"), F.size("words").alias("n_slots")]
    rows = words.select("query_id", "words", *sizes, F.posexplode("words").alias("slot", "term"))
    lead = F.array_position("words", F.col("term")) - 1 == F.col("slot")
    return rows.select("query_id", "slot", "term", lead.alias("lead"), "n_terms", "n_slots")


# one query with words known to the caller: a column of positions per word, then plain predicates


def word_columns(post: DataFrame, words: list[str]) -> tuple[DataFrame, dict[str, Column]]:
    """(id, field) with one positions column per word; NULL where the word does not occur."""
    words = list(dict.fromkeys(words))
    picked = post.where(F.col("term").isin(words)) if words else post.limit(0)
    # (id, field, term) is unique, so max only picks the one value
    wide = picked.groupBy("id", "field").agg(*[F.max(F.when(F.col("term") == w, F.col("positions"))).alias(f"w{i}") for i, w in enumerate(words)])
    return wide, {w: F.col(f"w{i}") for i, w in enumerate(words)}


def _shift(positions: Column, by: int) -> Column:
    return F.transform(positions, lambda p: p + by)


def _chain(lists: list[Column], slop: int, step: int) -> Column:
    """Last positions of ordered runs over the lists with up to ``slop`` words between, in all."""
    nothing = F.array().cast("array<int>")
    reached = [lists[0]] + [nothing] * slop
    for nxt in lists[1:]:
        # a run that has used g of the slop comes from one with g - h used and a gap of h
        reached = [
            F.array_intersect(nxt, reduce(F.array_union, [_shift(reached[g - h], step * (1 + h)) for h in range(g + 1)]))
            for g in range(slop + 1)
        ]
    return reduce(F.array_union, reached)


def phrase_ends(lists: list[Column], slop: int = 0) -> Column:
    return _chain(lists, slop, 1)


def phrase_starts(lists: list[Column], slop: int = 0) -> Column:
    return _chain(lists[::-1], slop, -1)


def match_span(post: DataFrame, first: str, second: str, distance: int, loose: bool = False) -> DataFrame:
    """Records where the second phrase starts behind the end of the first, with at most ``distance``
    words between. Inner phrases are exact, or may have gaps up to max(1, words - 1)."""
    a, b = first.lower().split(), second.lower().split()
    wide, at = word_columns(post, a + b)

    def slop(words):
        return max(1, len(words) - 1) if loose and len(words) > 1 else 0

    ends = phrase_ends([at[w] for w in a], slop(a))
    starts = phrase_starts([at[w] for w in b], slop(b))
    reach = F.flatten(F.transform(ends, lambda e: F.sequence(e + 1, e + 1 + distance)))
    present = reduce(lambda x, y: x & y, [at[w].isNotNull() for w in dict.fromkeys(a + b)])
    return wide.where(present).where(F.arrays_overlap(reach, starts)).select("id", "field").distinct()


def tree_words(node) -> list[str]:
    if isinstance(node, str):
        return node.lower().split()
    return [w for part in (node.get("and") or node.get("or") or [node.get("not")]) for w in tree_words(part)]


def match_tree(ids: DataFrame, post: DataFrame, node) -> DataFrame:
    """Records that satisfy a tree of ``{"and": [...]}``, ``{"or": [...]}``, ``{"not": x}`` and words or
    phrases; one pass over the postings. ``ids`` holds all record ids, for those a negation lets in."""
    wide, at = word_columns(post, tree_words(node))

    def test(part) -> Column:
        if isinstance(part, str):
            words = part.lower().split()
            if len(words) == 1:
                return at[words[0]].isNotNull()
            return F.coalesce(F.size(phrase_ends([at[w] for w in words])) > 0, F.lit(False))
        if "not" in part:
            return ~test(part["not"])
        parts = [test(p) for p in part.get("and") or part["or"]]
        return reduce((lambda x, y: x & y) if "and" in part else (lambda x, y: x | y), parts)

    return ids.join(wide, "id", "left").where(test(node)).select("id").distinct()


def wildcard_pattern(text: str, min_prefix: int = 3) -> tuple[str, str]:
    """Plain prefix and full pattern of a word with ``*`` and ``?``; ``*`` needs a prefix, unless ``min_prefix`` is 0: then a
    wildcard may also come first."""
    text = text.lower()
    cut = min((text.index(c) for c in "*?" if c in text), default=len(text))
    star = text.find("*")
    if star >= 0 and len(text[:star].replace("?", "")) < min_prefix:
        raise ValueError(f"a wildcard needs {min_prefix} characters before it")
    if min_prefix and text[:1] in "*?":
        raise ValueError("a wildcard cannot come first")
    body = "".join({"*": ".*", "?": "."}.get(c, c if c.isalnum() else "\\" + c) for c in text)
    return text[:cut], f"^{body}$"


def citation_boost(score: Column, cited: Column, how: str = "sqrt") -> Column:
    """Score times 1 + sqrt(c) or 1 + ln(c); 0.5 where c is missing or too low to count."""
    if how == "sqrt":
        return score * F.when(F.coalesce(cited, F.lit(0)) == 0, 0.5).otherwise(1 + F.sqrt(cited))
    if how == "log":
        return score * F.when(F.coalesce(cited, F.lit(0)) <= 1, 0.5).otherwise(1 + F.log(cited))
    raise ValueError("how must be sqrt or log")


def match_name(df: DataFrame, cols: list[str], q: str) -> DataFrame:
    """Records one of whose names has all words of the query, accents aside, with a score: one point per
    field, two more where the words stand as a phrase. Of an array of names the best one counts; no match goes over two of them."""
    want = fold(F.lit(q))
    words = F.array_distinct(tokens(want))
    phrase = normal_phrase(F.lit(q))

    def points(name):
        whole = F.concat(normal_phrase(name), F.lit(" "))
        hit = F.size(F.array_except(words, tokens(fold(name)))) == 0
        return F.when(hit, 1 + F.when(whole.contains(F.concat(phrase, F.lit(" "))), 2).otherwise(0)).otherwise(0)

    score = reduce(lambda a, b: a + b, [F.coalesce(F.array_max(F.transform(texts(df, c), points)), F.lit(0)) for c in cols])
    return df.withColumn("score", score).where("score > 0")


def match_tokens(col: Column, q: str) -> Column:
    """All pieces of the query occur, in any order, case and accent; commas and hyphens part pieces."""
    pieces = q.replace(",", " ").replace("-", " ").split()
    if not pieces:
        return fold(col).contains(fold(F.lit(q)))
    folded = fold(col)
    return reduce(lambda a, b: a & b, [folded.contains(fold(F.lit(p))) for p in pieces])


def highlight(col: Column, words: list[str], size: int = 300, n: int = 5, pre: str = ">>", post: str = "<<") -> Column:
    """The first ``n`` fragments, of about ``size`` characters, that hold a word, with the words marked.
    Fragments break at blanks and cover the whole text."""
    either = "|".join(re.escape(w) for w in words)
    whole = rf"(?iu)(?<![\p{{L}}\p{{N}}])({either})(?![\p{{L}}\p{{N}}])"
    pieces = F.regexp_extract_all(col, F.lit(rf"(?s)(\S{{{size + 1},}}|.{{1,{size}}})(?:\s+|$)"), F.lit(1))
    hits = F.filter(pieces, lambda p: p.rlike(whole))
    return F.transform(F.slice(hits, 1, n), lambda p: F.regexp_replace(p, whole, f"{pre}$1{post}"))


def affiliation_search(df: DataFrame, text: str, q: str, have: Column, lack: Column, count: Column) -> DataFrame:
    """Records with a string that has all words of the query, with and without some linked ids, in a range of counts."""
    words = tokens(F.lit(q))
    return df.where(have & lack & count & F.exists(texts(df, text), lambda x: F.size(F.array_except(words, tokens(x))) == 0))


# suggestions and completion


def ngrams(df: DataFrame, key: str, col: str, n: int) -> DataFrame:
    """(key, ngram, tokens, count) per record."""
    grams = df.select(key, F.explode(ngram_list(tokens(F.col(col)), n)).alias("ngram"))
    return grams.groupBy(key, "ngram").agg(F.count("*").alias("count")).select(key, "ngram", F.lit(n).alias("tokens"), "count")


def phrase_counts(df: DataFrame, col: str, n: int) -> DataFrame:
    """(phrase, count) over all records."""
    grams = df.select(F.explode(ngram_list(tokens(F.col(col)), n)).alias("phrase"))
    return grams.groupBy("phrase").agg(F.count("*").alias("count"))


def phrase_prefix(col: Column, q: str) -> Column:
    """The words of the query in a row, the last one as a prefix."""
    return normal_phrase(col).contains(normal_phrase(F.lit(q)))


def suggest(phrases: DataFrame, q: str, n: int = 10, min_len: int = 3) -> DataFrame:
    hits = phrases.where(phrase_prefix(F.col("phrase"), q)) if len(q) >= min_len else phrases.where(F.lit(False))
    return hits.orderBy(F.desc("count"), "phrase").limit(n)


def autocomplete(df: DataFrame, q: str, cols: list[str], key: str, name: str, tie: str, n: int = 10, norm=None) -> DataFrame:
    """The first ``n`` records one of whose texts (arrays of alternatives or acronyms too) has the query as a phrase prefix: exact
    names first, then names that start with it, then by the tie column. With ``norm``, an id normaliser, a query that
    is an id in any spelling gives the record with that id instead."""
    hit = reduce(lambda a, b: a | b, [F.exists(texts(df, c), lambda x: phrase_prefix(x, q)) for c in cols])
    if norm is not None:
        asked = norm(F.lit(q))
        hit = F.when(asked.isNotNull(), F.col(key) == asked).otherwise(hit)
    weight = F.when(F.lower(F.col(name)) == q.lower(), 1000).when(F.lower(F.col(name)).startswith(q.lower()), 500).otherwise(1)
    out = df.where(hit).withColumn("weight", weight)
    return out.orderBy(F.desc("weight"), F.desc_nulls_last(tie), key).limit(n)


SHORT_QUERY = 5
# fixed values: entities searched for a short query
SHORT_ENTITIES = ("institution", "author", "country", "license")


def autocomplete_all(frames: dict[str, DataFrame], q: str, tie: str, short=SHORT_ENTITIES, hidden: Column | None = None, n: int = 10) -> DataFrame:
    """Completion over several entities with columns ``id, display_name`` and the tie; short queries
    look at some entities only."""
    names = [e for e in frames if len(q) > SHORT_QUERY or e in short]
    parts = [frames[e].select(F.col("id").cast("string").alias("id"), "display_name", F.col(tie).cast("bigint").alias(tie), F.lit(e).alias("entity_type")) for e in names]
    both = reduce(DataFrame.unionByName, parts)
    if hidden is not None:
        both = both.where(~hidden)
    return autocomplete(both, q, ["display_name"], "id", "display_name", tie, n)


