"""A stored search table and the queries it answers.

It has four parts, each in folders by a hash of its key, so that a query opens few of them:

- ``postings``: (id, field, term, tf, positions, doc_len), by word. The empty word stands once for every record and field with words,
  with their number as ``tf``: its rows are the records, its sums the lengths.
- ``vocabulary``: (field, term, df, words), by word; for the empty word the number of records and of words in the field.
- ``deletes``: (variant, term): the beginning of each word, ``PREFIX`` characters, with up to two of them left out, by variant. Two words within
  an edit distance of two, swaps of neighbours included, share a variant: an edit costs each beginning one character at most.
- ``grams``: (gram, term): the runs of three characters of each word with its ends marked, by run.

Records match, are scored and searched for phrases from postings alone, never from their texts, with the statistics of
the whole table. A query is led by its rarest word: the words of a record that any query asks for come together in one row,
one shuffle by record; a row meets only queries whose rarest word it has, and all the rest is looked up inside the row. Where the rarest
words are rare, only the records that have one move.
"""

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bibspark.operators import search as S
from bibspark.session import exists, portions, settings, stored

BUCKETS = 32
SPREAD = 8
# words of the vocabulary whose keys one task makes and sorts
WORDS = 100_000
PREFIX = 6
GRAM = 3
# records without a query's rarest word are left out where they hold all but one in so many of the postings of all words asked for
FEW = 4
ENDS = ("\x02\x02", "\x03\x03")


def _bucket(col: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(col), F.lit(buckets)).cast("int")


def _written(rows: DataFrame, path: str, key: str | Column, buckets: int, **options: str) -> None:
    """In folders by the key's bucket. Every task keeps a file of each bucket open and writes its own rows as they come, so nothing moves, and
    no rows are held in memory to be sorted."""
    placed = rows.withColumn("bucket", _bucket(F.col(key) if isinstance(key, str) else key, buckets))
    # with fewer files open Spark would sort by the bucket
    with settings(rows.sparkSession, {"spark.sql.maxConcurrentOutputFileWriters": str(buckets + 1)}):
        placed.write.options(**options).mode("overwrite").partitionBy("bucket").parquet(path)


def _stored(rows: DataFrame, path: str, key: str, buckets: int, salt: Column, **last: Column) -> None:
    """In folders by the key's bucket, sorted by the key; ``salt`` spreads a bucket, and a hot key, over ``SPREAD`` tasks. The columns of
    ``last`` are set after the sort, from narrower ones that move."""
    dealt = rows.withColumn("bucket", _bucket(F.col(key), buckets)).withColumn("salt", F.pmod(F.xxhash64(salt), F.lit(SPREAD)))
    dealt = dealt.repartition("bucket", "salt").drop("salt").sortWithinPartitions("bucket", key).withColumns(last)
    dealt.write.mode("overwrite").partitionBy("bucket").parquet(path)


@dataclass(frozen=True)
class SearchTable:
    spark: SparkSession
    path: str
    exact: bool
    buckets: int

    def part(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")

    def of_keys(self, part: str, key: str, keys: DataFrame) -> DataFrame:
        """Rows of a part for the keys of a frame; other folders are pruned once the keys are known. The keys are stored first, for with
        an unknown number of them the join would shuffle the folders."""
        wanted = stored(keys.select(F.col(key)).distinct().withColumn("bucket", _bucket(F.col(key), self.buckets)), "keys")
        return self.part(part).join(wanted, ["bucket", key], "left_semi").drop("bucket")

    @property
    def ids(self) -> DataFrame:
        """(id): records with words in some field."""
        rows = self.part("postings").where((F.col("bucket") == _bucket(F.lit(""), self.buckets)) & (F.col("term") == ""))
        return rows.select("id").distinct()


def build(df: DataFrame, key: str, fields: list[str], path: str, exact: bool = True, buckets: int = BUCKETS) -> SearchTable:
    """Store postings and vocabulary of the text fields, which may hold one text or an array of texts a record."""
    _written(S.postings(portions(df), key, fields, exact, lengths=True), f"{path}/postings", "term", buckets)
    table = SearchTable(df.sparkSession, path, exact, buckets)
    vocabulary = table.part("postings").groupBy("field", "term").agg(F.count("*").alias("df"), F.sum("tf").alias("words"))
    _written(vocabulary, f"{path}/vocabulary", "term", buckets)
    return table


def _likenesses(term: Column) -> dict[str, tuple[str, Column]]:
    marked = F.concat(F.lit(ENDS[0]), term, F.lit(ENDS[1]))
    return {"deletes": ("variant", variants(term)), "grams": ("gram", F.array_distinct(grams(marked)))}


def add_lookups(table: SearchTable, *parts: str) -> SearchTable:
    """Store ``deletes``, for words asked for by likeness, or ``grams``, for those by pattern, of a table's vocabulary, unless they
    are there; both if none is named. A word is dealt to a task, which makes and writes its keys."""
    for name, (key, keys) in _likenesses(F.col("term")).items():
        if name not in (parts or (name,)) or exists(table.spark, f"{table.path}/{name}/_SUCCESS"):
            continue
        words = table.part("vocabulary").where("term != ''").select("term")
        words = words.repartition(-(-words.count() // WORDS) or 1, "term").distinct()
        # sorted, a key's many words take less room
        rows = words.select(F.explode(keys).alias(key), "term").sortWithinPartitions(key)
        _written(rows, f"{table.path}/{name}", key, table.buckets)
    return table


def _without(word: Column) -> Column:
    """The word with each one of its characters left out."""
    return F.when(F.length(word) > 0, F.transform(F.sequence(F.lit(1), F.length(word)), lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.length(word))))).otherwise(F.array().cast("array<string>"))


def variants(word: Column) -> Column:
    """The beginning of the word with up to two characters left out."""
    word = F.substring(word, 1, PREFIX)
    one = F.get(F.transform(F.array(word), _without), F.lit(0))
    return F.array_distinct(F.concat(F.array(word), one, F.flatten(F.transform(one, _without))))


def grams(text: Column) -> Column:
    return F.when(F.length(text) >= GRAM, F.transform(F.sequence(F.lit(1), F.length(text) - (GRAM - 1)), lambda i: F.substring(text, i, F.lit(GRAM)))).otherwise(F.array().cast("array<string>"))


def _swaps(word: Column) -> Column:
    """The word with each pair of neighbours swapped."""

    def swapped(i):
        return F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.lit(1)), F.substring(word, i, F.lit(1)), F.substring(word, i + 2, F.length(word)))

    return F.when(F.length(word) > 1, F.transform(F.sequence(F.lit(1), F.length(word) - 1), swapped)).otherwise(F.array().cast("array<string>"))


def within(a: Column, b: Column, distance: int) -> Column:
    """An edit distance of at most 1 or 2, where a swap of neighbours is one edit."""
    near = F.levenshtein(a, b, distance).between(0, distance)
    if distance == 1:
        return near | F.array_contains(_swaps(a), b)
    one = F.exists(_swaps(a), lambda s: F.levenshtein(s, b, 1).between(0, 1)) | F.exists(_swaps(b), lambda s: F.levenshtein(a, s, 1).between(0, 1))
    return near | one | F.arrays_overlap(_swaps(a), _swaps(b))


def fuzzy_words(table: SearchTable, words: DataFrame, distance: int = 2) -> DataFrame:
    """(word, term): words of the table within an edit distance of 1 or 2 of the words asked for; those with a common variant
    are compared."""
    if distance not in (1, 2):
        raise ValueError("the distance is 1 or 2")
    asked = words.select(F.lower("word").alias("word")).distinct()
    cut = asked.select("word", F.explode(variants(F.col("word"))).alias("variant"))
    near = table.of_keys("deletes", "variant", cut).join(cut, "variant").select("word", "term").distinct()
    near = near.where(F.abs(F.length("word") - F.length("term")) <= distance)
    return near.where(within(F.col("word"), F.col("term"), distance))


def wildcard_words(table: SearchTable, patterns: list[str], min_prefix: int = 3) -> DataFrame:
    """(pattern, term): words of the table that fit patterns with ``*`` and ``?``, by the runs of characters that a pattern fixes. With
    ``min_prefix=0`` a wildcard may stand anywhere; else ``*`` needs so many characters before it. A pattern that fixes no run reads
    the whole vocabulary."""
    found = None
    for pattern in dict.fromkeys(p.lower() for p in patterns):
        regex = S.wildcard_pattern(pattern, min_prefix)[1]
        runs = {run[i : i + GRAM] for run in re.split("[*?]", ENDS[0] + pattern + ENDS[1]) for i in range(len(run) - GRAM + 1)} - {"".join(ENDS)}
        if runs:
            asked = table.spark.createDataFrame([(r,) for r in sorted(runs)], "gram string")
            words = table.of_keys("grams", "gram", asked).groupBy("term").agg(F.count("*").alias("n")).where(F.col("n") == len(runs)).select("term")
        else:
            words = table.part("vocabulary").where("term != ''").select("term").distinct()
        words = words.where(F.col("term").rlike(regex)).select(F.lit(pattern).alias("pattern"), "term")
        found = found.unionByName(words) if found is not None else words
    return found


def with_words(table: SearchTable, words: DataFrame, field: str | None = None) -> DataFrame:
    """(id): records with one of the words of a frame (term)."""
    rows = table.of_keys("postings", "term", words)
    return (rows.where(F.col("field") == field) if field else rows).select("id").distinct()


def with_patterns(table: SearchTable, patterns: list[str], min_prefix: int = 3, field: str | None = None) -> DataFrame:
    """(id): records with a word for each pattern in one field."""
    words = wildcard_words(table, patterns, min_prefix)
    rows = table.of_keys("postings", "term", words).select("id", "field", "term").join(words, "term")
    rows = rows.where(F.col("field") == field) if field else rows
    found = rows.groupBy("id", "field").agg(F.count_distinct("pattern").alias("n"))
    return found.where(F.col("n") == len({p.lower() for p in patterns})).select("id").distinct()


# queries of plain words


def asked(table: SearchTable, queries: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Per query and field with all its words: query_id, field, lead (the rarest), terms (term, df; the rarest first), phrase (words in
    order), n_docs and avg_len. From the vocabulary alone; a query with a word the field has not got is answered here."""
    terms = S.query_terms(queries, table.exact)
    known = table.of_keys("vocabulary", "term", terms).select("field", "term", "df")
    if fields:
        known = known.where(F.col("field").isin(fields))
    whole = table.of_keys("vocabulary", "term", table.spark.range(1).select(F.lit("").alias("term")))
    whole = whole.select("field", F.col("df").alias("n_docs"), (F.col("words") / F.col("df")).alias("avg_len"))
    rows = terms.join(known, "term").groupBy("query_id", "field").agg(
        F.array_sort(F.collect_list(F.when(F.col("lead"), F.struct("df", "term")))).alias("terms"),
        F.transform(F.array_sort(F.collect_list(F.struct("slot", "term"))), lambda s: s["term"]).alias("phrase"),
        F.max("n_terms").alias("n_terms"),
    )
    rows = rows.where(F.size("terms") == F.col("n_terms")).join(whole, "field")
    return rows.select("query_id", "field", F.get("terms", F.lit(0))["term"].alias("lead"), "terms", "phrase", "n_docs", "avg_len")


def _led(table: SearchTable, wanted: DataFrame, rows: DataFrame) -> DataFrame:
    """The postings of a query's words in records that have its rarest one, where these are few by the vocabulary: no query
    has all its words in the others, which need not move."""
    words = wanted.select("field", "lead", F.get("terms", F.lit(0))["df"].alias("led"), F.explode("terms").alias("t"))
    words = words.select("field", "lead", "led", F.col("t.term").alias("term"), F.col("t.df").alias("df")).distinct()
    few, many = words.groupBy("field", "term").agg(F.sum("led").alias("led"), F.max("df").alias("df")).agg(F.sum("led"), F.sum("df")).first()
    if not many or few * FEW > many:
        return rows
    records = table.of_keys("postings", "term", words.select(F.col("lead").alias("term"))).select("id", "field", F.col("term").alias("lead"))
    records = records.join(words, ["field", "lead"]).select(F.col("id").alias("led_id"), F.col("field").alias("led_field"), F.col("term").alias("led_term"))
    same = F.col("id").eqNullSafe(F.col("led_id")) & (F.col("field") == F.col("led_field")) & (F.col("term") == F.col("led_term"))
    return rows.join(stored(records, "led"), same, "left_semi")


def matches(table: SearchTable, queries: DataFrame, fields: list[str] | None = None, places: bool = True) -> DataFrame:
    """The rows of ``asked`` with each record that has all words in the field: id, doc_len and have, the positions of words. Without
    ``places`` no positions move: have only tells the words."""
    wanted = stored(asked(table, queries, fields).withColumn("bucket", _bucket(F.col("lead"), table.buckets)), "asked").drop("bucket")
    words = wanted.select("field", F.explode("phrase").alias("term"))
    rows = table.of_keys("postings", "term", words)
    if fields:
        rows = rows.where(F.col("field").isin(fields))
    rows = _led(table, wanted, rows)
    value = F.col("positions") if places else F.lit(True)
    records = rows.groupBy("id", "field").agg(F.max("doc_len").alias("doc_len"), F.map_from_entries(F.collect_list(F.struct("term", value))).alias("have"))
    led = records.select("*", F.explode(F.map_keys("have")).alias("lead")).join(wanted, ["field", "lead"])
    return led.where(F.forall("terms", lambda t: F.map_contains_key("have", t["term"])))


def _places(word: Column) -> Column:
    return F.element_at("have", word)


def phrase_starts() -> Column:
    """Positions where the words stand in a row."""
    shifted = F.transform("phrase", lambda w, i: F.transform(_places(w), lambda p: p - i))
    return F.aggregate(F.slice(shifted, 2, F.size("phrase")), F.get(shifted, F.lit(0)), lambda a, b: F.array_intersect(a, b))


def near_starts(slop: int) -> Column:
    """Positions from which each word of the phrase stands within ``slop`` behind its place. Equal words take different positions: the
    first that is free, in order, which finds a choice wherever there is one."""
    if not slop:
        return phrase_starts()
    first = F.get("phrase", F.lit(0))
    starts = F.array_distinct(F.flatten(F.transform(_places(first), lambda p: F.sequence(p - slop, p))))

    def fits(start):
        def of_word(t):
            word = t["term"]
            slots = F.filter(F.transform("phrase", lambda w, i: F.when(w == word, i)), lambda i: i.isNotNull())

            def take(last, slot):
                least = F.greatest(last + 1, start + slot)
                return F.coalesce(F.array_min(F.filter(_places(word), lambda p: (p >= least) & (p <= start + slot + slop))), F.lit(1 << 62))

            return F.aggregate(slots, F.lit(-(1 << 62)), take) < (1 << 62)

        return F.forall("terms", of_word)

    return F.filter(starts, fits)


def match_all(table: SearchTable, queries: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """(query_id, id) with all words in one of the fields."""
    return matches(table, queries, fields, places=False).select("query_id", "id").distinct()


def match_near(table: SearchTable, queries: DataFrame, slop: int = 0, fields: list[str] | None = None) -> DataFrame:
    """(query_id, id, field, starts): words of the query within ``slop`` of their places in the phrase."""
    return matches(table, queries, fields).select("query_id", "id", "field", near_starts(slop).alias("starts")).where(F.size("starts") > 0)


def scores(table: SearchTable, queries: DataFrame, fields: list[str], boosts=None) -> DataFrame:
    """(query_id, id, score): records with all words in some field; the boosted sum over fields of BM25 for the words, and again for the phrase."""
    boosts = boosts or S.BOOSTS[len(fields)]
    weights = [F.create_map(*[F.lit(x) for f, b in zip(fields, boosts, strict=True) for x in (f, float(b[i]))]) for i in (0, 1)]
    rows = matches(table, queries, fields).withColumn("hits", F.size(phrase_starts()))
    rarity = F.transform("terms", lambda t: F.struct(F.log(1 + (F.col("n_docs") - t["df"] + 0.5) / (t["df"] + 0.5)).alias("idf"), F.size(_places(t["term"])).alias("tf")))
    rows = rows.select("query_id", "id", "field", "doc_len", "avg_len", "hits", rarity.alias("found"))

    def bm25(idf, tf):
        return idf * tf * (S.K1 + 1) / (tf + S.K1 * (1 - S.B + S.B * F.col("doc_len") / F.col("avg_len")))

    total = lambda part: F.aggregate("found", F.lit(0.0), lambda s, x: s + part(x))
    words = total(lambda x: bm25(x["idf"], x["tf"]))
    phrase = bm25(total(lambda x: x["idf"]), F.col("hits"))
    part = F.element_at(weights[0], F.col("field")) * words + F.element_at(weights[1], F.col("field")) * phrase
    return rows.select("query_id", "id", part.alias("part")).groupBy("query_id", "id").agg(F.sum("part").alias("score"))


def word_rows(table: SearchTable, words: list[str]) -> DataFrame:
    """The postings of some words, for ``search.match_tree`` and ``search.match_span``."""
    wanted = table.spark.createDataFrame([(w,) for w in dict.fromkeys(words)], "term string")
    return table.of_keys("postings", "term", wanted)
