"""Document fingerprints by Order MinHash, and each document's edited copy.

A text's k-mers are runs of ``K`` words (fewer words: the whole sequence), each numbered by how often it
has occurred before in the text. A k-mer is told by the high 34 bits of its hash. Every tuple hashes all k-mers
with their numbers anew, by its own seed, and takes the two at the ends, the least and the greatest: as random a
pair as the two least, and two different k-mers in any text that has two. They are put in the order they have in
the text and hashed together. Two texts agree in a tuple when they share both k-mers in the same order, so moved
passages lower the likeness too, as they raise the edit distance. A text of one k-mer has it alone in each tuple.

Likeness: the root of the share of equal tuples among those that at least one of two texts has; 1 if neither has
any. The root, since both of a tuple's k-mers must agree.

``signatures`` is the older form, one hash that deals the k-mers into bins; short texts leave bins empty and tuples
without an order, so no query reads it.

The next document is the next lower doc_id. Documents are dealt into ranges of doc_id by quantiles of the
ids; the highest documents of a range are copied to the end of the range above it, so all neighbours meet
in one range and the texts move once.

Cases. Empty table: no rows. Null text: empty. No words: no k-mers, all tuples missing. Null doc_id: after
all others. Equal doc_ids stand in text order, repeated rows side by side. One document follows itself.
Extra columns are ignored.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bibspark.llm.common import checkpointed, whole

K = 3
TUPLES = 32
# low bits of a minimum hold the position: a text of 2 GB has fewer words
PLACE_BITS = 30
MASK = (1 << PLACE_BITS) - 1
ROWS_PER_RANGE = 1_000
MOST_RANGES = 10_000


def ranges(docs: DataFrame, rows_per_range: int) -> list[int]:
    """Upper ends of the ranges of doc_id, each an id that occurs, rising; at most MOST_RANGES numbers."""
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(2**63)))
    ids = docs.select(key.alias("key"))
    count, top = ids.agg(F.count(F.lit(1)), F.max("key")).first()
    n = min(MOST_RANGES, count // rows_per_range)
    if n < 2:
        return [] if top is None else [top]
    cuts = ids.agg(F.percentile_approx("key", [i / n for i in range(1, n)], 10 * n)).first()[0]
    return sorted({*cuts, top})


def in_range(key: Column, ends: list[int]) -> Column:
    """Index of the first end that is not below the key, looked up in two steps."""
    step = max(1, int(len(ends) ** 0.5))
    parts = [ends[i : i + step] for i in range(0, len(ends), step)]
    def bigints(xs):
        return F.array(*[F.lit(x).cast("bigint") for x in xs])
    part = F.size(F.filter(bigints([p[-1] for p in parts]), lambda e: e < key))
    inside = F.get(F.array(*[bigints(p) for p in parts]), part)
    return part * step + F.size(F.filter(inside, lambda e: e < key))


def neighbours(docs: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """doc_id, text and next_text, with the row's address (part, row) and that of the next document."""
    ends = ranges(docs, rows_per_range)
    n = max(1, len(ends))
    key = F.coalesce("doc_id", F.lit(-(2**63)))
    rows = docs.select(F.col("doc_id").cast("bigint"), whole(F.col("text")).alias("text"))
    rows = rows.withColumn("home", in_range(key, ends or [0]))
    first = F.array_contains(F.array(*[F.lit(e).cast("bigint") for e in ends or [0]]), key)
    above = F.when(first, F.array("home", (F.col("home") + 1) % n)).otherwise(F.array("home"))
    # a part that cannot be null takes no filter for a join, so all uses of the shuffled texts share one shuffle
    rows = rows.select("doc_id", "text", F.posexplode(above).alias("guest", "part")).withColumn("part", F.coalesce("part", F.lit(0)))
    rows = rows.repartition(n, "part")
    order = W.partitionBy("part").orderBy("guest", F.col("doc_id").desc_nulls_last(), "text")
    at_end = F.lead("guest").over(order) == 1
    rows = rows.select(
        "part", F.row_number().over(order).alias("row"), "guest", "doc_id", "text", F.lead("text").over(order).alias("next_text"), at_end.alias("last")
    ).where("guest = 0")
    return rows.select(
        "part", "row", "doc_id", "text", "next_text",
        F.when(F.col("last"), (F.col("part") + n - 1) % n).otherwise(F.col("part")).alias("next_part"),
        F.when(F.col("last"), 1).otherwise(F.col("row") + 1).alias("next_row"),
    )


def edited(text: Column, following: Column) -> Column:
    """The last floor(n/2) code points replaced by as many of the next text's first."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(following, F.lit(1), half))


def once(column: Column) -> Column:
    """The column as a generator's one row: the optimizer then keeps its value instead of making it anew for
    every use. The outer form is taken since a filter on the array would be inferred for the other."""
    return F.explode_outer(F.array(column))


def words_of(text: Column) -> Column:
    """Words as an array; cut at one character, which takes no pattern matching."""
    return F.array_remove(F.split(F.translate(text, "\t\n\x0b\x0c\r", " " * 5), " "), "")


def minima(each: DataFrame, keys: list[str], bins: int) -> DataFrame:
    """Rows of keys, kmer, nth and place: per key an array with each bin's least code, its place below it."""
    code = F.xxhash64("kmer", "nth")
    least = code.bitwiseAND(F.lit(~MASK)).bitwiseOR(F.col("place").cast("bigint"))
    per_bin = each.select(*keys, F.pmod(code, F.lit(bins)).alias("bin"), least.alias("least")).groupBy(*keys, "bin").agg(F.min("least").alias("least"))
    found = per_bin.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("bin", "least"))).alias("found"))
    found = found.select(*keys, once(F.col("found")).alias("found"))
    every = F.transform(F.sequence(F.lit(0).cast("bigint"), F.lit(bins - 1).cast("bigint")), lambda b: F.col("found")[b])
    return found.select(*keys, every.alias("least"))


def occurrences(texts: DataFrame, keys: list[str], k: int) -> tuple[DataFrame, DataFrame]:
    """Rows of keys, kmer, nth and place: all k-mers as first ones, and the repeated ones with their numbers.
    First occurrences need no numbering: the least place of a k-mer is the first. Only texts that repeat a k-mer
    are numbered. With the input dealt by some of the keys, k-mers are not dealt again."""
    rows = texts.select(*keys, once(words_of(F.col("text"))).alias("words")).where(F.size("words") > 0)
    high, after = F.lit(~MASK), range(1, k)

    def kmer(word: Column, i: Column) -> Column:
        return F.xxhash64(word, *[F.get("words", i + j) for j in after]).bitwiseAND(high)

    last = F.greatest(F.size("words") - k, F.lit(0))
    first = rows.select(*keys, "words", F.posexplode_outer("words").alias("place", "word")).where(F.col("place") <= last)
    first = first.select(*keys, kmer(F.col("word"), F.col("place")).alias("kmer"), F.lit(1).alias("nth"), "place")
    again = rows.select(*keys, once(F.transform(F.slice("words", F.lit(1), last + 1), kmer)).alias("kmers"))
    again = again.where(F.size(F.array_distinct("kmers")) < F.size("kmers"))
    placed = F.sort_array(F.transform("kmers", lambda x, i: x.bitwiseOR(i.cast("bigint"))))
    again = again.select(*keys, once(placed).alias("placed"))
    same = lambda x, i: F.shiftright(F.get("placed", F.greatest(i - 1, F.lit(0))), PLACE_BITS) == F.shiftright(x, PLACE_BITS)
    again = again.select(*keys, F.explode_outer(F.filter("placed", lambda x, i: (i > 0) & same(x, i))).alias("x"))
    again = again.select(*keys, F.col("x").bitwiseAND(high).alias("kmer"), F.col("x").bitwiseAND(F.lit(MASK)).alias("place"))
    # the mix leads the order: one number that tells nearly all groups apart
    order = W.partitionBy("mix", *keys, "kmer").orderBy("place")
    again = again.withColumn("mix", F.xxhash64(*keys, "kmer")).withColumn("nth", F.row_number().over(order) + 1)
    return first, again


def extremes(each: DataFrame, keys: list[str], tuples: int) -> DataFrame:
    """Rows of keys, kmer, nth and place: per key an array with each tuple's least code and, turned over, its greatest,
    each with its place below it."""
    place = F.col("place").cast("bigint")
    coded = each.select(*keys, F.xxhash64("kmer", "nth").alias("code"), place.alias("place"))

    def least(code: Column) -> Column:
        return F.min(code.bitwiseAND(F.lit(~MASK)).bitwiseOR(F.col("place")))

    codes = [F.xxhash64("code", F.lit(t)) for t in range(tuples)]
    ends = [end for t, c in enumerate(codes) for end in (least(c).alias(f"e{2 * t}"), least(F.bitwise_not(c)).alias(f"e{2 * t + 1}"))]
    return coded.groupBy(*keys).agg(*ends).select(*keys, F.array(*[f"e{i}" for i in range(2 * tuples)]).alias("least"))


def joined(first: DataFrame, again: DataFrame, keys: list[str], tuples: int) -> DataFrame:
    """The lesser of both sides' minima, two to a tuple: per key an array of ``tuples`` hashes."""
    both = first.union(again).groupBy(*keys).agg(F.collect_list("least").alias("l"))
    merged = F.when(F.size("l") == 2, F.zip_with(F.get("l", F.lit(0)), F.get("l", F.lit(1)), lambda a, b: F.least(a, b))).otherwise(F.get("l", F.lit(0)))
    least = both.select(*keys, once(merged).alias("least"))

    def joint(t: Column) -> Column:
        a, b = F.get("least", t * 2), F.get("least", t * 2 + 1)
        ha, hb, at = F.shiftright(a, PLACE_BITS), F.shiftright(b, PLACE_BITS), F.lit(MASK)
        pair = F.when(a.bitwiseAND(at) <= b.bitwiseAND(at), F.xxhash64(ha, hb)).otherwise(F.xxhash64(hb, ha))
        return F.when(a.isNotNull() | b.isNotNull(), pair.bitwiseAND(F.lit(0xFFFFFFFF)))

    return least.select(*keys, F.transform(F.sequence(F.lit(0), F.lit(tuples - 1)), joint).alias("signature"))


def ordered(texts: DataFrame, keys: list[str], k: int = K, tuples: int = TUPLES) -> DataFrame:
    """Per key, an array of ``tuples`` hashes of ordered pairs; texts without words have no row."""
    first, again = occurrences(texts, keys, k)
    return joined(extremes(first, keys, tuples), extremes(again, keys, tuples), keys, tuples)


def signatures(texts: DataFrame, keys: list[str], k: int = K, tuples: int = TUPLES) -> DataFrame:
    """Per key, an array of ``tuples`` hashes over bins, null where a tuple has no k-mer; texts without words have no row."""
    first, again = occurrences(texts, keys, k)
    return joined(minima(first, keys, 2 * tuples), minima(again, keys, 2 * tuples), keys, tuples)


def likeness(a: Column, b: Column) -> Column:
    """Root of equal tuples by tuples that at least one side has."""
    pairs = F.zip_with(a, b, lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    same = F.size(F.filter(pairs, lambda p: p["x"] == p["y"]))
    some = F.size(F.filter(pairs, lambda p: p["x"].isNotNull() | p["y"].isNotNull()))
    return F.when(some == 0, 1.0).otherwise(F.sqrt(same / some))


def written(signature: Column) -> Column:
    """Eight hex digits per tuple, dots for a missing one."""
    return F.array_join(F.transform(signature, lambda t: F.coalesce(F.lpad(F.lower(F.hex(t)), 8, "0"), F.lit("........"))), "")


def fingerprints(docs: DataFrame, k: int = K, tuples: int = TUPLES, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, both signatures, and their likeness (near_edited);
    next_signature and near_next for the next document."""
    near = neighbours(docs, rows_per_range).withColumn("edit", edited(F.col("text"), F.col("next_text")))
    heads = near.select("part", "row", "doc_id", F.length("text").alias("n_chars"), F.sha2("edit", 256).alias("edited_sha256"), "next_part", "next_row")
    both = near.select("part", "row", F.posexplode_outer(F.array("text", "edit")).alias("kind", "text"))
    found = ordered(both, ["part", "row", "kind"], k, tuples)
    none = F.array_repeat(F.lit(None).cast("bigint"), tuples)
    sides = found.groupBy("part", "row").agg(
        F.max(F.when(F.col("kind") == 0, F.col("signature"))).alias("signature"), F.max(F.when(F.col("kind") == 1, F.col("signature"))).alias("edited_signature")
    )
    rows = checkpointed(heads.join(sides, ["part", "row"], "left").withColumns({c: F.coalesce(c, none) for c in ("signature", "edited_signature")}))
    following = rows.select(F.col("part").alias("next_part"), F.col("row").alias("next_row"), F.col("signature").alias("next_signature"))
    return rows.join(following, ["next_part", "next_row"]).select(
        "doc_id", F.col("n_chars").cast("bigint"), "edited_sha256", "signature", "edited_signature", "next_signature",
        likeness(F.col("signature"), F.col("edited_signature")).alias("near_edited"),
        likeness(F.col("signature"), F.col("next_signature")).alias("near_next"),
    )
