"""Derived columns of a citation catalogue.

Ranks inside a group are taken over a histogram: the distinct citation counts of a group with their
frequencies, aggregated before any shuffle. A group's window then sees its distinct counts, of which
there are few however many records it has.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bibspark.operators.overlap import HOT, top_overlaps
from bibspark.operators.paging import best_per_key
from bibspark.session import stored


def _by(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def cited_by_count(works: DataFrame, edges: DataFrame, key: str = "id") -> DataFrame:
    """Works with their number of incoming ``(citing, cited)`` edges, 0 where there are none."""
    counts = edges.groupBy(F.col("cited").alias(key)).agg(F.count("*").alias("cited_by_count"))
    return works.join(counts, key, "left").fillna({"cited_by_count": 0})


def counts_by_year(works: DataFrame, edges: DataFrame, this_year: int, n: int = 10, key: str = "id", year: str = "year") -> DataFrame:
    """(id, counts_by_year): citations by citing year over the last ``n`` years, latest first, years
    without any left out. An array holds at most ``n`` entries."""
    when = works.select(F.col(key).alias("citing"), F.col(year).alias("year"))
    recent = edges.join(when, "citing").where(F.col("year").between(this_year - n + 1, this_year))
    cells = recent.groupBy("cited", "year").agg(F.count("*").alias("cited_by_count"))
    listed = F.sort_array(F.collect_list(F.struct("year", "cited_by_count")), asc=False)
    return cells.groupBy(F.col("cited").alias(key)).agg(listed.alias("counts_by_year"))


def histogram_ranks(df: DataFrame, by, value: str) -> DataFrame:
    """Per group and distinct value: ``n`` records with it, ``below`` and ``above`` it, ``total`` in all."""
    by = _by(by)
    cells = df.groupBy(*by, value).agg(F.count("*").alias("n"))
    up = Window.partitionBy(*by).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cells = cells.withColumn("upto", F.sum("n").over(up)).withColumn("total", F.sum("n").over(Window.partitionBy(*by)))
    return cells.select(*by, value, "n", (F.col("upto") - F.col("n")).alias("below"), (F.col("total") - F.col("upto")).alias("above"), "total")


def h_index(df: DataFrame, key, citations: str) -> DataFrame:
    """The largest h with h records cited h times or more: the maximum over distinct counts c of
    min(c, records with c or more)."""
    ranks = histogram_ranks(df.where(F.col(citations).isNotNull()), key, citations)
    at_least = F.col("n") + F.col("above")
    return ranks.groupBy(*_by(key)).agg(F.max(F.least(F.col(citations).cast("bigint"), at_least)).alias("h_index"))


def i10(df: DataFrame, key, citations: str, least: int = 10) -> DataFrame:
    return df.groupBy(*_by(key)).agg(F.count_if(F.col(citations) >= least).alias("i10_index"))


def mean_citedness(works: DataFrame, edges: DataFrame, group: str, this_year: int, key: str = "id", year: str = "year") -> DataFrame:
    """Citations made in the year before, to works of the two years before that, per such work."""
    receiving = works.where(F.col(year).isin(this_year - 2, this_year - 3)).select(F.col(key).alias("cited"), group)
    citing = works.where(F.col(year) == this_year - 1).select(F.col(key).alias("citing"))
    received = edges.join(citing, "citing", "left_semi").groupBy("cited").agg(F.count("*").alias("n"))
    both = receiving.join(received, "cited", "left")
    return both.groupBy(group).agg((F.coalesce(F.sum("n"), F.lit(0)) / F.count("*")).alias("mean_citedness"))


def citations_received(works: DataFrame, edges: DataFrame, span: int = 3, key: str = "id", year: str = "year") -> DataFrame:
    """Works with ``received``: citations made in the year of publication and ``span`` years after."""
    cited = works.select(F.col(key).alias("cited"), F.col(year).alias("cited_year"))
    citing = works.select(F.col(key).alias("citing"), F.col(year).alias("citing_year"))
    dated = edges.join(citing, "citing").join(cited, "cited")
    dated = dated.where((F.col("citing_year") - F.col("cited_year")).between(0, span))
    counts = dated.groupBy(F.col("cited").alias(key)).agg(F.count("*").alias("received"))
    return works.join(counts, key, "left").fillna({"received": 0})


def fwci(received: DataFrame, by: list[str]) -> DataFrame:
    """Citations received over the mean of the record's group; NULL where that mean is 0 or a part of
    the group's key is missing. The input is computed once."""
    received = stored(received)
    means = received.groupBy(*by).agg(F.avg("received").alias("expected"))
    return received.join(means, by, "left").withColumn("fwci", F.when(F.col("expected") > 0, F.col("received") / F.col("expected")))


def norm_percentile(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Percent rank of the value within the group, and the flags for the top 1 % and 10 %; NULL where the
    value or a part of the group's key is missing. The input is computed once."""
    df = stored(df)
    ranks = histogram_ranks(df, by, value)
    share = F.when(F.col("total") > 1, F.col("below") / (F.col("total") - 1)).otherwise(0.0)
    out = df.join(ranks.select(*by, value, share.alias("percentile")), [*by, value], "left")
    return out.withColumn("is_in_top_1_percent", F.col("percentile") >= 0.99).withColumn("is_in_top_10_percent", F.col("percentile") >= 0.9)


def year_percentile(df: DataFrame, year: str, value: str) -> DataFrame:
    """Whole percents below, and up to and with, the value among records of the year; NULL where the
    year or the value is missing. The input is computed once."""
    df = stored(df)
    ranks = histogram_ranks(df, year, value)
    low = F.floor(F.when(F.col("total") > 1, 100 * F.col("below") / (F.col("total") - 1)).otherwise(0.0))
    high = F.floor(100 * (F.col("below") + F.col("n")) / F.col("total"))
    return df.join(ranks.select(year, value, low.cast("int").alias("min"), high.cast("int").alias("max")), [year, value], "left")


def related_works(works: DataFrame, terms: str, recency: str, k: int = 10, key: str = "id", hot: int = HOT) -> DataFrame:
    """(id, related_id, shared, rank): the records that share the most terms, the recent first. Null terms are
    left out. Records with the same set of terms count as one set, of which the ``k + 1`` newest can be answers; the sets meet in
    ``overlap.top_overlaps``. ``hot`` only decides which lists are read out; the result is exact with any."""
    members = F.array_sort(F.array_distinct(F.array_compact(terms)))
    sets = works.select(F.col(key).alias("related_id"), F.col(recency).alias("at"), members.alias("set")).where(F.size("set") > 0)
    sets = stored(sets.withColumn("sid", F.md5(F.to_json("set"))))
    newest = stored(best_per_key(sets, "sid", ["-at", "related_id"], k + 1, "nth"))
    best = top_overlaps(newest.where("nth = 1").drop("nth"), k + 1, hot).select("sid", F.col("other"), "shared")
    # one more than k, for the record itself may be among them
    offers = newest.select(F.col("sid").alias("other"), "at", "related_id")
    best = best_per_key(best.join(offers, "other"), "sid", ["-shared", "-at", "related_id"], k + 1)
    pairs = sets.select(F.col("related_id").alias(key), "sid").join(best, "sid").where(F.col(key) != F.col("related_id"))
    return best_per_key(pairs, key, ["-shared", "-at", "related_id"], k, "rank").select(key, "related_id", "shared", "rank")


def last_institutions(auth: DataFrame, author: str, work: str, date: str, institution: str) -> DataFrame:
    """All institutions on each author's latest work."""
    last = auth.groupBy(author).agg(F.max_by(F.col(work), F.struct(date, work)).alias(work))
    return auth.join(last, [author, work], "left_semi").select(author, institution).where(F.col(institution).isNotNull()).distinct()


def affiliation_years(auth: DataFrame, author: str, institution: str, year: Column) -> DataFrame:
    """(author, institution, years), latest first; a list holds calendar years, each once."""
    cells = auth.select(author, institution, year.alias("year")).distinct()
    return cells.groupBy(author, institution).agg(F.sort_array(F.collect_list("year"), asc=False).alias("years"))


def oa_status(is_oa_journal: Column, has_apc: Column, is_free_at_publisher: Column, has_open_license: Column, in_repository: Column) -> Column:
    return (
        F.when(is_oa_journal & ~has_apc, "diamond")
        .when(is_oa_journal, "gold")
        .when(is_free_at_publisher & has_open_license, "hybrid")
        .when(is_free_at_publisher, "bronze")
        .when(in_repository, "green")
        .otherwise("closed")
    )


def topic_share(pairs: DataFrame, entity: str, work: str, topic: str, k: int = 25) -> DataFrame:
    """Per entity its top topics: works, share of its own works, and share of all works on the topic. The input is computed once."""
    rows = stored(pairs.select(entity, work, topic).distinct())
    cells = rows.groupBy(entity, topic).agg(F.count("*").alias("count"))
    own = rows.groupBy(entity).agg(F.count_distinct(work).alias("__own"))
    whole = rows.groupBy(topic).agg(F.count_distinct(work).alias("__all"))
    shares = cells.join(own, entity).join(whole, topic)
    shares = shares.select(entity, topic, "count", (F.col("count") / F.col("__own")).alias("share"), (F.col("count") / F.col("__all")).alias("value"))
    return best_per_key(shares, entity, ["-count", topic], k, "rank")


def concept_scores(pairs: DataFrame, entity: str, work: str, concept: str, score: str, k: int = 25) -> DataFrame:
    """Per entity its strongest concepts, 0 to 100: the summed score over the number of its works."""
    one = stored(pairs.groupBy(entity, work, concept).agg(F.max(score).alias("__s")))
    own = one.groupBy(entity).agg(F.count_distinct(work).alias("__n"))
    sums = one.groupBy(entity, concept).agg(F.sum("__s").alias("__s")).join(own, entity)
    out = sums.select(entity, concept, F.round(F.round(100 * F.col("__s") / F.col("__n"), 9), 1).alias("score"))
    return best_per_key(out, entity, ["-score", concept], k, "rank")

