"""Mixing sources to target weights by Pareto order sampling.

A source whose target is ``r`` times its words gives ``floor(r)`` whole copies of every document for
certain. The rest of the target is drawn without replacement, at most one more copy each: inclusion
odds follow a document's words, so that a long document, which can swing the total, is all but certain
or all but out and the total stays near the target. Each document gets ``q = (u/(1-u)) / (p/(1-p))``
from its own uniform number ``u`` and inclusion probability ``p``; documents are taken in order of
``q`` until the words of the rest are reached (Pareto order sampling, with a sample size in words).

Cases. Empty table: no rows. Null text: no words, nothing taken. Null source: a source of its own, last
in order. Repeated rows (equal doc_id, source and words): separate documents, numbered by text, each with
its own ``u``. Extra columns are ignored. A source without words has target 0.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bibspark.llm.common import DOCUMENT, checkpointed, documents, lookup, n_words

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
# steps per doubling of q in the first pass that looks for the cut
STEPS = 4096
PLACE = ("q", "doc_id", "size", "turn")


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, words and number among rows equal in these; no text goes on from here. Equal rows
    are counted before the shuffle and numbered after it, so they never meet in one task."""
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("source").cast("string"), n_words(F.col("text")).alias("size"))
    groups = rows.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("many"))
    return groups.select("doc_id", "source", "size", F.explode(F.sequence(F.lit(1).cast("bigint"), "many")).alias("turn"))


def uniform(doc_id: Column, turn: Column, seed: int) -> Column:
    """A number inside (0, 1) that depends on the document and the seed alone: 48 bits of a digest, plus a half."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("null")), turn.cast("string")))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Per source: words, weight and target. Targets follow the weights, and none exceeds ``most`` times
    its source; with the excess shared again until none does, every other source ends at one common
    multiple of its weight, which running sums over the sources by falling room find at once.
    Windows here run over one row per source."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    order = W.orderBy(F.col("source").isNull(), "source")
    pick = F.array(*[F.lit(float(w)) for w in weights])
    sources = sources.withColumn("weight", F.get(pick, (F.row_number().over(order) - 1) % len(weights)))
    room = W.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source")
    before = room.rowsBetween(W.unboundedPreceding, -1)
    after = W.orderBy((F.col("source_size") / F.col("weight")).desc(), F.col("source").isNull().desc(), F.col("source").desc())
    total = F.sum("source_size").over(W.partitionBy())
    level = (share * total - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / F.sum("weight").over(
        after.rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    # from the first source that fits on, levels fall: the first is the largest
    common = F.max(F.when(F.col("fits"), F.col("level"))).over(W.partitionBy())
    return (
        sources.withColumn("level", level)
        .withColumn("fits", F.col("level") * F.col("weight") <= most * F.col("source_size"))
        .withColumn("target", F.least(most * F.col("source_size"), F.coalesce(common * F.col("weight"), most * F.col("source_size"))))
        .select("source", "source_size", "weight", "target")
    )


def scales(sizes: DataFrame, goals: DataFrame) -> DataFrame:
    """Per source: certain copies, the words left to draw, the size from which one more copy is certain,
    and the factor from words to inclusion probability below it. Runs over one row per source and size."""
    ratio = F.col("target") / F.col("source_size")
    goals = goals.withColumn("copies", F.when(F.col("source_size") > 0, F.floor(ratio)).otherwise(0).cast("bigint")).withColumn(
        "rest", F.col("target") - F.col("copies") * F.col("source_size")
    )
    cells = sizes.where("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    cells = cells.withColumn("words", F.col("size") * F.col("n")).withColumn("squares", (F.col("words") * F.col("size")).cast("decimal(38,0)"))
    down = W.partitionBy("source").orderBy(F.col("size").desc())
    up = W.partitionBy("source").orderBy("size")
    cells = cells.withColumn("above", F.coalesce(F.sum("words").over(down.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).withColumn(
        "below", F.sum("squares").over(up.rowsBetween(W.unboundedPreceding, W.currentRow)).cast("double")
    )
    cells = lookup(cells.withColumnRenamed("source", "s"), goals, F.col("s").eqNullSafe(F.col("source")), "inner")
    cells = cells.withColumn("scale", (F.col("rest") - F.col("above")) / F.col("below"))
    # the largest size that is not certain
    chosen = (
        cells.where(F.col("scale") * F.col("size") < 1)
        .groupBy(F.col("s").alias("cs"))
        .agg(F.max(F.struct("size", "scale")).alias("at"))
        .select("cs", F.col("at.size").alias("open_size"), F.col("at.scale").alias("scale"))
    )
    joined = goals.join(chosen, F.col("source").eqNullSafe(F.col("cs")), "left").drop("cs")
    # a source without words has nothing to draw
    return joined.withColumn("open_size", F.coalesce("open_size", F.lit(-1))).withColumn("scale", F.coalesce("scale", F.lit(0.0)))


def ranked(sizes: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """Documents with their source's plan and their place ``q`` in the order; null where nothing is drawn."""
    rows = lookup(sizes.withColumnRenamed("source", "s"), plan, F.col("s").eqNullSafe(F.col("source")))
    u, p = uniform(F.col("doc_id"), F.col("turn"), seed), F.col("scale") * F.col("size")
    drawn = (F.col("size") > 0) & (F.col("rest") > 0) & (F.col("size") <= F.col("open_size")) & (p > 0)
    odds = F.when(drawn, (u / (1.0 - u)) / (p / (1.0 - p)))
    return rows.withColumn("sure", (F.col("rest") > 0) & (F.col("size") > F.col("open_size"))).withColumn("q", odds)


def cuts(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """Per source: the last place taken. The words of steps of ``q`` are summed first, and only the
    documents of the step in which the rest is reached are put in order."""
    open_ = rows.where(F.col("q").isNotNull()).withColumn("step", F.floor(F.log2("q") * STEPS))
    steps = open_.groupBy("source", "step").agg(F.sum("size").alias("words"))
    by_step = W.partitionBy("source").orderBy("step").rowsBetween(W.unboundedPreceding, -1)
    steps = steps.withColumn("before", F.coalesce(F.sum("words").over(by_step), F.lit(0)))
    sure = rows.where("sure").groupBy("source").agg(F.sum("size").alias("sure_words"))
    need = goals.select("source", "rest").join(sure.withColumnRenamed("source", "ss"), F.col("source").eqNullSafe(F.col("ss")), "left")
    need = need.select(F.col("source").alias("ns"), (F.col("rest") - F.coalesce("sure_words", F.lit(0))).alias("need"))
    last = W.partitionBy("source")
    steps = steps.join(need, F.col("source").eqNullSafe(F.col("ns")), "inner")
    # the last step that starts below what is needed
    steps = steps.where(F.col("before") < F.col("need")).withColumn("at", F.max("step").over(last)).where("step = at")
    steps = checkpointed(steps.select(F.col("source").alias("cs"), F.col("step").alias("at"), "before", "need"))
    inside = lookup(open_, steps, F.col("source").eqNullSafe(F.col("cs")) & (F.col("step") == F.col("at")), "inner")
    run = F.sum("size").over(W.partitionBy("cs").orderBy(*PLACE).rowsBetween(W.unboundedPreceding, W.currentRow))
    upto = F.col("before") + F.col("run")
    # the document that crosses the mark is taken where that ends nearer to it
    taken = (upto <= F.col("need")) | ((upto - F.col("need") < F.col("need") - (upto - F.col("size"))) & (upto - F.col("size") < F.col("need")))
    inside = inside.withColumn("run", run).withColumn("taken", taken)
    # none taken inside the step: everything before the step is
    none = F.struct(F.lit(float("-inf")).alias("q"), F.lit(None).cast("bigint").alias("doc_id"), F.lit(0).cast("bigint").alias("size"), F.lit(0).cast("bigint").alias("turn"))
    one = inside.groupBy("cs", "at").agg(F.max(F.when(F.col("taken"), F.struct(*PLACE))).alias("cut"))
    return one.select(F.col("cs"), F.col("at"), F.coalesce("cut", none).alias("cut"))


class Mix:
    """The mix of one corpus: its plan per source, and each document's copies by it."""

    def __init__(self, docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = 42):
        self.docs, self.seed = docs, seed
        self.sizes = checkpointed(sized(docs))
        goals = checkpointed(targets(self.sizes, weights, share, most))
        self.plan = checkpointed(scales(self.sizes, goals))
        self.edge = checkpointed(cuts(ranked(self.sizes, self.plan, seed), self.plan))

    def decide(self, sizes: DataFrame) -> DataFrame:
        """Rows of doc_id, source, size and turn (and any more) with source_size, target and copies."""
        rows = lookup(ranked(sizes, self.plan, self.seed), self.edge, F.col("s").eqNullSafe(F.col("cs")))
        step = F.floor(F.log2("q") * STEPS)
        before = (step < F.col("at")) | ((step == F.col("at")) & (F.struct(*PLACE) <= F.col("cut")))
        one_more = F.col("sure") | F.coalesce(F.col("q").isNotNull() & before, F.lit(False))
        rows = rows.withColumn("copies", F.when(F.col("size") > 0, F.col("copies") + one_more.cast("bigint")).otherwise(F.lit(0).cast("bigint")))
        return rows.drop("source", "weight", "rest", "open_size", "scale", "sure", "q", "cs", "at", "cut").withColumnRenamed("s", "source")

    def documents(self) -> DataFrame:
        """Per document: doc_id, source, size, turn, source_size, target and copies (0 to ceil(most))."""
        return self.decide(self.sizes)

    def texts(self) -> DataFrame:
        """The input's rows of doc_id, text, lang, source and n_chars, each as often as the mix takes it.
        Only rows that share id, source and words with another are put in order; the others are number 1."""
        rows = documents(self.docs).withColumn("size", n_words(F.col("text")))
        many = checkpointed(self.sizes.where("turn = 2").select(*[F.col(c).alias(f"m_{c}") for c in ("doc_id", "source", "size")]))
        same = F.col("doc_id").eqNullSafe(F.col("m_doc_id")) & F.col("source").eqNullSafe(F.col("m_source")) & (F.col("size") == F.col("m_size"))
        marked = lookup(rows, many.withColumn("again", F.lit(True)), same).drop("m_doc_id", "m_source", "m_size")
        order = W.partitionBy("doc_id", "source", "size").orderBy("text", "lang", "n_chars")
        single = marked.where("again is null").withColumn("turn", F.lit(1).cast("bigint"))
        shared = marked.where("again").withColumn("turn", F.row_number().over(order).cast("bigint"))
        decided = self.decide(single.unionByName(shared).drop("again")).where("copies > 0")
        return decided.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies"))).select(*DOCUMENT)
