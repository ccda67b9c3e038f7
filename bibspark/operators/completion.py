"""A stored completion table: names by what is typed of them.

It has three parts, each in folders by a hash of its key, so that a completion opens few of them:

- ``heads``: (kind, at, tier, rid), sorted by ``at``, in folders by its first character. Of kind ``any`` are the first ``PREFIX`` characters of what
  stands at every word of a text, folded, once a record; of kind ``lead`` those of the name itself, as it is written, in lower case, as
  far as a text of the record has them; ``END`` stands behind a whole name. The rows of a prefix of up to ``PREFIX`` characters lie together.
  What is of both kinds is one row, and a record's number is in two columns, for narrower files.
- ``prefixes``: (kind, prefix, record), by prefix: the best ``best`` records of every prefix with more than ``OFTEN`` rows in ``heads`` and more
  than one in ``SHARE`` of all, so that a completion never needs more of them.
- ``records``: (rid, id, name, tie, phrases), by id, for ids, for the order and for what is typed beyond ``PREFIX``. The number ``rid`` says the
  folder too. What can be made of the id or the name is not stored again.

Records are in tiers by quantiles of the tie column. Of a prefix the tiers are counted first, and only those that hold the best ones are read.
No text moves, and no beginnings but the few of the best: every task writes the rows of its own records.

The answers are those of ``search.autocomplete``: the best of a query lie among the best that have it anywhere, by the tie column, the
best whose name starts with it and the best whose name it is, so three short lists give them exactly, however often a prefix occurs. Many
queries are answered at once, by equality joins.

Cases. Null texts do not match, null names have the least weight, null ties come last. A query of no word matches every record
with a text. Equal rows are records of their own.
"""

from dataclasses import dataclass, replace
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bibspark.functions.text import normal_phrase, texts
from bibspark.operators.search import SHORT_ENTITIES, SHORT_QUERY
from bibspark.operators.searchtable import _bucket, _written
from bibspark.session import checkpointed, local_frame, settings, stored

PREFIX = 12
HEAD = 64
BEST = 10
BUCKETS = 32
# a prefix with more rows than this, and than one in SHARE of all, has a list
OFTEN = 10_000
SHARE = 1000
# behind a whole name; no character of a text
END = "\uffff"
# what a beginning is of, as one number
ANY, LEAD, WHOLE = 1, 2, 4
# beginnings are counted up to these lengths, each time of those only that are frequent at the length before
STEPS = (4, 8, PREFIX + 1)
# the best of so many records are a tier
TIERS = (4096, 512, 64, 8)
# rows that a join may send to every task
SENT = 1_000_000
RECORD = ["rid", "id", "mark", "name", "tie"]
PACKED = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0"}
# shuffles go as soon as what needs them is stored
ONCE = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.files.maxPartitionBytes": "16m", "spark.sql.files.openCostInBytes": "64k"}
# a task sorts the beginnings of some 4 MB of records
SORTING = ONCE | {"spark.sql.files.maxPartitionBytes": "4m"}


@dataclass(frozen=True)
class CompletionTable:
    spark: SparkSession
    path: str
    buckets: int
    best: int
    schemas: dict
    # the columns that phrases are made of, where they are not stored
    made: tuple = ()
    few: bool = False

    def part(self, name: str) -> DataFrame:
        # an empty part has no file to read the columns from, and no folders
        rows = self.spark.read.schema(self.schemas[name]).parquet(f"{self.path}/{name}")
        return rows if len(rows._jdf.inputFiles()) else self.spark.createDataFrame([], self.schemas[name])

    def heads(self) -> DataFrame:
        """(kind, at, tier, rid, bucket): a row for each kind."""
        rows = self.part("heads")
        kinds = F.when(F.col("of") == ANY, F.array(F.lit("any"))).when(F.col("of").bitwiseAND(ANY) == 0, F.array(F.lit("lead"))).otherwise(F.array(F.lit("any"), F.lit("lead")))
        at = F.when((F.col("kind") == "lead") & (F.col("of") >= WHOLE), F.concat("at", F.lit(END))).otherwise(F.col("at"))
        rid = F.col("home") + F.col("low") * self.buckets
        return rows.withColumn("kind", F.explode(kinds)).select("kind", at.alias("at"), "tier", rid.alias("rid"), "bucket")

    def add(self, name: str, rows: DataFrame) -> DataFrame:
        self.schemas[name] = T.StructType([*rows.schema.fields, T.StructField("bucket", T.IntegerType())])
        return rows

    def of_keys(self, part: str, bucket: Column, asked: DataFrame, *on: str) -> DataFrame:
        """The rows of a part that meet the asked ones. Other folders are pruned while the join runs; those of heads, and all where ``few``
        texts are asked for, as the plan is made, from the folders' numbers."""
        asked = asked.withColumn("bucket", bucket)
        rows = self.heads() if part == "heads" else self.part(part)
        if self.few or part == "heads":
            rows = rows.where(F.col("bucket").isin(asked.agg(F.collect_set("bucket")).first()[0]))
        return rows.join(asked, ["bucket", *on]).drop("bucket")

    def whole(self, rows: DataFrame) -> DataFrame:
        """Rows of ``records`` with the columns that are not stored."""
        if "name" not in rows.columns:
            rows = rows.withColumn("name", F.col("id"))
        if self.made:
            one = F.when(F.col(self.made[0]).isNotNull(), F.array(normal_phrase(F.col(self.made[0])))).otherwise(F.array().cast("array<string>"))
            rows = rows.withColumn("phrases", one if len(set(self.made)) == 1 else _phrases(F.array(*self.made))).withColumn("mark", _mark())
        return rows

    def of_records(self, asked: DataFrame, key: str = "rid") -> DataFrame:
        """The asked rows with their records."""
        bucket = F.pmod("rid", F.lit(self.buckets)).cast("int") if key == "rid" else _bucket(F.col(key), self.buckets)
        return self.whole(self.of_keys("records", bucket, asked, key))

    def kept(self, rows: DataFrame) -> DataFrame:
        """Rows that several joins need, computed once, and sent to every task if they are no more than ``SENT``."""
        with settings(self.spark, ONCE):
            rows = checkpointed(rows) if self.few else stored(rows, "completed")
            return F.broadcast(rows) if rows.count() <= SENT else rows


def _phrases(every: Column) -> Column:
    return F.array_sort(F.array_distinct(F.transform(F.filter(every, lambda x: x.isNotNull()), normal_phrase)))


def _texts(df: DataFrame, cols: list[str]) -> Column:
    return _phrases(F.concat(*[F.coalesce(texts(df, c), F.array().cast("array<string>")) for c in cols]))


def _mark() -> Column:
    return F.xxhash64("id", "name", "tie", "phrases")


def _heads(phrase: Column, most: int) -> Column:
    """The first characters of what stands at each word of a phrase."""
    return F.regexp_extract_all(phrase, F.lit(f" (?=(.{{1,{most}}}))"), F.lit(1))


def _first_of(at: Column) -> Column:
    """The character that says the folder; the end of an empty name is none."""
    return F.translate(F.substring(at, 1, 1), END, "")


def _best_first(*first: Column) -> list[Column]:
    return [*first, F.desc_nulls_last("tie"), F.col("id"), F.col("mark")]


def _tier(rows: DataFrame) -> Column:
    """0 for the best records, by quantiles of the tie column, which need not be exact. Ties that are no numbers are all in one."""
    bounds = None
    if isinstance(rows.schema["tie"].dataType, T.NumericType):
        bounds = rows.agg(F.percentile_approx("tie", [1 - 1 / n for n in TIERS])).first()[0]
    above = reduce(lambda c, b: c + F.when(F.col("tie") >= b, 0).otherwise(1), bounds or [], F.lit(0))
    return above.cast("byte")


def _led(spoken: bool) -> Column:
    """The beginning of a record's name that its texts have. ``spoken``: they have all of it."""
    lower = F.lower("name")
    most = F.least(F.length(lower), F.lit(PREFIX))
    if not spoken:
        most = F.array_max(F.filter(F.sequence(F.lit(0), most), lambda k: F.exists("phrases", lambda x: x.contains(normal_phrase(F.substring(lower, F.lit(1), k))))))
    return F.substring(lower, F.lit(1), most)


def _beginnings() -> Column:
    """The beginnings at the words of a record; that of its name is marked if it is none of these."""
    heads = F.array_distinct(F.concat(F.array(F.lit("")), F.flatten(F.transform("phrases", lambda p: _heads(p, PREFIX)))))
    led = F.col("led")
    both = lambda hs: F.when(led.isNull() | F.array_contains(hs, led), hs).otherwise(F.concat(F.array(F.concat(F.lit(END), led)), hs))
    # a lambda binds the heads once
    return F.get(F.transform(F.array(heads), both), F.lit(0))


def _headed(table: CompletionTable, rows: DataFrame) -> DataFrame:
    """The rows of ``heads`` as they are stored, of records with a tier."""
    rows = rows.where(F.size("phrases") > 0).withColumn("led", _led("name" in table.made)).withColumn("whole", F.when(F.lower("name") == F.col("led"), WHOLE).otherwise(0))
    # the number in its partition, and what is the same for many
    low = F.pmod("rid", F.lit((1 << 33) * table.buckets)) - F.pmod("rid", F.lit(table.buckets))
    rows = rows.select(F.explode(_beginnings()).alias("at"), "led", "whole", "tier", (F.col("rid") - low).alias("home"), (low / table.buckets).cast("bigint").alias("low"))
    at, led, lead = F.col("at"), F.col("led"), LEAD + F.col("whole")
    of = F.when(at.startswith(END), lead).when(at == led, ANY + lead).when((at == "") & led.isNotNull(), F.lit(ANY + LEAD)).otherwise(ANY)
    return rows.select(F.when(at.startswith(END), led).otherwise(at).alias("at"), of.cast("byte").alias("of"), "tier", "home", "low")


def build(df: DataFrame, cols: list[str], key: str, name: str, tie: str, path: str, best: int = BEST, buckets: int = BUCKETS, often: int = OFTEN) -> CompletionTable:
    """Store the completion table of the texts under ``cols``, which may hold one text or an array of texts a record. A prefix with more
    than ``often`` rows, and one in ``SHARE`` of all, has its best records stored."""
    spark = df.sparkSession
    one = all(c in (key, name) and isinstance(df.schema[c].dataType, T.StringType) for c in cols)
    made = tuple("name" if c == name else "id" for c in cols) if one else ()
    table = CompletionTable(spark, path, buckets, best, {}, made)
    rows = df.select(F.col(key).alias("id"), *[F.col(name).alias("name")] * (name != key), F.col(tie).alias("tie"), *[] if made else [_texts(df, cols).alias("phrases")])
    if not made:
        rows = rows.withColumn("mark", _mark() if name != key else F.xxhash64("id", "id", "tie", "phrases"))
    rows = rows.withColumn("rid", F.monotonically_increasing_id() * buckets + _bucket(F.col("id"), buckets))
    with settings(spark, ONCE):
        _written(table.add("records", rows), f"{path}/records", "id", buckets, **PACKED)

    with settings(spark, SORTING):
        records = table.part("records")
        rows = _headed(table, table.whole(records).withColumn("tier", _tier(records))).sortWithinPartitions("at")
        _written(table.add("heads", rows), f"{path}/heads", _first_of(F.col("at")), buckets, **PACKED)

    with settings(spark, ONCE):
        _written(table.add("prefixes", _listed(table, often)), f"{path}/prefixes", "prefix", buckets, **PACKED)
    return table


def _counted() -> list[Column]:
    """Of rows with a tier and a rid: their number, and for each tier the records in it and the ones before, as bits. A record is one
    of 64, so that several rows of one do not count as several."""
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.xxhash64("rid"), F.lit(64)).cast("int"))
    return [F.count("*").alias("n"), *[F.bit_or(F.when(F.col("tier") <= i, bit).otherwise(0)).alias(f"bits{i}") for i in range(len(TIERS))]]


def _summed() -> list[Column]:
    return [F.sum("n").alias("n"), *[F.bit_or(f"bits{i}").alias(f"bits{i}") for i in range(len(TIERS))]]


def _last(best: int) -> Column:
    """The last tier that is needed for the best records, of counted rows."""
    return F.coalesce(*[F.when(F.bit_count(f"bits{i}") >= best, i) for i in range(len(TIERS))], F.lit(len(TIERS))).cast("byte").alias("last")


def _often(table: CompletionTable, often: int) -> DataFrame:
    """(kind, key, last): the beginnings of more than ``often`` heads and one in ``SHARE``."""
    found, before = [], None
    often = max(often, table.part("heads").count() // SHARE)
    for at, to in zip((0, *STEPS), STEPS, strict=False):
        rows = table.heads()
        if before is not None:
            parents = before.where(F.length("key") == at).select("kind", F.col("key").alias("start"))
            if parents.isEmpty():
                break
            # each has one in ``SHARE`` of the rows
            rows = rows.where(F.length("at") > at).withColumn("start", F.substring("at", 1, at)).join(F.broadcast(parents), ["kind", "start"], "left_semi")
        rows = rows.groupBy("kind", F.substring("at", 1, to).alias("cut")).agg(*_counted())
        # no character is the beginning of nothing but itself: a record has a row of its own for it
        long = F.when(F.col("cut") == "", F.array(F.lit(0))).otherwise(F.sequence(F.lit(at + 1), F.length("cut")))
        rows = rows.withColumn("long", F.explode(long)).withColumn("key", F.substring("cut", F.lit(1), F.col("long")))
        rows = rows.groupBy("kind", "key").agg(*_summed()).where(F.col("n") > often)
        before = stored(rows.select("kind", "key", _last(table.best)), "often")
        found.append(before)
    return reduce(DataFrame.unionByName, found)


def _begun(table: CompletionTable, keys: DataFrame, tier: int | None = None) -> DataFrame:
    """(kind, key, tier, rid): the heads that begin with a key (kind, key, ...). A head is cut to the lengths asked for at its first character."""
    firsts = keys.groupBy("kind", F.substring("key", 1, 1).alias("first")).agg(F.collect_set(F.length("key")).alias("lengths"))
    rows = table.of_keys("heads", _bucket(_first_of(F.col("first")), table.buckets), F.broadcast(firsts), "kind").where(F.substring("at", 1, 1) == F.col("first"))
    rows = rows if tier is None else rows.where(F.col("tier") <= tier)
    rows = rows.withColumn("long", F.explode(F.filter("lengths", lambda n: n <= F.length("at")))).withColumn("key", F.substring("at", F.lit(1), F.col("long")))
    return rows.join(keys, ["kind", "key"]).drop("at", "first", "long", "lengths")


def _best(table: CompletionTable, rows: DataFrame) -> DataFrame:
    """(kind, prefix, record): the best of rows (kind, key, rid)."""
    rows = table.of_records(table.kept(rows.select("kind", "key", "rid").distinct())).select("kind", F.col("key").alias("prefix"), *RECORD)
    order = W.partitionBy("kind", "prefix").orderBy(*_best_first())
    return rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= table.best).drop("place")


def _listed(table: CompletionTable, often: int) -> DataFrame:
    """The best records of the frequent beginnings."""
    keys = _often(table, often)
    lasts = sorted(x[0] for x in keys.select("last").distinct().collect())
    rows = [_begun(table, F.broadcast(keys.where(F.col("last") == x).drop("last")), x) for x in lasts]
    if not rows:
        rows = [table.heads().where(F.lit(False)).select("kind", F.col("at").alias("key"), "tier", "rid")]
    return _best(table, reduce(DataFrame.unionByName, rows))


def _asked(queries: DataFrame) -> DataFrame:
    """(query_id, raw, folded): the query in lower case, and its words folded."""
    rows = queries.where("text is not null")
    return rows.select("query_id", F.lower("text").alias("raw"), F.substring(normal_phrase(F.col("text")), 2, 2**31 - 1).alias("folded"))


def _by_heads(table: CompletionTable, asked: DataFrame) -> DataFrame:
    """The asked rows (kind, typed, ...) with the records that have what is typed at a word, up to ``HEAD`` characters. What stands there is cut to
    the lengths asked for at its beginning and meets the equal texts only, however many names begin alike."""
    asked = asked.withColumn("at", F.substring("typed", 1, PREFIX))
    lengths = table.kept(asked.groupBy("kind", "at").agg(F.collect_set(F.length("typed")).alias("lengths")))
    found = table.kept(table.of_keys("heads", _bucket(_first_of(F.col("at")), table.buckets), lengths, "kind", "at").drop("tier"))
    named = F.array(F.substring(F.lower("name"), 1, HEAD))
    heads = F.when(F.col("kind") == "lead", named).otherwise(F.array_distinct(F.flatten(F.transform("phrases", lambda p: _heads(p, HEAD)))))
    rows = table.of_records(found).withColumn("head", F.explode(F.filter(heads, lambda h: F.substring(h, 1, PREFIX) == F.col("at"))))
    rows = rows.withColumn("cut", F.explode(F.filter("lengths", lambda n: n <= F.length("head"))))
    rows = rows.withColumn("typed", F.substring("head", F.lit(1), F.col("cut"))).select("kind", "typed", *RECORD, "phrases").distinct()
    return rows.join(asked.drop("at"), ["kind", "typed"])


def _by_prefix(table: CompletionTable, short: DataFrame) -> DataFrame:
    """(query_id, raw, record): the best records of every asked row (query_id, raw, kind, prefix)."""
    keys = short.select("kind", "prefix").distinct()
    bucket = _bucket(F.col("prefix"), table.buckets)
    listed = table.of_keys("prefixes", bucket, short, "prefix", "kind").select("query_id", "raw", *RECORD)
    known = table.of_keys("prefixes", bucket, keys, "prefix", "kind").select("kind", "prefix").distinct()
    rare = table.kept(keys.join(known, ["kind", "prefix"], "left_anti").withColumnRenamed("prefix", "key"))
    last = table.kept(_begun(table, rare).groupBy("kind", "key").agg(*_counted()).select("kind", "key", _last(table.best)))
    rows = _best(table, _begun(table, last).where(F.col("tier") <= F.col("last")))
    return listed.unionByName(rows.join(short, ["kind", "prefix"]).select("query_id", "raw", *RECORD))


def _matches(table: CompletionTable, asked: DataFrame) -> DataFrame:
    """(query_id, raw, record): the best records of every query, and of a long one all that match."""
    raw, folded = F.length("raw"), F.length("folded")
    by_any, by_lead = F.lit("any").alias("kind"), F.lit("lead").alias("kind")
    short = asked.where(folded <= PREFIX).select("*", by_any, F.col("folded").alias("prefix"))
    for typed in (F.col("raw"), F.concat("raw", F.lit(END))):
        short = short.unionByName(asked.where(raw <= PREFIX).select("*", by_lead, typed.alias("prefix")))
    found = _by_prefix(table, short)

    typed = F.substring("folded", 1, HEAD)
    long = asked.where(folded > PREFIX).select("*", by_any, typed.alias("typed"))
    odd = asked.where((raw > PREFIX) & (folded <= PREFIX)).select("*", by_lead, F.substring("raw", 1, HEAD).alias("typed"))
    by_head = _by_heads(table, long.unionByName(odd))
    has = F.exists("phrases", lambda x: x.contains(F.concat(F.lit(" "), F.col("folded"))))
    # what lies beyond the heads is read in the record
    sure = by_head.where(F.when(F.col("kind") == "lead", F.lower("name").startswith(F.col("raw")) & has).otherwise((folded <= HEAD) | has))
    return found.unionByName(sure.select("query_id", "raw", *RECORD))


def _first(rows: DataFrame, n: int, *first: Column) -> DataFrame:
    order = W.partitionBy("query_id").orderBy(*_best_first(*first))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n).drop("raw")


def complete(table: CompletionTable, queries: DataFrame | list[str], n: int = BEST, norm=None) -> DataFrame:
    """(query_id, rank, id, name, tie, weight): the first ``n`` records of every query (query_id, text): exact names first, then names
    that start with it, then all that have it as a phrase prefix, by the tie column. With ``norm``, an id normaliser, a query
    that is an id in any spelling gives the record with that id instead. A list of texts is numbered from 0."""
    if isinstance(queries, list):
        table = replace(table, few=True)
        queries = local_frame(table.spark, query_id=pa.array(range(len(queries)), pa.int32()), text=pa.array(queries, pa.string()))
    out = _weighed(table, queries, n, norm)
    return _first(out, n, F.desc("weight")).select("query_id", "rank", "id", "name", "tie", "weight")


def _weighed(table: CompletionTable, queries: DataFrame, n: int, norm=None) -> DataFrame:
    if n > table.best:
        raise ValueError(f"the table keeps {table.best} records of a prefix")
    queries = table.kept(queries)
    if norm is None:
        rows = _matches(table, _asked(queries))
    else:
        named = queries.withColumn("id", norm(F.col("text")))
        rows = _matches(table, _asked(named.where("id is null")))
        ids = named.where("id is not null").select("query_id", F.lower("text").alias("raw"), "id")
        rows = rows.unionByName(table.of_records(ids, "id").select("query_id", "raw", *RECORD))
    rows = rows.dropDuplicates(["query_id", "rid"])
    lower = F.lower("name")
    return rows.withColumn("weight", F.when(lower == F.col("raw"), 1000).when(lower.startswith(F.col("raw")), 500).otherwise(1))


def complete_all(tables: dict[str, CompletionTable], queries: DataFrame, short=SHORT_ENTITIES, n: int = BEST) -> DataFrame:
    """Completion over the tables of several entities; short queries look at some entities only. Records to hide are left out
    when a table is built."""
    parts = []
    for entity, table in tables.items():
        mine = queries if entity in short else queries.where(F.length("text") > SHORT_QUERY)
        rows = _first(_weighed(table, mine, n), n, F.desc("weight"))
        parts.append(rows.select("query_id", F.col("id").cast("string").alias("id"), "mark", "name", F.col("tie").cast("bigint").alias("tie"), "weight", F.lit(entity).alias("entity_type")))
    both = reduce(DataFrame.unionByName, parts)
    order = W.partitionBy("query_id").orderBy(*_best_first(F.desc("weight")))
    return both.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n).drop("mark")


def suggest(table: CompletionTable, queries: DataFrame, n: int = BEST, min_len: int = 3) -> DataFrame:
    """(query_id, rank, phrase, count): the most frequent phrases that have the query, of a table of phrases with their counts."""
    if n > table.best:
        raise ValueError(f"the table keeps {table.best} records of a prefix")
    rows = _matches(table, _asked(table.kept(queries.where(F.length("text") >= min_len)))).dropDuplicates(["query_id", "rid"])
    return _first(rows, n).select("query_id", "rank", F.col("id").alias("phrase"), F.col("tie").alias("count"))
