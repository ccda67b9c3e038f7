"""Chat formatting by quotation linking.

A line that starts with ``>`` is quoted, once per mark. Lines of one level in a row are a passage. Passages
and messages are normalised (lower case, white space to one blank, ends cut) and hashed; a message can be
quoted whole, by paragraph (lines up to a blank one) or by line. A passage belongs to the earliest message
of the conversation that wrote such a text itself and stands before the quoting one; if the passage as a whole
has none, its lines are looked up and the longest that is found decides (ties: the first). A message replies to the original of its
first linked passage of the lowest level. Quoted lines, and a line "On ... wrote:" before them, leave the content.

Threads: a message without a reply target starts one. Conversations are ordered by thread (turn of its first
message), then turn, so a reply always follows its original. Hashes of originals are reduced to their first
turn before the join, so frequent passages make no pairs; positions are counted within slices of the sorted table first, which cut a long thread anywhere.

Cases. Empty table: no rows. Null text: empty content, no quotes. Null conv_id or turn: kept; a message without
turn neither replies nor is replied to and stands last. Repeated rows: each a message of its own with the same
target. Extra columns are ignored.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bibspark.llm.common import checkpointed, sliced, whole

QUOTED = r"^[\x20\t]*>"
# one character class, no repeated group: a line may hold any number of marks
MARKS = r"^([\x20\t>]*>)"
INTRO = r"(?md)^On [^\n]* wrote:[\x20\t]*\n(?=[\x20\t]*>)"
QUOTED_LINES = r"(?md)^[\x20\t]*>[^\n]*(\n|\z)"


def normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def key_of(text: Column) -> Column:
    return F.md5(normal(text))


def content(text: Column) -> Column:
    """The text without quoted lines and their introductions, blank ends cut."""
    return F.btrim(F.regexp_replace(F.regexp_replace(text, INTRO, ""), QUOTED_LINES, ""), F.lit(" \t\r\n"))


def passages(messages: DataFrame) -> DataFrame:
    """Per message (conv_id, turn, mark) and passage: run (from 1), level, body (its lines joined)."""
    rows = messages.where(F.col("text").rlike("(?md)" + QUOTED)).select("conv_id", "turn", "mark", F.posexplode(F.split("text", "\n")).alias("no", "line"))
    rows = rows.repartition("conv_id", "turn", "mark").dropDuplicates(["conv_id", "turn", "mark", "no"])
    marks = F.regexp_extract("line", MARKS, 1)
    rows = rows.withColumn("level", F.length(marks) - F.length(F.translate(marks, ">", ""))).withColumn("body", F.trim(F.substring("line", F.length(marks) + 1, F.length("line"))))
    order = W.partitionBy("conv_id", "turn", "mark").orderBy("no")
    fresh = (F.coalesce(F.lag("level").over(order), F.lit(0)) != F.col("level")).cast("int")
    rows = rows.withColumn("fresh", fresh).withColumn("run", F.sum("fresh").over(order)).where("level > 0")
    lines = F.transform(F.array_sort(F.collect_list(F.struct("no", "body"))), lambda x: x["body"])
    return rows.groupBy("conv_id", "turn", "mark", "run", "level").agg(F.array_join(lines, "\n").alias("body"))


def units(text: Column) -> Column:
    """A text whole, its paragraphs and its lines, as keys; blank ones left out."""
    every = F.concat(F.array(text), F.split(text, r"\n[\x20\t\r]*\n"), F.split(text, "\n"))
    return F.array_distinct(F.transform(F.filter(every, lambda x: normal(x) != ""), key_of))


def links(messages: DataFrame) -> DataFrame:
    """Passages with the turn of the message they come from (null: not found)."""
    found = passages(messages)
    own = messages.where(F.col("turn").isNotNull() & F.col("conv_id").isNotNull())
    own = own.select("conv_id", "turn", F.explode(units(F.col("content"))).alias("key"))
    first = own.groupBy("conv_id", "key").agg(F.min("turn").alias("origin"))
    line = F.transform(F.split("body", "\n"), lambda x, i: F.struct(F.lit(1).alias("part"), (-F.length(x)).alias("less"), i.alias("at"), key_of(x).alias("key"), normal(x).alias("norm")))
    every = F.struct(F.lit(0).alias("part"), F.lit(0).alias("less"), F.lit(0).alias("at"), key_of(F.col("body")).alias("key"), normal(F.col("body")).alias("norm"))
    keys = found.where("conv_id is not null").select("conv_id", "turn", "mark", "run", F.explode(F.concat(F.array(every), line)).alias("k")).select("*", "k.*")
    hits = keys.where("norm != ''").join(first, ["conv_id", "key"]).where("origin < turn")
    best = hits.groupBy("conv_id", "turn", "mark", "run").agg(F.min(F.struct("part", "less", "at", "origin"))["origin"].alias("origin"))
    same = [F.col(f"f.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("conv_id", "turn", "mark", "run")]
    return found.alias("f").join(best.alias("b"), same[0] & same[1] & same[2] & same[3], "left").select("f.*", "b.origin")


def roots(parents: DataFrame) -> DataFrame:
    """conv_id, turn, root of every message that replies; parents has (conv_id, turn, up). Each round
    doubles the steps looked ahead."""
    ahead = checkpointed(parents.select("conv_id", "turn", F.col("up").alias("root")))
    while True:
        up = ahead.select("conv_id", F.col("turn").alias("root"), F.col("root").alias("further"))
        step = checkpointed(ahead.join(up, ["conv_id", "root"], "left").select("conv_id", "turn", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        if step.where("moved").isEmpty():
            return step.drop("moved")
        ahead = step.drop("moved")


def conversations(messages: DataFrame) -> DataFrame:
    """Per message: conv_id, turn, role, position in the conversation's reply order (from 1), parent_turn,
    thread_turn, content, passages (number), linked (number found), deepest level, formatted."""
    text = whole(F.col("text").cast("string"))
    rows = messages.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), F.col("role").cast("string"), text.alias("text"))
    rows = rows.withColumn("mark", F.xxhash64("text")).withColumn("content", content(F.col("text")))
    quotes = checkpointed(links(rows))
    per = quotes.groupBy("conv_id", "turn", "mark").agg(
        F.count(F.lit(1)).alias("passages"), F.count("origin").alias("linked"), F.max("level").alias("levels"),
        F.min(F.when(F.col("origin").isNotNull(), F.struct("level", "run", "origin")))["origin"].alias("parent_turn"),
    )
    up = per.where("parent_turn is not null").groupBy("conv_id", "turn").agg(F.min("parent_turn").alias("up"))
    top = roots(up)
    per = per.select(*[F.col(c).alias(f"p_{c}") for c in ("conv_id", "turn", "mark")], "passages", "linked", "levels", "parent_turn")
    same = F.col("conv_id").eqNullSafe(F.col("p_conv_id")) & F.col("turn").eqNullSafe(F.col("p_turn")) & (F.col("mark") == F.col("p_mark"))
    rows = rows.join(per, same, "left").join(top, ["conv_id", "turn"], "left")
    rows = rows.withColumn("thread_turn", F.coalesce("root", "turn")).withColumn("no_thread", F.isnull("thread_turn")).withColumn("no_turn", F.isnull("turn"))
    order = ["conv_id", "no_thread", "thread_turn", "no_turn", "turn", "role", "mark"]
    rows = sliced(rows, *order)
    sizes = rows.groupBy("conv_id", "slice").agg(F.count(F.lit(1)).alias("many"))
    ahead = F.sum("many").over(W.partitionBy("conv_id").orderBy("slice")) - F.col("many")
    sizes = sizes.select(F.col("conv_id").alias("s_conv"), F.col("slice").alias("s_slice"), ahead.alias("before"))
    rows = rows.join(sizes, F.col("conv_id").eqNullSafe(F.col("s_conv")) & (F.col("slice") == F.col("s_slice")))
    inside = W.partitionBy("conv_id", "slice").orderBy(*order[1:])
    return rows.select(
        "conv_id", "turn", "role", (F.col("before") + F.row_number().over(inside)).alias("position"), "parent_turn", "thread_turn", "content",
        F.coalesce("passages", F.lit(0)).alias("passages"), F.coalesce("linked", F.lit(0)).alias("linked"), F.coalesce("levels", F.lit(0)).alias("levels"),
        F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"), F.col("content"), F.lit("\n")).alias("formatted"),
    )
