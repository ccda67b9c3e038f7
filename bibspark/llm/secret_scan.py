"""Secret scans: base patterns in every text, and weak candidates linked into multipart credentials.

Three base kinds are always reported: ``assign``, ``access`` and ``hex``. Three weak kinds are looked for
as well: ``identifier`` (a named account or key id), ``secret`` (a long mixed token) and ``endpoint`` (an
address with a scheme). A weak candidate is reported only where its complement stands in the same scope, a run of
lines without a blank one, however far apart they are:

* an identifier beside a secret (assign, hex or weak secret),
* a secret beside an identifier (access or weak identifier),
* an endpoint beside both.

A weak candidate that base spans cover wholly adds nothing and is dropped, and so is a secret inside a weak
identifier: it is that one's value, not its complement. One that a base span overlaps in part stays. Spans are found by
splitting a text at a pattern, so their places are running sums over gaps and matches. Parts meet their scopes in an interval
join by a sweep over the parts and scope breaks of a text in order of place; no pairs are made. Only parts move, never texts, and
the weak patterns run only on texts that have both an identifier and a secret.

Cases. Empty table: no rows. Null text: empty, no spans. Repeated rows: the same result for each. Null doc_id:
kept. Extra columns are ignored. Offsets are code points, ends exclusive.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bibspark.llm.common import DOCUMENT, documents, whole

# kinds in the order in which they are listed at one place; the value is group 2 of assign
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = {"assign": ASSIGN, "access": r"AKIA[A-Z0-9]{16,}", "hex": r"[0-9a-f]{24,}"}
# at the start of a name or of a part of one: after '_', or where a camel-case part begins
IDENTIFIER = r"""(?i)(?:(?-i:(?<![A-Za-z0-9])|(?<=[a-z0-9])(?=[A-Z]))(?:access_?key_?id|client_?id|account_?id|user_?name|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@+-]{4,}|(?-i:(?<![A-Za-z0-9])ASIA[A-Z0-9]{16,}))"""
# may follow '=', as a value does its name; its own '=' is padding at the end
SECRET = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{32,}={0,2}(?![A-Za-z0-9+/=_-])"
ENDPOINT = r"""[a-z][a-z0-9+]{1,15}://[^\s"'<>]{3,}"""
WEAK = {"identifier": IDENTIFIER, "secret": SECRET, "endpoint": ENDPOINT}
BREAK = r"\n[\x20\t\r]*\n"
KINDS = [*BASE, *WEAK]
ASSIGN_CHARS = 6
ROLE = {"access": "id", "identifier": "id", "assign": "key", "hex": "key", "secret": "key"}


def pieces(text: Column, kind: str, pattern: str, on: Column | None = None) -> Column:
    """The matches of a pattern in order, each with the gap before it in characters and bytes."""
    found, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if kind == "assign" else found

    def piece(p: Column, i: Column) -> Column:
        match, gap = p["m"], F.get(gaps, i)
        good = F.lit(True)
        if kind == "assign":
            good = F.length(p["v"]) >= ASSIGN_CHARS
        elif kind == "secret":
            good = p["m"].rlike("[0-9]") & p["m"].rlike("[a-z]") & p["m"].rlike("[A-Z]")
        return F.struct(
            F.lit(kind).alias("kind"), i.alias("nth"), F.length(gap).alias("gap"), F.octet_length(gap).alias("bgap"), F.length(match).alias("len"),
            F.octet_length(match).alias("blen"), good.alias("good"),
        )

    listed = F.transform(F.zip_with(found, value, lambda m, v: F.struct(m.alias("m"), v.alias("v"))), piece)
    here = text.rlike(pattern) if on is None else on & text.rlike(pattern)
    return F.when(here, listed).otherwise(F.array().cast(
        "array<struct<kind:string,nth:int,gap:int,bgap:int,len:int,blen:int,good:boolean>>"))


def parts(docs: DataFrame) -> DataFrame:
    """All parts and scope breaks with their places, once per different (doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("bigint"), whole(F.col("text")).alias("text"))
    rows = rows.withColumns({k: pieces(F.col("text"), k, p) for k, p in BASE.items()})
    some = lambda k: F.size(k) > 0
    text = F.col("text")
    both = (some("access") | text.rlike(IDENTIFIER)) & (some("assign") | some("hex") | text.rlike(SECRET))
    rows = rows.withColumn("both", both)
    weak = {k: pieces(text, k, p, F.col("both")) for k, p in {**WEAK, "break": BREAK}.items()}
    rows = rows.withColumns({f"w_{k}": c for k, c in weak.items()})
    every = F.concat(*[F.col(k) for k in BASE], *[F.col(f"w_{k}") for k in weak])
    each = rows.select("doc_id", F.xxhash64("text").alias("mark"), F.explode(every).alias("p")).select("doc_id", "mark", "p.*")
    each = each.repartition("doc_id", "mark").dropDuplicates(["doc_id", "mark", "kind", "nth"])
    run = W.partitionBy("doc_id", "mark", "kind").orderBy("nth")
    each = each.withColumns({"end": F.sum(F.col("gap") + F.col("len")).over(run), "bend": F.sum(F.col("bgap") + F.col("blen")).over(run)})
    return each.where("good").select("doc_id", "mark", "kind", (F.col("end") - F.col("len")).alias("start"), "end", (F.col("bend") - F.col("blen")).alias("bstart"), "bend")


def linked(found: DataFrame) -> DataFrame:
    """Base parts, and those weak ones whose complement stands in their scope."""
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    text = W.partitionBy("doc_id", "mark")
    upto = text.orderBy("start", "rank", "end")
    before = upto.rowsBetween(W.unboundedPreceding, -1)
    role = F.create_map(*[F.lit(x) for kv in ROLE.items() for x in kv])[F.col("kind")]
    rows = found.withColumns({"rank": rank, "role": role, "base": F.col("kind").isin(*BASE)})

    def latest(which: Column) -> Column:
        return F.coalesce(F.max(F.when(which, F.col("end"))).over(before), F.lit(-1))

    # base spans that overlap or touch make a block; a weak one begins in or behind the block before it
    rows = rows.withColumns({
        "new": F.col("base") & (F.col("start") > latest(F.col("base"))), "named": (F.col("kind") == "secret") & (latest(F.col("kind") == "identifier") >= F.col("end")),
        "scope": F.sum((F.col("kind") == "break").cast("int")).over(upto),
    })
    rows = rows.withColumn("block", F.sum(F.col("new").cast("int")).over(upto)).where("kind != 'break'")
    end = F.max(F.when(F.col("base"), F.col("end"))).over(W.partitionBy("doc_id", "mark", "block"))
    rows = rows.withColumn("gone", ~F.col("base") & (F.coalesce(end >= F.col("end"), F.lit(False)) | F.col("named")))
    scope = W.partitionBy("doc_id", "mark", "scope")
    has = {r: F.coalesce(F.max(~F.col("gone") & (F.col("role") == r)).over(scope), F.lit(False)) for r in ("id", "key")}
    rows = rows.withColumns({f"{r}_here": c for r, c in has.items()})
    weak = (
        ((F.col("kind") == "identifier") & F.col("key_here"))
        | ((F.col("kind") == "secret") & F.col("id_here"))
        | ((F.col("kind") == "endpoint") & F.col("id_here") & F.col("key_here"))
    )
    return rows.where(F.col("base") | (weak & ~F.col("gone")))


def scan(docs: DataFrame) -> DataFrame:
    """Per document with spans: doc_id, mark (hash of its text) and spans, an array in order of start, then
    kind as listed, of (start, rank, kind, end, bstart, bend, base)."""
    spans = F.array_sort(F.collect_list(F.struct("start", "rank", "kind", "end", "bstart", "bend", "base")))
    return linked(parts(docs)).groupBy("doc_id", "mark").agg(spans.alias("spans"))


def with_spans(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """Rows that have doc_id and mark, with their spans; null for none."""
    found = scan(docs).select(F.col("doc_id").alias("f_id"), F.col("mark").alias("f_mark"), "spans")
    return rows.join(found, F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("mark") == F.col("f_mark")), "left").drop("f_id", "f_mark")


def secrets(docs: DataFrame) -> DataFrame:
    """Every document: doc_id and its spans (empty array for none)."""
    rows = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64(whole(F.col("text"))).alias("mark"))
    return with_spans(rows, docs).select("doc_id", F.coalesce("spans", F.array().cast(SPANS)).alias("spans"))


SPANS = "array<struct<start:bigint,rank:bigint,kind:string,end:bigint,bstart:bigint,bend:bigint,base:boolean>>"


def listed(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """documents with every span replaced by ``mask`` (spans that overlap or touch by one), n_chars anew.
    Texts are cut by byte places, in time linear in the text."""
    rows = documents(docs).withColumn("mark", F.xxhash64(whole(F.col("text"))))
    run = W.partitionBy("doc_id", "mark").orderBy("bstart", "bend").rowsBetween(W.unboundedPreceding, -1)
    cover = linked(parts(docs)).withColumn("upto", F.coalesce(F.max("bend").over(run), F.lit(-1))).withColumn("new", (F.col("bstart") > F.col("upto")).cast("int"))
    blocks = cover.withColumn("block", F.sum("new").over(W.partitionBy("doc_id", "mark").orderBy("bstart", "bend").rowsBetween(W.unboundedPreceding, W.currentRow)))
    blocks = blocks.groupBy("doc_id", "mark", "block").agg(F.min("bstart").alias("a"), F.max("bend").alias("b"))
    cuts = blocks.groupBy("doc_id", "mark").agg(F.array_sort(F.collect_list(F.struct("a", "b"))).alias("cuts"))
    cuts = cuts.select(F.col("doc_id").alias("f_id"), F.col("mark").alias("f_mark"), "cuts")
    rows = rows.join(cuts, F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("mark") == F.col("f_mark")), "left")
    # a generator keeps the optimizer from making the bytes anew for every piece
    rows = rows.withColumn("bytes", F.explode(F.array(F.col("text").cast("binary"))))

    def between(c: Column, i: Column) -> Column:
        start = F.when(i == 0, F.lit(0)).otherwise(F.get("cuts", i - 1)["b"])
        return F.concat(F.substring("bytes", (start + 1).cast("int"), (c["a"] - start).cast("int")).cast("string"), F.lit(mask))

    tail = F.substring("bytes", (F.element_at("cuts", -1)["b"] + 1).cast("int"), F.octet_length("text")).cast("string")
    text = F.when(F.col("cuts").isNull(), F.col("text")).otherwise(F.concat(F.array_join(F.transform("cuts", between), ""), tail))
    rows = rows.withColumn("text", text)
    return rows.withColumn("n_chars", F.when(F.col("cuts").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("bigint"))).select(*DOCUMENT)
