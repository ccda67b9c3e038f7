"""Token ids of whole texts, and the exact length histogram.

The tokenizer cuts a text into parts (runs of letters, single digits, runs of marks) and encodes each alone. Parts
repeat, so a worker keeps the ids of the parts it has met, at most ``KNOWN``, the newer half when full, from one task to the next; a text's ids
are those of its parts put together, and a new part goes to the tokenizer's model directly. That holds for texts of Latin letters, whose
normal form is the lower-cased text. All other texts, and those that may hold a special token, go to the tokenizer whole.

``histogram`` counts documents by encoded length. Totals, quantiles and totals cut at a context limit for
every limit follow from sums over the lengths above: ``sum(min(length, L)) = tokens at or below L + L * documents above``.
The sums are taken in blocks of lengths first, so no task reads more than a block.

Cases. Empty table: no rows. Null text: empty, no tokens of its own. Repeated rows: counted each. Ties: one row per length.
Extra columns are ignored.
"""

import re
import sys
import types
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bibspark.session import ship

VOCABULARY = "word_bpe_49k.json"
KNOWN = 300_000
LONG = 64
BLOCK = 1024
# what the fast way leaves to the tokenizer: letters beyond Latin, and marks that Python takes for white space
OTHER = re.compile("[^\x00-\x1b\x20-\u024f]")
SPECIAL = "<|"


# the tokenizer's own parts, for lower-cased Latin letters; fixed values: its pattern's endings and classes
LETTERS = "a-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u02af\u2c65\u2c66"
DIGITS = "0-9\xb2\xb3\xb9\xbc-\xbe"
PART = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{DIGITS}]|[^\\s{LETTERS}{DIGITS}]+")


def visible() -> dict[int, str]:
    """A printable character for each byte, as byte-level models write it: its own where it has one, else the next after U+00FF."""
    own = {b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174}
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) if b in own else chr(256 + others.index(b)) for b in range(256)}


class Runs(dict):
    """Ids of a part as little-endian unsigned 32-bit numbers, encoded when first met."""

    def __init__(self, path: str | None = None):
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(VOCABULARY)
        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.visible = self.tokenizer.model, visible()

    def direct(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, part: str) -> bytes:
        shown = part if part.isascii() and part.isprintable() else part.encode().decode("latin-1").translate(self.visible)
        ids = np.array([t.id for t in self.model.tokenize(shown)], "<u4").tobytes()
        if len(part) <= LONG:
            if len(self) >= KNOWN:
                for old in list(islice(self, KNOWN // 2)):
                    del self[old]
            self[part] = ids
        return ids

    def text(self, text: str | None) -> bytes:
        if not text:
            return b""
        if SPECIAL in text or OTHER.search(text):
            return self.direct(text)
        return b"".join(map(self.__getitem__, PART.findall(text.lower())))


def kept(path: str | None) -> Runs:
    """The worker's own ``Runs``, which outlive a task."""
    worker = sys.modules.setdefault("_kept_token_ids", types.ModuleType("_kept_token_ids")).__dict__
    if path not in worker:
        worker[path] = Runs(path)
    return worker[path]


def mapped(docs: DataFrame, keep: list[str], make, schema: str, path: str | None) -> DataFrame:
    """``make(runs, kept values, text)`` yields output rows per document, written in small batches."""
    ship(__name__)
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches):
        runs = kept(path)
        for batch in batches:
            rows, size = [], 0
            columns = [batch.column(c).to_pylist() for c in keep]
            for i, text in enumerate(batch.column("text")):
                for row in make(runs, tuple(c[i] for c in columns), text.as_py()):
                    rows.append(row)
                    size += sum(len(x) for x in row if isinstance(x, bytes))
                    if len(rows) >= 4096 or size > 1 << 22:
                        yield table(rows, names, schema)
                        rows, size = [], 0
            if rows:
                yield table(rows, names, schema)

    return docs.select(*keep, F.col("text").cast("string")).mapInArrow(run, schema)


ARROW = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}


def table(rows: list[tuple], names: list[str], schema: str) -> pa.RecordBatch:
    types = [ARROW[part.split()[1]] for part in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def lengths(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, source and n_tokens."""

    def one(runs, kept, text):
        yield (*kept, len(runs.text(text)) // 4)

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("source").cast("string"), "text")
    return mapped(rows, ["doc_id", "source"], one, "doc_id bigint, source string, n_tokens bigint", path)


def pieces(docs: DataFrame, most: int, end: int = 1, path: str | None = None) -> DataFrame:
    """Each document's ids and the end id, cut after every ``most``: doc_id, piece, start, length and ids
    (bytes of little-endian unsigned 32-bit numbers)."""

    def cut(runs, kept, text):
        ids = runs.text(text) + np.uint32(end).astype("<u4").tobytes()
        for k in range(-(-len(ids) // (4 * most))):
            part = ids[4 * most * k : 4 * most * (k + 1)]
            yield (*kept, k, most * k, len(part) // 4, part)

    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    return mapped(rows, ["doc_id"], cut, "doc_id bigint, piece int, start bigint, length bigint, ids binary", path)


def histogram(lengths: DataFrame, length: str = "n_tokens") -> DataFrame:
    """Per occurring length: docs of that length, docs_above and tokens_above (longer ones), docs_upto,
    quantile (share of documents up to it), total (all tokens) and truncated (total if cut at it)."""
    counts = lengths.groupBy(F.col(length).cast("bigint").alias("length")).agg(F.count(F.lit(1)).alias("docs"))
    counts = counts.withColumn("tokens", F.col("length") * F.col("docs")).withColumn("block", F.floor(F.col("length") / BLOCK))
    blocks = counts.groupBy("block").agg(F.sum("docs").alias("d"), F.sum("tokens").alias("t"))
    above = W.orderBy(F.desc("block")).rowsBetween(W.unboundedPreceding, -1)
    every = W.partitionBy()
    blocks = blocks.select(
        "block", F.coalesce(F.sum("d").over(above), F.lit(0)).alias("d"), F.coalesce(F.sum("t").over(above), F.lit(0)).alias("t"),
        F.sum("d").over(every).alias("all_docs"), F.sum("t").over(every).alias("total"),
    )
    inside = W.partitionBy("block").orderBy(F.desc("length")).rowsBetween(W.unboundedPreceding, -1)
    rows = counts.join(blocks, "block")
    rows = rows.withColumn("docs_above", F.col("d") + F.coalesce(F.sum("docs").over(inside), F.lit(0)))
    rows = rows.withColumn("tokens_above", F.col("t") + F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
    upto = F.col("all_docs") - F.col("docs_above")
    return rows.select(
        "length", "docs", "docs_above", "tokens_above", upto.alias("docs_upto"), (upto / F.col("all_docs")).alias("quantile"), "total",
        (F.col("total") - F.col("tokens_above") + F.col("length") * F.col("docs_above")).alias("truncated"),
    )


def at_limits(hist: DataFrame, limits: list[int]) -> DataFrame:
    """Per context limit: documents longer than it, and all tokens if longer ones are cut at it. From
    the next longer length's row: what lies above the limit lies at or above that length."""
    pick = [F.min(F.when(F.col("length") > x, F.struct("length", "docs", "docs_above", "tokens_above"))).alias(f"at{i}") for i, x in enumerate(limits)]
    one = hist.agg(F.max("total").alias("total"), *pick)
    zero = F.lit(0).cast("bigint")
    rows = [
        F.struct(
            F.lit(x).cast("bigint").alias("limit"), F.coalesce(F.col(f"at{i}.docs") + F.col(f"at{i}.docs_above"), zero).alias("longer"),
            F.coalesce(F.col(f"at{i}.docs") * F.col(f"at{i}.length") + F.col(f"at{i}.tokens_above"), zero).alias("tokens"), F.col("total"),
        )
        for i, x in enumerate(limits)
    ]
    each = one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return each.select("limit", "longer", (F.col("total") - F.col("tokens") + F.col("limit") * F.col("longer")).alias("truncated"))


def quantile_lengths(hist: DataFrame, shares: list[float]) -> DataFrame:
    """Per share: the least length that at least that share of documents does not exceed."""
    return hist.agg(*[F.min(F.when(F.col("quantile") >= s, F.col("length"))).alias(f"q{i}") for i, s in enumerate(shares)]).select(
        F.explode(F.array(*[F.struct(F.lit(float(s)).alias("share"), F.col(f"q{i}").alias("length")) for i, s in enumerate(shares)])).alias("r")
    ).select("r.*")


