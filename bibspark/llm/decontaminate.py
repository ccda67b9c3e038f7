"""Benchmark decontamination by a generalised suffix automaton of the items' words.

A text is lower-cased (A-Z only) and cut into words: letters, digits and everything beyond ASCII. Items are dealt
into blocks of at most ``BLOCK_WORDS`` words; a task builds the automaton of a block, whose states are the sets of
places where a run of words ends. A document's words stream through it: the state and the length of the
longest run of words that ends here and stands in some item. A match counts once it has ``length`` words, or
covers the share ``coverage`` of its item: an item's windows are its runs of ``min(length, ceil(coverage * words))``
words. A word is hit if an occurrence of a window holds it. Before the words stream, pairs of neighbours that no item holds are
looked up for a whole text at once; no match crosses such a pair, so only stretches without one go through.

An item longer than a block goes in pieces that overlap by a window, so no window is lost. Automata go to the tasks
by broadcast, as many at a time as ``SENT_BYTES`` allows (a million words of items, say); each round reads the
documents once and adds its spans and items to those found before.

``matched`` gives spans and items, ``cleaned`` the texts without the spans, and without the documents of which too much is hit.

Cases. Empty documents: no rows; empty benchmark: no hits. Null or wordless texts have no words; such items have no
windows. Repeated documents are answered each. Rows with one item id count as one item; an item without id marks words
but is not counted or listed. Very long texts go through whole, in memory of a few times their size. Extra columns are ignored.
"""

import pickle
import re
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bibspark.llm.common import checkpointed
from bibspark.session import ship

LENGTH = 10
COVERAGE = 1.0
BLOCK_WORDS = 100_000
SENT_BYTES = 32 << 20
MOST_HIT = 0.5
TABLE_BITS = 20
# a word before A-Z are lower-cased
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# bytes of a text: A-Z to a-z, other ASCII but letters and digits to a blank, the rest as it is
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(FOLD).split() if text else []


class Automaton:
    """Suffix automaton of several word sequences, with the windows that end in each state."""

    def __init__(self, items: list[tuple[int | None, int, bytes]]):
        """``items``: (id, words of a window, text)."""
        self.number: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        numbered = [(item, size, [self.number.setdefault(w, len(self.number) + 1) for w in words_of(text)]) for item, size, text in items]
        for _, _, words in numbered:
            last = 0
            for w in words:
                last = self.extend(last, w)
        self.mark(numbered)
        pairs = {(a << 32) | b for _, _, words in numbered for a, b in zip(words, words[1:])}
        self.slots = np.unique(self.slot(np.array(sorted(pairs), np.uint64))).astype(np.uint32)

    @classmethod
    def of(cls, state: dict) -> "Automaton":
        """From the attributes of one, with the table of pairs that a task needs."""
        made = cls.__new__(cls)
        made.__dict__ = dict(state)
        made.pairs = np.zeros(1 << TABLE_BITS, bool)
        made.pairs[made.slots] = True
        return made

    @staticmethod
    def slot(code: np.ndarray) -> np.ndarray:
        return (code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TABLE_BITS)

    def extend(self, last: int, word: int) -> int:
        """The state of the sequence of ``last`` and this word; new states and links as needed."""
        there = self.next[last].get(word)
        if there is not None:
            return there if self.len[there] == self.len[last] + 1 else self.split(last, word, there)
        new = self.state({}, self.len[last] + 1, 0)
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = new
            at = self.link[at]
        if at >= 0:
            there = self.next[at][word]
            self.link[new] = there if self.len[there] == self.len[at] + 1 else self.split(at, word, there)
        return new

    def state(self, after: dict, length: int, link: int) -> int:
        self.next.append(after)
        self.len.append(length)
        self.link.append(link)
        return len(self.len) - 1

    def split(self, at: int, word: int, there: int) -> int:
        """A state for the shorter runs of ``there``, those that also end elsewhere."""
        short = self.state(dict(self.next[there]), self.len[at] + 1, self.link[there])
        self.link[there] = short
        while at >= 0 and self.next[at].get(word) == there:
            self.next[at][word] = short
            at = self.link[at]
        return short

    def step(self, state: int, length: int, word: int) -> tuple[int, int]:
        """State and length of the longest run that ends with ``word``."""
        while state and word not in self.next[state]:
            state = self.link[state]
            length = self.len[state]
        there = self.next[state].get(word)
        return (0, 0) if there is None else (there, length + 1)

    def mark(self, items: list[tuple[int | None, int, list[int]]]) -> None:
        """``ends[state]``: (words, owner) of windows that end there, longest first; ``owned[owner]``: their items."""
        self.least = min((size for _, size, _ in items), default=0)
        owned: dict[tuple[int, int], set] = {}
        for item, size, words in items:
            state = 0
            for at, w in enumerate(words, 1):
                state = self.next[state][w]  # the item's own beginnings are states
                if at >= size:
                    owner = state
                    while self.len[self.link[owner]] >= size:
                        owner = self.link[owner]
                    owned.setdefault((owner, size), set()).add(item)
        by_state: dict[int, list[int]] = {}
        for owner, size in owned:
            by_state.setdefault(owner, []).append(size)
        self.owned = {key: sorted(i for i in found if i is not None) for key, found in owned.items()}
        self.ends: list[tuple] = [()] * len(self.len)
        for state in sorted(range(1, len(self.len)), key=self.len.__getitem__):
            above = self.ends[self.link[state]]
            mine = by_state.get(state)
            self.ends[state] = (*((size, (state, size)) for size in sorted(mine, reverse=True)), *above) if mine else above

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Spans of hit words (start, end) in order, disjoint, and the windows met."""
        spans: list[list[int]] = []
        met: set = set()
        if not words:
            return [], met
        ids = np.fromiter(map(self.number.get, words, repeat(0)), np.uint64, len(words))
        joined = self.pairs[self.slot((ids[:-1] << np.uint64(32)) | ids[1:])] & (ids[:-1] > 0) & (ids[1:] > 0)
        # stretches of known words without an unknown pair
        breaks = np.flatnonzero(~joined) + 1
        starts, stops = np.concatenate([[0], breaks]), np.concatenate([breaks, [len(ids)]])
        long = (stops - starts >= self.least) & (ids[starts] > 0)
        for start, stop in zip(starts[long].tolist(), stops[long].tolist()):
            state = length = 0
            for at, word in enumerate(ids[start:stop].tolist(), start):
                state, length = self.step(state, length, word)
                best = 0
                for size, owner in self.ends[state]:
                    if size <= length:
                        best = best or size
                        met.add(owner)
                if best:
                    first = at + 1 - best
                    while spans and spans[-1][0] >= first:
                        spans.pop()
                    if spans and spans[-1][1] >= first:
                        spans[-1][1] = at + 1
                    else:
                        spans.append([first, at + 1])
        return [(a, b) for a, b in spans], met


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def pieces(benchmark: DataFrame, length: int, coverage: float, block_words: int) -> DataFrame:
    """item_id, size (words of a window), text and n (words) of every item, in pieces of at most a block."""
    words = F.regexp_extract_all(F.col("text").cast("string"), F.lit(f"({WORD})"))
    rows = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), words.alias("words")).where(F.size("words") > 0)
    size = F.least(F.lit(length), F.greatest(F.lit(1), F.ceil(F.lit(float(coverage)) * F.size("words")))).cast("int")
    rows = rows.withColumn("size", size)
    starts = F.sequence(F.lit(0), F.size("words") - F.col("size"), F.lit(block_words))
    rows = rows.select("item_id", "size", "words", F.explode(starts).alias("start"))
    rows = rows.select("item_id", "size", F.slice("words", F.col("start") + 1, F.lit(block_words - 1) + F.col("size")).alias("part"))
    return rows.select("item_id", "size", F.array_join("part", " ").cast("binary").alias("text"), F.size("part").cast("bigint").alias("n"))


def automata(benchmark: DataFrame, length: int, coverage: float, block_words: int) -> DataFrame:
    """block and its automaton (bytes). Blocks hold the rows of a stored table in order, by running word counts."""
    ship(__name__)
    items = checkpointed(pieces(benchmark, length, coverage, block_words).withColumn("part", F.spark_partition_id()))
    sizes = items.groupBy("part").agg(F.sum("n").alias("of_part"))
    sizes = sizes.select("part", (F.sum("of_part").over(W.orderBy("part")) - F.col("of_part")).alias("before"))
    running = F.sum("n").over(W.partitionBy("part").orderBy("item_id", "text").rowsBetween(W.unboundedPreceding, -1))
    items = items.join(sizes, "part").withColumn("block", F.floor((F.col("before") + F.coalesce(running, F.lit(0))) / block_words))

    def build(block: tuple, part: pa.Table) -> pa.Table:
        columns = [part.column(c).to_pylist() for c in ("item_id", "size", "text")]
        made = Automaton(list(zip(*columns)))
        return pa.table({"block": pa.array([block[0].as_py()], pa.int64()), "automaton": pa.array([pickle.dumps(made.__dict__)], pa.binary())})

    return items.select("block", "item_id", "size", "text").groupBy("block").applyInArrow(build, "block bigint, automaton binary")


def rounds(built: DataFrame, most: int):
    """Automata, of at most ``most`` bytes together (or one), round by round."""
    size = built.select("block", F.length("automaton").alias("bytes"))
    before = F.sum("bytes").over(W.orderBy("block").rowsBetween(W.unboundedPreceding, -1))
    planned = checkpointed(size.select("block", F.floor(F.coalesce(before, F.lit(0)) / most).alias("round")))
    last = planned.agg(F.max("round")).first()[0]
    for r in range(-1 if last is None else last + 1):
        yield [pickle.loads(x["automaton"]) for x in built.join(planned.where(F.col("round") == r), "block").select("automaton").collect()], r == last


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
ITEMS = pa.list_(pa.int64())
FOUND = [("n_words", "bigint", pa.int64()), ("spans", "array<struct<start:bigint,stop:bigint>>", SPANS), ("items", "array<bigint>", ITEMS)]


def scanned(rows: DataFrame, automata: list[dict], keep: list[str]) -> DataFrame:
    """The columns ``keep`` with n_words, spans and items, those that rows may have from earlier rounds included."""
    sent = rows.sparkSession.sparkContext.broadcast(automata)
    before = "spans" in rows.columns
    schema = T.StructType([*(rows.schema[c] for c in keep), *(T.StructField(n, T._parse_datatype_string(t)) for n, t, _ in FOUND)])

    def run(batches):
        made = [Automaton.of(x) for x in sent.value]
        for batch in batches:
            counts, spans, items = [], [], []
            earlier = zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist()) if before else repeat(([], []))
            for text, (had, listed) in zip(batch.column("_bytes"), earlier):
                words = words_of(text.as_py())
                all_spans, all_items = [(x["start"], x["stop"]) for x in had], set(listed)
                for automaton in made:
                    new, met = automaton.hits(words)
                    all_spans += new
                    for owner in met:
                        all_items.update(automaton.owned[owner])
                counts.append(len(words))
                spans.append([{"start": a, "stop": b} for a, b in merged(all_spans)])
                items.append(sorted(all_items))
            new = [pa.array(x, t) for x, (_, _, t) in zip((counts, spans, items), FOUND)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *new], schema.names)

    had = ["spans", "items"] if before else []
    return rows.select(*keep, *had, F.col("text").cast("string").cast("binary").alias("_bytes")).mapInArrow(run, schema)


def matched(docs: DataFrame, benchmark: DataFrame, keep: list[str], length: int = LENGTH, coverage: float = COVERAGE, block_words: int = BLOCK_WORDS,
            sent: int = SENT_BYTES) -> DataFrame:
    """Per document: the columns ``keep``, n_words, spans (of hit words: start, stop; disjoint, in order) and items (ids, ascending)."""
    ship(__name__)
    built = checkpointed(automata(benchmark, length, coverage, block_words))
    rows, more = docs, list(dict.fromkeys([*keep, "text"]))
    for automata_now, last in rounds(built, sent):
        rows = scanned(rows, automata_now, keep if last else more)
        if last:
            return rows
        rows = checkpointed(rows)
    return scanned(rows, [], keep)


def cleaned(docs: DataFrame, benchmark: DataFrame, length: int = LENGTH, coverage: float = COVERAGE, most_hit: float = MOST_HIT) -> DataFrame:
    """Documents with hit spans cut out of their texts; those with over ``most_hit`` of their words hit go."""
    columns = [c for c in docs.columns if c not in ("n_words", "spans", "items")]
    found = matched(docs.select(*columns), benchmark, columns, length, coverage)
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda s, x: s + x["stop"] - x["start"])
    kept = found.where(hit <= F.lit(float(most_hit)) * F.col("n_words"))
    schema = T.StructType([T.StructField(c, T.StringType()) if c == "text" else docs.schema[c] for c in columns])

    def run(batches):
        word = re.compile(WORD)
        for batch in batches:
            texts = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                if spans:
                    at = [m.span() for m in word.finditer(text)]
                    parts, end = [], 0
                    for x in spans:
                        parts.append(text[end : at[x["start"]][0]])
                        end = at[x["stop"] - 1][1]
                    text = "".join([*parts, text[end:]])
                texts.append(text)
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in columns], columns)

    return kept.withColumn("text", F.col("text").cast("string")).select(*columns, "spans").mapInArrow(run, schema)


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 (of the ids sorted as strings) and contaminated, per document."""
    found = matched(docs.withColumn("doc_id", F.col("doc_id").cast("bigint")), benchmark, ["doc_id"])
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda s, x: s + x["stop"] - x["start"])
    ids = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"), F.sha2(ids, 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))
