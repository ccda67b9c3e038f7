"""SimHash near-dedup with bit-sliced comparison.

A text's fingerprint is the majority of its shingle hashes, bit by bit. Equal fingerprints are one from
here on. Two fingerprints within ``radius`` bits agree in all but ``radius`` of ``PARTS`` parts, so every choice
of the other parts is a bucket key, and each close pair meets in some bucket. Rows of buckets arrive in order;
whole buckets are filled into blocks and each block is compared with itself bit-sliced: 64 fingerprints to a
machine word, one word per bit plane. For every row a plane is compared with that row's bit, and the differences
are added to carry-save counters of a few bits, 64 distances at once. The counters start so high that the first
difference beyond the radius carries out of the top; words in which all lanes have done so are abandoned.
Links found inside a block leave it as a spanning star per group, so no pairs are written. Buckets above
``CELL`` rows are dealt into cells that cover all their pairs.

Cases. Empty table: no rows. Null or empty text, or no words: fingerprint zero, linked like any other. Fewer words
than a shingle: one shingle. Repeated rows: in one component. Null doc_id: never the smallest; a component
without any id has a null component_id. Extra columns are ignored.
"""

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bibspark.llm.common import DOCUMENT, checkpointed, documents, lookup, whole
from bibspark.llm.graph import components
from bibspark.session import ship

SHINGLE = 3
RADIUS = 2
SEED = 42
PARTS = 4
CELL = 4096
BLOCK = 512
AT_ONCE = 1 << 15
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash; bytes.lower and bytes.split know ASCII letters and white space only."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        shingles, n = iter([b" ".join(words)]), 1
    else:
        shingles, n = map(b" ".join, zip(*(words[i:] for i in range(shingle)))), len(words) - shingle + 1
    hashes = map(xxhash.xxh64_intdigest, shingles, repeat(seed))
    ones = np.zeros(64, np.int64)
    for left in range(n, 0, -AT_ONCE):
        part = np.fromiter(hashes, "<u8", min(left, AT_ONCE))
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """doc_id and fp (the 64 bits as a signed long)."""
    ship(__name__)

    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle, seed) for t in batch.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, "doc_id bigint, fp bigint")


def close_pairs(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs i < j of 64-bit values that differ in at most radius bits."""
    n = len(fps)
    words = -(-n // 64)
    lanes = np.zeros(words * 64, np.uint64)
    lanes[:n] = fps
    bits = np.unpackbits(lanes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    planes = np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view(np.uint64)
    own = np.where(bits[:n].T.astype(bool), ALL, np.uint64(0))
    row, word = (x.astype(np.int32) for x in np.nonzero(np.arange(words)[None, :] >= (np.arange(n) // 64)[:, None]))
    # lanes up to the row itself, and those behind the last row, count as done
    over = np.zeros(len(row), np.uint64)
    same = word == row // 64
    over[same] = ALL >> (np.uint64(63) - (row[same] % 64).astype(np.uint64))
    if n % 64:
        over[word == words - 1] |= ALL << np.uint64(n % 64)
    size = (radius + 1).bit_length()
    start = (1 << size) - 1 - radius
    counters = [np.full(len(row), ALL if start >> k & 1 else 0, np.uint64) for k in range(size)]
    for b in range(64):
        carry = planes[b][word] ^ own[b][row]
        for c in counters:
            both = c & carry
            c ^= carry
            carry = both
        over |= carry
        if b % 4 == 3:
            live = over != ALL
            if not live.all():
                row, word, over = row[live], word[live], over[live]
                counters = [c[live] for c in counters]
    near, lane = np.nonzero(np.unpackbits((~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
    return row[near].astype(np.int64), word[near].astype(np.int64) * 64 + lane


def stars(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """The same groups as the close pairs, each row linked to its group's first."""
    i, j = close_pairs(fps, radius)
    first = np.arange(len(fps))
    while True:
        least = np.minimum(first[i], first[j])
        after = first.copy()
        np.minimum.at(after, i, least)
        np.minimum.at(after, j, least)
        after = after[after]
        if (after == first).all():
            break
        first = after
    linked = first != np.arange(len(fps))
    return fps[linked], fps[first[linked]]


def keys(fp: Column, radius: int, parts: int) -> Column:
    """Bucket keys: the bits of each choice of parts - radius parts, with the number of the choice."""
    edge = [64 * i // parts for i in range(parts + 1)]
    masks = [sum(((1 << (edge[p + 1] - edge[p])) - 1) << edge[p] for p in chosen) for chosen in combinations(range(parts), parts - radius)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    return F.array(*[F.struct(F.lit(k).alias("choice"), fp.bitwiseAND(F.lit(m)).alias("key")) for k, m in enumerate(signed)])


def links(fps: DataFrame, radius: int = RADIUS, parts: int | None = None, cell: int = CELL) -> DataFrame:
    """Edges (a, b) between different fingerprints that connect all that are within radius bits."""
    ship(__name__)
    rows = fps.select("fp", F.explode(keys(F.col("fp"), radius, max(parts or PARTS, radius + 1))).alias("k")).select("fp", "k.*")
    sizes = rows.groupBy("choice", "key").agg(F.count(F.lit(1)).alias("many")).where("many > 1")
    rows = rows.join(sizes, ["choice", "key"])
    slots = F.ceil(F.col("many") / cell).cast("int")
    rows = rows.withColumn("slots", slots).withColumn("slot", F.pmod(F.xxhash64("fp"), F.col("slots")).cast("int"))
    other = F.transform(F.sequence(F.lit(0), F.col("slots") - 1), lambda o: F.struct(F.least("slot", o).alias("lo"), F.greatest("slot", o).alias("hi")))
    rows = rows.select("choice", "key", F.explode(other).alias("c"), "fp").select("choice", "key", "c.lo", "c.hi", "fp")
    order = ["choice", "key", "lo", "hi"]
    rows = rows.repartition(*order).sortWithinPartitions(*order)

    def run(batches):
        def out(parts):
            a, b = stars(np.unique(np.concatenate(parts)), radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        held, size, last = [], 0, None  # whole buckets, and the one being read
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in order]
            fp = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            new = np.zeros(len(fp), bool)
            for c in cols:
                new[1:] |= c[1:] != c[:-1]
            here = tuple(int(c[0]) for c in cols)
            new[0] = last is not None and here != last
            for start, end in zip(*(lambda s: (s, [*s[1:], len(fp)]))([0, *[int(x) for x in np.nonzero(new)[0] if x]])):
                if new[start] and size >= BLOCK:
                    yield out(held)
                    held, size = [], 0
                held.append(fp[start:end])
                size += end - start
            last = tuple(int(c[-1]) for c in cols)
        if held:
            yield out(held)

    return rows.mapInArrow(run, "a bigint, b bigint")


def groups(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, seed: int = SEED) -> DataFrame:
    """Per document: doc_id, fp, component_id, and root, a key of the component that is never null."""
    prints = checkpointed(fingerprints(docs, shingle, seed))
    distinct = checkpointed(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = components(links(distinct, radius)).withColumnRenamed("node", "fp")
    rooted = distinct.join(roots, "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    rooted = checkpointed(rooted)
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return prints.join(rooted.join(ids, "root").select("fp", "root", "component_id"), "fp")


def hexadecimal(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def deduplicated(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, seed: int = SEED) -> DataFrame:
    """documents with one row of each component: that with the smallest doc_id, or the least text where ids
    are shared or missing. Only rows with such ids are put in order; the others are told by their id."""
    found = checkpointed(groups(docs, shingle, radius, seed))
    shared = checkpointed(found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or doc_id is null").select(F.col("doc_id").alias("s_id")))
    gone = found.where("component_id is not null and (doc_id is null or doc_id != component_id)").select("doc_id", "fp").distinct()
    rows = documents(docs)
    marked = lookup(rows, shared.withColumn("again", F.lit(True)), F.col("doc_id").eqNullSafe(F.col("s_id"))).drop("s_id")
    plain = marked.where("again is null").drop("again").join(gone.select("doc_id").where("doc_id is not null"), "doc_id", "left_anti")
    tied = marked.where("again").drop("again")
    # the few rows with shared ids: their fingerprints anew, beside their texts
    prints = fingerprints(tied.select(F.xxhash64("doc_id", whole(F.col("text"))).alias("doc_id"), "text")).distinct().withColumnRenamed("doc_id", "mark")
    tied = tied.withColumn("mark", F.xxhash64("doc_id", whole(F.col("text")))).join(prints, "mark")
    roots = found.select("fp", "root", "component_id").distinct()
    tied = tied.join(roots, "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    first = F.row_number().over(W.partitionBy("root").orderBy("text", "lang", "source", "n_chars"))
    tied = tied.withColumn("nth", first).where("nth = 1")
    return plain.select(*DOCUMENT).unionByName(tied.select(*DOCUMENT))
