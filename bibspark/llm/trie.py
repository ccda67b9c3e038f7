"""Conversation prefix trie, built as a burst trie.

A turn's id is the MD5 of its role and text; a conversation is the list of its turns' ids. Conversations of equal turns are
counted first and go on as one path with a weight. All paths begin in one container under the root. A container
whose paths hold more than ``BURST`` turns bursts: what all of them begin with becomes a chain of trie nodes, its end
a trie head, and every path goes on in the container of its next turn id under that head, which is a new shard key.
Rounds end when no container is oversized; a chain is passed in one round, however long.
Then the containers that remain are dealt to the tasks by shard key, sorted, and swept: neighbours share their first turns, so a
stack of open nodes gives every node of a container. What a container holds in all (leaves, tokens) goes up from head to head, round by round.

Conversations that end at a node are sorted over all nodes at once and cut into slices, which write them as text; a digest
streams over a node's few texts.

Cases. Empty table: no rows. Null conv_id: no conversation, so such rows take no part. Null role or text: empty. Null turns first; equal
turns are ordered by role, then text's MD5; repeated rows are turns of their own. Very long texts are hashed whole. Negative ids: the remainder of
a division has their sign. Extra columns are ignored. A limit: the ids of a conversation's turns (not its texts) are one row, some 30 bytes a turn.
"""

import hashlib
import os.path
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bibspark.llm.common import checkpointed, sliced
from bibspark.session import ship

BURST = 65_536
CHUNK = 1 << 20


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), id and chars of every turn, numbered within slices first."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = conversations.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), role.alias("role"), F.md5(text).alias("digest"), F.char_length(text).cast("bigint").alias("chars"),
                                F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text))).alias("id"))
    rows = sliced(rows.where("conv_id is not null"), "conv_id", "turn", "role", "digest")
    sizes = rows.groupBy("conv_id", "slice").agg(F.count(F.lit(1)).alias("many"))
    ahead = F.sum("many").over(W.partitionBy("conv_id").orderBy("slice")) - F.col("many")
    sizes = sizes.select("conv_id", "slice", ahead.alias("ahead"))
    inside = F.row_number().over(W.partitionBy("conv_id", "slice").orderBy("turn", "role", "digest"))
    return rows.withColumn("inside", inside).join(sizes, ["conv_id", "slice"]).select("conv_id", (F.col("ahead") + F.col("inside")).alias("pos"), "id", "chars")


def listed(rows: DataFrame) -> DataFrame:
    """conv_id and path: structs of id and chars in order."""
    path = F.transform(F.array_sort(F.collect_list(F.struct("pos", "id", "chars"))), lambda x: F.struct(x["id"].alias("id"), x["chars"].alias("chars")))
    return rows.groupBy("conv_id").agg(path.alias("path"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Conversations that begin with the first turns of the first of their hundred."""
    own = checkpointed(listed(turns(conversations)))
    first = own.where("conv_id % 100 = 0").select(F.col("conv_id").alias("base"), F.slice("path", 1, 5).alias("start"))
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).cast("int")
    rows = own.withColumn("taken", taken).join(first, F.col("conv_id") - F.col("conv_id") % 100 == F.col("base"), "left")
    start = F.coalesce(F.slice("start", F.lit(1), F.col("taken")), F.array().cast("array<struct<id:binary,chars:bigint>>"))
    return rows.select("conv_id", F.concat(start, F.slice("path", F.col("taken") + 1, F.greatest(F.size("path"), F.lit(1)))).alias("path"))


def common(a: Column, b: Column) -> Column:
    """How many first entries two lists share."""
    other = F.array_position(F.zip_with(a, b, lambda x, y: x != y), True)
    return F.when(other > 0, other - 1).otherwise(F.least(F.size(a), F.size(b))).cast("int")


def nodes(paths: DataFrame, burst: int = BURST) -> DataFrame:
    """Per node of the trie of (conv_id, path): conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    and ends, the key of the conversations that end there (null: none)."""
    ship(__name__)
    keyed = paths.select("conv_id", F.transform("path", lambda x: x["id"]).alias("ids"), F.transform("path", lambda x: x["chars"]).alias("chars"))
    live = keyed.groupBy("ids").agg(F.any_value("chars").alias("chars"), F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("low"))
    live = checkpointed(live.select("ids", "chars", "n", "low", key_of(F.col("ids")).alias("ends"), F.lit(0).alias("depth"), F.lit("").alias("shard"), F.lit(None).cast("string").alias("up")))
    heads, closed = [], []
    while True:
        left = F.size("ids") - F.col("depth") + 1
        sizes = live.groupBy("shard").agg(F.sum(left).alias("turns"), F.min("ids").alias("a"), F.max("ids").alias("b"), F.count(F.lit(1)).alias("paths"))
        over = checkpointed(sizes.where((F.col("turns") > burst) & (F.col("paths") > 1)).select("shard", common(F.col("a"), F.col("b")).alias("end")))
        closed.append(live.join(over, "shard", "left_anti"))
        if over.isEmpty():
            break
        bursting = live.join(over, "shard")
        here = F.size("ids") == F.col("end")
        heads.append(checkpointed(bursting.groupBy("shard", "up", "depth", "end").agg(
            F.sum("n").alias("n"), F.min("low").alias("low"), F.max(F.when(here, F.col("ends"))).alias("ends"),
            F.min(F.slice("chars", F.greatest(F.col("depth"), F.lit(1)), F.col("end") - F.greatest(F.col("depth"), F.lit(1)) + 1)).alias("chars"),
        )))
        further = F.md5(F.concat(F.col("shard").cast("binary"), F.element_at("ids", F.col("end") + 1)))
        live = checkpointed(bursting.where(~here).select("ids", "chars", "n", "low", "ends", (F.col("end") + 1).alias("depth"), further.alias("shard"), F.col("shard").alias("up")))
    rows = closed[0]
    for more in closed[1:]:
        rows = rows.unionByName(more)
    # by a value of its own: a shuffle by the joins' key counts as done by them, and is not, once they turn into broadcasts
    swept = checkpointed(rows.repartition(F.xxhash64("shard")).sortWithinPartitions("shard", "ids").mapInArrow(sweep, NODE_SQL))
    return joined(swept, heads)


def key_of(ids: Column) -> Column:
    return F.md5(F.concat(F.size(ids).cast("string").cast("binary"), F.aggregate(ids, F.lit(b""), lambda s, x: F.concat(s, x))))


NODE_SQL = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends string, up string, top boolean"
NODE = pa.schema([(part.split()[0], {"bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}[part.split()[1]]) for part in NODE_SQL.split(", ")])


def sweep(batches):
    """The nodes of containers, whose paths come in order."""
    rows = (r for batch in batches for r in batch.select(["shard", "up", "depth", "ids", "chars", "n", "low", "ends"]).to_pylist())
    out = []
    for _, container in groupby(rows, key=lambda r: r["shard"]):
        stack: list[dict] = []
        made: list[dict] = []
        last: list = []

        def close(to, stack=stack, made=made):
            while len(stack) > to:
                node = stack.pop()
                node["n_leaves"] = node["n_leaves"] or 1
                node["saved_tokens"] += (node["n_convs"] - 1) * node.pop("chars")
                if stack:
                    above = stack[-1]
                    above["n_convs"] += node["n_convs"]
                    above["n_children"] += 1
                    above["n_leaves"] += node["n_leaves"]
                    above["saved_tokens"] += node["saved_tokens"]
                    above["conv_id"] = node["conv_id"] if above["conv_id"] is None else min(above["conv_id"], node["conv_id"])
                node["children"] = node.get("children", [])
                if stack:
                    stack[-1].setdefault("children", []).append(node)
                else:
                    made.append(node)

        for r in container:
            ids = r["ids"]
            shared = len(os.path.commonprefix([last, ids]))
            # the container's head is the stack's first node
            close(shared - r["depth"] + 1 if stack else 0)
            for at in range(r["depth"] + len(stack), len(ids) + 1):
                stack.append({"conv_id": None, "depth": at, "n_convs": 0, "n_children": 0, "n_leaves": 0, "saved_tokens": 0, "ends": None, "chars": r["chars"][at - 1] if at else 0,
                              "up": r["up"], "top": not stack, "parent_conv_id": None})
            node = stack[-1]
            node["n_convs"] += r["n"]
            node["conv_id"] = r["low"] if node["conv_id"] is None else min(node["conv_id"], r["low"])
            node["ends"] = r["ends"]
            last = ids
        close(0)
        while made:
            node = made.pop()
            for child in node.pop("children"):
                child["parent_conv_id"] = node["conv_id"]
                made.append(child)
            out.append(node)
            if len(out) >= 8192:
                yield pa.RecordBatch.from_pylist(out, NODE)
                out = []
    if out:
        yield pa.RecordBatch.from_pylist(out, NODE)


def joined(swept: DataFrame, heads: list[DataFrame]) -> DataFrame:
    """Container nodes and the chains of burst heads; totals go up round by round."""
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    below = swept.where("top").select("up", "n_leaves", "saved_tokens")
    chains, summed = [], None
    for level in reversed(heads):
        sums = below.where("up is not null").groupBy("up").agg(F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved")).withColumnRenamed("up", "shard")
        level = checkpointed(level.join(sums, "shard"))
        # a chain's turns from ``depth`` (the root has none) to ``end``; each node saves what stands from it to the end, and below
        after = F.aggregate("chars", F.lit(0).cast("bigint"), lambda s, x: s + x)
        chains.append(level)
        below = below.unionByName(level.select("up", "n_leaves", (F.col("saved") + (F.col("n") - 1) * after).alias("saved_tokens")))
    if not chains:
        return swept.select(*columns)
    low = chains[0].select(F.col("shard").alias("of"), F.col("low").alias("parent_low"))
    for level in chains[1:]:
        low = low.unionByName(level.select(F.col("shard").alias("of"), F.col("low").alias("parent_low")))
    low = checkpointed(low)
    found = swept.join(low, F.col("up") == F.col("of"), "left").withColumn("parent_conv_id", F.when(F.col("top"), F.col("parent_low")).otherwise(F.col("parent_conv_id"))).select(*columns)
    for level in chains:
        found = found.unionByName(level.join(low, F.col("up") == F.col("of"), "left").select("low", "depth", "end", "parent_low", "n", "n_children", "n_leaves", "saved", "ends", "chars").mapInArrow(chain, CHAIN_SQL))
    return found


CHAIN_SQL = ", ".join(NODE_SQL.split(", ")[:8])
CHAIN = pa.schema([NODE.field(i) for i in range(8)])


def chain(batches):
    """The nodes of chains, from their ends up."""
    for batch in batches:
        for r in batch.to_pylist():
            saved, out = r["saved"], []
            for at in range(r["end"], r["depth"] - 1, -1):
                saved += (r["n"] - 1) * (r["chars"][at - max(r["depth"], 1)] if at else 0)
                end = at == r["end"]
                out.append({"conv_id": r["low"], "depth": at, "parent_conv_id": r["low"] if at > r["depth"] else r["parent_low"], "n_convs": r["n"], "n_children": r["n_children"] if end else 1,
                            "n_leaves": r["n_leaves"], "saved_tokens": saved, "ends": r["ends"] if end else None})
            yield pa.RecordBatch.from_pylist(out, CHAIN)


def digests(paths: DataFrame) -> DataFrame:
    """ends and ends_sha256: per path key the digest of its conv_ids, ascending, comma-joined."""
    ship(__name__)
    rows = sliced(paths.select(key_of(F.transform("path", lambda x: x["id"])).alias("ends"), "conv_id"), "ends", "conv_id")

    def written(batches):
        found = (r for batch in batches for r in zip(*(batch.column(c).to_pylist() for c in ("slice", "ends", "conv_id"))))
        for (part, key), group in groupby(found, key=lambda r: r[:2]):
            text, no = [], 0
            for r in group:
                text.append(str(r[2]))
                if len(text) * 8 >= CHUNK:
                    yield chunk(part, key, no, text)
                    text, no = [], no + 1
            if text:
                yield chunk(part, key, no, text)

    def chunk(part, key, no, text):
        return pa.RecordBatch.from_pylist([{"slice": part, "ends": key, "no": no, "text": ",".join(text)}], pa.schema([("slice", pa.int32()), ("ends", pa.string()), ("no", pa.int32()), ("text", pa.string())]))

    def hashed(batches):
        found = (r for batch in batches for r in batch.to_pylist())
        for key, group in groupby(found, key=lambda r: r["ends"]):
            taken, between = hashlib.sha256(), ""
            for r in group:
                taken.update((between + r["text"]).encode())
                between = ","
            yield pa.RecordBatch.from_pylist([{"ends": key, "ends_sha256": taken.hexdigest()}], pa.schema([("ends", pa.string()), ("ends_sha256", pa.string())]))

    texts = rows.mapInArrow(written, "slice int, ends string, no int, text string")
    return texts.repartition("ends").sortWithinPartitions("ends", "slice", "no").mapInArrow(hashed, "ends string, ends_sha256 string")


def trie(paths: DataFrame, burst: int = BURST) -> DataFrame:
    """All nodes of the trie of (conv_id, path), one row each."""
    paths = checkpointed(paths)
    found = nodes(paths, burst).join(digests(paths), "ends", "left")
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"))
