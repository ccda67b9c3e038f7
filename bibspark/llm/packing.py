"""Best-fit packing in several dimensions.

A piece asks for tokens, one document, and attention cost (the square of its length); a sequence has a
capacity for each. Pieces come in order of length, longest first. Each goes to the open sequence, among those
that have room in every dimension, with the smallest weighted norm of what is left (``rule="norm"``, as shares of
the capacities) or the largest weighted dot product of demand and what is left (``rule="dot"``); where none has
room a new one is opened. Pieces are dealt evenly into groups of about ``GROUP`` by their place in the table, not
by any key, and each group is packed by one task; a group has thousands of sequences, so what its last ones leave open
is a small share.

Cases. Empty table: no rows. Null text: the end id alone. Repeated rows: packed each. A piece above a capacity
by itself gets a sequence of its own. Ties: the sequence opened first. Extra columns of documents are ignored;
``pack`` carries the columns of its pieces along.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bibspark.llm.common import checkpointed
from bibspark.session import ship

TOKENS = 4096
GROUP = 16_384
SHIFT = 32


def best_fit(lengths: np.ndarray, tokens: int, docs: int, cost: float, weights=(1.0, 1.0, 1.0), rule: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece."""
    capacity = np.array([tokens, docs, cost], float)
    weight = np.asarray(weights, float)
    n = len(lengths)
    sequence, offset = np.zeros(n, np.int64), np.zeros(n, np.int64)
    left, number = np.empty((n + 1, 3)), np.empty(n + 1, np.int64)  # of open sequences
    used = opened = 0
    lengths = np.asarray(lengths, np.int64)
    order = np.argsort(-lengths, kind="stable")
    least = int(lengths.min()) if n else 0
    for at, i in enumerate(order):
        size = int(lengths[i])
        demand = np.array([size, 1.0, float(size) * size])
        room = left[:used]
        fits = np.flatnonzero((room[:, 0] >= demand[0]) & (room[:, 1] >= 1) & (room[:, 2] >= demand[2]))
        if len(fits):
            share = (room[fits] - demand) / capacity if rule == "norm" else room[fits] / capacity
            score = (share * share) @ weight if rule == "norm" else -((share * (demand / capacity)) @ weight)
            best = fits[score == score.min()]
            k = best[np.argmin(number[best])]
        else:
            k = used
            left[k], number[k] = capacity, opened
            used, opened = used + 1, opened + 1
        sequence[i], offset[i] = number[k], tokens - left[k, 0]
        left[k] -= demand
        if left[k, 0] < least or left[k, 1] < 1 or left[k, 2] < float(least) * least:
            used -= 1  # closed: the last open one takes its place
            left[k], number[k] = left[used], number[used]
    return sequence, offset


def pack(pieces: DataFrame, tokens: int = TOKENS, docs: int = TOKENS, cost: float = float(TOKENS) ** 2, weights=(1.0, 1.0, 1.0), rule: str = "norm",
         group: int = GROUP) -> DataFrame:
    """Pieces (a column ``length``, others carried along) with sequence_id and offset."""
    ship(__name__)
    rows = checkpointed(pieces)  # stored, so that a task that runs again deals its rows as before
    groups = max(1, -(-rows.count() // group))
    rows = rows.withColumn("_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(part: pd.DataFrame) -> pd.DataFrame:
        sequence, offset = best_fit(part["length"].to_numpy(), tokens, docs, cost, weights, rule)
        base = int(part["_group"].iloc[0]) << SHIFT
        return part.drop(columns="_group").assign(sequence_id=base + sequence, offset=offset)

    return rows.groupBy("_group").applyInPandas(run, schema)


def packed_ids(pieces: DataFrame, tokens: int = TOKENS, **options) -> DataFrame:
    """``pack`` for pieces with a column ``ids``. Only lengths go through the packing tasks; the ids meet their places by a key of
    their own, since repeated documents share doc_id and piece."""
    rows = checkpointed(pieces).withColumn("_piece", F.monotonically_increasing_id())  # stored, so both uses number alike
    placed = pack(rows.select("_piece", "length"), tokens, **options).select("_piece", "sequence_id", "offset")
    return rows.join(placed, "_piece").drop("_piece")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and ids: the pieces of a sequence put together (a sequence's size is bounded)."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    empty = F.lit(b"")
    return packed.groupBy("sequence_id").agg(F.aggregate(parts, empty, lambda s, x: F.concat(s, x["ids"])).alias("ids"))
