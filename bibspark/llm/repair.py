"""Conversation structure repair by a run-length dynamic programme.

A message has a role class (system, user, assistant, other) and a fault: blank, a duplicate of an earlier one
(both must go), truncated, or none. Roles must read ``(s?(ua)+)?``; that automaton has four states. Keeping a message is free, ``REROLE`` to
user or assistant and ``INSERT`` of an empty one cost 2, ``DELETE`` 3, a kept truncated message 1 more.
Per symbol the costs from state to state are a 4 x 4 matrix under (min, +). Equal symbols in a row are one run, and a
run is passed by the binary powers of its matrix, which are kept. The values at the ends of runs are then
unrolled into choices, a bounded stretch at a time; of equally cheap audits the least in ASCII is the one that takes the
least letter at each step.

Rows are sorted over all conversations at once and cut into slices anywhere, so a conversation of a third of all rows
spreads over many tasks. Only a slice's first and last conversation can go on in another: their pieces are
multiplied (two matrices a slice come to the driver), which gives the costs behind every piece; then the state each piece begins
in. Equal rows of one turn travel as one row with a count, and "seen earlier" is a join with the first turn of
each (role, text), so copies form no groups. A digest over a conversation is one byte stream: for conversations within a
slice it is taken there, for others the repaired messages stream through a task in order, in constant memory.

Cases. Empty table: no rows. Null role or text: one blank character (so such text is blank, such a role is no role);
null conv_id: a conversation like others. Null turns come first; equal turns are ordered by role, then the text's MD5. Repeated rows
are duplicates. Very long texts go through whole. Extra columns are ignored.
"""

import hashlib
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bibspark.llm.common import sliced
from bibspark.session import ship

DELETE, INSERT, REROLE, CUT = 3, 2, 2, 1
BLANKS = " \t\n\x0b\f\r"
STRETCH = 1024
INF = 1 << 60
# states: nothing yet, after system, after user, after assistant
STATES = range(4)
MOVES = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
INSERTED = ((2, "user"), (2, "user"), (3, "assistant"), (2, "user"))  # the one insertion or new role each state allows
GOOD = {"su", "ua", "au"}
GONE = ("", 2)  # symbols are (initial, fault): 0 none, 1 truncated, 2 must go


def times(a, b):
    return tuple(tuple(min(x + y for x, y in zip(row, column)) for column in zip(*b)) for row in a)


def applied(matrix, values):
    return tuple(min(x + v for x, v in zip(row, values)) for row in matrix)


def inserting():
    """Cheapest insertions from state to state."""
    cost = [[0 if p == q else INF for q in STATES] for p in STATES]
    for p in STATES:
        at, spent = INSERTED[p][0], INSERT
        while cost[p][at] > spent:
            cost[p][at] = spent
            at, spent = INSERTED[at][0], spent + INSERT
    return cost


BEFORE = inserting()
END = tuple(min(row[0], row[3]) for row in BEFORE)


def one(symbol):
    """The matrix of one message, insertions before it included."""
    initial, fault = symbol
    row = [[INF] * 4 for _ in STATES]
    for p in STATES:
        row[p][p] = DELETE
        if fault < 2:
            more = CUT * fault
            kept = MOVES.get(initial, (None,) * 4)[p]
            if kept is not None:
                row[p][kept] = min(row[p][kept], more)
            there = INSERTED[p][0]
            row[p][there] = min(row[p][there], REROLE + more)
    return times(BEFORE, row)


class Powers(dict):
    """(symbol, j): the matrix of 2**j messages in a row."""

    def __missing__(self, key):
        symbol, j = key
        self[key] = made = one(symbol) if j == 0 else times(self[symbol, j - 1], self[symbol, j - 1])
        return made

    def over(self, symbol, n, values):
        """Values before ``n`` messages from those behind them."""
        for j in range(n.bit_length()):
            if n >> j & 1:
                values = applied(self[symbol, j], values)
        return values

    def product(self, runs):
        """The matrix of all runs."""
        columns = [tuple(0 if p == q else INF for p in STATES) for q in STATES]
        for symbol, n in reversed(runs):
            columns = [self.over(symbol, n, c) for c in columns]
        return tuple(zip(*columns))

    def unrolled(self, runs, values, state):
        """The cheapest edits from ``state``, of equally cheap ones the ASCII-least, as (letter, role), row by row (insertions stand
        before their row); the state behind them; ``values`` are the costs behind the runs."""
        behind = [values]
        for symbol, n in reversed(runs):
            behind.append(self.over(symbol, n, behind[-1]))
        behind.reverse()
        edits = []
        for (symbol, n), after in zip(runs, behind[1:]):
            for left in range(n, 0, -STRETCH):
                size = min(STRETCH, left)
                at = [self.over(symbol, left - size, after)]
                for _ in range(size):
                    at.append(applied(self[symbol, 0], at[-1]))
                for k in range(size, 0, -1):
                    state = self.choose(symbol, state, at[k], at[k - 1], edits)
        return edits, state

    @staticmethod
    def choose(symbol, state, here, after, edits):
        initial, fault = symbol
        while True:
            cost = here[state]
            there, role = INSERTED[state]
            kept = MOVES.get(initial, (None,) * 4)[state] if fault < 2 else None
            if DELETE + after[state] == cost:
                edits.append(("D", None))
                return state
            if INSERT + here[there] == cost:
                edits.append(("I", role))
                state = there
            elif kept is not None and CUT * fault + after[kept] == cost:
                edits.append(("K", None))
                return kept
            else:
                edits.append(("R", role))
                return there


def ending(state):
    """Insertions that end a conversation."""
    edits = []
    while state not in (0, 3):
        state, role = INSERTED[state]
        edits.append(("I", role))
    return edits


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after damage by the CRC of ``conv_id:turn``; a null is one blank."""
    blank = F.lit(" ")
    rows = conversations.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), F.coalesce(F.col("role").cast("string"), blank).alias("role"),
                                F.coalesce(F.col("text").cast("string"), blank).alias("text"))
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), blank), F.coalesce(F.col("turn").cast("string"), blank))
    rows = rows.withColumn("code", F.crc32(key) % 20).where("code != 0")
    text = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("code") == 3, F.array_repeat(F.lit(0), 2)).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def messages(conversations: DataFrame) -> DataFrame:
    """Sorted slices of messages: equal ones of a turn once with their number n; blank, cut, seen (an equal one stands in an earlier turn)."""
    blank = F.lit(" ")
    rows = conversations.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), F.coalesce(F.col("role").cast("string"), blank).alias("role"),
                                F.coalesce(F.col("text").cast("string"), blank).alias("text"))
    rows = rows.withColumn("digest", F.md5("text")).groupBy("conv_id", "turn", "role", "digest").agg(F.any_value("text").alias("text"), F.count(F.lit(1)).alias("n"))
    place = F.struct(F.col("turn").isNotNull().alias("given"), F.coalesce("turn", F.lit(0)).alias("turn"))
    first = rows.groupBy(*[F.col(c).alias(f"f_{c}") for c in ("conv_id", "role", "digest")]).agg(F.min(place).alias("first"))
    same = [F.col(c).eqNullSafe(F.col(f"f_{c}")) for c in ("conv_id", "role", "digest")]
    rows = rows.join(first, same[0] & same[1] & same[2])
    trimmed = F.rtrim(F.col("text"), F.lit(BLANKS))
    rows = rows.select("conv_id", "turn", "role", "digest", "text", "n", (trimmed == "").alias("blank"), (~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("cut"), (F.col("first") < place).alias("seen"))
    return sliced(rows, "conv_id", "turn", "role", "digest").drop("digest")


def symbols(rows):
    """Per row its symbols as (symbol, number) and faults as (blank, duplicate, truncated)."""
    for r in rows:
        n = r["n"]
        if r["blank"]:
            yield [(GONE, n)], (n, 0, 0)
        elif r["seen"]:
            yield [(GONE, n)], (0, n, 0)
        else:
            yield [((r["role"][:1], int(r["cut"])), 1), *([(GONE, n - 1)] if n > 1 else [])], (0, n - 1, int(r["cut"]))


def collapsed(per_row):
    """Runs of equal symbols."""
    every = (x for found, _ in per_row for x in found)
    return [(symbol, sum(n for _, n in group)) for symbol, group in groupby(every, key=lambda x: x[0])]


def conversations_in(batches, columns):
    """(slice, conv_id), rows of every conversation of a slice, in order; rows are dicts."""
    rows = (r for batch in batches for r in batch.select(columns).to_pylist())
    return ((key, list(group)) for key, group in groupby(rows, key=lambda r: (r["slice"], r["conv_id"])))


MARKS = ["slice", "conv_id", "turn", "role", "n", "blank", "cut", "seen"]
LINK = pa.schema([("slice", pa.int32()), ("conv_id", pa.int64()), ("place", pa.int64()), ("costs", pa.list_(pa.int64())), ("first_role", pa.string()), ("last_role", pa.string()),
                  ("first_turn", pa.int64()), ("last_turn", pa.int64()), ("numbered", pa.bool_())])
LINK_SQL = "slice int, conv_id bigint, place bigint, costs array<bigint>, first_role string, last_role string, first_turn bigint, last_turn bigint, numbered boolean"


def border(rows: DataFrame) -> dict:
    """What pieces of conversations in several slices must know: {(slice, conv_id): {values, state, first (is it the
    first piece), role, turn}} with the costs behind it, its state and the role and turn before it. The driver sees two rows a slice."""

    def ends(batches):
        powers = Powers()
        last = None
        for place, (key, part) in enumerate(conversations_in(batches, MARKS)):
            matrix = powers.product(collapsed(symbols(part)))
            last = {"slice": key[0], "conv_id": key[1], "place": place, "costs": [x for row in matrix for x in row], "first_role": part[0]["role"], "last_role": part[-1]["role"],
                    "first_turn": part[0]["turn"], "last_turn": part[-1]["turn"], "numbered": True}
            if place == 0:
                yield pa.RecordBatch.from_pylist([last], LINK)
        if last and last["place"]:
            yield pa.RecordBatch.from_pylist([last], LINK)

    met = rows.select(*MARKS).mapInArrow(ends, LINK_SQL).collect()
    pieces = sorted(({(r["slice"], r["conv_id"]): r for r in met}).values(), key=lambda r: (r["slice"], r["place"]))
    chains = [chain for chain in (list(group) for _, group in groupby(pieces, key=lambda r: r["conv_id"])) if len(chain) > 1]
    known: dict = {}
    for chain in chains:
        values = END
        for before, r in reversed(list(zip([None, *chain], chain))):
            known[r["slice"], r["conv_id"]] = {"values": values, "first": before is None, "last": r is chain[-1], "role": before and before["last_role"], "turn": before and before["last_turn"]}
            values = applied([r["costs"][4 * p : 4 * p + 4] for p in STATES], values)
    if known:
        of = rows.where(F.col("slice").isin(sorted({s for s, _ in known}))).select(*MARKS)
        moves = {(r["slice"], r["conv_id"]): r["ends"] for r in of.mapInArrow(ended(known), "slice int, conv_id bigint, ends array<int>").collect()}
        for chain in chains:
            state = 0
            for r in chain:
                known[r["slice"], r["conv_id"]]["state"] = state
                state = moves[r["slice"], r["conv_id"]][state]
    return known


def ended(known: dict):
    """The state behind each piece for every state before it."""

    def run(batches):
        powers = Powers()
        for key, part in conversations_in(batches, MARKS):
            if key in known:
                runs = collapsed(symbols(part))
                ends = [powers.unrolled(runs, known[key]["values"], state)[1] for state in STATES]
                yield pa.RecordBatch.from_pylist([{"slice": key[0], "conv_id": key[1], "ends": ends}], pa.schema([("slice", pa.int32()), ("conv_id", pa.int64()), ("ends", pa.list_(pa.int32()))]))

    return run


WHOLE = {"values": END, "state": 0, "first": True, "last": True, "role": None, "turn": None}


def edited(rows: DataFrame, known: dict, make, schema: str) -> DataFrame:
    """What ``make(key, rows, per row (symbols, faults), edits, cost, border)`` yields for every piece, in batches."""
    types = pa.schema([(part.split()[0], ARROW[part.split()[1]]) for part in schema.split(", ")])

    def run(batches):
        powers, out, size = Powers(), [], 0
        for key, part in conversations_in(batches, [*MARKS, "text"]):
            at = known.get(key, WHOLE)
            per_row = list(symbols(part))
            runs = collapsed(per_row)
            edits, state = powers.unrolled(runs, at["values"], at["state"])
            if at["last"]:
                edits += ending(state)
            before = at["values"]
            for symbol, n in reversed(runs):
                before = powers.over(symbol, n, before)
            for row in make(key, part, per_row, edits, before[0] if at["first"] else 0, at):
                out.append(row)
                size += len(row.get("text") or "")
                if len(out) >= 4096 or size > 1 << 22:
                    yield pa.RecordBatch.from_pylist(out, types)
                    out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, types)

    return rows.select(*MARKS, "text").mapInArrow(run, schema)


ARROW = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}


def told(part, edits):
    """(letter, role, text) of every edit; role and text are None for what is deleted."""
    source = (r for r in part for _ in range(r["n"]))
    for letter, role in edits:
        r = None if letter == "I" else next(source)
        yield (letter, None, None) if letter == "D" else (letter, r["role"] if letter == "K" else role, r["text"] if r else "")


MESSAGE = "conv_id bigint, slice int, place bigint, edit string, role string, text string"


def message_rows(only=None):
    def make(key, part, per_row, edits, cost, at):
        if only is None or key in only:
            for place, (letter, role, text) in enumerate(told(part, edits)):
                yield {"conv_id": key[1], "slice": key[0], "place": place, "edit": letter, "role": role, "text": text}

    return make


REPORT = "conv_id bigint, slice int, low bigint, high bigint, turns bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, digest string"


def report_row(key, part, per_row, edits, cost, at):
    turns = [r["turn"] for r in part if r["turn"] is not None]
    fresh = len(set(turns)) - bool(turns and turns[0] == at["turn"])
    roles = [at["role"], *(r["role"] for r in part)] if at["role"] is not None else [r["role"] for r in part]
    illegal = sum(r["n"] - 1 for r in part) + sum(a[:1] + b[:1] not in GOOD for a, b in zip(roles, roles[1:]))
    blank, duplicate, truncated = map(sum, zip(*(faults for _, faults in per_row)))
    digest = None
    if at is WHOLE or at["first"] and at["last"]:
        digest = hashlib.sha256("\n".join(f"{role}:{text}" for letter, role, text in told(part, edits) if letter != "D").encode()).hexdigest()
    yield {"conv_id": key[1], "slice": key[0], "low": min(turns, default=None), "high": max(turns, default=None), "turns": fresh, "blank": blank, "duplicate": duplicate,
           "truncated": truncated, "illegal": illegal, "cost": cost, "audit": "".join(letter for letter, _ in edits), "digest": digest}


def streamed(rows: DataFrame) -> DataFrame:
    """conv_id and digest of conversations whose messages lie in several slices; a task reads them in order, one message at a time."""

    def run(batches):
        found = (r for batch in batches for r in batch.to_pylist())
        for conv, group in groupby(found, key=lambda r: r["conv_id"]):
            taken, between = hashlib.sha256(), ""
            for r in group:
                if r["edit"] != "D":
                    taken.update(f"{between}{r['role']}:{r['text']}".encode())
                    between = "\n"
            yield pa.RecordBatch.from_pylist([{"conv_id": conv, "digest": taken.hexdigest()}], pa.schema([("conv_id", pa.int64()), ("digest", pa.string())]))

    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "slice", "place").mapInArrow(run, "conv_id bigint, digest string")


def repaired(conversations: DataFrame) -> DataFrame:
    """The repaired messages with their edits, deleted ones (role and text null) included: conv_id, slice and place (in this order), edit, role, text."""
    ship(__name__)
    rows = messages(conversations)
    return edited(rows, border(rows), message_rows(), MESSAGE)


def report(original: DataFrame, conversations: DataFrame) -> DataFrame:
    """Per conv_id of ``original``: faults, cost and audit of the repair of ``conversations`` and the digest of its result."""
    ship(__name__)
    rows = messages(conversations)
    known = border(rows)
    parts = edited(rows, known, report_row, REPORT)
    empty = [F.lit(None).cast(part.split()[1]).alias(part.split()[0]) for part in REPORT.split(", ")[1:]]
    parts = parts.unionByName(original.select(F.col("conv_id").cast("bigint")).distinct().select("conv_id", *empty))
    if known:
        spread = streamed(edited(rows, known, message_rows(frozenset(known)), MESSAGE))
        parts = parts.unionByName(spread, allowMissingColumns=True)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    gaps = F.coalesce((wide("high") - wide("low") + 1 - wide("turns")).try_cast("bigint"), F.lit(0))
    audit = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("slice", "audit"))), lambda x: x["audit"]), "")
    found = parts.groupBy("conv_id").agg(F.min("low").alias("low"), F.max("high").alias("high"), total("turns"), *map(total, ("blank", "duplicate", "truncated", "illegal", "cost")),
                                         audit.alias("audit"), F.coalesce(F.max("digest"), F.sha2(F.lit(b""), 256)).alias("repaired_sha256"))
    return found.select("conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
