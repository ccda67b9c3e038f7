"""Top-k join of sets by the number of shared members, exact at any size and skew.

Equal sets count as one, and sets are numbered in the order that settles ties. A member is rare if at most ``hot`` sets have it.

- The list of each rare member is sent to every set in it, as bare numbers, and a set counts how often it meets another. No set
  is carried along, and a set of rare members alone is done. Another set only goes on with those that its frequent
  members could still lift among the best, and compares the frequent members of the two.
- What is left are sets that share frequent members alone. These stand in one order, the rarest first. A *run* is a short list of them in that
  order; its list holds the sets that have them all. Rounds lengthen the runs:

  - The newest few sets of every run asked for are compared with the sets that ask. That already settles how many
    members the k-th best partner of a set shares at least; call it b.
  - A partner that shares b members or more shares j of the first ``size - b + j`` members, so a set
    only asks for runs within that prefix.
  - A run with at most ``hot`` sets gives all of them, and is done. A longer list is never read out: its run is lengthened by
    every later member of the asking set in its prefix, and goes on into the next round.

A partner of the final answer is met: by a rare member, or else follow the members it shares, in order. Either some run of them is short and gives it, or
the run of all shared members is long, and then the partner is among that run's newest few, for every set of the list shares at least as
much. No list longer than ``hot`` meets another, nothing is collected, and rounds end when no long run is asked for.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bibspark.operators.paging import best_per_key, numbered
from bibspark.session import ship, stored

HOT = 128
# numbers that one task sends or counts: 256 MB of them, but the cores are used from 4 MB each
MEETINGS, SHORT = 1 << 26, 1 << 20


def _longer(run: Column, member: Column) -> Column:
    return F.unhex(F.md5(F.concat(run, member.cast("string").cast("binary"))))


def _lengthened(runs: DataFrame, last: Column) -> DataFrame:
    """Rows (sid, ordered, run, pos) with one row per member after ``pos`` up to the place ``last``."""
    places = F.when(F.col("pos") < last, F.sequence(F.col("pos") + 1, last))
    rows = runs.select("sid", "ordered", "run", F.explode(places).alias("pos"))
    return rows.select("sid", "ordered", _longer(F.col("run"), F.get("ordered", F.col("pos") - 1)).alias("run"), "pos")


def _compared(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """(sid, other, shared): pairs (sid, other, rare), each met once, with the frequent members that both have added to ``rare``."""
    one = parts.select("sid", F.col("ordered").alias("a"))
    two = parts.select(F.col("sid").alias("other"), F.col("ordered").alias("b"))
    rows = pairs.join(one, "sid").join(two, "other", "left")
    return rows.select("sid", "other", (F.col("rare") + F.coalesce(F.size(F.array_intersect("a", "b")), F.lit(0))).alias("shared"))


def _best(found: DataFrame, k: int) -> DataFrame:
    # a pair met again through a run may be counted without its rare members
    return best_per_key(found.groupBy("sid", "other").agg(F.max("shared").alias("shared")), "sid", ["-shared", "other"], k)


def _bound(found: DataFrame, k: int) -> DataFrame:
    """(sid, bound): what the k-th best other set shares; sets with fewer are left out."""
    others = found.where("other != sid")
    return others.groupBy("sid").agg(F.count("*").alias("n"), F.min("shared").alias("bound")).where(F.col("n") >= k).select("sid", "bound")


def _tally(rows: pa.Table, k: int) -> pa.RecordBatch:
    """How often each set of sorted rows (sid, others, frequent) meets another: the best ``k``, and those that come within its
    ``frequent`` members of the k-th."""
    rows = rows.combine_chunks()
    sid, lists = rows["sid"].to_numpy(), rows["others"].combine_chunks()
    sids, first = np.unique(sid, return_index=True)
    frequent = np.maximum.reduceat(rows["frequent"].to_numpy(), first).astype(np.int64)
    others = lists.flatten().to_numpy().astype(np.int64)
    who = np.repeat(np.searchsorted(sids, sid), lists.value_lengths().to_numpy())
    span = int(others.max(initial=0)) + 1
    met, times = np.unique(who * span + others, return_counts=True)
    who, others = np.divmod(met, span)
    apart = others != sids[who]
    who, others, times = who[apart], others[apart], times[apart]
    order = np.lexsort((others, -times, who))
    who, others, times = who[order], others[order], times[order]
    begin = np.searchsorted(who, np.arange(len(sids) + 1))
    rank = np.arange(len(who)) - begin[who]
    kth = np.zeros(len(sids), np.int64)
    many = begin[1:] - begin[:-1] >= k
    kth[many] = times[begin[:-1][many] + k - 1]
    kept = (rank < k) | ((frequent[who] > 0) & (times + frequent[who] >= kth[who]))
    who = who[kept]
    return pa.RecordBatch.from_arrays([pa.array(sids[who]), pa.array(others[kept]), pa.array(times[kept]), pa.array(frequent[who])], ["sid", "other", "rare", "frequent"])


def _tallied(k: int):
    def tallied(batches):
        held = []
        for batch in batches:
            if not batch.num_rows:
                continue
            # the last set of a batch may go on in the next
            sid = batch.column("sid").to_numpy()
            cut = int(np.searchsorted(sid, sid[-1]))
            if held and sid[0] != held[-1].column("sid")[-1].as_py() and not cut:
                yield _tally(pa.Table.from_batches(held), k)
                held = []
            elif cut:
                yield _tally(pa.Table.from_batches([*held, batch.slice(0, cut)]), k)
                held = []
            held.append(batch.slice(cut))
        if held:
            yield _tally(pa.Table.from_batches(held), k)

    return tallied


def _met_by_rare(each: DataFrame, often: DataFrame, parts: DataFrame, k: int, hot: int) -> DataFrame:
    """(sid, other, rare, frequent) of sets that share rare members, by lists of numbers."""
    ship(__name__)
    size = often.where(F.col("n") <= hot).agg(F.coalesce(F.sum(F.col("n") * F.col("n")), F.lit(0)).alias("pairs")).first()
    tasks = max(size["pairs"] // MEETINGS + 1, min(each.sparkSession.sparkContext.defaultParallelism, size["pairs"] // SHORT + 1))
    rare = each.join(often.where(F.col("n").between(2, hot)).select("member"), "member", "left_semi")
    lists = rare.repartition(tasks, "member").groupBy("member").agg(F.collect_list("sid").alias("others"))
    sent = lists.select(F.explode("others").alias("sid"), "others").select(F.col("sid").cast("bigint"), "others", F.lit(0).alias("frequent"))
    none = F.slice(F.array(F.col("sid")), 1, 0).cast(dict(lists.dtypes)["others"])
    sent = sent.unionByName(parts.select("sid", none.alias("others"), F.size("ordered").alias("frequent")))
    met = sent.repartition(tasks, "sid").sortWithinPartitions("sid")
    return met.mapInArrow(_tallied(k), "sid bigint, other bigint, rare bigint, frequent bigint")


def top_overlaps(sets: DataFrame, k: int, hot: int = HOT) -> DataFrame:
    """(sid, other, shared, at, related_id): for every set the ``k`` best, itself included, by shared
    members, then ``at``, latest first, then ``related_id``. ``sets``: (sid, set, at, related_id), each set once."""
    # numbers in place of digests while rows move
    order = numbered(sets.select("sid", "at", "related_id"), ["-at", "related_id", "sid"], "no")
    named = stored(sets.join(order.select("sid", "no"), "sid").select(F.col("sid").alias("name"), F.col("no").cast("bigint").alias("sid"), "set", "at", "related_id"))
    sets, names = named.select("sid", "set"), named.select("sid", "name")
    each = sets.select(F.col("sid").cast("int" if named.count() < 1 << 31 else "bigint").alias("sid"), F.explode("set").alias("member"))
    often = stored(each.groupBy("member").agg(F.count("*").alias("n")))
    ranked = F.transform(F.array_sort(F.collect_list(F.struct("n", "member"))), lambda x: x["member"])
    parts = each.join(often.where(F.col("n") > hot), "member").groupBy(F.col("sid").cast("bigint").alias("sid")).agg(ranked.alias("ordered"))
    parts = stored(parts)
    met = stored(_met_by_rare(each, often, parts, k, hot))
    alone = met.where("frequent = 0").select("sid", "other", F.col("rare").alias("shared"))
    itself = sets.select("sid", F.col("sid").alias("other"), F.size("set").cast("bigint").alias("shared"))
    found = stored(_best(itself.unionByName(alone).unionByName(_compared(met.where("frequent > 0").select("sid", "other", "rare"), parts)), k))
    start = parts.select("sid", "ordered", F.lit(b"").alias("run"), F.lit(0).alias("pos"))
    offered = asked = _lengthened(start, F.size("ordered"))
    length, going = 1, not parts.isEmpty()
    while going:
        offered = stored(offered)
        asked = asked if length > 1 else offered
        newest = best_per_key(offered.select("sid", "run"), "run", ["sid"], k)
        pairs = asked.select("sid", "run").join(newest.select("run", F.col("sid").alias("other")), "run").select("sid", "other")
        zero = F.lit(0).cast("bigint").alias("rare")
        found = stored(_best(found.unionByName(_compared(pairs.distinct().select("*", zero), parts)), k))
        # the k-th best other set: itself is one of the k, so one less is known for sure
        bound = _bound(found, k - 1)
        within = F.least(F.size("ordered"), F.size("ordered") - F.coalesce("bound", F.lit(1)) + length).cast("int")
        asked = stored(asked.join(bound, "sid", "left").withColumn("last", within).where("pos <= last"))
        counts = stored(offered.join(asked.select("run").distinct(), "run", "left_semi").groupBy("run").agg(F.count("*").alias("n")))
        long = counts.where(F.col("n") > hot).select("run")
        short = counts.where(F.col("n") <= hot).select("run")
        few = offered.select("run", F.col("sid").alias("other")).join(short, "run", "left_semi")
        pairs = asked.select("sid", "run").join(few, "run").select("sid", "other")
        found = stored(_best(found.unionByName(_compared(pairs.distinct().select("*", zero), parts)), k))
        length += 1
        after = F.least(F.size("ordered"), F.col("last") + 1)
        asked = stored(_lengthened(asked.join(long, "run", "left_semi").withColumn("last", after), F.col("last")))
        going = not asked.isEmpty()
        wanted = asked.select("run").distinct()
        offered = _lengthened(offered.join(long, "run", "left_semi"), F.size("ordered")).join(wanted, "run", "left_semi")
    other = named.select(F.col("sid").alias("other"), F.col("name").alias("other_name"), "at", "related_id")
    found = found.join(names, "sid").join(other, "other")
    return found.select(F.col("name").alias("sid"), F.col("other_name").alias("other"), F.col("shared").cast("int").alias("shared"), "at", "related_id")
