"""Incremental jobs, run to the end of their input; the result is the final state."""

from pyspark.sql import functions as F

from bibspark.plans.registry import query
from bibspark.session import scratch
from bibspark.streaming import streams
from bibspark.streaming.state import KeyedState


def event_stream(t, files: int = 6, per_batch: int = 2):
    """Events dealt out over files by key hash, so that versions arrive out of order over batches."""
    path = scratch(t.spark, "incoming")
    t.events.repartition(files, "event_id").write.parquet(path)
    return streams.read_files(t.spark, path, t.events.schema, "parquet", per_batch)


def _paths(t, *names):
    return [scratch(t.spark, n) for n in names]


@query("stream_flatten", "select event_id, user_id, event_type, cast(props->>'$.k' as bigint) as k from events")
def stream_flatten(t):
    out, mark = _paths(t, "flat", "mark")
    mapping = {"event_id": "event_id", "user_id": "user_id", "event_type": "event_type", "k": F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint")}
    streams.stream_flatten(event_stream(t), mapping, out, mark)
    return t.spark.read.parquet(out).drop("batch")


_LATEST = "select user_id, arg_max(event_id, (ts, event_id)) as event_id, arg_max(event_type, (ts, event_id)) as event_type from events group by 1"


@query("stream_upsert", _LATEST)
def stream_upsert(t):
    out, mark = _paths(t, "latest", "mark")
    streams.stream_upsert(event_stream(t), "user_id", "ts", out, mark, ["event_id"])
    return streams.read_latest(t.spark, out).select("user_id", "event_id", "event_type")


@query("stream_upsert_compacted", _LATEST)
def stream_upsert_compacted(t):
    """The stored rows themselves: each key once, without a reduction on reading."""
    out, mark = _paths(t, "latest", "mark")
    streams.stream_upsert(event_stream(t, 6, 1), "user_id", "ts", out, mark, ["event_id"], buckets=4)
    state = KeyedState(t.spark, out, "user_id", 4)
    return state.rows(state.manifest()).select("user_id", "event_id", "event_type")


@query("stream_cube", """
select event_type, day, cast(count(*) as bigint) as doc_count, cast(sum(event_id) as bigint) as id_sum from (
 select user_id, arg_max(event_type, (ts, event_id)) as event_type, strftime(max(ts), '%Y-%m-%d') as day, arg_max(event_id, (ts, event_id)) as event_id from events group by user_id) group by 1, 2""")
def stream_cube(t):
    state, cells, mark = _paths(t, "state", "cells", "mark")
    rows = event_stream(t).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    keys = ["event_type", "day"]
    streams.stream_cube(rows, "user_id", "ts", keys, {"id_sum": F.col("event_id")}, state, cells, mark, ["event_id"])
    return streams.read_cube(t.spark, cells)


@query("stream_version_guard", _LATEST)
def stream_version_guard(t):
    out, mark, path = _paths(t, "latest", "mark", "incoming")
    twice = t.events.unionByName(t.events)
    twice.withColumn("ts", F.col("ts").cast("timestamp")).repartition(6, "event_type").write.parquet(path)
    stream = streams.read_files(t.spark, path, t.spark.read.parquet(path).schema, "parquet", 2)
    streams.version_guard(stream, "user_id", "ts", out, mark, ["event_id"])
    return streams.read_latest(t.spark, out).select("user_id", "event_id", "event_type")
