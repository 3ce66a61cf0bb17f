"""The stateful and per-record operators run as streams over the same tables; results equal the batch forms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace import session
from millrace.operators import slices, steps
from millrace.queries import SQL, query
from millrace.queries.records import CHAIN, split_event
from millrace.queries.tables import event_envelopes, table
from millrace.sources import capture
from millrace.streaming import runs, state


BATCHES = 4


#: Bytes of a row group of these files: a micro-batch is one file, and tasks share it by row groups.
ROW_GROUP = 4 << 20


def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """``events`` as four files in the order of time, which a stream reads as four micro-batches."""
    path, events = session.scratch_path(spark, "events"), table(spark, sf, "events")
    first, last = events.agg(F.min("event_id"), F.max("event_id")).first()
    first, span = first or 0, (last or 0) - (first or 0) + 1
    starts = [first - (-k * span // BATCHES) for k in range(BATCHES + 1)]
    for low, high in zip(starts, starts[1:]):
        batch = events.where((F.col("event_id") >= low) & (F.col("event_id") < high))  # bounds that skip the other row groups
        batch.coalesce(1).write.mode("append").option("parquet.block.size", ROW_GROUP).parquet(path)
    return capture.read_files(spark, path, "parquet", events.schema, tail=True, **capture.source_pace(max_files=1))


@query("w5_apply_changes_stream", SQL["w5_apply_changes"])
def w5_stream(spark: SparkSession, sf: str) -> DataFrame:
    path = session.scratch_path(spark, "w5-stream")
    state.fold_changes(event_envelopes(event_stream(spark, sf)), path, ["user_id"], ["ts", "seq"])
    return slices.read(spark, path)


@query("w17_nack_breaches_stream", SQL["w17_nack_breaches"])
def w17_stream(spark: SparkSession, sf: str) -> DataFrame:
    found = state.nack_breaches(event_stream(spark, sf), ["user_id"], ["ts", "event_id"], F.col("event_type") == "error", 10, 4)
    return runs.to_files(found, session.scratch_path(spark, "w17-stream"))


@query("w19_to_key_value_stream", """
    SELECT 'user:' || user_id AS key, arg_max(value, (ts, event_id)) AS value, max(ts) AS written
    FROM events GROUP BY user_id HAVING max(ts) + INTERVAL 3 DAY > (SELECT max(ts) FROM events)
""")
def w19_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Keys expire while later batches move the watermark on."""
    path = session.scratch_path(spark, "w19-stream")
    rows = state.to_key_value(event_stream(spark, sf), "user_id", "value", "ts", "user:", 3 * 86400, ["event_id"])
    state.into_table(rows, path, ["key"], [], "expired", f"{path}-checkpoint")
    return slices.read(spark, path).withColumn("written", F.col("written").cast("timestamp_ntz"))


@query("t13_apply_steps_stream", SQL["t13_apply_steps"])
def t13_stream(spark: SparkSession, sf: str) -> DataFrame:
    df = steps.apply_steps(event_envelopes(event_stream(spark, sf)), CHAIN,
                           {"private": "event_type = 'purchase'", "noise": "event_type = 'view'"})
    rows = df.select("seq", "user_id", "event_type", "value", "__deleted", "origin",
                     F.col("_placeholders")[0].alias("placeholder"))
    return runs.to_files(rows, session.scratch_path(spark, "t13-stream"))


@query("t14_one_to_many_stream", SQL["t14_one_to_many"])
def t14_stream(spark: SparkSession, sf: str) -> DataFrame:
    rows = steps.one_to_many(split_event, "part int, value double", ["event_id"])(event_stream(spark, sf))
    return runs.to_files(rows, session.scratch_path(spark, "t14-stream"))
