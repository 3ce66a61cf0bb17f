"""Capture and selection S1-S9."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from datetime import datetime

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from millrace import session
from millrace.queries import query
from millrace.queries.tables import event_records, table
from millrace.sources import capture, tail
from millrace.streaming import runs

SINCE = datetime(2024, 1, 10)


@query("s1_incremental_extract", """
    SELECT event_id, ts, value FROM events
    WHERE ts > TIMESTAMP '2024-01-10' OR (ts = TIMESTAMP '2024-01-10' AND event_id > 100)
""")
def s1(spark: SparkSession, sf: str) -> DataFrame:
    rows, _ = capture.incremental_extract(table(spark, sf, "events"), "timestamp+incrementing", "event_id", "ts",
                                          capture.Position(SINCE, 100))
    return rows.select("event_id", "ts", "value")


@query("s1_next_position", """
    SELECT max(ts) AS ts, arg_max(event_id, (ts, event_id)) AS id FROM events
""")
def s1_position(spark: SparkSession, sf: str) -> DataFrame:
    _, position = capture.incremental_extract(table(spark, sf, "events"), "timestamp+incrementing", "event_id", "ts")
    return position


@query("s2_select_tables", """
    SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'purchase')
    UNION ALL SELECT event_id, event_type FROM events WHERE event_type NOT IN ('error', 'view')
""")
def s2(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "events").select("event_id", "event_type")
    wanted = capture.select_tables(df, "click, purchase", "click", table="event_type")
    others = capture.select_tables(df, None, "error, view", table="event_type")
    return wanted.unionByName(others)


@query("s3_snapshot_then_changes", """
    SELECT o_orderkey, o_totalprice, 'r' AS op FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01'
    UNION ALL SELECT o_orderkey, o_totalprice, 'c' FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'
""")
def s3(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    cut = F.lit("1997-01-01").cast("timestamp_ntz")
    old = orders.where(F.col("o_orderdate") < cut).select("o_orderkey", "o_totalprice")
    new = orders.where(F.col("o_orderdate") >= cut).select("o_orderkey", "o_totalprice", F.lit("c").alias("op"))
    return capture.snapshot_then_changes(old, new, "when_needed")


@query("s4_subscribe", """
    SELECT event_id, 'srv.app.' || event_type AS topic FROM events WHERE event_type IN ('view', 'click')
    UNION ALL SELECT event_id, 'srv.app.' || event_type FROM events
    WHERE regexp_full_match('srv.app.' || event_type, 'srv\\.app\\.(signup|err.*)')
""")
def s4(spark: SparkSession, sf: str) -> DataFrame:
    df = event_records(spark, sf).select("event_id", "topic")
    named = capture.subscribe(df, "srv.app.view, srv.app.click", "ignored")
    return named.unionByName(capture.subscribe(df, None, r"srv\.app\.(signup|err.*)"))


@query("s5_start_position", "SELECT event_id, event_type FROM events WHERE event_id > 42")
def s5(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "events").select("event_id", "event_type")
    return capture.start_position(df, "latest", "event_id", 42)


@query("s6_decode", """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type AS type_text FROM events
""")
def s6(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "events").withColumns(
        {"raw": F.encode("props", "UTF-8"), "type_raw": F.encode("event_type", "UTF-8")})
    df = capture.decode(df, "raw", capture.payload_format("org.apache.kafka.connect.json.JsonConverter"), "k bigint")
    df = capture.decode(df, "type_raw", capture.payload_format("org.apache.kafka.connect.storage.StringConverter"),
                        out="type_text")
    return df.select("event_id", "raw.k", "type_text")


def stream_path(sf: str, name: str) -> str:
    """A glob, because a plain streaming path must be a folder and the tables may be single files."""
    return f"{sf}/{{{name}}}.parquet"


@query("s7_read_files", "SELECT event_id, event_type, value FROM events")
def s7(spark: SparkSession, sf: str) -> DataFrame:
    """The parquet file followed as a stream until it is exhausted, then read back."""
    schema = table(spark, sf, "events").schema
    stream = capture.read_files(spark, stream_path(sf, "events"), "parquet", schema, tail=True,
                                **capture.source_pace(max_files=1000))
    rows = stream.select("event_id", "event_type", "value")
    return runs.to_files(rows, session.scratch_path(spark, "s7"))


def _write_lines(folder: str):
    def write(rows: Iterator[Row]) -> None:
        """One file of lines for each ``file`` of a partition; written again with more lines it has grown."""
        fs, root = tail.open_folder(folder)
        for name, lines in itertools.groupby(rows, lambda r: r.file):
            with fs.open_output_stream(f"{root}/{name}.log") as out:
                for row in lines:
                    out.write(row.line.encode() + b"\n")

    return write


@query("s7_tail_growing_files", """
    SELECT event_id, event_type, value, 'file' || (event_id % 4) AS file, 1::BIGINT AS times FROM events
""")
def s7_tail(spark: SparkSession, sf: str) -> DataFrame:
    """``events`` as lines of four files that grow between two runs of one stream: every line appears once."""
    folder, out = session.scratch_path(spark, "growing"), session.scratch_path(spark, "s7-tail")
    events = table(spark, sf, "events")
    lines = events.select("event_id", F.concat(F.lit("file"), (F.col("event_id") % 4).cast("string")).alias("file"),
                          F.to_json(F.struct("event_id", "event_type", "value")).alias("line"))
    tail.make_folder(folder)
    middle = events.agg(F.avg("event_id")).first()[0] or 0
    for part in (lines.where(F.col("event_id") <= middle), lines):
        part.repartition(4, "file").sortWithinPartitions("file", "event_id").foreachPartition(_write_lines(folder))
        found = runs.to_files(tail.follow(spark, folder, max_range_bytes=1 << 16), out)
    parsed = found.select(F.from_json("value", "event_id bigint, event_type string, value double").alias("e"),
                          F.regexp_extract("path", r"([^/]+)\.log$", 1).alias("file"))
    return parsed.groupBy("e.event_id", "e.event_type", "e.value", "file").agg(F.count(F.lit(1)).alias("times"))


@query("s8_read_query", """
    SELECT l_returnflag, count(*) AS n, round(sum(l_quantity), 2) AS quantity
    FROM lineitem WHERE l_discount > 0.05 GROUP BY l_returnflag
""")
def s8(spark: SparkSession, sf: str) -> DataFrame:
    return capture.read_query(spark, """
        SELECT l_returnflag, count(*) AS n, round(sum(l_quantity), 2) AS quantity
        FROM {lineitem} WHERE l_discount > 0.05 GROUP BY l_returnflag
    """, table="ignored", lineitem=table(spark, sf, "lineitem"))


@query("s9_pace", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def s9(spark: SparkSession, sf: str) -> DataFrame:
    """Orders drained in bounded micro-batches; the batches together hold every row once."""
    schema = table(spark, sf, "orders").schema
    stream = capture.read_files(spark, stream_path(sf, "orders"), "parquet", schema, tail=True,
                                **capture.source_pace(max_bytes=1 << 36))
    drained = runs.to_files(stream.select("o_orderkey", "o_orderstatus"), session.scratch_path(spark, "s9"))
    return drained.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
