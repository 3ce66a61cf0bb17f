"""Streams give the rows the batch forms give, whatever way the input falls into micro-batches."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from millrace.operators import deadletter, slices, steps, writes
from millrace.queries.tables import event_envelopes
from millrace.sources import capture
from millrace.streaming import runs, state
from tests.conftest import rows

EVENTS = "/root/testdata/sf0.001/events.parquet"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The events in four files, in time order, so a stream reads them as four micro-batches."""
    path = str(tmp_path_factory.mktemp("events") / "in")
    events = spark.read.parquet(EVENTS).withColumn("ts", F.col("ts").cast("timestamp"))
    for i in range(4):
        part = events.where(F.floor(F.col("event_id") * 4 / events.count()) == i)
        part.coalesce(1).write.mode("append").parquet(path)
    return path


def stream(spark, folder):
    schema = spark.read.parquet(folder).schema
    return capture.read_files(spark, folder, "parquet", schema, tail=True, **capture.source_pace(max_files=1))


def test_changes(spark, folder, tmp_path):
    path, keys, order = str(tmp_path / "table"), ["user_id"], ["ts", "seq"]
    state.fold_changes(event_envelopes(stream(spark, folder)), path, keys, order)
    expected = rows(writes.apply_changes(None, event_envelopes(spark.read.parquet(folder)), keys, order))
    assert rows(slices.read(spark, path)) == expected
    # A restart finds nothing new and changes nothing.
    state.fold_changes(event_envelopes(stream(spark, folder)), path, keys, order)
    assert rows(slices.read(spark, path)) == expected
    # A new stream over the same changes, as after a lost checkpoint, gives the same table too.
    state.into_table(state.last_changes(event_envelopes(stream(spark, folder)), keys, order), path, keys, order, "__deleted", str(tmp_path / "again"))
    assert rows(slices.read(spark, path)) == expected


def test_changes_after_a_restart(spark, folder, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "table")
    parts = sorted((spark.read.parquet(f) for f in spark.read.parquet(folder).inputFiles()), key=lambda df: df.agg(F.min("event_id")).first()[0])
    for some in (parts[2:], parts[:2]):  # the older half comes late
        for part in some:
            part.coalesce(1).write.mode("append").parquet(source)
        state.fold_changes(event_envelopes(stream(spark, source)), path, ["user_id"], ["ts", "seq"])
    expected = writes.apply_changes(None, event_envelopes(spark.read.parquet(folder)), ["user_id"], ["ts", "seq"])
    assert rows(slices.read(spark, path)) == rows(expected)


def test_streams_without_rows(spark, folder, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "table")
    spark.read.parquet(folder).limit(0).write.parquet(source)
    state.fold_changes(event_envelopes(stream(spark, source)), path, ["user_id"], ["ts", "seq"])
    assert slices.read(spark, path).count() == 0
    found = state.nack_breaches(stream(spark, source), KEYS, ORDER, bad(), 3, 1)
    assert runs.to_files(found, str(tmp_path / "out")).count() == 0


WINDOWS = [(10, 4), (1, 1), (25, 6)]
KEYS, ORDER = ["user_id"], ["ts", "event_id"]


def bad():
    return F.col("event_type") == "error"


@pytest.mark.parametrize("size,threshold", WINDOWS)
def test_failures(spark, folder, tmp_path, size, threshold):
    found = state.nack_breaches(stream(spark, folder), KEYS, ORDER, bad(), size, threshold)
    batch = deadletter.nack_breaches(spark.read.parquet(folder), KEYS, ORDER, bad(), size, threshold)
    assert rows(runs.to_files(found, str(tmp_path / "out"))) == rows(batch)


def test_failures_go_on_after_a_restart(spark, folder, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    parts = sorted((spark.read.parquet(f) for f in spark.read.parquet(folder).inputFiles()), key=lambda df: df.agg(F.min("event_id")).first()[0])
    for some in (parts[:2], parts[2:]):
        for part in some:
            part.coalesce(1).write.mode("append").parquet(path)
        got = runs.to_files(state.nack_breaches(stream(spark, path), KEYS, ORDER, bad(), 10, 4), out)
    assert rows(got) == rows(deadletter.nack_breaches(spark.read.parquet(folder), KEYS, ORDER, bad(), 10, 4))


def test_keys_expire(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "table")
    batches = [[("a", 1, "2024-01-01 00:00:00"), ("b", 2, "2024-01-01 00:00:05"), ("a", 0, "2023-12-31 23:59:59")],
               [("b", 3, "2024-01-01 00:00:08"), ("c", 4, "2024-01-01 00:00:09")],
               [("d", 5, "2024-01-01 00:00:16")], [("a", 6, "2024-01-01 00:00:17"), ("b", 7, "2024-01-01 00:00:18")]]
    schema = "k string, v int, ts timestamp"

    def step():
        given = capture.read_files(spark, source, "parquet", schema, tail=True, **capture.source_pace(max_files=1))
        state.into_table(state.to_key_value(given, "k", "v", "ts", "p:", 10), path, ["key"], [], "expired", str(tmp_path / "checkpoint"))
        return {r.key: r.value for r in slices.read(spark, path).collect()}

    seen = []
    for batch in batches:
        spark.createDataFrame(batch, "k string, v int, ts string").withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(source)
        seen.append(step())
    # a expires when the watermark passes 00:00:10, b's first write never does as a second one follows, a comes back.
    assert seen == [{"p:a": 1, "p:b": 2}, {"p:a": 1, "p:b": 3, "p:c": 4}, {"p:b": 3, "p:c": 4, "p:d": 5}, {"p:a": 6, "p:b": 7, "p:c": 4, "p:d": 5}]


@pytest.mark.parametrize("change", [
    lambda df: steps.route_regex(df.withColumn("topic", F.col("event_type")), "(c.*)", "new-$1"),
    lambda df: steps.convert_timestamp(df, "ts", "string"),
    lambda df: steps.insert_field(df, "x", "1"),
    lambda df: steps.replace_field(df, exclude=["props"], renames={"value": "v"}),
    lambda df: steps.mask_field(df, "value,event_type"),
    lambda df: steps.filter_records(df, "value < 10"),
    lambda df: steps.when_predicate(df, steps.masked("value"), "event_type = 'click'", negate=True),
    lambda df: steps.cast_fields(df, "value:int"),
    lambda df: steps.flatten(df.select("event_id", F.struct("value", "props").alias("v")), "_"),
    lambda df: steps.unwrap_cdc(event_envelopes(df)),
    lambda df: capture.subscribe(df.withColumn("topic", F.col("event_type")), pattern="c.*"),
    lambda df: capture.decode(df, "props", "json", "k int").select("event_id", "props.k"),
], ids=["route", "convert", "insert", "replace", "mask", "filter", "predicate", "cast", "flatten", "unwrap", "subscribe",
        "decode"])
def test_steps_run_the_same_on_streams(spark, folder, tmp_path, change):
    got = runs.to_files(change(stream(spark, folder)), str(tmp_path / "out"))
    assert rows(got) == rows(change(spark.read.parquet(folder)))


def test_dead_letters_on_a_stream(spark, folder, tmp_path):
    from pyspark.sql import types as T

    def tagged(df):
        broken = df.withColumn("p", F.when(F.col("value") < 5, "{").otherwise(F.col("props")))
        out = deadletter.tag_records(broken, "p", T.StructType([T.StructField("k", T.LongType())]))
        return out.select("event_id", "verdict", "parsed.k")

    got = runs.to_files(tagged(stream(spark, folder)), str(tmp_path / "out"))
    assert rows(got) == rows(tagged(spark.read.parquet(folder)))


def test_a_micro_batch_is_shared_by_row_groups(spark, tmp_path, monkeypatch):
    import pyarrow.parquet as pq

    from millrace import queries, session

    queries.load_all()
    from millrace.queries import streams

    monkeypatch.setattr(streams, "ROW_GROUP", 16 << 10, raising=False)
    monkeypatch.setattr(session, "scratch_path", lambda *_: f"{tmp_path}/out")
    spark.range(5, 40_006).selectExpr("id event_id", "id * 7 % 1000 user_id", "cast(xxhash64(id) as string) props").write.parquet(
        f"{tmp_path}/events.parquet")
    streams.event_stream(spark, str(tmp_path))
    files = [pq.ParquetFile(f) for f in (tmp_path / "out").glob("*.parquet")]
    assert min(f.num_row_groups for f in files) > 1
    ids = sorted((min(x), max(x), len(x)) for x in (f.read(["event_id"])["event_id"].to_pylist() for f in files))
    place = lambda i: (i - 5) * 4 // 40_001
    assert sum(n for *_, n in ids) == 40_001 and [(place(a), place(b)) for a, b, _ in ids] == [(k, k) for k in range(4)]
