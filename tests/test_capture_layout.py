from __future__ import annotations

import glob

import pytest
from pyspark.sql import functions as F, types as T

from millrace.operators import deadletter, layout
from millrace.sources import capture
from tests.conftest import rows


def test_incremental_modes(spark):
    df = spark.createDataFrame([(1, 10), (2, 10), (3, 20)], "id int, ts int")

    def run(mode, position=None):
        got, nxt = capture.incremental_extract(df, mode, "id", "ts", position)
        return [r["id"] for r in got.orderBy("id").collect()], tuple(nxt.first())

    assert run("bulk") == ([1, 2, 3], (None, None))
    assert run("odd") == ([1, 2, 3], (None, None))
    assert run("incrementing") == ([1, 2, 3], (None, 3))
    assert run("incrementing", capture.Position(id=2)) == ([3], (None, 3))
    assert run("incrementing", capture.Position(id=9)) == ([], (None, 9))
    assert run("timestamp", capture.Position(ts=10)) == ([3], (20, None))
    assert run("timestamp+incrementing", capture.Position(10, 1)) == ([2, 3], (20, 3))


def test_position_reaches_the_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    got, _ = capture.incremental_extract(df, "incrementing", "event_id", position=capture.Position(id=5))
    assert "GreaterThan(event_id,5)" in got._jdf.queryExecution().executedPlan().toString()


def test_selection(spark):
    df = spark.createDataFrame([("a", "s"), ("b", "s"), (None, "r")], "table string, schema string")
    assert capture.select_tables(df, " a , ", "a").count() == 1
    assert capture.select_tables(df, None, "a").count() == 2
    assert capture.select_tables(df, schemas="s", exclude="b").count() == 1
    topics = spark.createDataFrame([("x1",), ("x2",), ("yx1",)], "topic string")
    assert capture.subscribe(topics, "x1", ".*").count() == 1
    assert capture.subscribe(topics, "", r"x\d").count() == 2
    with pytest.raises(ValueError):
        capture.subscribe(topics)
    assert capture.start_position(topics, "earliest", "topic", "x1").count() == 3
    assert capture.start_position(topics, "latest", "topic", "x1").count() == 2


@pytest.mark.parametrize("mode,has,expected", [
    ("initial", False, ["c", "r"]), ("initial", True, ["c"]), ("never", False, ["c"]), ("initial_only", True, ["r"]),
    ("when_needed", True, ["c"]), ("when_needed", False, ["c", "r"]), ("always", True, ["c", "r"]), ("?", False, ["c", "r"])])
def test_snapshot_modes(spark, mode, has, expected):
    got = capture.snapshot_then_changes(spark.sql("SELECT 1 AS id"), spark.sql("SELECT 2 AS id, 'c' AS op"), mode, has)
    assert sorted(r["op"] for r in got.collect()) == expected


def test_decode(spark):
    names = {"x.ByteArrayConverter": "bytes", "x.StringDeserializer": "string", "x.JsonConverter": "json", "": "bytes"}
    assert {n: capture.payload_format(n) for n in names} == names
    df = spark.createDataFrame([(bytearray(b'{"a":1}'),), (bytearray(b"{"),)], "v binary")
    assert [r[0] and r[0]["a"] for r in capture.decode(df, "v", "json", "a int").collect()] in ([1, None],)


def test_query_beats_table_beats_list(spark):
    one, two = spark.sql("SELECT 1 AS a"), spark.sql("SELECT 2 AS a")
    assert capture.read_query(spark, "SELECT a + 10 AS a FROM {one}", "two", one=one, two=two).first()[0] == 11
    assert capture.read_query(spark, None, "two", "one", one=one, two=two).first()[0] == 2
    assert capture.read_query(spark, include="one, two", one=one, two=two).count() == 2
    with pytest.raises(ValueError):
        capture.read_query(spark)


SCHEMA = T.StructType([T.StructField("k", T.LongType())])


def test_good_and_dead_records_make_the_input(spark):
    df = spark.createDataFrame([('{"k":1}',), ('{"k":',), (None,), ('{"k":"x"}',), ("[]",)], "v string")
    good, dead = deadletter.split_bad_records(df, "v", SCHEMA, "delete", "warn")
    assert rows(good.select("verdict", "parsed.k")) == [("delete", None), ("good", 1)]
    assert good.count() + dead.count() == df.count()
    kept, none = deadletter.split_bad_records(df, "v", SCHEMA, "ignore", "ignore")
    assert kept.count() == 1 and none.count() == 0
    for policies in (("fail", "ignore"), ("ignore", "fail")):
        with pytest.raises(Exception, match="record"):
            deadletter.split_bad_records(df, "v", SCHEMA, *policies)[0].collect()


def test_path_format():
    assert layout.path_segments("'year='YYYY/'month='MM/HH") == [("year", "yyyy"), ("month", "MM"), ("part2", "HH")]


def test_formats_and_dispositions(spark, tmp_path):
    assert [layout.choose_format(c) for c in ("x.ParquetFormat", "x.JsonFormat", None)] == ["parquet", "json", "json"]
    with pytest.raises(ValueError):
        layout.write_disposition("WRITE_ODD")
    path = str(tmp_path / "out")
    df = spark.range(10)
    layout.file_writer(df.coalesce(1), "ParquetFormat", flush_size=3).save(path)
    assert len(glob.glob(f"{path}/*.parquet")) == 4
    layout.file_writer(df, "ParquetFormat", disposition="WRITE_TRUNCATE").save(path)
    layout.file_writer(df, "ParquetFormat").save(path)
    assert spark.read.parquet(path).count() == 20
    with pytest.raises(Exception, match="already exists"):
        layout.file_writer(df, "ParquetFormat", disposition="WRITE_EMPTY").save(path)


def test_key_value_expiry(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 'old', timestamp'2024-01-01'), (1, 'new', timestamp'2024-01-02'), "
                   "(2, 'x', timestamp'2024-01-01') AS t(k, v, ts)")
    as_of = F.lit("2024-01-02 12:00:00").cast("timestamp")
    got = layout.to_key_value(df, "k", "v", "ts", "p:", 86400, as_of)
    assert rows(got.select("key", "value")) == [("p:1", "new")]
    assert layout.to_key_value(df, "k", "v", "ts").count() == 2


def test_targets(spark):
    df = spark.createDataFrame([("a.b", 1)], "topic string, id int")
    assert layout.fan_out_by_topic(df).first()["target"] == "a.b"
    assert layout.fan_out_by_topic(df, "k_${topic}_${topic}").first()["target"] == "k_a.b_a.b"
    assert layout.mirror_topics(df, "a.b", prefix="m.").first()["target"] == "m.a.b"
    body = layout.wrap_envelope(df, {"index": "i", "source": ""}, ["id"]).first()["body"]
    assert body == '{"event":{"id":1},"index":"i"}'


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    for name in ("left_rows", "right_rows"):
        df = spark.range(100).withColumn("v", F.lit(name))
        layout.bucketed_writer(df, 4, "id").option("path", str(tmp_path / name)).saveAsTable(name)
    try:
        joined = spark.table("left_rows").hint("merge").join(spark.table("right_rows"), "id")
        assert joined.count() == 100
        assert "Exchange hashpartitioning" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in ("left_rows", "right_rows"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_position_policies(spark):
    df = spark.range(5)
    assert capture.start_position(df, "latest", "id").count() == 0
    with pytest.raises(ValueError, match="unknown start position"):
        capture.start_position(df, "bogus", "id")


def test_path_format_quotings():
    want = [("year", "yyyy"), ("month", "MM")]
    for text in ("'year='YYYY/'month='MM", "'year'=YYYY/'month'=MM", "year=YYYY/month=MM"):
        assert layout.path_segments(text) == want


def test_avro_is_refused():
    with pytest.raises(ValueError, match="not available"):
        layout.choose_format("io.example.AvroFormat")


def test_interleaved_files_are_narrow_in_each_column(spark, tmp_path):
    df = spark.range(20_000).select(
        (F.col("id") * 7919 % 1000).cast("int").alias("a"), F.concat(F.lit("n"), F.lpad((F.col("id") * 104_729 % 900).cast("string"), 4, "0")).alias("b"),
        F.when(F.col("id") % 3 != 0, F.timestamp_micros(F.col("id") * 15_485_863 % 1_000_000)).alias("c"), "id")
    path = str(tmp_path / "z")
    layout.interleaved_layout(df, ["a", "b", "c"], 64).write.parquet(path)
    stored = spark.read.parquet(path).withColumn("file", F.col("_metadata.file_path"))
    assert rows(stored.drop("file")) == rows(df)
    total = stored.select("file").distinct().count()
    for hit in (F.col("a").between(10, 30), F.col("b") > "n0880", F.col("c") < F.timestamp_micros(F.lit(20_000)), F.col("c").isNull()):
        assert stored.where(hit).select("file").distinct().count() < 0.6 * total
    assert layout.interleaved_layout(df.limit(0), "a,b", 4).count() == 0
    one = layout.interleaved_layout(spark.range(5000).select(F.lit(1).alias("a"), "id"), "a", 8)  # one value in many files
    assert one.select(F.spark_partition_id().alias("p")).distinct().count() == 8
