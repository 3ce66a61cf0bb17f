"""Output layout W9-W14, W18-W21 and dead letters W16, W17. Written files are read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from millrace import session
from millrace.operators import deadletter, layout
from millrace.queries import query
from millrace.queries.tables import event_records, table


@query("w9_partition_by_time", """
    SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day, count(*) AS n,
           round(sum(value), 2) AS value
    FROM events GROUP BY ALL
""")
def w9(spark: SparkSession, sf: str) -> DataFrame:
    path = session.scratch_path(spark, "w9")
    df, parts = layout.partition_by_time(table(spark, sf, "events"), "ts", "'year='YYYY/'month='MM/'day='dd")
    layout.file_writer(layout.cluster_layout(df, parts), "ParquetFormat", "snappy", parts).save(path)
    back = spark.read.schema("value double, year string, month string, day string").parquet(path)
    return back.groupBy(*parts).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("value"))


@query("w10_partition_by_field", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def w10(spark: SparkSession, sf: str) -> DataFrame:
    path = session.scratch_path(spark, "w10")
    rows = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.struct("o_orderstatus").alias("meta"))
    df, parts = layout.partition_by_field(rows, "meta.o_orderstatus")
    layout.file_writer(layout.cluster_layout(df.drop("meta"), parts), "ParquetFormat", partitions=parts).save(path)
    return spark.read.parquet(path)


@query("w11_roll_files", "SELECT event_id, event_type, value FROM events")
def w11(spark: SparkSession, sf: str) -> DataFrame:
    path = session.scratch_path(spark, "w11")
    rows = table(spark, sf, "events").select("event_id", "event_type", "value")
    layout.file_writer(rows, "io.confluent.connect.s3.format.parquet.ParquetFormat", flush_size=1000).save(path)
    return spark.read.parquet(path)


@query("w12_choose_format", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def w12(spark: SparkSession, sf: str) -> DataFrame:
    path = session.scratch_path(spark, "w12")
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    layout.file_writer(rows, "io.confluent.connect.s3.format.json.JsonFormat", "gzip").save(path)
    return spark.read.schema(rows.schema).json(path)


@query("w13_cluster_layout", """
    SELECT l_returnflag, l_linestatus, count(*) AS n, min(l_shipdate) AS first_ship FROM lineitem GROUP BY ALL
""")
def w13(spark: SparkSession, sf: str) -> DataFrame:
    path = session.scratch_path(spark, "w13")
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate")
    df = layout.cluster_layout(rows, "l_returnflag", "l_shipdate,l_orderkey")
    layout.file_writer(df, "ParquetFormat", partitions=["l_returnflag"]).save(path)
    return spark.read.parquet(path).groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.min("l_shipdate").alias("first_ship"))


@query("w13_interleaved_layout", """
    SELECT 'l_partkey' AS filtered, count(*) AS n, true AS few_files FROM lineitem WHERE l_partkey BETWEEN 100 AND 150
    UNION ALL SELECT 'l_shipdate', count(*), true FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-01-01'
    UNION ALL SELECT 'l_quantity', count(*), true FROM lineitem WHERE l_quantity > 48
    UNION ALL SELECT 'all', count(*), false FROM lineitem
""")
def w13_interleaved(spark: SparkSession, sf: str) -> DataFrame:
    """A filter on each of three columns finds its rows in less than three fifths of the files."""
    path = session.scratch_path(spark, "w13-z")
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_shipdate", "l_quantity")
    layout.interleaved_layout(rows, "l_partkey,l_shipdate,l_quantity", 64).write.parquet(path)
    stored = spark.read.parquet(path).withColumn("file", F.col("_metadata.file_path"))
    filters = {"l_partkey": F.col("l_partkey").between(100, 150), "l_shipdate": F.col("l_shipdate") >= F.lit("2001-01-01").cast("timestamp_ntz"),
               "l_quantity": F.col("l_quantity") > 48, "all": F.lit(True)}
    # A reader skips a file by its smallest and greatest value of the column.
    tested = F.explode(F.array(*[F.struct(F.lit(n).alias("filtered"), hit.alias("hit")) for n, hit in filters.items()]))
    per_file = stored.select("file", tested.alias("t")).groupBy("file", "t.filtered").agg(F.count_if("t.hit").alias("n"))
    return per_file.groupBy("filtered").agg(F.sum("n").alias("n"), (F.count_if(F.col("n") > 0) < 0.6 * F.count(F.lit(1))).alias("few_files"))


@query("w14_write_disposition", """
    SELECT c_custkey, c_name FROM customer UNION ALL SELECT c_custkey, c_name FROM customer
""")
def w14(spark: SparkSession, sf: str) -> DataFrame:
    """Truncate an earlier load, then append to it."""
    path = session.scratch_path(spark, "w14")
    rows = table(spark, sf, "customer").select("c_custkey", "c_name")
    for disposition in ("WRITE_EMPTY", "WRITE_TRUNCATE", "WRITE_APPEND"):
        layout.file_writer(rows, "ParquetFormat", disposition=disposition).save(path)
    return spark.read.parquet(path)


def payloads(spark: SparkSession, sf: str) -> DataFrame:
    """``events`` where every tenth payload is cut short and some others are null."""
    event = F.col("event_id") % 10
    return table(spark, sf, "events").withColumn(
        "payload", F.when(event == 3, F.lit('{"k": ')).when(event == 7, F.lit(None)).otherwise(F.col("props")))


@query("w16_split_bad_records", """
    SELECT event_id, CASE event_id % 10 WHEN 3 THEN 'dead' WHEN 7 THEN 'delete' ELSE 'good' END AS verdict,
           CASE WHEN event_id % 10 NOT IN (3, 7) THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k
    FROM events
""")
def w16(spark: SparkSession, sf: str) -> DataFrame:
    schema = T.StructType([T.StructField("k", T.LongType())])
    good, dead = deadletter.split_bad_records(payloads(spark, sf), "payload", schema, "delete", "warn")
    return good.select("event_id", "verdict", "parsed.k").unionByName(
        dead.select("event_id", "verdict"), allowMissingColumns=True)


BREACHES_SQL = """
    SELECT {key}, ts, event_id, CAST(failures AS BIGINT) AS failures FROM (
        SELECT {key}, ts, event_id, sum(CASE WHEN {bad} THEN 1 ELSE 0 END) OVER (
                   PARTITION BY {key} ORDER BY ts, event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS failures
        FROM events) WHERE failures >= 4
"""


@query("w17_nack_breaches", BREACHES_SQL.format(key="user_id", bad="event_type = 'error'"))
def w17(spark: SparkSession, sf: str) -> DataFrame:
    return deadletter.nack_breaches(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"],
                                    F.col("event_type") == "error", 10, 4)


@query("w17_nack_breaches_hot_keys", BREACHES_SQL.format(key="event_type", bad="value > 20"))
def w17_hot_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Few keys with many records each; the low limit sends them down the numbered path."""
    return deadletter.nack_breaches(table(spark, sf, "events"), ["event_type"], ["ts", "event_id"],
                                    F.col("value") > 20, 10, 4, hot_rows=100)


@query("w18_fan_out_by_topic", """
    SELECT 'copy_srv.app.' || event_type || '_v1' AS target, count(*) AS n FROM events GROUP BY ALL
""")
def w18(spark: SparkSession, sf: str) -> DataFrame:
    path = session.scratch_path(spark, "w18")
    df = layout.fan_out_by_topic(event_records(spark, sf), "copy_${topic}_v1")
    layout.file_writer(df, "ParquetFormat", partitions=["target"]).save(path)
    return spark.read.parquet(path).groupBy("target").agg(F.count(F.lit(1)).alias("n"))


@query("w19_to_key_value", """
    SELECT 'user:' || user_id AS key, arg_max(value, (ts, event_id)) AS value, max(ts) AS written
    FROM events GROUP BY user_id HAVING max(ts) + INTERVAL 3 DAY > TIMESTAMP '2024-01-30'
""")
def w19(spark: SparkSession, sf: str) -> DataFrame:
    as_of = F.lit("2024-01-30").cast("timestamp_ntz")
    return layout.to_key_value(table(spark, sf, "events"), "user_id", "value", "ts", "user:", 3 * 86400, as_of,
                               tie=["event_id"])


@query("w20_wrap_envelope", """
    SELECT event_id, '{"event":{"user_id":' || user_id || ',"event_type":"' || event_type
                     || '"},"index":"main","sourcetype":"app"}' AS body
    FROM events
""")
def w20(spark: SparkSession, sf: str) -> DataFrame:
    df = layout.wrap_envelope(table(spark, sf, "events"), {"index": "main", "sourcetype": "app", "source": ""},
                              ["user_id", "event_type"])
    return df.select("event_id", "body")


@query("w21_mirror_topics", """
    SELECT event_id, 'dr.srv.app.' || event_type AS target FROM events WHERE event_type IN ('signup', 'purchase')
""")
def w21(spark: SparkSession, sf: str) -> DataFrame:
    df = layout.mirror_topics(event_records(spark, sf), pattern=r"srv\.app\.(signup|purchase)", prefix="dr.")
    return df.select("event_id", "target")
