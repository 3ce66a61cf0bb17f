"""Record steps T1-T14."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

from millrace.operators import steps
from millrace.queries import query
from millrace.queries.tables import CHANGES_SQL, event_changes, event_records, table


@query("t1_route_regex", """
    SELECT event_id,
           regexp_replace('srv.app.' || event_type, '^([^.]+)\\.([^.]+)\\.(p.*|c.*)$', '\\3-\\1') AS topic
    FROM events
""")
def t1(spark: SparkSession, sf: str) -> DataFrame:
    routed = steps.route_regex(event_records(spark, sf), r"([^.]+)\.([^.]+)\.(p.*|c.*)", "$3-$1")
    return routed.select("event_id", "topic")


@query("t2_convert_timestamp", """
    SELECT event_id, epoch_us(ts) // 1000 AS ms, CAST(ts AS DATE) AS day, strftime(ts, '%Y/%m/%d %H:%M') AS text,
           epoch_ms(strptime(strftime(ts, '%Y/%m/%d %H:%M'), '%Y/%m/%d %H:%M')) AS minute_ms
    FROM events
""")
def t2(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "events")
    df = steps.convert_timestamp(df, "ts", "unix", out="ms")
    df = steps.convert_timestamp(df, "ts", "date", out="day")
    df = steps.convert_timestamp(df, "ts", "string", "yyyy/MM/dd HH:mm", out="text")
    df = steps.convert_timestamp(df, "text", "unix", "yyyy/MM/dd HH:mm", out="minute_ms")
    return df.select("event_id", "ms", "day", "text", "minute_ms")


@query("t3_insert_field", """
    SELECT o_orderkey, 'eu' AS region, 'srv.' || o_orderstatus AS origin FROM orders
""")
def t3(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "orders").withColumn("topic", F.concat(F.lit("srv."), "o_orderstatus"))
    df = steps.insert_field(df, "region", "eu")
    return steps.insert_field(df, "origin", meta="topic").select("o_orderkey", "region", "origin")


@query("t4_replace_field", """
    SELECT c_custkey AS id, c_name AS name, c_mktsegment FROM customer
""")
def t4(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "customer")
    df = steps.replace_field(df, exclude=["c_acctbal"], renames={"c_custkey": "id", "c_name": "name"})
    return steps.replace_field(df, include=["id", "name", "c_mktsegment"])


@query("t5_mask_field", """
    SELECT c_custkey, '' AS c_name, CAST(0 AS DOUBLE) AS c_acctbal, '***' AS c_mktsegment FROM customer
""")
def t5(spark: SparkSession, sf: str) -> DataFrame:
    df = steps.mask_field(table(spark, sf, "customer"), "c_name,c_acctbal")
    return steps.mask_field(df, ["c_mktsegment"], "***").drop("c_nationkey")


@query("t6_filter_records", """
    SELECT event_id, event_type, value FROM events WHERE NOT (event_type = 'error' OR value < 5)
""")
def t6(spark: SparkSession, sf: str) -> DataFrame:
    df = steps.filter_records(table(spark, sf, "events"), "event_type = 'error' OR value < 5")
    return df.select("event_id", "event_type", "value")


@query("t7_when_predicate", """
    SELECT l_orderkey, l_linenumber,
           CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_extendedprice END AS l_extendedprice,
           CASE WHEN l_returnflag <> 'R' THEN 'kept' END AS note
    FROM lineitem WHERE NOT (l_returnflag = 'A' AND l_quantity > 40)
""")
def t7(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "lineitem")
    returned = "l_returnflag = 'R'"
    df = steps.when_predicate(df, steps.masked(["l_extendedprice"]), returned)
    df = steps.when_predicate(df, steps.inserted("note", "kept"), returned, negate=True)
    df = steps.when_predicate(df, steps.filtered("l_quantity > 40"), "l_returnflag = 'A'")
    return df.select("l_orderkey", "l_linenumber", "l_extendedprice", "note")


@query("t8_cast_fields", """
    SELECT c_custkey, TRY_CAST(substr(c_name, 10) AS INTEGER) AS number, TRY_CAST(c_mktsegment AS INTEGER) AS bad,
           CAST(c_nationkey AS VARCHAR) AS c_nationkey
    FROM customer
""")
def t8(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "customer").select(
        "c_custkey", F.expr("substr(c_name, 10)").alias("number"), F.col("c_mktsegment").alias("bad"), "c_nationkey")
    return steps.cast_fields(df, "number:int, bad:int, c_nationkey:string")


@query("t9_extract_field", "SELECT o_orderkey, o_orderpriority AS value FROM orders")
def t9(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "orders").select(
        "o_orderkey", F.struct("o_orderpriority", "o_totalprice").alias("value"))
    return steps.extract_field(df, "o_orderpriority")


@query("t10_flatten", """
    SELECT o_orderkey, o_custkey AS value_customer_id, o_orderstatus AS value_state, o_totalprice AS value_price_total
    FROM orders
""")
def t10(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "orders").select("o_orderkey", F.struct(
        F.struct(F.col("o_custkey").alias("id")).alias("customer"),
        F.col("o_orderstatus").alias("state"),
        F.struct(F.col("o_totalprice").alias("total")).alias("price"),
    ).alias("value"))
    return steps.flatten(df, "_")


@query("t11_unwrap_cdc", f"""
    SELECT seq, user_id, event_type, value, op = 'd' AS __deleted FROM ({CHANGES_SQL})
""")
def t11(spark: SparkSession, sf: str) -> DataFrame:
    return steps.unwrap_cdc(event_changes(spark, sf)).drop("ts")


@query("t12_route_logical_table", """
    SELECT o_orderkey, 'srv.orders' AS topic, 'srv.orders_' || (o_orderkey % 4) AS shard, o_orderkey AS id FROM orders
""")
def t12(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "orders").select(
        "o_orderkey",
        F.concat(F.lit("srv.orders_"), (F.col("o_orderkey") % 4).cast("string")).alias("topic"),
        F.struct(F.col("o_orderkey").alias("id")).alias("key"))
    return steps.route_logical_table(df, r"(.*)_\d+", "$1").select("o_orderkey", "topic", "key.*")


CHAIN = [
    {"class": "io.debezium.transforms.ExtractNewRecordState", "settings": {"drop.tombstones": "true"}},
    {"class": "org.apache.kafka.connect.transforms.InsertField$Value",
     "settings": {"static.field": "origin", "static.value": "events"}},
    {"class": "org.apache.kafka.connect.transforms.MaskField$Value", "settings": {"fields": "value"},
     "predicate": "private", "negate": True},
    {"class": "org.apache.kafka.connect.transforms.Filter", "predicate": "noise"},
    {"class": "com.example.Unknown"},
]


@query("t13_apply_steps", f"""
    SELECT seq, user_id, event_type, CASE WHEN event_type = 'purchase' THEN value ELSE 0 END AS value,
           op = 'd' AS __deleted, 'events' AS origin, 'processor-4:com.example.Unknown' AS placeholder
    FROM ({CHANGES_SQL}) WHERE event_type <> 'view'
""")
def t13(spark: SparkSession, sf: str) -> DataFrame:
    df = steps.apply_steps(event_changes(spark, sf), CHAIN,
                           {"private": "event_type = 'purchase'", "noise": "event_type = 'view'"})
    return df.select("seq", "user_id", "event_type", "value", "__deleted", "origin",
                     F.col("_placeholders")[0].alias("placeholder"))


@query("t14_custom_step", "SELECT event_id, round(value * 100) AS value FROM events")
def t14(spark: SparkSession, sf: str) -> DataFrame:
    @F.pandas_udf(T.DoubleType())
    def to_cents(value: pd.Series) -> pd.Series:
        return (value * 100).round()

    steps.custom_step("com.example.ToCents", lambda df: df.withColumn("value", to_cents("value")))
    df = steps.apply_steps(table(spark, sf, "events"), [{"class": "com.example.ToCents"}])
    return df.select("event_id", "value")


def _two_sides(spark: SparkSession, sf: str) -> DataFrame:
    """``orders`` with a struct on either side of the record."""
    return table(spark, sf, "orders").select(
        "o_orderkey", F.struct(F.col("o_custkey").alias("id"), F.col("o_orderstatus").alias("state")).alias("key"),
        F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("level")).alias("value"),
        F.concat(F.lit("srv."), "o_orderstatus").alias("topic"), F.col("o_custkey").alias("offset"),
        F.col("o_orderkey").cast("string").alias("number"))


@query("t9_extract_key", "SELECT o_orderkey, o_custkey AS key, o_orderpriority AS value FROM orders")
def t9_sides(spark: SparkSession, sf: str) -> DataFrame:
    chain = [{"class": "kafka.ExtractField$Key", "settings": {"field": "id"}},
             {"class": "kafka.ExtractField$Value", "settings": {"field": "level"}}]
    return steps.apply_steps(_two_sides(spark, sf), chain).select("o_orderkey", "key", "value")


@query("t13_steps_on_keys", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE o_custkey END AS key_id, o_orderstatus AS key_state, 'k' AS key_origin,
           CAST(o_orderkey AS VARCHAR) AS value_id, '' AS value_level, o_custkey AS "offset"
    FROM orders
""")
def t13_keys(spark: SparkSession, sf: str) -> DataFrame:
    """The same step classes on either side: the key is masked under a predicate, and the value's fields of the same name stay."""
    chain = [{"class": "kafka.MaskField$Key", "settings": {"fields": "id"}, "predicate": "done"},
             {"class": "kafka.InsertField$Key", "settings": {"static.field": "origin", "static.value": "k"}},
             {"class": "kafka.MaskField$Value", "settings": {"fields": "level"}},
             {"class": "kafka.Cast$Value", "settings": {"spec": "id:string"}}]
    done = steps.apply_steps(_two_sides(spark, sf), chain, {"done": "key.state = 'F'"})
    return done.select("o_orderkey", F.col("key.id").alias("key_id"), F.col("key.state").alias("key_state"), F.col("key.origin").alias("key_origin"),
                       F.col("value.id").alias("value_id"), F.col("value.level").alias("value_level"), "offset")


@query("t14_one_to_many", """
    SELECT event_id, i::INT AS part, value / 2 AS value FROM events, unnest(range(CASE event_type WHEN 'purchase' THEN 2 WHEN 'click' THEN 0 ELSE 1 END)) t(i)
""")
def t14_many(spark: SparkSession, sf: str) -> DataFrame:
    """None, one or two records for each, by its type."""
    steps.custom_step("com.example.Split", steps.one_to_many(split_event, "part int, value double", ["event_id"]))
    return steps.apply_steps(table(spark, sf, "events"), [{"class": "com.example.Split"}])


def split_event(record: Row) -> Iterator[tuple]:
    for part in range({"purchase": 2, "click": 0}.get(record["event_type"], 1)):
        yield part, record["value"] / 2


@query("t10_flatten_value", """
    SELECT o_orderkey AS value_id, o_orderpriority AS value_level, o_custkey AS id, o_orderstatus AS state FROM orders
""")
def t10_sides(spark: SparkSession, sf: str) -> DataFrame:
    chain = [{"class": "kafka.Flatten$Value", "settings": {"delimiter": "_"}}]
    return steps.apply_steps(_two_sides(spark, sf), chain).select(
        "value_id", "value_level", "key.id", "key.state")


@query("t3_insert_several", """
    SELECT o_orderkey, 'srv.' || o_orderstatus AS origin, o_custkey AS place, 'eu' AS region FROM orders
""")
def t3_several(spark: SparkSession, sf: str) -> DataFrame:
    settings = {"topic.field": "origin", "offset.field": "place", "static.field": "region", "static.value": "eu"}
    df = steps.apply_steps(_two_sides(spark, sf), [{"class": "kafka.InsertField$Value", "settings": settings}])
    return df.select("o_orderkey", "origin", "place", "region")


@query("t8_cast_public_types", """
    SELECT o_orderkey, CAST(o_orderkey AS INTEGER) AS number, CAST(o_custkey AS DOUBLE) AS offset FROM orders
""")
def t8_public(spark: SparkSession, sf: str) -> DataFrame:
    return steps.cast_fields(_two_sides(spark, sf), "number:int32,offset:float64").select("o_orderkey", "number", "offset")


@query("t2_time", "SELECT event_id, CAST(epoch_us(ts) // 1000 % 86400000 AS INTEGER) AS at FROM events")
def t2_time(spark: SparkSession, sf: str) -> DataFrame:
    return steps.convert_timestamp(table(spark, sf, "events"), "ts", "time", out="at").select("event_id", "at")
