"""Write modes W1-W8, W15 and dead letters W16, W17."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace import session
from millrace.operators import slices, writes
from millrace.queries import query
from millrace.queries.tables import CHANGES_SQL, event_changes, table


def customer_batch(spark: SparkSession, sf: str) -> DataFrame:
    """New versions of the customers of two segments, and one new customer for each of them."""
    changed = table(spark, sf, "customer").where(F.col("c_mktsegment").isin("MACHINERY", "HOUSEHOLD"))
    copies = F.explode(F.array(F.lit(0), F.lit(1)))
    return changed.withColumn("copy", copies).select(
        F.when(F.col("copy") == 0, F.col("c_custkey")).otherwise(-1 - F.col("c_custkey")).alias("c_custkey"),
        "c_name", "c_nationkey", (F.col("c_acctbal") + 1).alias("c_acctbal"), "c_mktsegment")


BATCH_SQL = """
    SELECT c_custkey, c_name, c_nationkey, c_acctbal + 1 AS c_acctbal, c_mktsegment
    FROM customer WHERE c_mktsegment IN ('MACHINERY', 'HOUSEHOLD')
    UNION ALL
    SELECT -1 - c_custkey, c_name, c_nationkey, c_acctbal + 1, c_mktsegment FROM customer WHERE c_mktsegment IN ('MACHINERY', 'HOUSEHOLD')
"""


@query("w1_write_insert", f"SELECT * FROM customer UNION ALL SELECT * FROM ({BATCH_SQL})")
def w1(spark: SparkSession, sf: str) -> DataFrame:
    return writes.write_insert(table(spark, sf, "customer"), customer_batch(spark, sf))


@query("w2_write_update", f"""
    SELECT t.c_custkey, coalesce(b.c_name, t.c_name) AS c_name, coalesce(b.c_nationkey, t.c_nationkey) AS c_nationkey,
           coalesce(b.c_acctbal, t.c_acctbal) AS c_acctbal, coalesce(b.c_mktsegment, t.c_mktsegment) AS c_mktsegment
    FROM customer t LEFT JOIN ({BATCH_SQL}) b USING (c_custkey)
""")
def w2(spark: SparkSession, sf: str) -> DataFrame:
    return writes.write_update(table(spark, sf, "customer"), customer_batch(spark, sf), ["c_custkey"])


UPSERT_SQL = f"""
    SELECT * FROM customer t WHERE NOT EXISTS (SELECT 1 FROM ({BATCH_SQL}) b WHERE b.c_custkey = t.c_custkey)
    UNION ALL SELECT * FROM ({BATCH_SQL})
"""


@query("w3_write_upsert", UPSERT_SQL)
def w3(spark: SparkSession, sf: str) -> DataFrame:
    return writes.write_mode(table(spark, sf, "customer"), customer_batch(spark, sf), ["c_custkey"])


@query("w3_write_upsert_repeated_keys", """
    WITH b AS (SELECT o_custkey AS c_custkey, 'order-' || o_orderkey AS c_name, o_custkey % 25 AS c_nationkey, o_totalprice AS c_acctbal,
                      o_orderstatus AS c_mktsegment
               FROM orders WHERE o_custkey % 3 = 0
               QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
    SELECT * FROM customer t WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.c_custkey = t.c_custkey)
    UNION ALL SELECT * FROM b
""")
def w3_repeated(spark: SparkSession, sf: str) -> DataFrame:
    """A batch with several versions of a customer: the last order of each counts."""
    rows = table(spark, sf, "orders").where("o_custkey % 3 = 0").select(
        F.col("o_custkey").alias("c_custkey"), F.concat(F.lit("order-"), "o_orderkey").alias("c_name"),
        (F.col("o_custkey") % 25).cast("int").alias("c_nationkey"), F.col("o_totalprice").alias("c_acctbal"),
        F.col("o_orderstatus").alias("c_mktsegment"), "o_orderdate", "o_orderkey")
    return writes.write_upsert(table(spark, sf, "customer"), rows, ["c_custkey"], ["o_orderdate", "o_orderkey"])


@query("w4_write_delete", f"""
    SELECT * FROM customer t WHERE NOT EXISTS (SELECT 1 FROM ({BATCH_SQL}) b WHERE b.c_custkey = t.c_custkey)
""")
def w4(spark: SparkSession, sf: str) -> DataFrame:
    return writes.write_delete(table(spark, sf, "customer"), customer_batch(spark, sf), ["c_custkey"])


LAST_SQL = f"""
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, seq DESC) AS rn
                   FROM ({CHANGES_SQL})) WHERE rn = 1
"""


@query("w5_apply_changes", f"SELECT user_id, event_type, value FROM ({LAST_SQL}) WHERE op <> 'd'")
def w5(spark: SparkSession, sf: str) -> DataFrame:
    return writes.apply_changes(None, event_changes(spark, sf), ["user_id"], ["ts", "seq"])


@query("w5_apply_changes_to_target", f"""
    SELECT coalesce(l.user_id, c.c_custkey) AS user_id, coalesce(l.event_type, c.c_mktsegment) AS event_type,
           coalesce(l.value, c.c_acctbal) AS value
    FROM customer c FULL JOIN ({LAST_SQL}) l ON l.user_id = c.c_custkey
    WHERE l.op IS NULL OR l.op <> 'd'
""")
def w5_target(spark: SparkSession, sf: str) -> DataFrame:
    target = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("event_type"), F.col("c_acctbal").alias("value"))
    return writes.apply_changes(target, event_changes(spark, sf), ["user_id"], ["ts", "seq"])


def stored_customers(spark: SparkSession, sf: str) -> str:
    """Customers as a stored table of slices of 500 keys; its path."""
    path = session.scratch_path(spark, "w5-slices")
    target = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("event_type"), F.col("c_acctbal").alias("value"))
    slices.create(target, path, ["user_id"], "ts timestamp_ntz, seq bigint", F.floor(F.col("user_id") / 500))
    return path


@query("w5_apply_changes_by_slice", f"""
    SELECT coalesce(l.user_id, c.c_custkey) AS user_id, coalesce(l.event_type, c.c_mktsegment) AS event_type,
           coalesce(l.value, c.c_acctbal) AS value
    FROM customer c FULL JOIN ({LAST_SQL}) l ON l.user_id = c.c_custkey
    WHERE l.op IS NULL OR l.op <> 'd'
""")
def w5_slices(spark: SparkSession, sf: str) -> DataFrame:
    """Two batches, the later events first: only slices that hold a changed key are rewritten."""
    path, changes = stored_customers(spark, sf), event_changes(spark, sf)
    for late in (True, False):
        slices.apply_changes(spark, path, changes.where((F.col("seq") % 3 == 0) != late), ["user_id"], ["ts", "seq"])
    return slices.read(spark, path)


@query("w5_replaced_slices", """
    SELECT c_custkey // 500 AS slice, bool_or(user_id IS NOT NULL) AS replaced, count(DISTINCT c_custkey)::BIGINT AS n
    FROM customer LEFT JOIN (SELECT DISTINCT user_id FROM events WHERE user_id % 7 = 0) ON user_id = c_custkey GROUP BY 1
""")
def w5_replaced(spark: SparkSession, sf: str) -> DataFrame:
    """Which slices got new files: those of a touched key, and no others."""
    path = stored_customers(spark, sf)
    files = lambda: spark.read.parquet(path).select(slices.SLICE, F.col("_metadata.file_path").alias("file"))
    before = files().groupBy(slices.SLICE, "file").agg(F.count(F.lit(1)).alias("n")).checkpoint()
    slices.apply_changes(spark, path, event_changes(spark, sf).where(F.coalesce("after.user_id", "before.user_id") % 7 == 0), ["user_id"], ["ts", "seq"])
    kept = files().select("file").distinct().withColumn("kept", F.lit(True))
    return before.join(kept, "file", "left").groupBy(F.col(slices.SLICE).cast("long").alias("slice")).agg(
        (~F.bool_or(F.coalesce("kept", F.lit(False)))).alias("replaced"), F.sum("n").alias("n"))


@query("w6_resolve_keys", """
    SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL
""")
def w6(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "orders").select(
        F.struct("o_custkey", "o_orderstatus").alias("key"), F.struct("o_totalprice").alias("value"))
    df, keys = writes.resolve_keys(df, "record_key")
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


@query("w7_assign_document_id", """
    SELECT o_orderkey, substr(sha256('{"f0":"' || o_orderkey || '","f1":"' || o_orderstatus || '"}'), 1, 24) AS _id,
           CAST(o_custkey AS VARCHAR) AS key_id, '{"state":"' || o_orderstatus || '"}' AS part_id
    FROM orders
""")
def w7(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", F.struct(F.col("o_custkey").alias("id")).alias("key"),
        F.struct(F.col("o_orderstatus").alias("state"), "o_totalprice").alias("value"))
    df = writes.assign_document_id(df, "bson_objectid", ["o_orderkey", "o_orderstatus"])
    df = writes.assign_document_id(df, "provided_in_key", out="key_id")
    df = writes.assign_document_id(df, "partial_value", ["state"], out="part_id")
    return df.select("o_orderkey", "_id", "key_id", "part_id")


@query("w8_write_model", f"""
    SELECT coalesce(b.c_custkey, t.c_custkey) AS c_custkey, coalesce(b.c_acctbal, t.c_acctbal) AS c_acctbal,
           coalesce(CASE WHEN t.c_custkey IS NOT NULL THEN TIMESTAMP '2024-01-01' END, TIMESTAMP '2024-06-01')
               AS inserted_ts,
           CASE WHEN b.c_custkey IS NULL THEN TIMESTAMP '2024-01-01' ELSE TIMESTAMP '2024-06-01' END AS modified_ts
    FROM customer t FULL JOIN ({BATCH_SQL}) b ON b.c_custkey = t.c_custkey
""")
def w8(spark: SparkSession, sf: str) -> DataFrame:
    first, now = (F.lit(d).cast("timestamp_ntz") for d in ("2024-01-01", "2024-06-01"))
    target = table(spark, sf, "customer").select(
        "c_custkey", "c_acctbal", first.alias("inserted_ts"), first.alias("modified_ts"))
    rows = customer_batch(spark, sf).select("c_custkey", "c_acctbal")
    model = writes.write_model_name("com.mongodb.kafka.connect.sink.writemodel.strategy.UpdateOneTimestampsStrategy")
    return writes.write_model(target, rows, ["c_custkey"], model, now=now)


@query("w8_write_model_by_slice", f"""
    SELECT coalesce(b.c_custkey, t.c_custkey) AS c_custkey, coalesce(b.c_acctbal, t.c_acctbal) AS c_acctbal,
           coalesce(CASE WHEN t.c_custkey IS NOT NULL THEN TIMESTAMP '2024-01-01' END, TIMESTAMP '2024-06-01') AS inserted_ts,
           CASE WHEN b.c_custkey IS NULL THEN TIMESTAMP '2024-01-01' ELSE TIMESTAMP '2024-06-01' END AS modified_ts
    FROM (SELECT * FROM customer WHERE c_nationkey <> 3) t FULL JOIN (SELECT * FROM ({BATCH_SQL}) WHERE c_nationkey <> 3) b ON b.c_custkey = t.c_custkey
    UNION ALL SELECT c_custkey, c_acctbal + 5, TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-01' FROM customer WHERE c_nationkey = 4
""")
def w8_slices(spark: SparkSession, sf: str) -> DataFrame:
    """Four write models one after another on a stored table: timestamps, deletion, replacement of nothing, insertion."""
    first, now = (F.lit(d).cast("timestamp_ntz") for d in ("2024-01-01", "2024-06-01"))
    path, customers = session.scratch_path(spark, "w8-slices"), table(spark, sf, "customer")
    slices.create(customers.select("c_custkey", "c_acctbal", first.alias("inserted_ts"), first.alias("modified_ts")), path, ["c_custkey"], slice_rows=1000)
    slices.write_model(spark, path, customer_batch(spark, sf).select("c_custkey", "c_acctbal"), ["c_custkey"], "update_one_timestamps", now=now)
    gone = customers.where("c_nationkey = 3")
    both = F.explode(F.array(F.col("c_custkey"), -1 - F.col("c_custkey")))
    slices.write_model(spark, path, gone.select(both.alias("c_custkey")), ["c_custkey"], "delete_one")
    slices.write_model(spark, path, customers.limit(0).select("c_custkey", "c_acctbal"), ["c_custkey"])
    more = customers.where("c_nationkey = 4").select("c_custkey", (F.col("c_acctbal") + 5).alias("c_acctbal"), first.alias("inserted_ts"), first.alias("modified_ts"))
    slices.write_model(spark, path, more, ["c_custkey"], "insert_one")
    return slices.read(spark, path)


@query("w15_evolve_schema", f"""
    SELECT c_custkey, c_name, c_acctbal, NULL::VARCHAR AS tier FROM customer t
    WHERE NOT EXISTS (SELECT 1 FROM ({BATCH_SQL}) b WHERE b.c_custkey = t.c_custkey)
    UNION ALL SELECT c_custkey, c_name, NULL, 'tier-' || c_nationkey FROM ({BATCH_SQL})
""")
def w15(spark: SparkSession, sf: str) -> DataFrame:
    target = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    rows = customer_batch(spark, sf).select(
        "c_custkey", "c_name", F.concat(F.lit("tier-"), F.col("c_nationkey").cast("string")).alias("tier"))
    target, rows = writes.evolve_schema(target, rows, auto_evolve=True)
    return writes.write_upsert(target, rows, ["c_custkey"])
