"""Driver tables and the record shapes built from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace import session


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def topic() -> Column:
    return F.concat(F.lit("srv.app."), F.col("event_type"))


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with a topic per event type."""
    return table(spark, sf_dir, "events").withColumn("topic", topic())


def event_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_envelopes(table(spark, sf_dir, "events"))


def event_envelopes(events: DataFrame) -> DataFrame:
    """``events`` as change envelopes per user: signup creates, error deletes, everything else updates."""
    image = F.struct("user_id", "event_type", "value")
    op = F.when(F.col("event_type") == "signup", "c").when(F.col("event_type") == "error", "d").otherwise("u")
    return events.select(
        op.alias("op"),
        F.when(op == "d", image).alias("before"),
        F.when(op != "d", image).alias("after"),
        "ts",
        F.col("event_id").alias("seq"),
    )


# The change envelopes above, for the SQL side.
CHANGES_SQL = """
    SELECT CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
           user_id, event_type, value, ts, event_id AS seq
    FROM events
"""


def definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as an inventory of definitions: record_id and a map of settings. Null settings are absent.

    Every record reads or writes a topic per customer and a topic per order status; the latter hold a third of all
    records each.
    """
    key, status, priority = F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderpriority")
    customer = F.col("o_custkey").cast("string")
    number = key.cast("string")
    place = key % 6
    class_name = (
        F.when(place == 0, "io.debezium.connector.mysql.MySqlConnector")
        .when(place == 1, "io.confluent.connect.jdbc.JdbcSourceConnector")
        .when(place == 2, "io.confluent.connect.jdbc.JdbcSinkConnector")
        .when(place == 3, "com.mongodb.kafka.connect.MongoSourceConnector")
        .when(place == 4, "jdbc.JdbcSinkConnector")
        .otherwise(F.concat(F.lit("com.example.Custom"), (F.col("o_custkey") % 50).cast("string")))
    )
    settings = {
        "name": F.concat(F.lit("rec-"), number),
        "connector.class": class_name,
        "tasks.max": (key % 4).cast("string"),
        "topics": F.concat(F.lit("cust-"), customer, F.lit(", status-"), status),
        "connection.url": F.when(status != "F", F.concat(F.lit("jdbc:postgresql://db:5432/d"), customer)),
        "connection.password": F.when(priority == "1-URGENT", "${file:pw}").otherwise(F.concat(F.lit("pw"), number)),
        "mode": F.when(priority != "5-LOW", "bulk"),
        "copy.existing": F.when(status == "P", "true").otherwise("false"),
        "validate.non.null": F.when(status == "O", "false"),
        "database.hostname": F.concat(F.lit("h"), customer),
        "database.user": F.when(status != "O", "u"),
        "transforms": F.lit("unwrap, route"),
        "transforms.unwrap.type": F.lit("io.debezium.transforms.ExtractNewRecordState"),
        "transforms.route.type": F.when(status == "F", "org.apache.kafka.connect.transforms.RegexRouter")
        .when(status == "O", "org.apache.kafka.connect.transforms.Flatten$Value").otherwise("com.example.MyRoute"),
        "transforms.route.predicate": F.when(status == "P", "pending"),
        "transforms.route.negate": F.when(priority == "2-HIGH", "true"),
        "transforms.route.target.type": F.lit("t"),
        "consumer.max.poll.records": customer,
        "key.converter.schema.registry.url": F.when(status == "F", F.concat(F.lit("http://reg-"), customer)),
        "value.converter.schema.registry.ssl": F.when(status == "O", "on"),
    }
    pairs = F.map_from_arrays(F.array(*[F.lit(k) for k in settings]), F.array(*settings.values()))
    present = F.map_filter(pairs, lambda k, v: v.isNotNull()).alias("settings")
    # Behind ``inline``, as in the document parser: filters on the settings must not build the map again.
    return session.spread(table(spark, sf_dir, "orders"), "o_orderkey").select(
        number.alias("record_id"), (F.col("o_custkey") % 25).cast("int").alias("group"),
        F.inline(F.array(F.struct(present))))


# The settings above as columns, for the SQL side.
DEFS_SQL = """
    SELECT CAST(o_orderkey AS VARCHAR) AS record_id, 'rec-' || o_orderkey AS name, o_custkey % 25 AS grp,
           CASE o_orderkey % 6
               WHEN 0 THEN 'io.debezium.connector.mysql.MySqlConnector'
               WHEN 1 THEN 'io.confluent.connect.jdbc.JdbcSourceConnector'
               WHEN 2 THEN 'io.confluent.connect.jdbc.JdbcSinkConnector'
               WHEN 3 THEN 'com.mongodb.kafka.connect.MongoSourceConnector'
               WHEN 4 THEN 'jdbc.JdbcSinkConnector'
               ELSE 'com.example.Custom' || (o_custkey % 50) END AS class,
           o_orderkey % 4 AS tasks_max, 'cust-' || o_custkey AS topic1, 'status-' || o_orderstatus AS topic2,
           CASE WHEN o_orderstatus <> 'F' THEN 'jdbc:postgresql://db:5432/d' || o_custkey END AS connection_url,
           CASE WHEN o_orderpriority = '1-URGENT' THEN '${file:pw}' ELSE 'pw' || o_orderkey END AS connection_password,
           CASE WHEN o_orderpriority <> '5-LOW' THEN 'bulk' END AS mode,
           CASE WHEN o_orderstatus = 'P' THEN 'true' ELSE 'false' END AS copy_existing,
           CASE WHEN o_orderstatus = 'O' THEN 'false' END AS validate_non_null,
           'h' || o_custkey AS database_hostname, CASE WHEN o_orderstatus <> 'O' THEN 'u' END AS database_user,
           CASE o_orderstatus WHEN 'F' THEN 'org.apache.kafka.connect.transforms.RegexRouter'
               WHEN 'O' THEN 'org.apache.kafka.connect.transforms.Flatten$Value' ELSE 'com.example.MyRoute' END AS route,
           CASE WHEN o_orderstatus = 'P' THEN 'pending' END AS predicate, o_orderpriority = '2-HIGH' AS negate,
           CAST(o_custkey AS VARCHAR) AS max_poll,
           CASE WHEN o_orderstatus = 'F' THEN 'http://reg-' || o_custkey END AS registry_url,
           CASE WHEN o_orderstatus = 'O' THEN 'on' END AS registry_ssl
    FROM orders
"""

# Status, effort and equivalent the catalog gives each class.
MATCHED_SQL = f"""
    SELECT *, CASE WHEN class LIKE 'com.example%' THEN 'manual' WHEN class LIKE '%Mongo%' THEN 'partial'
                   ELSE 'supported' END AS status,
           class NOT LIKE 'com.example%' AS known,
           CASE WHEN class LIKE 'com.example%' THEN NULL WHEN class = 'jdbc.JdbcSinkConnector'
                THEN 'io.confluent.connect.jdbc.JdbcSinkConnector' ELSE class END AS catalog_class,
           CASE WHEN class LIKE 'com.example%' THEN '2-5 days' WHEN class LIKE '%Mongo%' THEN '1-2 hours'
                WHEN class LIKE '%JdbcSource%' THEN '45 minutes' ELSE '30 minutes' END AS effort
    FROM ({DEFS_SQL})
"""
