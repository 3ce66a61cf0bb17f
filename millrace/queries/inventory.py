"""Documents A1-A6, catalog A8-A12, A34, A35, classes A14, selection A33, identifiers A39."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace import session
from millrace.functions import maps, text, values
from millrace.operators import audit, catalog
from millrace.queries import query
from millrace.queries.tables import DEFS_SQL, MATCHED_SQL, definitions, table
from millrace.sources import documents


def heads(spark: SparkSession, sf: str) -> DataFrame:
    return documents.record_heads(definitions(spark, sf))


def matched(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.default_unmatched(catalog.match_catalog(heads(spark, sf), catalog.load_catalog(spark)))


@query("a1_scan_documents", """
    SELECT 'orders-' || strftime(o_orderdate, '%Y-%m') AS name, 'json' AS format, false AS worker,
           CAST(count(*) AS VARCHAR) AS orders
    FROM orders GROUP BY ALL
""")
def a1(spark: SparkSession, sf: str) -> DataFrame:
    """One JSON document per order month, written as files and scanned back."""
    path = session.scratch_path(spark, "a1")
    month = F.date_format("o_orderdate", "yyyy-MM")
    docs = table(spark, sf, "orders").groupBy(month.alias("month")).agg(F.count(F.lit(1)).alias("orders"))
    rows = docs.select(F.concat(F.lit("orders-"), "month").alias("name"), "orders", "month")
    rows.write.partitionBy("month").json(path)
    good, _ = documents.parse_documents(documents.scan_documents(spark, path))
    return good.select(F.col("settings")["name"].alias("name"), "format", "worker",
                       F.col("settings")["orders"].alias("orders"))


def event_documents(spark: SparkSession, sf: str) -> DataFrame:
    """``events`` as JSON documents: every tenth is cut short, some are wrapped in ``config``."""
    event = F.col("event_id") % 10
    inner = F.concat(F.lit('"connector.class": "'), "event_type", F.lit('", "value": '), F.col("value").cast("string"),
                     F.lit(', "props": '), "props")
    name = F.concat(F.lit('{"name": "e'), F.col("event_id").cast("string"), F.lit('", '))
    body = (
        F.when(event == 3, F.concat(name, inner))
        .when(event == 5, F.concat(name, F.lit('"config": {'), inner, F.lit("}}")))
        .otherwise(F.concat(name, inner, F.lit("}")))
    )
    return session.spread(table(spark, sf, "events"), "event_id").select(
        F.col("event_id").cast("string").alias("record_id"), F.lit("json").alias("format"), body.alias("text"))


@query("a2_parse_json_documents", """
    SELECT record_id, key, value FROM (
        SELECT CAST(event_id AS VARCHAR) AS record_id, event_id % 10 AS place,
               unnest(['name', 'connector.class', 'props.k']) AS key,
               unnest(['e' || event_id, event_type, json_extract_string(props, '$.k')]) AS value FROM events)
    WHERE place <> 3
    UNION ALL SELECT CAST(event_id AS VARCHAR), 'error', 'document is not a JSON object' FROM events
    WHERE event_id % 10 = 3
""")
def a2(spark: SparkSession, sf: str) -> DataFrame:
    tagged = documents.tag_documents(event_documents(spark, sf))
    both = F.coalesce("settings", F.create_map(F.lit("error"), F.col("error")))
    found = tagged.select("record_id", F.explode(both)).where("key <> 'value'")
    nested = F.col("key") == "props"
    return found.select("record_id", F.when(nested, "props.k").otherwise(F.col("key")).alias("key"),
                        F.when(nested, F.get_json_object("value", "$.k")).otherwise(F.col("value")).alias("value"))


@query("a3_parse_properties_documents", """
    SELECT CAST(c_custkey AS VARCHAR) AS record_id, unnest(['name', 'segment', 'list', 'url', 'quoted']) AS key,
           unnest([c_name, c_mktsegment, 'a,b' || c_nationkey, 'jdbc:x?k=' || c_custkey, ' ' || c_name || ' ']) AS value
    FROM customer
""")
def a3(spark: SparkSession, sf: str) -> DataFrame:
    """``customer`` as properties texts with comments, a continuation, quotes and a repeated key."""
    number, nation = F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string")
    body = F.concat(
        F.lit("# made from customer \\\nname=old\n! note\n  name = "), "c_name", F.lit("\r\nsegment='"), "c_mktsegment",
        F.lit("'\nlist=a,\\\n    b"), nation, F.lit("\nurl=jdbc:x?k="), number, F.lit('\nquoted=" '), "c_name",
        F.lit(' "\n=no key\nno value\n'))
    docs = session.spread(table(spark, sf, "customer"), "c_custkey").select(
        number.alias("record_id"), F.lit("properties").alias("format"), body.alias("text"))
    return documents.entries(documents.parse_documents(docs)[0])


@query("a4_record_heads", f"""
    SELECT record_id, name, class, tasks_max, topic1 || '|' || topic2 AS topics,
           13 + (connection_url IS NOT NULL)::INT - 4 + (mode IS NOT NULL)::INT + (validate_non_null IS NOT NULL)::INT
              + (database_user IS NOT NULL)::INT + (registry_url IS NOT NULL)::INT + (registry_ssl IS NOT NULL)::INT
              - 5 AS n_rest
    FROM ({DEFS_SQL})
""")
def a4(spark: SparkSession, sf: str) -> DataFrame:
    return heads(spark, sf).select("record_id", "name", "class", "tasks_max",
                                   F.array_join("topics", "|").alias("topics"), F.size("rest").alias("n_rest"))


STEPS_SQL = f"""
    SELECT record_id, 0 AS pos, 'unwrap' AS step, 'io.debezium.transforms.ExtractNewRecordState' AS class,
           NULL::VARCHAR AS predicate, false AS negate, NULL::VARCHAR AS target_type FROM ({DEFS_SQL})
    UNION ALL SELECT record_id, 1, 'route', route, predicate, negate, 't' FROM ({DEFS_SQL})
"""


@query("a5_explode_steps", STEPS_SQL)
def a5(spark: SparkSession, sf: str) -> DataFrame:
    steps = documents.explode_steps(definitions(spark, sf))
    return steps.select("record_id", "pos", "step", "class", "predicate", "negate",
                        F.col("step_settings")["target.type"].alias("target_type"))


@query("a6_scope_by_prefix", f"""
    SELECT record_id, 'max.poll.records' AS key, max_poll AS value FROM ({DEFS_SQL})
""")
def a6(spark: SparkSession, sf: str) -> DataFrame:
    scoped = documents.scope_by_prefix(definitions(spark, sf), ["consumer.", "producer."])
    return scoped.select("record_id", F.explode(F.map_concat("consumer_settings", "producer_settings")))


@query("a8_load_catalog", """
    SELECT p_type AS class, any_value(CASE WHEN p_type = 'ECONOMY' THEN 'partial' ELSE 'supported' END) AS status,
           count(*) AS n FROM part GROUP BY p_type
""")
def a8(spark: SparkSession, sf: str) -> DataFrame:
    """A catalog with one entry per part type, one of them overridden, matched to every part."""
    parts = table(spark, sf, "part").withColumnRenamed("p_type", "class")
    base = parts.select("class", F.lit("odd text").alias("status")).distinct()
    new = base.where("class = 'ECONOMY'").withColumn("status", F.lit("Partial"))
    types = catalog.override(base, new).withColumn("status", catalog.normal_status(F.col("status")))
    return catalog.match_catalog(parts.select("p_partkey", "class"), types).groupBy("class", "status").agg(
        F.count(F.lit(1)).alias("n"))


NAMES = ["ring", "red", "red ring", "small ring", "widget", "small", "blue widget plus", "o", "large bolt deluxe"]
NAMES_SQL = "(VALUES " + ", ".join(f"('{n}')" for n in NAMES) + ") AS t(key)"


@query("a9_match_catalog", f"""
    SELECT p_partkey, class, catalog_class FROM (
        SELECT p_partkey, p_name AS class, key AS catalog_class, row_number() OVER (
                   PARTITION BY p_partkey ORDER BY p_name <> key, length(key) DESC, key) AS rn
        FROM part LEFT JOIN {NAMES_SQL} ON contains(p_name, key) OR contains(key, p_name)) WHERE rn = 1
""")
def a9(spark: SparkSession, sf: str) -> DataFrame:
    names = spark.createDataFrame([(n,) for n in NAMES], "class string")
    parts = table(spark, sf, "part").select("p_partkey", F.col("p_name").alias("class"))
    return catalog.match_catalog(parts, names)


@query("a9_match_large_catalog", """
    WITH keys AS (
        SELECT c_name AS key FROM customer WHERE c_custkey % 2 = 1
        UNION SELECT 'feed.' || c_name || '.v1.extra' FROM customer WHERE c_custkey % 4 = 0
        UNION SELECT 'v' || (c_custkey % 2) FROM customer),
    classes AS (SELECT DISTINCT 'feed.' || c_name || '.v' || (o_orderkey % 3) AS class FROM orders JOIN customer ON c_custkey = o_custkey),
    best AS (
        SELECT class, key FROM classes JOIN keys ON contains(class, key) OR contains(key, class)
        QUALIFY row_number() OVER (PARTITION BY class ORDER BY class <> key, length(key) DESC, key) = 1)
    SELECT o_orderkey, class, key AS catalog_class
    FROM (SELECT o_orderkey, 'feed.' || c_name || '.v' || (o_orderkey % 3) AS class FROM orders JOIN customer ON c_custkey = o_custkey)
    LEFT JOIN best USING (class)
""")
def a9_large(spark: SparkSession, sf: str) -> DataFrame:
    """A catalog that grows with the customers: over a thousand keys, some within the classes and some around them."""
    customers, name = table(spark, sf, "customer"), F.col("c_name")
    keys = customers.where("c_custkey % 2 = 1").select(name.alias("class"))
    keys = keys.union(customers.where("c_custkey % 4 = 0").select(F.concat(F.lit("feed."), name, F.lit(".v1.extra"))))
    keys = keys.union(customers.select(F.concat(F.lit("v"), (F.col("c_custkey") % 2).cast("string")))).distinct()
    records = table(spark, sf, "orders").join(customers, F.col("c_custkey") == F.col("o_custkey")).select(
        "o_orderkey", F.concat(F.lit("feed."), name, F.lit(".v"), (F.col("o_orderkey") % 3).cast("string")).alias("class"))
    return catalog.match_catalog(records, keys).select("o_orderkey", "class", "catalog_class")


@query("a10_default_unmatched", f"SELECT record_id, catalog_class, known, status, effort FROM ({MATCHED_SQL})")
def a10(spark: SparkSession, sf: str) -> DataFrame:
    return matched(spark, sf).select("record_id", "catalog_class", "known", "status", "effort")


REQUIRED_SQL = f"""
    SELECT record_id, unnest(CASE
        WHEN class LIKE '%MySql%' THEN ['database.port', 'database.password', 'database.server.name']
             || CASE WHEN database_user IS NULL THEN ['database.user'] ELSE [] END
        WHEN class LIKE '%JdbcSource%' THEN CASE WHEN connection_url IS NULL THEN ['connection.url'] ELSE [] END
             || CASE WHEN mode IS NULL THEN ['mode'] ELSE [] END
        WHEN class LIKE '%JdbcSink%' THEN CASE WHEN connection_url IS NULL THEN ['connection.url'] ELSE [] END
        WHEN class LIKE '%Mongo%' THEN ['connection.uri'] ELSE [] END) AS field
    FROM ({DEFS_SQL})
"""
FORBIDDEN_SQL = f"""
    SELECT record_id, 'validate.non.null' AS field FROM ({DEFS_SQL})
    WHERE class LIKE '%JdbcSource%' AND validate_non_null = 'false'
    UNION ALL SELECT record_id, 'copy.existing' FROM ({DEFS_SQL}) WHERE class LIKE '%Mongo%' AND copy_existing = 'true'
"""


@query("a11_audit_required_keys", f"SELECT record_id, 'error' AS severity, field FROM ({REQUIRED_SQL})")
def a11(spark: SparkSession, sf: str) -> DataFrame:
    return audit.audit_required_keys(matched(spark, sf)).select("record_id", "severity", "field")


@query("a11_audit_forbidden_values", f"SELECT record_id, 'warning' AS severity, field FROM ({FORBIDDEN_SQL})")
def a11_forbidden(spark: SparkSession, sf: str) -> DataFrame:
    return audit.audit_forbidden_values(matched(spark, sf)).select("record_id", "severity", "field")


@query("a11_missing_entries", f"SELECT record_id, field AS key FROM ({REQUIRED_SQL})")
def a11_entries(spark: SparkSession, sf: str) -> DataFrame:
    """The same audit over a long entry table."""
    expected = matched(spark, sf).select("record_id", F.explode("required").alias("key"))
    keys = sorted({key for row in values.CATALOG for key in row[8]})
    return audit.missing_entries(documents.entries(definitions(spark, sf)), expected, keys)


CLASSIFIED_SQL = f"""
    SELECT record_id, step, class, CASE class WHEN 'com.example.MyRoute' THEN 'manual' ELSE 'supported' END AS status
    FROM ({STEPS_SQL})
"""


def classified(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.classify_steps(documents.explode_steps(definitions(spark, sf)), catalog.load_step_catalog(spark))


@query("a12_classify_steps", CLASSIFIED_SQL)
def a12(spark: SparkSession, sf: str) -> DataFrame:
    return classified(spark, sf).select("record_id", "step", "class", "status")


@query("a14_classify_kind", f"""
    SELECT record_id, CASE WHEN lower(class) LIKE '%source%' OR lower(class) LIKE '%debezium%' THEN 'source'
                           WHEN lower(class) LIKE '%sink%' THEN 'sink' ELSE 'unknown' END AS kind,
           CASE WHEN lower(class) LIKE '%source%' THEN 'source' WHEN lower(class) LIKE '%sink%' THEN 'destination'
                ELSE 'source' END AS direction
    FROM ({DEFS_SQL})
""")
def a14(spark: SparkSession, sf: str) -> DataFrame:
    return heads(spark, sf).select("record_id", text.kind(F.col("class")).alias("kind"),
                                   text.direction(F.col("class")).alias("direction"))


@query("a33_select_records", """
    SELECT p_partkey, p_name AS name, CASE WHEN p_size > 40 THEN 'unsupported' ELSE 'supported' END AS status
    FROM part WHERE p_name IN ('red ring', 'small ring', 'red widget') AND p_size <= 40
""")
def a33(spark: SparkSession, sf: str) -> DataFrame:
    status = F.when(F.col("p_size") > 40, "unsupported").otherwise("supported")
    records = table(spark, sf, "part").select("p_partkey", F.col("p_name").alias("name"), status.alias("status"))
    return audit.select_records(records, "red ring, small ring, red widget", skip_unsupported=True)


def part_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """``part`` as a catalog: the brand is the category, the size decides the status."""
    status = F.when(F.col("p_size") > 40, "manual").when(F.col("p_size") > 20, "partial").otherwise("supported")
    return table(spark, sf, "part").select(
        F.concat(F.lit("part."), F.col("p_partkey").cast("string")).alias("class"), F.col("p_name").alias("catalog_name"),
        F.col("p_brand").alias("category"), maps.filled(F.replace("p_type", F.lit("ECONOMY"), F.lit(""))).alias("equivalent"),
        status.alias("status"), F.when(F.col("p_retailprice") > 1000, "30 minutes").alias("effort"))


PART_CATALOG_SQL = """
    SELECT 'part.' || p_partkey AS class, p_name AS catalog_name, p_brand AS category,
           nullif(replace(p_type, 'ECONOMY', ''), '') AS equivalent,
           CASE WHEN p_size > 40 THEN 'manual' WHEN p_size > 20 THEN 'partial' ELSE 'supported' END AS status,
           CASE WHEN p_retailprice > 1000 THEN '30 minutes' END AS effort
    FROM part
"""


@query("a34_browse_catalog", f"""
    SELECT category, status, count(*) AS n FROM ({PART_CATALOG_SQL}) WHERE status = 'partial' GROUP BY ALL
""")
def a34(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.catalog_counts(catalog.browse_catalog(part_catalog(spark, sf), status="partial"))


@query("a35_search_catalog", f"""
    SELECT class, catalog_name, lower(catalog_name) = 'red ring' AS exact FROM ({PART_CATALOG_SQL})
    WHERE contains(lower(catalog_name), 'red ring') OR contains(lower(class), 'red ring')
""")
def a35(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.search_catalog(part_catalog(spark, sf), " Red RING ").select("class", "catalog_name", "exact")


@query("a35_suggest_all", f"""
    WITH texts AS (SELECT DISTINCT upper(p_name) || ' ' AS text FROM part WHERE p_partkey % 40 = 0 UNION SELECT split_part(p_name, ' ', 1) FROM part
                   UNION SELECT 'no such part')
    SELECT text, class, catalog_name FROM texts JOIN ({PART_CATALOG_SQL})
    ON contains(lower(catalog_name), trim(lower(text))) OR (catalog_name <> '' AND contains(trim(lower(text)), lower(catalog_name)))
""")
def a35_suggest(spark: SparkSession, sf: str) -> DataFrame:
    parts, name = table(spark, sf, "part"), F.col("p_name")
    texts = parts.where("p_partkey % 40 = 0").select(F.concat(F.upper(name), F.lit(" "))).union(parts.select(F.split_part(name, F.lit(" "), F.lit(1))))
    texts = texts.union(spark.range(1).select(F.lit("no such part")))
    return catalog.suggest_all(part_catalog(spark, sf), texts)


@query("a35_catalog_quality", f"""
    SELECT class, 'error' AS severity, 'missing equivalent' AS message FROM ({PART_CATALOG_SQL}) WHERE equivalent IS NULL
    UNION ALL SELECT class, 'warning', 'missing effort' FROM ({PART_CATALOG_SQL}) WHERE effort IS NULL
""")
def a35_quality(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.catalog_quality(part_catalog(spark, sf))


@query("a39_make_identifier", """
    SELECT c_custkey, regexp_replace(translate(lower(c_name || '._(é) x'), ' _.', '---'), '[^a-z0-9-]', '', 'g') AS id,
           translate(lower(c_name || ': "a/b"'), ' /:".', '-----') AS file_id,
           'p' || replace(replace(c_custkey || ':a*b', ':', '-'), '*', '-') AS command_id,
           'p' || replace(replace(c_custkey || ':a*b', ':', '-'), '*', '') AS generator_id
    FROM customer
""")
def a39(spark: SparkSession, sf: str) -> DataFrame:
    name, odd = F.col("c_name"), F.concat(F.col("c_custkey").cast("string"), F.lit(":a*b"))
    return table(spark, sf, "customer").select(
        "c_custkey", text.identifier(F.concat(F.lit("-"), name, F.lit("._(é) x"), F.lit("_"))).alias("id"),
        text.file_identifier(F.concat(name, F.lit(': "a/b"'))).alias("file_id"),
        text.command_identifier(odd).alias("command_id"), text.generator_identifier(odd).alias("generator_id"))
