"""Issues and reports A13, A15-A25, A28-A30, A32."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace import session
from millrace.operators import audit, catalog
from millrace.plans import flow, rollups
from millrace.queries import query
from millrace.queries.inventory import CLASSIFIED_SQL, FORBIDDEN_SQL, REQUIRED_SQL, heads, matched
from millrace.queries.tables import DEFS_SQL, MATCHED_SQL, table


def audited(spark: SparkSession, sf: str) -> DataFrame:
    return audit.with_issues(matched(spark, sf), catalog.load_step_catalog(spark))


ISSUES_SQL = f"""
    SELECT record_id, 'warning' AS severity, 'connector.class' AS field, 'Unknown connector class' AS message
    FROM ({MATCHED_SQL}) WHERE NOT known
    UNION ALL SELECT record_id, 'error', field, 'Required field missing' FROM ({REQUIRED_SQL})
    UNION ALL SELECT record_id, 'warning', field, 'Unsupported feature detected: ' || field || '='
                     || CASE field WHEN 'copy.existing' THEN 'true' ELSE 'false' END FROM ({FORBIDDEN_SQL})
    UNION ALL SELECT record_id, 'warning', 'transforms.' || step, 'Unknown transform: ' || class
    FROM ({CLASSIFIED_SQL}) WHERE status = 'manual'
"""


@query("a13_collect_issues", ISSUES_SQL)
def a13(spark: SparkSession, sf: str) -> DataFrame:
    return audit.record_issues(audited(spark, sf)).select("record_id", "severity", "field", "message")


@query("a15_plan_summary", f"""
    SELECT count(*) AS total, count(*) FILTER (status = 'supported') AS direct,
           count(*) FILTER (status = 'partial') AS manual,
           count(*) FILTER (status IN ('manual', 'unsupported')) AS unsupported, '2-5 minutes' AS downtime
    FROM ({MATCHED_SQL})
""")
def a15(spark: SparkSession, sf: str) -> DataFrame:
    return rollups.plan_summary(matched(spark, sf))


@query("a16_effort_by_status", f"""
    SELECT minutes, '1-2 days' AS effort FROM (SELECT CAST(sum(m) AS BIGINT) AS minutes FROM (
        SELECT CASE status WHEN 'supported' THEN 30 WHEN 'partial' THEN 90 ELSE 240 END AS m FROM ({MATCHED_SQL})
        UNION ALL SELECT CASE status WHEN 'supported' THEN 15 ELSE 120 END FROM ({CLASSIFIED_SQL})))
""")
def a16(spark: SparkSession, sf: str) -> DataFrame:
    found = audited(spark, sf)
    return rollups.effort_by_status(found)


@query("a17_effort_by_catalog", f"""
    SELECT minutes, format('{{:.1f}} days', minutes / 480.0) AS effort FROM (
        SELECT CAST(floor(sum(CASE effort WHEN '2-5 days' THEN 240 WHEN '1-2 hours' THEN 120 WHEN '45 minutes' THEN 45
                                          ELSE 30 END) * 1.5) AS BIGINT) AS minutes FROM ({MATCHED_SQL}))
""")
def a17(spark: SparkSession, sf: str) -> DataFrame:
    return rollups.effort_by_catalog(matched(spark, sf))


def outcomes(spark: SparkSession, sf: str) -> DataFrame:
    return audit.outcomes(audited(spark, sf))


OUTCOMES_SQL = f"""
    SELECT d.record_id, d.class, coalesce(errors, 0) AS errors, coalesce(warnings, 0) AS warnings,
           coalesce(manual, false) AS manual, CASE WHEN errors > 0 THEN 'failed' ELSE 'success' END AS status
    FROM ({DEFS_SQL}) d LEFT JOIN (
        SELECT record_id, count(*) FILTER (severity = 'error') AS errors,
               count(*) FILTER (severity = 'warning') AS warnings, bool_or(message LIKE 'Unknown connector%' OR message LIKE 'Unsupported%') AS manual
        FROM ({ISSUES_SQL}) GROUP BY record_id) i ON i.record_id = d.record_id
"""


@query("a18_readiness", f"""
    SELECT round(greatest(0, (count(*) FILTER (status = 'success') * 100.0
                 - count(*) FILTER (status = 'success' AND warnings > 0) * 10.0) / count(*)), 6) AS readiness
    FROM ({OUTCOMES_SQL})
""")
def a18(spark: SparkSession, sf: str) -> DataFrame:
    return rollups.readiness(outcomes(spark, sf)).select(F.round("readiness", 6).alias("readiness"))


@query("a18_direct_share", f"""
    SELECT round(count(*) FILTER (status = 'supported') * 100.0 / count(*), 6) AS readiness FROM ({MATCHED_SQL})
""")
def a18_direct(spark: SparkSession, sf: str) -> DataFrame:
    return rollups.direct_share(matched(spark, sf)).select(F.round("readiness", 6).alias("readiness"))


LINKS_SQL = f"""
    SELECT * FROM (
        SELECT record_id, name, class, CASE WHEN lower(class) LIKE '%source%' OR lower(class) LIKE '%debezium%' THEN 'source'
                           WHEN lower(class) LIKE '%sink%' THEN 'sink' ELSE 'unknown' END AS kind,
               unnest([topic1, topic2]) AS topic FROM ({DEFS_SQL})) WHERE kind <> 'unknown'
"""


@query("a19_dependency_edges", f"""
    SELECT CASE kind WHEN 'sink' THEN record_id ELSE 'topic:' || topic END AS from_node,
           CASE kind WHEN 'sink' THEN 'topic:' || topic ELSE record_id END AS to_node, topic
    FROM ({LINKS_SQL}) WHERE topic IN (
        SELECT topic FROM ({LINKS_SQL}) GROUP BY topic
        HAVING count(*) FILTER (kind = 'sink') > 0 AND count(*) FILTER (kind = 'source') > 0)
""")
def a19(spark: SparkSession, sf: str) -> DataFrame:
    return flow.dependency_edges(heads(spark, sf))


@query("a19_dependencies_of", """
    SELECT 'o' || o_orderkey AS record_id, c_name AS depends_on FROM orders JOIN customer ON c_custkey = o_custkey
""")
def a19_of(spark: SparkSession, sf: str) -> DataFrame:
    """Every order reads the topic that its customer writes."""
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("record_id"), F.col("c_name").alias("name"),
        F.lit("x.Source").alias("class"), F.array(F.concat(F.lit("c"), F.col("c_custkey").cast("string"))).alias("topics"))
    number = F.concat(F.lit("o"), F.col("o_orderkey").cast("string"))
    orders = table(spark, sf, "orders").select(
        number.alias("record_id"), number.alias("name"), F.lit("x.Sink").alias("class"),
        F.array(F.concat(F.lit("c"), F.col("o_custkey").cast("string"))).alias("topics"))
    return flow.dependencies_of(customers.unionByName(orders), orders)


PLAN_SQL = f"""
    SELECT d.record_id, d.name, CASE WHEN lower(class) LIKE '%source%' THEN 1 WHEN lower(class) LIKE '%debezium%' THEN 0
                                     WHEN lower(class) LIKE '%sink%' THEN 2 ELSE 3 END AS priority,
           CAST(coalesce(dependencies, 0) AS BIGINT) AS dependencies, topic1, topic2
    FROM ({DEFS_SQL}) d LEFT JOIN (
        SELECT s.record_id, sum(writers) AS dependencies FROM ({LINKS_SQL}) s JOIN (
            SELECT topic, count(*) AS writers FROM ({LINKS_SQL}) WHERE kind = 'source' GROUP BY topic) w USING (topic)
        WHERE kind = 'sink' GROUP BY s.record_id) c ON c.record_id = d.record_id
"""


@query("a20_order_plan", f"""
    SELECT record_id, name, priority, dependencies,
           row_number() OVER (ORDER BY priority, dependencies, name, record_id) AS rank FROM ({PLAN_SQL})
""")
def a20(spark: SparkSession, sf: str) -> DataFrame:
    return flow.order_plan(heads(spark, sf))


@query("a21_shared_flow", f"""
    SELECT count(*) > 0 AS combined FROM ({LINKS_SQL}) a
    WHERE kind = 'sink' AND topic IN (SELECT topic FROM ({LINKS_SQL}) WHERE kind = 'source')
""")
def a21(spark: SparkSession, sf: str) -> DataFrame:
    return flow.shared_flow(heads(spark, sf))


@query("a23_outcome_metrics", f"""
    SELECT count(*) AS total, count(*) FILTER (status = 'success') AS successful,
           count(*) FILTER (status = 'failed') AS failed,
           count(*) FILTER (status = 'success' AND warnings > 0) AS with_warnings
    FROM ({OUTCOMES_SQL})
""")
def a23(spark: SparkSession, sf: str) -> DataFrame:
    return rollups.outcome_metrics(outcomes(spark, sf))


@query("a23_observed_outcomes", f"""
    SELECT count(*) AS total, count(*) FILTER (status = 'success') AS successful, count(*) FILTER (status = 'failed') AS failed,
           count(*) FILTER (status = 'success' AND warnings > 0) AS with_warnings, count(DISTINCT record_id) AS written
    FROM ({OUTCOMES_SQL})
""")
def a23_observed(spark: SparkSession, sf: str) -> DataFrame:
    """The outcomes written, and their metrics from the same pass."""
    path = session.scratch_path(spark, "outcomes")
    seen = rollups.write_outcomes(outcomes(spark, sf), path)
    return spark.read.parquet(path).agg(*[F.lit(v).cast("long").alias(k) for k, v in seen.items()], F.count_distinct("record_id").alias("written"))


@query("a23_class_counts", f"SELECT class, count(*) AS n FROM ({DEFS_SQL}) GROUP BY class")
def a23_classes(spark: SparkSession, sf: str) -> DataFrame:
    return rollups.class_counts(heads(spark, sf))


@query("a24_severity_report", f"""
    SELECT severity, count(*) AS n, CASE severity WHEN 'error' THEN 0 ELSE 1 END AS rank
    FROM ({ISSUES_SQL}) GROUP BY severity
""")
def a24(spark: SparkSession, sf: str) -> DataFrame:
    return rollups.severity_counts(audit.record_issues(audited(spark, sf)))


@query("a24_severity_messages", f"SELECT severity, message, count(*) AS n FROM ({ISSUES_SQL}) GROUP BY ALL")
def a24_messages(spark: SparkSession, sf: str) -> DataFrame:
    found = audit.record_issues(audited(spark, sf))
    return rollups.severity_messages(found).select("severity", "message", "n")


@query("a25_recommend", f"""
    WITH flags AS (
        SELECT count(*) FILTER (status = 'failed') / count(*) AS failed_share, count(*) FILTER (status = 'success') AS successful,
               count(*) FILTER (status = 'success' AND manual) AS manual FROM ({OUTCOMES_SQL})),
    advice AS (
        SELECT 0 AS place, 'High failure rate. Review definitions and their compatibility.' AS recommendation
        FROM flags WHERE failed_share > 0.2
        UNION ALL SELECT 1, 'Review masked credentials before deployment.' FROM flags WHERE successful > 0
        UNION ALL SELECT 2, manual || ' records need manual configuration.' FROM flags WHERE manual > 0
        UNION ALL SELECT 3, 'Test in a development environment before production.' FROM flags WHERE successful > 0
        UNION ALL SELECT 4, 'Configure the schema registry again if one is used.')
    SELECT (row_number() OVER (ORDER BY place) - 1)::INT AS pos, recommendation FROM advice
""")
def a25(spark: SparkSession, sf: str) -> DataFrame:
    return rollups.recommend(outcomes(spark, sf))


def stage_rows(spark: SparkSession, sf: str) -> DataFrame:
    """``lineitem`` as stages of pipeline documents (one document per order), with some attributes broken."""
    line, order = F.col("l_linenumber"), F.col("l_orderkey").cast("string")
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("doc_id"),
        F.when(F.col("l_quantity") < 2, "").otherwise(order).alias("id"),
        F.when(F.col("l_returnflag") == "R", "sideways").when(line < 4, "source").otherwise("destination").alias("type"),
        F.when(F.col("l_linestatus") == "O", F.concat(F.lit("builtin:p"), order)).when(
            line == 7, "builtin:a@b@c").otherwise("standalone:x@v1").alias("plugin"),
        F.when(line == 1, F.lit(None)).otherwise(order).alias("name"))


STAGE_ISSUES_SQL = """
    SELECT l_orderkey AS doc_id, 'error' AS severity, 'id' AS field, 'Connector ID is required' AS message
    FROM lineitem WHERE l_quantity < 2
    UNION ALL SELECT l_orderkey, 'error', 'type', 'Invalid connector type' FROM lineitem WHERE l_returnflag = 'R'
    UNION ALL SELECT l_orderkey, 'error', 'plugin', 'Invalid plugin format' FROM lineitem
    WHERE l_linestatus <> 'O' AND l_linenumber = 7
    UNION ALL SELECT l_orderkey, 'error', 'name', 'Connector name is required' FROM lineitem WHERE l_linenumber = 1
"""


@query("a28_check_rules", STAGE_ISSUES_SQL)
def a28(spark: SparkSession, sf: str) -> DataFrame:
    found = audit.check_rules(stage_rows(spark, sf), audit.stage_rules(), "doc_id")
    return found.select("doc_id", "severity", "field", "message")


def pipeline_rows(spark: SparkSession, sf: str) -> DataFrame:
    """``orders`` as pipelines; the order status and priority decide what is wrong with each."""
    number = F.col("o_orderkey").cast("string")
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("doc_id"), number.alias("id"), number.alias("name"),
        F.when(F.col("o_orderstatus") == "P", "waiting").otherwise("running").alias("status"),
        F.when(F.col("o_orderpriority") == "5-LOW", "").otherwise("text").alias("description"),
        F.lit(1).alias("n_stages"))


PIPELINE_ISSUES_SQL = """
    SELECT o_orderkey AS doc_id, 'error' AS severity, 'status' AS field, 'Invalid pipeline status' AS message
    FROM orders WHERE o_orderstatus = 'P'
    UNION ALL SELECT o_orderkey, 'warning', 'description', 'Pipeline description is recommended'
    FROM orders WHERE o_orderpriority = '5-LOW'
"""


@query("a28_check_rules_strict", PIPELINE_ISSUES_SQL)
def a28_strict(spark: SparkSession, sf: str) -> DataFrame:
    found = audit.check_rules(pipeline_rows(spark, sf), audit.pipeline_rules(strict=True), "doc_id")
    return found.select("doc_id", "severity", "field", "message")


@query("a29_find_duplicates", """
    SELECT doc_id, text_hash FROM (
        SELECT doc_id, md5(text) AS text_hash, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS rn
        FROM documents) WHERE rn > 1
""")
def a29(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select("doc_id", F.md5(F.encode("text", "UTF-8")).alias("text_hash"))
    return audit.find_duplicates(rows, ["text_hash"], ["doc_id"])


@query("a29_duplicate_counts", """
    SELECT l_orderkey, l_linenumber, count(*) - 1 AS extra FROM lineitem GROUP BY ALL HAVING count(*) > 1
""")
def a29_counts(spark: SparkSession, sf: str) -> DataFrame:
    return audit.duplicate_counts(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("a30_dangling_references", """
    SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = o_custkey)
""")
def a30(spark: SparkSession, sf: str) -> DataFrame:
    """Orders whose customer never appears in the event stream."""
    refs = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return audit.dangling_references(refs, "o_custkey", table(spark, sf, "events"), "user_id")


@query("a32_validation_summary", f"""
    SELECT count(*) AS total, count(*) FILTER (errors = 0) AS valid,
           count(*) FILTER (errors = 0 AND warnings > 0) AS with_warnings,
           count(*) FILTER (errors > 0) AS with_errors, bool_and(errors = 0 AND warnings = 0) AS passed
    FROM (SELECT o_orderkey, count(*) FILTER (severity = 'error') AS errors,
                 count(*) FILTER (severity = 'warning') AS warnings
          FROM orders LEFT JOIN (SELECT * FROM ({PIPELINE_ISSUES_SQL}) UNION ALL SELECT * FROM ({STAGE_ISSUES_SQL})) i
              ON doc_id = o_orderkey
          GROUP BY o_orderkey)
""")
def a32(spark: SparkSession, sf: str) -> DataFrame:
    pipelines = pipeline_rows(spark, sf)
    found = audit.collect_issues(
        audit.check_rules(pipelines, audit.pipeline_rules(strict=True), "doc_id"),
        audit.check_rules(stage_rows(spark, sf), audit.stage_rules(), "doc_id"))
    return audit.validation_summary(audit.document_verdicts(pipelines, found, strict=True))


@query("a32_observed_verdicts", f"""
    SELECT count(*) AS total, count(*) FILTER (errors = 0) AS valid, count(*) FILTER (errors = 0 AND warnings > 0) AS with_warnings,
           count(*) FILTER (errors > 0) AS with_errors, bool_and(errors = 0) AS passed, count(*) FILTER (errors > 0) AS written_invalid
    FROM (SELECT o_orderkey, count(*) FILTER (severity = 'error') AS errors, count(*) FILTER (severity = 'warning') AS warnings
          FROM orders LEFT JOIN ({PIPELINE_ISSUES_SQL}) i ON doc_id = o_orderkey GROUP BY o_orderkey)
""")
def a32_observed(spark: SparkSession, sf: str) -> DataFrame:
    """The verdicts written, and their summary from the same pass."""
    pipelines, path = pipeline_rows(spark, sf), session.scratch_path(spark, "verdicts")
    issues = audit.collect_issues(audit.check_rules(pipelines, audit.pipeline_rules(strict=True), "doc_id"))
    seen = rollups.write_observed(audit.document_verdicts(pipelines, issues), path, audit.verdict_counts())
    kinds = {"passed": "boolean"}
    return spark.read.parquet(path).agg(*[F.lit(v).cast(kinds.get(k, "long")).alias(k) for k, v in seen.items()],
                                        F.count_if(F.col("verdict") == "invalid").alias("written_invalid"))


@query("a32_document_verdicts", f"""
    SELECT o_orderkey AS doc_id, count(*) FILTER (severity = 'error') AS errors,
           count(*) FILTER (severity = 'warning') AS warnings,
           CASE WHEN count(*) FILTER (severity = 'error') > 0 THEN 'invalid'
                WHEN count(*) FILTER (severity = 'warning') > 0 THEN 'valid with warnings' ELSE 'valid' END AS verdict
    FROM orders LEFT JOIN ({PIPELINE_ISSUES_SQL}) ON doc_id = o_orderkey GROUP BY o_orderkey
""")
def a32_documents(spark: SparkSession, sf: str) -> DataFrame:
    pipelines = pipeline_rows(spark, sf)
    found = audit.check_rules(pipelines, audit.pipeline_rules(strict=True), "doc_id")
    return audit.document_verdicts(pipelines, found).drop("passed")
