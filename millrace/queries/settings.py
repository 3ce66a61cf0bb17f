"""Settings A7, A22, A26, A27, A31, A36, A37 and connection addresses A38."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace import session
from millrace.functions import setting_rules, text
from millrace.operators import audit, catalog, remap, settings
from millrace.queries import query
from millrace.queries.inventory import heads
from millrace.queries.tables import DEFS_SQL, definitions, table
from millrace.sources import documents


def workers(spark: SparkSession, sf: str) -> DataFrame:
    """``nation`` as worker documents; only some set a registry URL of their own."""
    region = F.col("n_regionkey")
    pairs = F.map_from_arrays(
        F.array(F.lit("schema.registry.url"), F.lit("value.converter.schema.registry.url"), F.lit("security.protocol"),
                F.lit("schema.registry.auth")),
        F.array(F.when(region == 0, F.concat(F.lit("http://main-"), "n_name")),
                F.when(region <= 1, F.concat(F.lit("http://value-"), "n_name")),
                F.when(region <= 2, "SSL"), F.when(region == 3, F.col("n_name"))))
    return table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("group"), F.map_filter(pairs, lambda k, v: v.isNotNull()).alias("settings"))


@query("a7_resolve_setting", f"""
    SELECT record_id,
           coalesce(CASE WHEN n_regionkey = 0 THEN 'http://main-' || n_name END,
                    CASE WHEN n_regionkey <= 1 THEN 'http://value-' || n_name END, registry_url, '') AS registry_url,
           CASE WHEN n_regionkey = 3 THEN n_name END AS auth, registry_ssl
    FROM ({DEFS_SQL}) JOIN nation ON n_nationkey = grp
""")
def a7(spark: SparkSession, sf: str) -> DataFrame:
    joined = settings.with_worker(definitions(spark, sf), workers(spark, sf))
    extra = F.col("registry_settings")
    return settings.resolve_registry(joined).select(
        "record_id", "registry_url", extra["schema.registry.auth"].alias("auth"),
        extra["value.converter.schema.registry.ssl"].alias("registry_ssl"))


@query("a22_apply_globals", f"""
    SELECT record_id, CASE WHEN n_regionkey = 0 THEN 'http://main-' || n_name END AS registry_url,
           CASE WHEN n_regionkey <= 2 THEN 'SSL' END AS protocol, name
    FROM ({DEFS_SQL}) JOIN nation ON n_nationkey = grp
""")
def a22(spark: SparkSession, sf: str) -> DataFrame:
    done = settings.apply_globals(settings.with_worker(definitions(spark, sf), workers(spark, sf)))
    s = F.col("settings")
    return done.select("record_id", s["schema.registry.url"].alias("registry_url"),
                       s["security.protocol"].alias("protocol"), s["name"].alias("name"))


@query("a26_mask_secrets", f"""
    SELECT record_id, CASE WHEN connection_password LIKE '${{%}}' THEN connection_password
                           ELSE '${{MASKED_CONNECTION.PASSWORD}}' END AS value, database_hostname AS hostname,
           CASE WHEN registry_url IS NOT NULL THEN '${{MASKED_KEY.CONVERTER.SCHEMA.REGISTRY.URL}}' END AS registry,
           1 + (registry_url IS NOT NULL)::INT AS n_references
    FROM ({DEFS_SQL})
""")
def a26(spark: SparkSession, sf: str) -> DataFrame:
    hidden, found = settings.mask_settings(definitions(spark, sf)), F.col("settings")
    records = hidden.where(F.size(found) > 0).select(
        "record_id", found["connection.password"].alias("value"), found["database.hostname"].alias("hostname"),
        found[settings.KEY_URL].alias("registry"),
        F.size(F.filter(F.map_values(found), lambda v: F.startswith(v, F.lit("${")))).alias("n_references"))
    # Dealt before they are compared: a maximum of texts sorts, and sorted parts of a large shuffle stay small.
    return records.repartition("record_id").groupBy("record_id").agg(
        F.max("value").alias("value"), F.max("hostname").alias("hostname"), F.max("registry").alias("registry"),
        F.sum("n_references").alias("n_references"))


@query("a27_find_sensitive_keys", f"""
    SELECT 'connection.password' AS key, count(*) AS n FROM ({DEFS_SQL})
    UNION ALL SELECT 'key.converter.schema.registry.url', count(*) FROM ({DEFS_SQL}) WHERE registry_url IS NOT NULL
""")
def a27(spark: SparkSession, sf: str) -> DataFrame:
    found = settings.find_sensitive_keys(documents.entries(definitions(spark, sf)))
    return found.groupBy("key").agg(F.count(F.lit(1)).alias("n"))


@query("a27_sensitive_text", """
    SELECT key, count(*) AS n, count(DISTINCT doc_id) AS documents FROM (
        SELECT doc_id, unnest(regexp_extract_all(text, '([A-Za-z_]+) ?[=:] ?"[^"\\n]*"', 1)) AS key FROM documents)
    WHERE regexp_matches(lower(key), 'password|passwd|pwd|secret|key|token|credential|auth|private|cert')
    GROUP BY key
""")
def a27_text(spark: SparkSession, sf: str) -> DataFrame:
    """Sensitive settings written into running text."""
    keys = F.regexp_extract_all("text", F.lit(r'([A-Za-z_]+) ?[=:] ?"[^"\n]*"'), F.lit(1))
    found = session.spread(table(spark, sf, "documents"), "doc_id").select("doc_id", F.explode(keys).alias("key"))
    return settings.find_sensitive_keys(found).groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("doc_id").alias("documents"))


def stages(spark: SparkSession, sf: str) -> DataFrame:
    """``customer`` as pipeline stages of three plugins, with some settings left out or unknown."""
    nation = F.col("c_nationkey")
    plugin = (
        F.when(nation < 8, "builtin:postgres@latest").when(nation < 16, "builtin:kafka").otherwise("custom:sink@v1")
    )
    pairs = F.map_from_arrays(
        F.array(*[F.lit(k) for k in ("host", "database", "brokers", "topics", "_note", "colour")]),
        F.array(F.when(nation < 8, F.col("c_name")), F.when((nation < 8) & (F.col("c_acctbal") > 0), "db"),
                F.when((nation >= 8) & (nation < 16), "b:9092"), F.when(nation == 9, "t"),
                F.when(nation < 16, "n"), F.when(F.col("c_mktsegment") == "BUILDING", "red")))
    return table(spark, sf, "customer").select(
        "c_custkey", plugin.alias("plugin"), F.map_filter(pairs, lambda k, v: v.isNotNull()).alias("settings"))


@query("a31_audit_capabilities", """
    SELECT c_custkey, severity, field FROM (
        SELECT c_custkey, 'error' AS severity, unnest(
            CASE WHEN c_nationkey < 8 THEN ['user'] || CASE WHEN c_acctbal > 0 THEN [] ELSE ['database'] END
                 WHEN c_nationkey < 16 AND c_nationkey <> 9 THEN ['topics'] ELSE [] END) AS field FROM customer
        UNION ALL
        SELECT c_custkey, 'warning', CASE WHEN c_nationkey < 16 THEN 'colour' ELSE 'settings' END FROM customer
        WHERE (c_nationkey < 16) = (c_mktsegment = 'BUILDING'))
""")
def a31(spark: SparkSession, sf: str) -> DataFrame:
    found = audit.audit_capabilities(stages(spark, sf), catalog.load_capabilities(spark), True, "c_custkey")
    return found.select("c_custkey", "severity", "field")


@query("a36_carry_over", f"""
    SELECT record_id, 4 + (connection_url IS NOT NULL)::INT + (mode IS NOT NULL)::INT
           + (validate_non_null IS NOT NULL)::INT + (database_user IS NOT NULL)::INT AS n,
           'raw' AS extra, database_hostname AS hostname
    FROM ({DEFS_SQL})
""")
def a36(spark: SparkSession, sf: str) -> DataFrame:
    plain = settings.carry_over(heads(spark, sf), "rest").withColumn("raw", F.create_map(
        F.lit("extra"), F.lit("raw"), F.lit("database.hostname"), F.lit("ignored")))
    filled = settings.carry_over(plain, "carried", "raw", out="filled")
    return filled.select("record_id", F.size("carried").alias("n"), F.col("filled")["extra"].alias("extra"),
                         F.col("filled")["database.hostname"].alias("hostname"))


@query("a37_remap_keys", f"""
    SELECT * FROM (SELECT record_id, unnest(keys) AS key, unnest(vals) AS value FROM (
        SELECT record_id,
               CASE WHEN class LIKE '%debezium%' THEN ['host', 'port', 'user', 'cdc.enabled', '!user', '!database']
                    WHEN class LIKE '%JdbcSource%'
                    THEN ['host', 'port', 'database', 'password', 'cdc.mode', 'snapshot.mode', '!host', '!database']
                    WHEN lower(class) LIKE '%jdbc%'
                    THEN ['host', 'port', 'database', 'password', 'table', 'sdk.record.operation', '!host', '!database']
                    WHEN class LIKE '%mongo%' THEN ['!uri', 'snapshot'] ELSE [] END AS keys,
               CASE WHEN class LIKE '%debezium%'
                    THEN [database_hostname, '3306', database_user, 'true', CASE WHEN database_user IS NULL THEN 'unmet' END, 'unmet']
                    WHEN lower(class) LIKE '%jdbc%'
                    THEN [CASE WHEN connection_url IS NOT NULL THEN 'db' END, CASE WHEN connection_url IS NOT NULL THEN '5432' END,
                          regexp_extract(connection_url, '/([^/]+)$', 1),
                          CASE WHEN connection_password LIKE '${{%' THEN connection_password ELSE '${{MASKED_PASSWORD}}' END]
                         || CASE WHEN class LIKE '%JdbcSource%' THEN ['snapshot', CASE WHEN mode = 'bulk' THEN 'initial_only' END]
                                 ELSE [topic1, 'upsert'] END
                         || CASE WHEN connection_url IS NULL THEN ['unmet', 'unmet'] ELSE [NULL, NULL] END
                    WHEN class LIKE '%mongo%' THEN ['unmet', CASE WHEN topic2 = 'status-P' THEN 'true' END] ELSE [] END AS vals
        FROM ({DEFS_SQL}))) WHERE value IS NOT NULL
""")
def a37(spark: SparkSession, sf: str) -> DataFrame:
    records = heads(spark, sf).withColumn("kind", remap.rule_kind(F.col("class")))
    done = remap.remap_settings(records)
    unmet = F.col("value").isNull()
    return done.select("record_id", F.when(unmet, F.concat(F.lit("!"), "target")).otherwise(F.col("target")).alias("key"),
                       F.when(unmet, "unmet").otherwise(F.col("value")).alias("value"))


# Values that rules tell apart; any other setting holds its own name and the record's number.
_VALUES = {
    "connection.url": ["jdbc:postgresql://h:5432/d?sslmode=require&ssl=no", "jdbc:mysql://u:p@h2/d2", "jdbc:sqlserver://h3:1433;databaseName=d3;ssl=yes"],
    "mode": ["incrementing", "timestamp", "timestamp+incrementing", "bulk", "other"], "insert.mode": ["insert", "upsert", "update", "else"],
    "snapshot.mode": ["initial", "never", "initial_only", "when_needed", "always", "schema_only"], "database.ssl.mode": ["disabled", "required"],
    "format.class": ["io.x.JsonFormat", "io.x.AvroFormat", "io.x.ParquetFormat", "io.x.Other"],
    "partitioner.class": ["io.x.TimeBasedPartitioner", "io.x.FieldPartitioner", "io.x.DefaultPartitioner"],
    "key.serializer": ["x.ByteArraySerializer", "x.StringSerializer"], "value.serializer": ["x.KafkaJsonSerializer", "x.KafkaAvroSerializer", "x.Odd"],
    "key.deserializer": ["x.ByteArrayDeserializer", "x.StringDeserializer"], "value.deserializer": ["x.JsonDeserializer", "x.AvroDeserializer"],
    "security.protocol": ["PLAINTEXT", "SSL", "SASL_PLAINTEXT", "SASL_SSL"], "auth.type": ["BASIC", "OAUTH2", "BEARER", "NONE"],
    "auth.user.info": ["me:se:cret", "nocolon"], "auth.bearer.token": ["t0", "${env:T}"], "topics": ["t1, t2", "t3"],
    "document.id.strategy": ["x.BsonOidStrategy", "x.UuidStrategy", "x.ProvidedInKeyStrategy", "x.PartialValueStrategy", "x.Odd"],
    "writemodel.strategy": ["x.ReplaceOneBusinessKeyStrategy", "x.DeleteOneDefaultStrategy", "x.UpdateOneTimestampsStrategy", "x.Odd"],
}
_FLAGS = ("tail", "copy.existing", "mongodb.upsert", "key.ignore", "cassandra.ssl.enabled", "redis.ssl.enabled", "autoCreateTables", "ssl",
          "splunk.hec.ack.enabled", "auto.create", "auto.evolve", "database.encrypt", "database.trustServerCertificate")
_VALUES |= {flag: ["true", "false"] for flag in _FLAGS}
# The parts of the addresses above, for the SQL side.
_URL_PARTS = [(0, "host", "h"), (0, "port", "5432"), (0, "database", "d"), (0, "sslmode", "require"), (0, "ssl", "no"),
              (1, "host", "h2"), (1, "database", "d2"), (1, "user", "u"), (1, "password", "p"),
              (2, "host", "h3"), (2, "port", "1433"), (2, "database", "d3"), (2, "ssl", "yes")]
_ROWS = remap.rule_rows([(g, n, [p + n], {}) for g, p, names in setting_rules.KEPT_NAMES for n in names] + setting_rules.RULES, setting_rules.KINDS)
_KINDS = list(dict.fromkeys(k for k, _, _ in setting_rules.KINDS))


def _universe(kind: str) -> list[str]:
    """All settings that the rules of a kind look at."""
    own = [r for r in _ROWS if r[0] == kind]
    keys = {r[3] for r in own if r[3]} | {c[0] for r in own for c in r[10]}
    keys |= {"connection.url"} if any(k.startswith("url.") for k in keys) else set()
    keys |= {"mongodb.hosts", "mongodb.user", "mongodb.password", "mongodb.authsource"} if "mongodb.uri" in keys else set()
    keys |= {"headers.X-One", "headers.a.b"} if "headers.*" in keys else set()
    return sorted(k for k in keys if not k.startswith("url.") and k not in ("mongodb.uri", "headers.*"))


_KEYS = [(kind, j, key) for kind in _KINDS for j, key in enumerate(_universe(kind))]


def connectors(spark: SparkSession, sf: str) -> DataFrame:
    """``customer`` as connectors of all kinds, each with about three quarters of the settings its rules know."""
    number = F.col("c_custkey")
    kind = F.get(F.array(*[F.lit(k) for k in _KINDS]), (number % len(_KINDS)).cast("int"))

    def settings_of(kind_: str) -> Column:
        rows = []
        for j, key in enumerate(_universe(kind_)):
            values = _VALUES.get(key)
            value = (F.get(F.array(*[F.lit(v) for v in values]), ((number + j) % len(values)).cast("int")) if values
                     else F.concat(F.lit(f"{key}-"), number.cast("string")))
            rows.append(F.struct(F.lit(key).alias("key"), F.when((number * 7 + F.col("c_nationkey") + j * 13) % 4 != 0, value).alias("value")))
        return F.array(*rows)

    pairs = F.coalesce(*[F.when(F.col("kind") == k, settings_of(k)) for k in _KINDS])
    present = F.map_from_entries(F.filter(pairs, lambda e: e["value"].isNotNull()))
    return table(spark, sf, "customer").withColumn("kind", kind).select(
        number.alias("record_id"), "kind", F.inline(F.array(F.struct(present.alias("settings")))))


def _sql(value: object) -> str:
    if value is None:
        return "NULL"
    return str(value).lower() if isinstance(value, bool) else str(value) if isinstance(value, int) else "'" + value.replace("'", "''") + "'"


def _values(rows: list[tuple]) -> str:
    return "(VALUES " + ", ".join("(" + ", ".join(map(_sql, r)) + ")" for r in rows) + ")"


_CONNECTORS_SQL = f"""
    records AS (SELECT c_custkey AS record_id, c_nationkey AS nation,
                       [{", ".join(map(_sql, _KINDS))}][(c_custkey % {len(_KINDS)} + 1)::INT] AS kind FROM customer),
    plain AS (
        SELECT record_id, r.kind, key, CASE WHEN n IS NULL THEN key || '-' || record_id ELSE vals[(record_id + j) % n + 1] END AS value,
               CASE WHEN n IS NOT NULL THEN (record_id + j) % n END AS variant
        FROM records r JOIN {_values(_KEYS)} k(kind, j, key) ON k.kind = r.kind
        LEFT JOIN (SELECT key AS vkey, list(value ORDER BY nth) AS vals, count(*) AS n
                   FROM {_values([(k, i, v) for k, vs in _VALUES.items() for i, v in enumerate(vs)])} v(key, nth, value) GROUP BY key) ON vkey = key
        WHERE (record_id * 7 + nation + j * 13) % 4 <> 0),
    entries AS (
        SELECT record_id, kind, key, value FROM plain
        UNION ALL SELECT record_id, kind, 'url.' || part, v FROM plain JOIN {_values(_URL_PARTS)} u(nth, part, v) ON key = 'connection.url' AND nth = variant
        UNION ALL SELECT record_id, kind, 'mongodb.uri', 'mongodb://' || CASE WHEN u IS NOT NULL AND p IS NOT NULL THEN u || ':' || p || '@' ELSE '' END
                         || h || CASE WHEN a IS NOT NULL THEN '/?authSource=' || a ELSE '' END
        FROM (SELECT record_id, kind, max(value) FILTER (key = 'mongodb.hosts') AS h, max(value) FILTER (key = 'mongodb.user') AS u,
                     max(value) FILTER (key = 'mongodb.password') AS p, max(value) FILTER (key = 'mongodb.authsource') AS a
              FROM plain WHERE kind = 'debezium-mongo' GROUP BY ALL) WHERE h IS NOT NULL),
    rules AS (SELECT row_number() OVER () AS rule, * FROM {_values([r[:10] for r in _ROWS])}
              r(kind, precedence, target, source, default_value, required, secret, value_map, form, part)),
    conditions AS (SELECT rules.rule, c.* EXCLUDE (kind, precedence)
                   FROM rules JOIN {_values([(r[0], r[1], *c) for r in _ROWS for c in r[10]])} c(kind, precedence, key, test, wanted)
                   ON c.kind = rules.kind AND c.precedence = rules.precedence),
    failed AS (
        SELECT DISTINCT r.record_id, c.rule FROM records r JOIN rules ON rules.kind = r.kind JOIN conditions c ON c.rule = rules.rule
        LEFT JOIN entries e ON e.record_id = r.record_id AND e.key = c.key
        WHERE NOT CASE test WHEN '!' THEN value IS NULL WHEN '*' THEN value IS NOT NULL WHEN '=' THEN coalesce(value = wanted, false)
                            ELSE coalesce(contains(value, wanted), false) END),
    taken AS (
        SELECT e.record_id, r.kind, r.rule, r.precedence, r.required, r.form, r.secret, e.key AS source, r.value_map,
               CASE WHEN r.source LIKE '%*' THEN replace(target, '*', substr(key, len(r.source))) ELSE target END AS target,
               CASE part WHEN 'first' THEN trim(split_part(value, ',', 1)) WHEN 'before' THEN CASE WHEN contains(value, ':') THEN split_part(value, ':', 1) END
                         WHEN 'after' THEN CASE WHEN contains(value, ':') THEN substr(value, strpos(value, ':') + 1) END ELSE value END AS value
        FROM entries e JOIN rules r ON r.kind = e.kind AND (r.source = e.key OR (r.source LIKE '%*' AND starts_with(e.key, rtrim(r.source, '*'))))),
    translated AS (
        SELECT * EXCLUDE (value), CASE WHEN fit IS NULL THEN value ELSE result END AS value
        FROM (SELECT t.*, m.place AS fit, m.result,
                     row_number() OVER (PARTITION BY record_id, rule, source ORDER BY m.place) AS first
              FROM taken t LEFT JOIN {_values([(n, i, p[0], p[1:], r) for i, (n, p, r) in enumerate(setting_rules.VALUE_MAPS)])}
                   m(value_map, place, test, pattern, result)
              ON m.value_map = t.value_map AND CASE test WHEN '=' THEN value = pattern ELSE contains(lower(value), lower(pattern)) END)
        WHERE first = 1),
    offered AS (
        SELECT record_id, kind, rule, target, precedence, source, required,
               replace(form, '{{}}', CASE WHEN secret IS NULL OR (value LIKE '${{%' AND value LIKE '%}}') THEN value
                                          ELSE '${{MASKED_' || upper(secret) || '}}' END) AS value
        FROM translated WHERE value IS NOT NULL
        UNION ALL
        SELECT record_id, r.kind, rule, target, precedence,
               (SELECT arg_min(f.source, f.precedence) FROM rules f WHERE f.kind = r.kind AND f.target = rules.target AND f.source IS NOT NULL),
               required, default_value
        FROM records r JOIN rules ON rules.kind = r.kind AND rules.source IS NULL AND (default_value IS NOT NULL OR required)),
    best AS (
        SELECT record_id, kind, target, arg_min(struct_pack(value := value, source := source, precedence := precedence),
                   precedence + CASE WHEN value IS NULL THEN 4000000000 ELSE 0 END) AS b, bool_or(required) AS required
        FROM offered o WHERE NOT EXISTS (SELECT 1 FROM failed f WHERE f.record_id = o.record_id AND f.rule = o.rule) GROUP BY ALL)
"""


@query("a37_remap_kinds", f"""
    WITH {_CONNECTORS_SQL}
    SELECT record_id, kind, target, b.value AS value, required,
           CASE WHEN b.value IS NULL OR b.precedence < {remap.LAST} THEN b.source END AS source
    FROM best WHERE b.value IS NOT NULL OR required
""")
def a37_kinds(spark: SparkSession, sf: str) -> DataFrame:
    """Every kind of connector, with all that its rules translate, default, mask, leave out or miss."""
    return remap.remap_settings(connectors(spark, sf)).select("record_id", "kind", "target", "value", "required", "source")


@query("a37_unmet_settings", f"""
    WITH {_CONNECTORS_SQL}
    SELECT kind, b.source AS field, count(*) AS n FROM best WHERE required AND b.value IS NULL GROUP BY ALL
""")
def a37_unmet(spark: SparkSession, sf: str) -> DataFrame:
    records = connectors(spark, sf)
    issues = remap.unmet_issues(remap.remap_settings(records))
    return issues.join(records.select("record_id", "kind"), "record_id").groupBy("kind", "field").agg(F.count(F.lit(1)).alias("n"))


@query("a38_parse_connection_url", """
    SELECT page_id, regexp_extract(url, '^([^/]+)://', 1) AS protocol,
           regexp_extract(url, '^[^/]+://([^/:?#]*)', 1) AS host,
           nullif(regexp_extract(url, '^[^/]+://[^/]*/([^?#]*)', 1), '') AS database,
           nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page, NULL::VARCHAR AS error
    FROM pages
""")
def a38(spark: SparkSession, sf: str) -> DataFrame:
    parsed = text.connection_url(F.concat(F.lit("jdbc:"), "url"))
    found = table(spark, sf, "pages").select("page_id", parsed.alias("r"))
    return found.select("page_id", "r.parts.protocol", "r.parts.host", "r.parts.database",
                        F.col("r.parts.params")["page"].alias("page"), "r.error")


@query("a38_semicolon_urls", """
    SELECT s_suppkey, 'sqlserver' AS family, s_name AS host, '1433' AS port, 'd' || s_nationkey AS database, 'yes' AS encrypt
    FROM supplier
""")
def a38_semicolons(spark: SparkSession, sf: str) -> DataFrame:
    url = F.concat(F.lit("jdbc:sqlserver://"), "s_name", F.lit(":1433;databaseName=d"),
                   F.col("s_nationkey").cast("string"), F.lit(";encrypt=yes"))
    found = table(spark, sf, "supplier").select("s_suppkey", text.connection_url(url).alias("r"))
    return found.select("s_suppkey", "r.parts.family", "r.parts.host", "r.parts.port", "r.parts.database",
                        F.col("r.parts.params")["encrypt"].alias("encrypt"))
