"""Document fixtures: JSON and properties definitions, worker documents, precedence rules."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import audit, catalog, settings
from millrace.sources import documents

CDC = {
    "name": "mysql-cdc-orders", "connector.class": "io.debezium.connector.mysql.MySqlConnector", "tasks.max": 1,
    "database.hostname": "mysql-server", "database.port": 3306, "database.user": "debezium",
    "database.password": "secret123", "database.server.id": 184054, "database.server.name": "mysql-prod",
    "table.include.list": "inventory.orders,inventory.customers", "transforms": "unwrap",
    "transforms.unwrap.type": "io.debezium.transforms.ExtractNewRecordState",
}
JDBC = """name=postgres-users-source
connector.class=io.confluent.connect.jdbc.JdbcSourceConnector
tasks.max=2
connection.url=jdbc:postgresql://postgres:5432/userdb
connection.password=secret123
mode=incrementing
incrementing.column.name=id
poll.interval.ms=5000
"""
SINK = {
    "name": "elasticsearch-orders-sink", "tasks.max": 2, "key.ignore": False,
    "connector.class": "io.confluent.connect.elasticsearch.ElasticsearchSinkConnector",
    "topics": "mysql-prod.inventory.orders, postgres-users", "connection.url": "http://elasticsearch:9200",
    "transforms": "routeRecords", "transforms.routeRecords.type": "org.apache.kafka.connect.transforms.RegexRouter",
    "transforms.routeRecords.regex": "(.*)\\.(.*)", "transforms.routeRecords.replacement": "$2",
}
STORE = """name=s3-backup
connector.class=io.confluent.connect.s3.S3SinkConnector
topics.regex=mysql-prod.*
transforms=flatten
transforms.flatten.type=org.apache.kafka.connect.transforms.Flatten$Value
transforms.flatten.delimiter=_
"""
DOCUMENT_STORE = {
    "name": "mongo", "connector.class": "com.mongodb.kafka.connect.MongoSourceConnector", "copy.existing": True,
    "connection.uri": "mongodb://u:p@h:27017",
}
WORKER = """bootstrap.servers=localhost:9092
group.id=connect-cluster
schema.registry.url=http://localhost:8081
security.protocol=SSL
consumer.max.poll.records=500
producer.batch.size=16384
plugin.path=/usr/share/java, /opt/plugins
"""


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("configs")
    (root / "deep").mkdir()
    (root / "cdc.json").write_text(json.dumps(CDC, indent=1))
    (root / "deep" / "jdbc.PROPERTIES").write_text(JDBC)
    (root / "deep" / "sink.json").write_text(json.dumps(SINK))
    (root / "s3.properties").write_text(STORE)
    (root / "mongo.json").write_text(json.dumps(DOCUMENT_STORE))
    (root / "connect-worker.properties").write_text(WORKER)
    (root / "broken.json").write_text('{"name": ')
    (root / "notes.txt").write_text("name=ignored")
    return str(root)


@pytest.fixture(scope="module")
def parsed(spark, folder):
    good, dead = documents.parse_documents(documents.scan_documents(spark, folder))
    return good.cache(), dead.cache()


@pytest.fixture(scope="module")
def matched(spark, parsed):
    records = parsed[0].where("not worker")
    return catalog.default_unmatched(catalog.match_catalog(documents.record_heads(records), catalog.load_catalog(spark)))


def by_name(df, *columns):
    return {r["name"]: tuple(r[c] for c in columns) for r in df.collect()}


def test_scan_and_dead_letters(parsed):
    good, dead = parsed
    assert good.count() == 6 and good.where("worker").count() == 1
    assert [r["error"] for r in dead.collect()] == ["document is not a JSON object"]


def test_heads(matched):
    heads = by_name(matched, "tasks_max", "topics", "topics_regex")
    assert heads["mysql-cdc-orders"] == (1, [], "")
    assert heads["postgres-users-source"][0] == 2
    assert heads["elasticsearch-orders-sink"] == (2, ["mysql-prod.inventory.orders", "postgres-users"], "")
    assert heads["s3-backup"] == (0, [], "mysql-prod.*")
    rest = by_name(matched, "rest")["mysql-cdc-orders"][0]
    assert rest["database.port"] == "3306" and not [k for k in rest if k.startswith(("transforms", "name", "tasks"))]


def test_steps_and_their_status(spark, matched):
    steps = catalog.classify_steps(documents.explode_steps(matched), catalog.load_step_catalog(spark))
    got = {r["step"]: (r["status"], r["step_settings"]) for r in steps.collect()}
    assert got["flatten"] == ("supported", {"delimiter": "_"})  # the $Value suffix is ignored
    assert got["routeRecords"][1] == {"regex": "(.*)\\.(.*)", "replacement": "$2"}


def test_status_and_issues(spark, matched):
    assert by_name(matched, "status", "effort")["mongo"] == ("partial", "1-2 hours")
    found = audit.with_issues(matched, catalog.load_step_catalog(spark))
    issues = {(r["severity"], r["field"]) for r in audit.record_issues(found).collect()}
    # A JSON true counts as the text true; the object-store record lacks its bucket.
    assert issues == {("warning", "copy.existing"), ("error", "s3.bucket.name")}


def test_a_long_step_catalog_with_repeated_classes(spark, matched):
    own = catalog.load_step_catalog(spark)
    many = own.unionByName(spark.range(5000).select(
        F.concat(F.lit("com.example.Step"), "id").alias("class"), F.lit("x").alias("equivalent"), F.lit("partial").alias("status")))
    short, long = (by_name(audit.with_issues(matched, c), "steps", "issues") for c in (own, many.unionByName(own)))
    assert short == long
    assert all([s["pos"] for s in steps] == sorted(s["pos"] for s in steps) for steps, _ in long.values())
    worse = own.select("class", "equivalent", F.lit("manual").alias("status"))
    found = by_name(audit.with_issues(matched, own.unionByName(worse)), "steps")
    assert {s["status"] for (steps,) in found.values() for s in steps} == {"manual"}  # the least supported counts


def test_worker(parsed):
    row = documents.worker_heads(documents.first_worker(parsed[0].where("worker"))).first()
    assert (row["brokers"], row["registry_url"], row["security_protocol"]) == ("localhost:9092", "http://localhost:8081", "SSL")
    assert row["consumer_settings"] == {"max.poll.records": "500"}
    assert row["producer_settings"] == {"batch.size": "16384"}
    assert row["plugin_path"] == ["/usr/share/java", "/opt/plugins"]


def parse(spark, text, fmt="properties"):
    docs = spark.createDataFrame([("r", fmt, text)], "record_id string, format string, text string")
    return documents.parse_documents(docs)[0]


@pytest.mark.parametrize("text,expected", [
    ("a=1\na=2", {"a": "2"}),
    ("a = 'x y' \nb=\"q\"\nc='q\"\nd='", {"a": "x y", "b": "q", "c": "'q\"", "d": "'"}),
    ("# c \\\na=1\n  ! n\nb=2", {"a": "1", "b": "2"}),
    ("a=1,\\\n  2,\\\n#3\nb=x", {"a": "1,2,#3", "b": "x"}),
    ("a=b=c\n=x\nplain\n\n", {"a": "b=c"}),
    ("a=1\r\nb=\r\n", {"a": "1", "b": ""}),
    ("", {}),
])
def test_properties(spark, text, expected):
    assert parse(spark, text).first()["settings"] == expected


def test_json_repeats_nesting_and_wrapping(spark):
    assert parse(spark, '{"a":1,"a":"2","n":{"x":[1]}}', "json").first()["settings"] == {"a": "2", "n": '{"x":[1]}'}
    wrapped = parse(spark, '{"name":"out","config":{"connector.class":"C","k":true}}', "json")
    assert wrapped.first()["settings"] == {"name": "out", "connector.class": "C", "k": "true"}
    own = parse(spark, '{"class":"C","config":{"k":1}}', "json").first()["settings"]
    assert own == {"class": "C", "config": '{"k":1}'}
    for text in ("[1]", '"x"', "{", "null"):
        assert parse(spark, text, "json").count() == 0


def test_steps_from_a_list_with_blanks_and_nested_keys(spark):
    text = ('{"transforms":["a"," b ",""],"transforms.a.type":"T","transforms.a.target.type":"int",'
            '"transforms.b.negate":"T","transforms.b.predicate":"p","transforms.ab.type":"no"}')
    got = documents.explode_steps(parse(spark, text, "json")).orderBy("pos").collect()
    assert [(r["step"], r["class"], r["predicate"], r["negate"], r["step_settings"]) for r in got] == [
        ("a", "T", None, False, {"target.type": "int"}), ("b", "", "p", True, {})]


def test_registry_precedence(spark):
    rows = [({"schema.registry.url": "http://localhost:8081", "schema.registry.basic.auth.user.info": "user:pass"},
             {"key.converter.schema.registry.url": "http://backup:8081"}),
            ({"value.converter.schema.registry.url": "http://v", "x.schema.registry.y": "w"},
             {"x.schema.registry.y": "r", "schema.registry.url": "kept"}),
            (None, {"value.converter.schema.registry.url": "http://own"})]
    df = spark.createDataFrame(rows, "worker_settings map<string,string>, settings map<string,string>")
    got = [(r["registry_url"], r["registry_settings"]) for r in settings.resolve_registry(df).collect()]
    assert got[0] == ("http://localhost:8081", {"schema.registry.basic.auth.user.info": "user:pass"})
    assert got[1] == ("http://v", {"value.converter.schema.registry.url": "http://v", "x.schema.registry.y": "r",
                                   "schema.registry.url": "kept"})
    assert got[2] == ("http://own", {})
    changed = settings.apply_globals(df).collect()
    assert changed[0]["settings"]["schema.registry.url"] == "http://localhost:8081"
    assert changed[1]["settings"]["schema.registry.url"] == "kept"


def brute_properties(text):
    lines = [line.removesuffix("\r") for line in text.split("\n")]
    if lines and lines[-1] == "":
        lines.pop()
    out, at = {}, 0
    while at < len(lines):
        line, at = lines[at].strip(), at + 1
        if not line or line[0] in "#!":
            continue
        while line.endswith("\\") and at < len(lines):
            line, at = line[:-1] + lines[at].strip(), at + 1
        key, mark, value = line.partition("=")
        if mark and key:
            value = value.strip()
            if len(value) >= 2 and value[0] == value[-1] and value[0] in "\"'":
                value = value[1:-1]
            out[key.strip()] = value
    return out


def test_properties_against_brute_force(spark):
    picked = random.Random(11)
    starts = ["a=", " b = ", "# c", "!d", "", "plain ", "a='q'", 'b="r" ', "=x", "c=d=e", "\t", "#e=f "]
    ends = ["", "\\", "\r", " \\ ", "tail", "'"]
    texts = ["\n".join(picked.choice(starts) + picked.choice(ends) for _ in range(picked.randrange(1, 9)))
             + picked.choice(["", "\n"]) for _ in range(500)]
    docs = spark.createDataFrame([(str(i), "properties", t) for i, t in enumerate(texts)],
                                 "record_id string, format string, text string")
    got = {int(r["record_id"]): r["settings"] for r in documents.parse_documents(docs)[0].collect()}
    wrong = [(t, got.get(i), brute_properties(t)) for i, t in enumerate(texts) if got.get(i) != brute_properties(t)]
    assert wrong == []
