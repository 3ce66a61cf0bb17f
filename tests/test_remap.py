"""Setting rules by hand-written expectations, one row set per kind."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from millrace.functions import setting_rules
from millrace.operators import remap

CASES = {
    "io.debezium.connector.mysql.MySqlConnector": (
        {"database.hostname": "h", "database.user": "u", "database.dbname": "d", "database.password": "p", "table.whitelist": "w",
         "table.include.list": "i", "snapshot.mode": "schema_only", "database.ssl.mode": "disabled", "database.server.id": "7"},
        {"host": "h", "user": "u", "database": "d", "password": "${MASKED_PASSWORD}", "port": "3306", "tables": "i", "snapshot.mode": "initial",
         "cdc.enabled": "true", "server.id": "7"}, []),
    "io.debezium.connector.postgresql.PostgresConnector": (
        {"database.hostname": "h", "database.port": "1", "slot.name": "s", "snapshot.mode": "never"},
        {"host": "h", "port": "1", "sslmode": "prefer", "cdc.mode": "logrepl", "replication.slot.name": "s", "snapshot.mode": "never"},
        ["database", "user"]),
    "io.debezium.connector.sqlserver.SqlServerConnector": (
        {"database.hostname": "h", "database.user": "u", "database.dbname": "d", "database.encrypt": "true", "database.names": "a,b"},
        {"host": "h", "user": "u", "database": "d", "port": "1433", "cdc.enabled": "true", "encrypt": "true", "trustServerCertificate": "false",
         "databases": "a,b"}, []),
    "io.debezium.connector.mongodb.MongoDbConnector": (
        {"mongodb.hosts": "a:1", "mongodb.user": "u", "mongodb.password": "p", "mongodb.authsource": "admin"},
        {"uri": "mongodb://u:p@a:1/?authSource=admin", "cdc.enabled": "true"}, []),
    "io.confluent.connect.jdbc.JdbcSourceConnector": (
        {"connection.url": "jdbc:postgresql://h/d?user=q", "connection.user": "u", "connection.password": "${file:x}", "mode": "timestamp+incrementing",
         "incrementing.column.name": "i", "timestamp.column.name": "t", "table.whitelist": "w", "table.blacklist": "b", "poll.interval.ms": "5"},
        {"host": "h", "database": "d", "user": "q", "password": "${file:x}", "cdc.mode": "timestamp_incrementing", "incrementing.column": "i",
         "timestamp.column": "t", "tables": "w", "poll.interval": "5ms"}, []),
    "jdbc.JdbcSinkConnector": (
        {"topics": " a , b", "insert.mode": "insert", "pk.fields": "k", "auto.create": "true", "auto.evolve": "false"},
        {"table": "a", "sdk.record.operation": "create", "table.auto.create": "true"}, ["database", "host"]),
    "io.confluent.connect.s3.S3SinkConnector": (
        {"s3.bucket.name": "b", "format.class": "io.x.AvroFormat", "partitioner.class": "x.TimeBasedPartitioner", "path.format": "YYYY",
         "partition.field.name": "f", "aws.secret.access.key": "s", "rotate.interval.ms": "9"},
        {"aws.bucket": "b", "aws.region": "us-east-1", "format": "avro", "partition.format": "time", "path.format": "YYYY",
         "aws.secretAccessKey": "${MASKED_AWS.SECRETACCESSKEY}", "rotate.interval": "9ms"}, []),
    "io.confluent.connect.gcs.GcsSinkConnector": (
        {"gcs.credentials.path": "/c", "gcs.credentials.json": "{}"}, {"credentials.path": "/c", "format": "json"}, ["bucket"]),
    "io.confluent.connect.azure.blob.AzureBlobSinkConnector": (
        {"azblob.container.name": "c", "azblob.sas.token": "t", "topics.dir": "d"},
        {"container": "c", "sas.token": "${MASKED_SAS.TOKEN}", "path.prefix": "d"}, ["account"]),
    "org.apache.kafka.connect.file.FileStreamSourceConnector": ({"file": "/f", "tail": "true", "compression": "gz"}, {"path": "/f", "tail": "true"}, []),
    "org.apache.kafka.connect.file.FileStreamSinkConnector": ({"tail": "true", "compression": "gz"}, {"compression": "gz"}, ["path"]),
    "com.mongodb.kafka.connect.MongoSourceConnector": (
        {"mongodb.connection.string": "m", "copy.existing": "true", "database": "d"}, {"uri": "m", "snapshot": "true", "database": "d"}, []),
    "com.mongodb.kafka.connect.MongoSinkConnector": (
        {"connection.uri": "c", "mongodb.connection.string": "m", "writemodel.strategy": "x.UpdateOneTimestampsStrategy", "document.id.strategy": "odd"},
        {"uri": "c", "write.model": "update_one_timestamps", "document.id.strategy": "bson_oid"}, []),
    "io.confluent.connect.elasticsearch.ElasticsearchSinkConnector": (
        {"elasticsearch.hosts": "e", "elasticsearch.username": "u", "connection.password": "p", "topics": "t1,t2", "key.ignore": "false"},
        {"urls": "e", "username": "u", "password": "${MASKED_PASSWORD}", "index": "t1", "use.document.id": "true"}, []),
    "com.datastax.oss.kafka.sink.CassandraSinkConnector": (
        {"contact.points": "c", "keyspace": "k", "cassandra.password": "p", "cassandra.ssl.cert.path": "x", "table": "t"},
        {"contact.points": "c", "keyspace": "k", "port": "9042", "table": "t"}, []),
    "com.x.DynamoDbSinkConnector": ({"table.name": "t", "dynamodb.read.capacity.units": "5"}, {"table": "t", "read.capacity": "5"}, ["aws.region"]),
    "com.github.jcustenborder.kafka.connect.redis.RedisSinkConnector": (
        {"redis.host": "r", "redis.ssl.enabled": "true", "redis.ssl.cert.path": "x", "redis.ttl": "60"},
        {"host": "r", "port": "6379", "tls.enabled": "true", "tls.cert.path": "x", "ttl": "60"}, []),
    "com.wepay.kafka.connect.bigquery.BigQuerySinkConnector": (
        {"project": "p", "defaultDataset": "d", "credentials": "c", "topics": "t", "table": "own", "clusteredFields": "a,b"},
        {"project.id": "p", "dataset": "d", "credentials.json": "${MASKED_CREDENTIALS.JSON}", "table": "own", "clustered.fields": "a,b"}, []),
    "com.snowflake.kafka.connector.SnowflakeSinkConnector": (
        {"snowflake.account": "a", "snowflake.private.key.passphrase": "x"}, {"account": "a"}, ["database", "password", "schema", "user"]),
    "io.confluent.connect.aws.redshift.RedshiftSinkConnector": (
        {"connection.url": "jdbc:redshift://h/d", "connection.user": "u", "s3.bucket.name": "b"},
        {"host": "h", "database": "d", "user": "u", "port": "5439", "s3.bucket": "b"}, []),
    "com.clickhouse.kafka.connect.ClickHouseSinkConnector": (
        {"hostname": "h", "database": "d", "password": "p", "ssl": "false", "sslmode": "strict"}, {"host": "h", "database": "d", "port": "8123"}, []),
    "com.splunk.kafka.connect.SplunkSinkConnector": (
        {"splunk.hec.uri": "s", "splunk.hec.token": "t", "splunk.indexes": "i", "splunk.hec.ack.enabled": "false"},
        {"url": "s", "method": "POST", "headers.Authorization": "Splunk ${MASKED_HEC.TOKEN}", "body.template.event": "{{.Payload}}",
         "body.template.index": "i", "tls.skip.verify": "true"}, []),
    "io.confluent.connect.http.HttpSinkConnector": (
        {"url": "u", "headers.X.Y": "1", "headers.Authorization": "own", "auth.type": "BASIC", "auth.user.info": "me:a:b", "oauth2.client.id": "c"},
        {"url": "u", "method": "POST", "headers.X.Y": "1", "headers.Authorization": "own", "auth.username": "me",
         "auth.password": "${MASKED_AUTH.PASSWORD}"}, []),
    "org.apache.kafka.connect.mirror.MirrorSourceConnector": (
        {"source.cluster.bootstrap.servers": "b", "topics.regex": "t.*", "security.protocol": "SASL_SSL", "sasl.mechanism": "PLAIN",
         "ssl.truststore.password": "p", "key.deserializer": "x.KafkaAvroDeserializer"},
        {"brokers": "b", "topic.regex": "t.*", "security.protocol": "SASL_SSL", "sasl.mechanism": "PLAIN",
         "ssl.truststore.password": "${MASKED_SSL.TRUSTSTORE.PASSWORD}", "key.deserializer": "avro"}, []),
    "com.x.KafkaSinkConnector": (
        {"bootstrap.servers": "b", "producer.acks": "all", "security.protocol": "PLAINTEXT", "sasl.mechanism": "PLAIN", "value.serializer": "odd"},
        {"brokers": "b", "producer.acks": "all", "security.protocol": "PLAINTEXT", "value.serializer": "bytes"}, []),
    "com.example.Unknown": ({"a": "b"}, None, None),
}


@pytest.fixture(scope="module")
def outcome(spark):
    rows = [(name, given) for name, (given, _, _) in CASES.items()]
    df = spark.createDataFrame(rows, "record_id string, settings map<string,string>").withColumn("kind", remap.rule_kind(F.col("record_id")))
    return {r.record_id: (r.remapped, r.unmet) for r in remap.remapped_records(remap.remap_settings(df)).collect()}


@pytest.mark.parametrize("name", CASES)
def test_kind(outcome, name):
    _, remapped, unmet = CASES[name]
    assert outcome.get(name) == (None if remapped is None else (remapped, unmet))


def test_every_kind_is_covered(spark):
    found = spark.createDataFrame([(n,) for n in CASES], "c string").select(remap.rule_kind(F.col("c")).alias("k")).distinct().collect()
    assert {r.k for r in found} - {None} == {k for k, _, _ in setting_rules.KINDS}
    assert {s for _, _, sets in setting_rules.KINDS for s in sets} >= {r[0] for r in setting_rules.RULES} | {k[0] for k in setting_rules.KEPT_NAMES}
    assert {r[3]["values"] for r in setting_rules.RULES if "values" in r[3]} == {m[0] for m in setting_rules.VALUE_MAPS}


RULES = [("a", "t", ["one", "two"], {"default": "d", "values": "m"}), ("a", "t", ["three"], {"form": "<{}>"}), ("a", "u", ["four"], {"required": True})]


@pytest.mark.parametrize("given, value, source", [
    ({"one": "1", "two": "2", "three": "3"}, "1", "one"), ({"two": "2", "three": "3"}, "2", "two"), ({"three": "3", "one": ""}, "<3>", "three"),
    ({"one": "gone", "two": "x"}, "x", "two"), ({"one": "gone"}, "d", None), ({"one": "old"}, "new", "one"), ({}, "d", None)])
def test_precedence_and_value_maps(spark, given, value, source):
    rules = spark.createDataFrame(remap.rule_rows(RULES, [("k", [], ["a"])]), remap.RULES)
    maps = spark.createDataFrame([("m", 0, "=", "old", "new"), ("m", 1, "~", "GON", None)], remap.VALUE_MAPS)
    df = spark.createDataFrame([("r", "k", given)], "record_id string, kind string, settings map<string,string>")
    rows = {r.target: r for r in remap.remap_settings(df, rules, maps).collect()}
    assert (rows["t"].value, rows["t"].source) == (value, source)
    assert rows["u"].value is None and rows["u"].required and rows["u"].source == "four"
    assert remap.unmet_issues(remap.remap_settings(df, rules, maps)).first().field == "four"


def test_nothing_to_remap(spark):
    empty = spark.createDataFrame([], "record_id string, kind string, settings map<string,string>")
    assert remap.remap_settings(empty).count() == 0
    odd = spark.createDataFrame([("r", "gcs", None), (None, "gcs", {"gcs.bucket.name": "b"}), ("s", None, {"a": "b"})], empty.schema)
    assert {(r.record_id, r.target, r.value) for r in remap.remap_settings(odd).collect()} == {
        ("r", "bucket", None), ("r", "format", "json"), (None, "bucket", "b"), (None, "format", "json")}


def test_rules_are_broadcast_and_entries_are_not_shuffled(spark):
    """Settings share few keys, so a shuffle by key would deal most of a table to a few tasks."""
    records = spark.createDataFrame([(str(i), "jdbc-sink", {"connection.url": "jdbc:postgresql://h/d", "topics": "t"}) for i in range(9)],
                                    "record_id string, kind string, settings map<string,string>")
    done = remap.remap_settings(records)
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\(kind#\d+, source#", plan) and "BroadcastHashJoin" in plan
    assert {(r.record_id, r.value) for r in done.where("target = 'host'").collect()} == {(str(i), "h") for i in range(9)}


def test_rules_too_many_to_broadcast_give_the_same(spark, monkeypatch):
    records = spark.createDataFrame([("a", "jdbc-source", {"mode": "timestamp", "timestamp.column.name": "t", "poll.interval.ms": "5"}), ("b", "jdbc-sink", {}),
                                     ("c", "none", {"topics": "t"})], "record_id string, kind string, settings map<string,string>")
    small = {tuple(r) for r in remap.remap_settings(records).collect()}
    monkeypatch.setattr("millrace.operators.skew.SMALL_ROWS", 0)
    many = remap.remap_settings(records)
    assert "BroadcastHashJoin" not in many._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in many.collect()} == small and ("a", "jdbc-source", "timestamp.column", "t", "timestamp.column.name", False) in small
