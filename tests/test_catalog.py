from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from millrace import session
from millrace.functions import text
from millrace.operators import audit, catalog, skew
from tests.conftest import rows


def brute(name, keys):
    if name in keys and name:
        return name
    hits = [k for k in keys if k and name and (k in name or name in k)]
    return min(hits, key=lambda k: (-len(k), k)) if hits else None


@pytest.mark.parametrize("gram", [1, 2, 5])
def test_match_equals_brute_force(spark, monkeypatch, gram):
    monkeypatch.setattr(catalog, "GRAM", gram)
    picked = random.Random(3)
    word = lambda n: "".join(picked.choice("ab.") for _ in range(n))
    keys = sorted({word(picked.randrange(1, 6)) for _ in range(30)})
    names = [word(picked.randrange(0, 9)) for _ in range(300)]
    table = spark.createDataFrame([(k,) for k in keys], "class string")
    records = spark.createDataFrame(list(enumerate(names)), "id int, class string")
    got = catalog.match_catalog(records, table)
    assert {r["id"]: r["catalog_class"] for r in got.collect()} == {i: brute(n, keys) for i, n in enumerate(names)}


def test_contained_pairs(spark):
    picked = random.Random(8)
    word = lambda n: "".join(picked.choice("abé") for _ in range(n))
    hays, needles = {word(picked.randrange(0, 14)) for _ in range(80)}, {word(picked.randrange(0, 9)) for _ in range(80)}
    one = lambda texts: spark.createDataFrame([(t,) for t in sorted(texts)] + [(None,)], "x string")
    found = [tuple(r) for r in catalog.containing(one(hays), one(needles)).collect()]
    assert set(found) == {(h, n) for h in hays for n in needles if h and n and (n in h or h in n)}
    assert len(found) == len(set(found)) + sum(1 for h in hays & needles if h)  # equal texts meet both ways
    assert catalog.containing(one(hays), one(set())).count() == 0 and catalog.containing(one(set()), one(needles)).count() == 0


def test_long_lists_of_pieces_are_not_broadcast(spark):
    """Texts that are small as files have many pieces."""
    hays = session.written(spark.range(9_000).select(F.format_string("feed.Customer#%09d.v1", "id").alias("x")), "hays")
    needles = session.written(spark.range(0, 9_000, 2).select(F.format_string("Customer#%09d", "id").alias("x")), "needles")
    found = catalog.containing(hays, needles)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.where("contains(left, right)").count() == found.count() == 4_500


def test_long_lists_of_matches_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(skew, "SMALL_ROWS", 2)
    records = spark.createDataFrame([(i, f"ring{i % 3}") for i in range(9)], "id int, class string")
    matched = catalog.match_catalog(records, spark.createDataFrame([("ring",)], "class string"))
    assert "BroadcastHashJoin" not in matched._jdf.queryExecution().executedPlan().toString()
    assert {r["catalog_class"] for r in matched.collect()} == {"ring"}


def test_suggestions_for_many_texts(spark):
    table = catalog.load_catalog(spark)
    texts = ["jdbc sink for me", " HTTP ", "nothing at all"]
    found = {(r.text, r.catalog_name) for r in catalog.suggest_all(table, spark.createDataFrame([(t,) for t in texts], "t string")).collect()}
    assert found == {(t, r.catalog_name) for t in texts for r in catalog.suggest(table, t).collect()}


def test_default_catalog(spark):
    table = catalog.load_catalog(spark)
    assert table.count() == 22
    records = spark.createDataFrame([("mysql.MySqlConnector",), ("com.unknown.UnknownConnector",), ("",)], "class string")
    got = {r["class"]: (r["status"], r["known"]) for r in
           catalog.default_unmatched(catalog.match_catalog(records, table)).collect()}
    assert got == {"mysql.MySqlConnector": ("supported", True), "com.unknown.UnknownConnector": ("manual", False),
                   "": ("manual", False)}


def test_overrides_and_status_text(spark, tmp_path):
    extra = spark.createDataFrame([("com.test.TestConnector", "MANUAL"), ("io.confluent.connect.http.HttpSinkConnector", "?")],
                                  "class string, status string")
    table = catalog.load_catalog(spark, overrides=extra)
    got = {r["class"]: r["status"] for r in table.collect()}
    assert len(got) == 23 and got["com.test.TestConnector"] == "manual"
    assert got["io.confluent.connect.http.HttpSinkConnector"] == "supported"
    table.coalesce(1).write.json(str(tmp_path / "c"))
    assert catalog.load_catalog(spark, str(tmp_path / "c")).count() == 23


def test_browse_and_search(spark):
    table, groups = catalog.load_catalog(spark), catalog.load_categories(spark)
    assert catalog.browse_catalog(table, groups, "search").count() == 2
    with pytest.raises(ValueError):
        catalog.browse_catalog(table, groups, "nothing")
    assert catalog.search_catalog(table, "MYSQL").count() == 1
    assert rows(catalog.suggest(table, "jdbc sink for me").select("catalog_name")) == [("JDBC Sink",)]
    with pytest.raises(ValueError):
        catalog.search_catalog(table, " ")
    assert catalog.catalog_quality(table).count() == 0 and catalog.category_quality(groups).count() == 0


def test_kinds(spark):
    names = ["io.debezium.connector.mysql.MySqlConnector", "x.S3SinkConnector", "com.example.UnknownConnector",
             "a.LogWriter", "a.CdcReader", "a.SinkSource"]
    df = spark.createDataFrame([(n,) for n in names], "c string")
    got = [tuple(r) for r in df.select(text.kind(F.col("c")), text.direction(F.col("c"))).collect()]
    assert got == [("source", "source"), ("sink", "destination"), ("unknown", "source"), ("unknown", "destination"),
                   ("unknown", "source"), ("source", "source")]


@pytest.mark.parametrize("plugin,good", [
    ("builtin:postgres", True), ("standalone:x@v1", True), ("custom:transform@latest", True), ("other:x", False),
    ("builtin", False), ("builtin:", False), ("builtin:x@", False), ("builtin:@v", False), ("builtin:a@b@c", False),
    ("builtin:a:b", False)])
def test_plugin_rule(spark, plugin, good):
    assert spark.range(1).select(audit.plugin_ok(F.lit(plugin))).first()[0] is good


@pytest.mark.parametrize("version,good", [("1", True), ("2.2", True), ("1.0.0", True), ("1.2.3.4", False)])
def test_version_rule(spark, version, good):
    assert spark.range(1).select(audit.version_ok(F.lit(version))).first()[0] is good


def test_pipeline_document_rules(spark):
    docs = spark.createDataFrame([("d1", "2.2", 1), ("d2", "", 0)], "doc_id string, version string, n_pipelines int")
    found = audit.check_rules(docs, audit.document_rules(), "doc_id")
    assert rows(found.select("doc_id", "field")) == [("d2", "pipelines"), ("d2", "version")]
    steps = spark.createDataFrame([("s", "builtin:f", "!predicate:p"), ("", "f", "p")],
                                  "id string, plugin string, condition string")
    assert rows(audit.check_rules(steps, audit.step_rules()).select("field")) == [("condition",), ("id",), ("plugin",)]
    dead = spark.createDataFrame([("builtin:log", 5, 5), (None, 5, 6), ("builtin:log", 0, 9)],
                                 "plugin string, window_size int, nack_threshold int")
    assert rows(audit.check_rules(dead, audit.dead_letter_rules()).select("field")) == [
        ("plugin",), ("windowNackThreshold",)]


def test_verdicts(spark):
    docs = spark.createDataFrame([("a",), ("b",), ("c",)], "doc_id string")
    issues = spark.createDataFrame([("a", "error"), ("a", "warning"), ("b", "warning")], "doc_id string, severity string")
    plain = audit.document_verdicts(docs, issues)
    assert rows(plain.select("doc_id", "verdict")) == [("a", "invalid"), ("b", "valid with warnings"), ("c", "valid")]
    assert tuple(audit.validation_summary(plain).first()) == (3, 2, 1, 1, False)
    strict = audit.document_verdicts(docs.where("doc_id <> 'a'"), issues, strict=True)
    assert tuple(audit.validation_summary(strict).first()) == (2, 2, 1, 0, False)
    assert audit.validation_summary(strict.limit(0)).first()["passed"] is True


def test_capabilities(spark):
    stages = spark.createDataFrame([
        (1, "builtin:s3@latest", {"aws.bucket": "b", "_x": "1", "odd": "2"}), (2, "builtin:s3", {}), (3, "custom:x", {}),
        (4, "custom:x", {"a": "b"})], "id int, plugin string, settings map<string,string>")
    table = catalog.load_capabilities(spark)
    assert rows(audit.audit_capabilities(stages, table, False, "id").select("id", "field")) == [(2, "aws.bucket")]
    strict = audit.audit_capabilities(stages, table, True, "id")
    assert rows(strict.select("id", "severity", "field")) == [
        (1, "warning", "odd"), (2, "error", "aws.bucket"), (3, "warning", "settings")]


@pytest.mark.parametrize("url,expected", [
    ("jdbc:postgresql://u%40:p%3Aw@h.x:5432/db1?ssl=true&a=1&a=2",
     ("postgres", "h.x", "5432", "db1", "u@", "p:w", {"ssl": "true", "a": "1"})),
    ("jdbc:sqlserver://h:1433;databaseName=d;encrypt=yes;bad", ("sqlserver", "h", "1433", "d", None, None, {"encrypt": "yes"})),
    ("jdbc:microsoft:sqlserver://h;user=u", ("sqlserver", "h", None, None, "u", None, {})),
    ("jdbc:mariadb://[::1]:33/d?user=q", ("mysql", "::1", "33", "d", "q", None, {})),
    ("jdbc:db2://h/x", (None, "h", None, "x", None, None, {})),
])
def test_connection_url(spark, url, expected):
    got = spark.range(1).select(text.connection_url(F.lit(url)).alias("r")).select("r.parts.*", "r.error").first()
    assert tuple(got[c] for c in ("family", "host", "port", "database", "user", "password", "params")) == expected
    assert got["error"] is None


@pytest.mark.parametrize("url,error", [("http://x", "must start with jdbc:"), ("jdbc:oracle:thin", "missing protocol"),
                                       ("jdbc:mysql://h:ab/d", "invalid port"), (None, "must start with jdbc:")])
def test_connection_url_errors(spark, url, error):
    col = F.lit(url).cast("string")
    assert spark.range(1).select(text.connection_url(col)["error"]).first()[0] == error


def test_identifiers(spark):
    def ids(name):
        c = F.lit(name)
        return tuple(spark.range(1).select(text.identifier(c), text.command_identifier(c), text.generator_identifier(c)).first())

    assert ids("My_Pipe.Line 1") == ("my-pipe-line-1", "my_pipe-line-1", "my_pipe-line-1")
    assert ids("--é!--") == ("pipeline", "--é!--", "p--é!--")
    assert ids("9*a") == ("9a", "p9-a", "p9a")


def test_masking(spark):
    got = spark.range(1).select(
        text.masked(F.lit("db.password"), F.lit("x")), text.masked(F.lit("k"), F.lit("${file:/a}")),
        text.is_sensitive(F.lit("My.AuthMode")), text.is_sensitive(F.lit("host"))).first()
    assert tuple(got) == ("${MASKED_DB.PASSWORD}", "${file:/a}", True, False)
