from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from millrace.operators import writes
from tests.conftest import rows


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, None, 3.0)], "id int, s string, d double")


@pytest.fixture
def batch(spark):
    return spark.createDataFrame([(2, None, 20.0), (4, "n", 4.0)], "id int, s string, d double")


def test_upsert_takes_nulls_and_is_idempotent(target, batch):
    once = writes.write_upsert(target, batch, ["id"])
    assert rows(once) == [(1, "a", 1.0), (2, None, 20.0), (3, None, 3.0), (4, "n", 4.0)]
    assert rows(writes.write_upsert(once, batch, ["id"])) == rows(once)


def test_update_ignores_new_keys_and_keeps_missing_columns(target, batch):
    assert rows(writes.write_update(target, batch.drop("s"), ["id"])) == [(1, "a", 1.0), (2, "b", 20.0), (3, None, 3.0)]


def test_mode_names(target, batch):
    assert writes.write_mode(target, batch, ["id"], "insert").count() == 5
    assert writes.write_mode(target, batch, ["id"], "update").count() == 3
    assert writes.write_mode(target, batch, ["id"], "anything").count() == 4
    assert rows(writes.write_delete(target, batch.union(batch), ["id"])) == [(1, "a", 1.0), (3, None, 3.0)]


def test_null_keys_are_never_merged(spark):
    target = spark.createDataFrame([(None, "old")], "id int, s string")
    batch = spark.createDataFrame([(None, "new")], "id int, s string")
    assert rows(writes.write_upsert(target, batch, ["id"])) == [(None, "new"), (None, "old")]


def changes(spark):
    return spark.createDataFrame([
        ("c", None, (1, "a"), 1), ("d", (1, "a"), None, 2), ("c", None, (2, "x"), 3), ("u", (2, "x"), (2, "y"), 4),
        ("d", (3, None), None, 5), ("c", None, (3, "back"), 6)],
        "op string, before struct<id:int,s:string>, after struct<id:int,s:string>, seq int")


def test_apply_changes(spark):
    target = spark.createDataFrame([(1, "old"), (9, "kept")], "id int, s string")
    got = writes.apply_changes(target, changes(spark), ["id"], ["seq"])
    assert rows(got) == [(2, "y"), (3, "back"), (9, "kept")]
    assert rows(writes.apply_changes(None, changes(spark), ["id"], ["seq"])) == [(2, "y"), (3, "back")]
    assert rows(writes.apply_changes(got, changes(spark), ["id"], ["seq"])) == rows(got)


@pytest.mark.parametrize("partitions", [1, 3, 11])
def test_result_does_not_depend_on_partitions(spark, partitions):
    df = changes(spark).repartition(partitions)
    assert rows(writes.apply_changes(None, df, ["id"], ["seq"])) == [(2, "y"), (3, "back")]


def test_last_per_key_aggregates_before_the_shuffle(spark):
    plan = writes.last_per_key(changes(spark), ["op"], ["seq"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max_by") > plan.index("Exchange")  # printed top down


def test_resolve_keys(spark):
    df = spark.sql("SELECT named_struct('a', 1, 'b', 2) AS key, named_struct('c', 3) AS value")
    out, keys = writes.resolve_keys(df, "record_key")
    assert keys == ["a", "b"] and out.first()["b"] == 2
    assert writes.resolve_keys(df, "record_value", "c")[1] == ["c"]
    assert writes.resolve_keys(df, None)[1] == []
    assert writes.resolve_keys(df, "kafka")[1] == ["topic", "partition", "offset"]
    for mode in ("record_value", "odd"):
        with pytest.raises(ValueError):
            writes.resolve_keys(df, mode)


def test_document_ids(spark):
    df = spark.sql("SELECT named_struct('id', 7, 'z', 1) AS key, named_struct('id', 'v', 'w', 2) AS value")
    got = {s: writes.assign_document_id(df, s, ["z"] if s == "partial_key" else ()).first()["_id"]
           for s in ("bson_objectid", "uuid", "provided_in_key", "provided_in_value", "partial_key")}
    assert (got["provided_in_key"], got["provided_in_value"], got["partial_key"]) == ("7", "v", '{"z":1}')
    assert len(got["bson_objectid"]) == 24 and len(got["uuid"]) == 36
    assert got["bson_objectid"] == writes.assign_document_id(df).first()["_id"]
    assert writes.id_strategy("nothing") == "bson_objectid"


def test_write_models(target, batch):
    assert writes.write_model_name("x.ReplaceOneBusinessKeyStrategy") == "replace_one_business_key"
    assert writes.write_model_name("") == "replace_one"
    assert writes.write_model(target, batch, ["id"], "delete_one").count() == 2
    assert writes.write_model(target, batch, ["id"], "insert_one").count() == 5
    stamped = target.withColumns({"inserted_ts": F.lit(1), "modified_ts": F.lit(1)})
    got = writes.write_model(stamped, batch, ["id"], "update_one_timestamps", now=F.lit(9))
    assert rows(got.select("id", "inserted_ts", "modified_ts")) == [(1, 1, 1), (2, 1, 9), (3, 1, 1), (4, 9, 9)]


def test_evolve_schema(spark, target):
    wider = spark.createDataFrame([(1, True)], "id int, extra boolean")
    with pytest.raises(ValueError):
        writes.evolve_schema(target, wider)
    with pytest.raises(ValueError):
        writes.evolve_schema(None, wider)
    with pytest.raises(ValueError):
        writes.evolve_schema(target, spark.createDataFrame([("x",)], "id string"), auto_evolve=True)
    new, incoming = writes.evolve_schema(target, wider, auto_evolve=True)
    assert new.columns == incoming.columns == ["id", "s", "d", "extra"]
    created, _ = writes.evolve_schema(None, wider, auto_create=True)
    assert created.count() == 0 and created.columns == ["id", "extra"]


def test_ids_of_neighbouring_fields_differ(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, "x"), ("", "x")], "p string, q string")
    assert writes.assign_document_id(df, fields=["p", "q"]).select("_id").distinct().count() == 4


def test_small_upsert_leaves_the_target_in_place(spark, tmp_path):
    target = spark.range(1000).withColumn("v", F.lit("old"))
    spark.createDataFrame([(5, "new"), (2000, "new"), (None, "new")], "id long, v string").write.parquet(f"{tmp_path}/batch")
    batch = spark.read.parquet(f"{tmp_path}/batch")
    got = writes.write_upsert(target, batch, ["id"])
    assert got.where("v = 'new'").count() == 3 and got.count() == 1002
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
