"""Stored tables that are rewritten by slice, against dictionaries."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import slices
from millrace.session import written
from tests.conftest import rows

CHANGES = "op string, before struct<id:bigint,v:string>, after struct<id:bigint,v:string>, ts bigint"


def stored(spark, path, n=100):
    df = spark.range(n).select("id", F.concat(F.lit("v"), F.col("id").cast("string")).alias("v"))
    slices.create(df, path, ["id"], "ts bigint", F.floor(F.col("id") / 10))
    return path


def files(spark, path):
    return {(r[0], r[1]) for r in spark.read.parquet(path).select("_slice", "_metadata.file_path").distinct().collect()}


def changes(spark, given):
    return spark.createDataFrame([("d", (k, None), None, ts) if v is None else ("u", None, (k, v), ts) for k, v, ts in given], CHANGES)


def apply(spark, path, given):
    return slices.apply_changes(spark, path, changes(spark, given), ["id"], ["ts"])


def test_untouched_files_keep_their_names(spark, tmp_path):
    path = stored(spark, str(tmp_path / "t"))
    before = files(spark, path)
    assert apply(spark, path, [(5, "new", 1), (17, None, 1), (500, "added", 1), (501, None, 1)]) == 2
    after = files(spark, path)
    assert {s for s, _ in before - after} == {0, 1} and {s for s, _ in before & after} == set(range(2, 10))
    assert {s for s, _ in after - before} == {0, 1, 10}
    expected = {i: f"v{i}" for i in range(100)} | {5: "new", 500: "added"}
    del expected[17]
    assert rows(slices.read(spark, path)) == sorted(expected.items(), key=repr)


def test_the_target_is_not_shuffled(spark, tmp_path):
    path = stored(spark, str(tmp_path / "t"))
    batch = written(spark.createDataFrame([(3,)], "id bigint"), "batch")
    plan = slices.places(spark, path, batch, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert "v#" not in plan  # the key column alone is read


def test_late_repeated_and_older_changes(spark, tmp_path):
    path = stored(spark, str(tmp_path / "t"), 30)
    pick, state = random.Random(2), {i: (None, f"v{i}") for i in range(30)}
    batches = [[(pick.randrange(40), pick.choice([None, "a", "b", "c"]), ts) for ts in pick.sample(range(1000), 25)] for _ in range(4)]
    for batch in [*batches, batches[1], batches[0]]:
        apply(spark, path, batch)
        for k, v, ts in batch:
            if k not in state or state[k][0] is None or ts >= state[k][0]:
                state[k] = (ts, v)
    # Timestamps repeat between batches: only keys whose last one is unique are compared.
    times = [(k, ts) for b in batches for k, _, ts in b]
    tied = {k for k, ts in times if times.count((k, ts)) > 1}
    found = {k: v for k, v in rows(slices.read(spark, path)) if k not in tied}
    assert found == {k: v for k, (_, v) in state.items() if v is not None and k not in tied}


def test_refused_batches(spark, tmp_path):
    path = stored(spark, str(tmp_path / "t"), 20)
    before = files(spark, path)
    with pytest.raises(ValueError, match="repeats"):
        slices.upsert(spark, path, spark.createDataFrame([(1, "a"), (1, "b")], "id bigint, v string"), ["id"])
    with pytest.raises(ValueError, match="can't be found"):
        slices.upsert(spark, path, spark.createDataFrame([(None, "a")], "id bigint, v string"), ["id"])
    assert slices.upsert(spark, path, spark.createDataFrame([], "id bigint, v string"), ["id"]) == 0
    assert files(spark, path) == before


def test_a_slice_whose_rows_all_go(spark, tmp_path):
    path = stored(spark, str(tmp_path / "t"), 20)
    slices.write_model(spark, path, spark.range(10), ["id"], "delete_one")
    assert sorted(k for k, _ in rows(slices.read(spark, path))) == list(range(10, 20))
    slices.write_model(spark, path, spark.createDataFrame([(3, "back")], "id bigint, v string"), ["id"])
    assert (3, "back") in rows(slices.read(spark, path))


def test_columns_a_batch_lacks_stay_and_new_slices_are_bounded(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(100).select("id", F.lit("a").alias("x"), F.lit("b").alias("y"))
    slices.create(df, path, ["id"], slice_rows=30)
    assert spark.read.parquet(path).select("_slice").distinct().count() == 4
    slices.upsert(spark, path, spark.range(90, 150).select("id", F.lit("n").alias("x")), ["id"], slice_rows=20)
    found = {r.id: (r.x, r.y) for r in slices.read(spark, path).collect()}
    assert found == {i: ("a", "b") for i in range(90)} | {i: ("n", "b") for i in range(90, 100)} | {i: ("n", None) for i in range(100, 150)}
    assert spark.read.parquet(path).where("_slice >= 4").select("_slice").distinct().count() == 3


def test_timestamps_of_written_documents(spark, tmp_path):
    path = str(tmp_path / "t")
    old, now = (F.lit(x).cast("timestamp") for x in ("2024-01-01", "2024-02-02"))
    slices.create(spark.range(3).select("id", old.alias("inserted_ts"), old.alias("modified_ts")), path, ["id"])
    slices.write_model(spark, path, spark.range(2, 4).select("id"), ["id"], "update_one_timestamps", now=now)
    found = {r.id: (r.inserted_ts.month, r.modified_ts.month) for r in slices.read(spark, path).collect()}
    assert found == {0: (1, 1), 1: (1, 1), 2: (1, 2), 3: (2, 2)}
