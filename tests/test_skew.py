"""Hot keys: a third of all rows or more in one key, forced through the spreading paths."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import audit, deadletter, layout, skew
from tests.conftest import rows


def skewed(spark, n=3000):
    """Half of the rows share key 0, some have a null key, the rest are spread."""
    picked = random.Random(7)
    data = [(i, None if i % 50 == 0 else 0 if picked.random() < 0.5 else picked.randrange(1, 200)) for i in range(n)]
    return spark.createDataFrame(data, "id bigint, k bigint")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_join(spark, how):
    big = skewed(spark)
    small = spark.createDataFrame([(k, f"v{k}") for k in range(0, 150, 2)], "k bigint, v string")
    assert rows(skew.salted_join(big, small, ["k"], how, hot_rows=100, salts=8).select(*big.join(small, "k", how).columns)
                ) == rows(big.join(small, "k", how))


def test_salted_join_spreads_the_hot_key(spark):
    big = skewed(spark)
    assert skew.hot_keys(big, ["k"], 10_000) is None
    hot = skew.hot_keys(big, ["k"], 100)
    assert [r[0] for r in hot.collect()] == [0]
    cold_rows, hot_rows = skew.split_hot(big, ["k"], hot)
    assert hot_rows.count() == big.where("k = 0").count()
    assert cold_rows.count() + hot_rows.count() == big.count()  # null keys stay


def test_null_key_can_be_hot(spark):
    big = spark.createDataFrame([(i, None if i % 3 else i) for i in range(900)], "id bigint, k bigint")
    assert [r[0] for r in skew.hot_keys(big, ["k"], 100).collect()] == [None]
    small = spark.createDataFrame([(0, "x")], "k bigint, v string")
    assert skew.salted_join(big, small, ["k"], "left_anti", hot_rows=100).count() == 899


def test_dense_index(spark):
    df = spark.createDataFrame([(i * 37 % 1000, i % 3) for i in range(1000)], "a bigint, b bigint").repartition(7)
    got = skew.dense_index(df, ["b", "a"], "n").orderBy("n").collect()
    assert [r["n"] for r in got] == list(range(1000))
    assert [(r["b"], r["a"]) for r in got] == sorted((i % 3, i * 37 % 1000) for i in range(1000))


def brute_breaches(data, size, threshold):
    out, seen = [], {}
    for key, ts, bad in sorted(data, key=lambda r: (repr(r[0]), r[1])):
        past = seen.setdefault(key, [])
        past.append(bad)
        failures = sum(past[-size:])
        if failures >= threshold:
            out.append((key, ts, failures))
    return sorted(out, key=repr)


@pytest.mark.parametrize("size,threshold,hot", [(1, 1, 50), (5, 3, 50), (10, 4, 100), (30, 12, 40), (200, 70, 50), (10, 10, 10**6)])
def test_nack_breaches_equals_brute_force(spark, size, threshold, hot):
    picked = random.Random(size)
    data = [(0 if picked.random() < 0.5 else None if picked.random() < 0.1 else picked.randrange(1, 30), ts,
             picked.random() < 0.4) for ts in range(2000)]
    df = spark.createDataFrame(data, "k bigint, ts bigint, bad boolean").repartition(5)
    got = deadletter.nack_breaches(df, ["k"], ["ts"], F.col("bad"), size, threshold, hot_rows=hot)
    assert rows(got) == brute_breaches(data, size, threshold)


def test_nack_threshold_rules(spark):
    df = spark.createDataFrame([(1, 1, True)], "k bigint, ts bigint, bad boolean")
    assert deadletter.nack_breaches(df, ["k"], ["ts"], F.col("bad"), 0, 3).count() == 0
    assert deadletter.nack_breaches(df, ["k"], ["ts"], F.col("bad"), 5, None).count() == 0
    with pytest.raises(ValueError):
        deadletter.nack_breaches(df, ["k"], ["ts"], F.col("bad"), 2, 3)


def test_duplicates_with_a_hot_key(spark):
    df = skewed(spark).where("k is not null")
    seen, expected = set(), []
    for r in df.orderBy("id").collect():
        if r["k"] in seen:
            expected.append(tuple(r))
        seen.add(r["k"])
    assert rows(audit.find_duplicates(df, ["k"], ["id"], hot_rows=100)) == sorted(expected, key=repr)


def test_dangling_with_a_hot_target(spark):
    refs = skewed(spark).where("k is not null")
    ids = spark.createDataFrame([(k,) for k in range(1, 150)], "id int")
    got = audit.dangling_references(refs, "k", ids, "id", hot_rows=100)
    assert rows(got) == rows(refs.where("k = 0 or k >= 150").select("k", "id"))


def test_cluster_layout_cuts_a_hot_partition(spark):
    df = skewed(spark, 8000).select(F.coalesce("k", F.lit(0)).alias("k"), "id")
    setting = "spark.sql.adaptive.coalescePartitions.enabled"  # would join these few rows into one task
    spark.conf.set(setting, "false")
    try:
        parts = layout.cluster_layout(df, "k", "id").groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set(setting, "true")
    assert len(parts) > 1 and max(r["count"] for r in parts) < 0.45 * 8000


def test_hot_key_among_many(spark):
    big = spark.range(50_000).select("id", F.when(F.col("id") < 1000, -1).otherwise(F.col("id")).alias("k"))  # 2 % of the rows
    assert [r[0] for r in skew.hot_keys(big, ["k"], 500).collect()] == [-1]


def test_a_long_list_of_hot_keys_is_not_broadcast(spark, monkeypatch):
    big = skewed(spark)
    small = spark.createDataFrame([(k, "v" * 10) for k in range(100)], "k bigint, v string")
    expected = rows(big.join(small, "k", "left"))
    monkeypatch.setattr(skew, "SMALL_ROWS", 20)
    assert not skew.is_small(small) and skew.hot_keys(big, ["k"], 3).count() > 20
    assert rows(skew.salted_join(big, small, ["k"], "left", hot_rows=3).select("k", "id", "v")) == expected
    monkeypatch.setattr(skew, "SMALL_ROWS", 1000)
    monkeypatch.setattr(skew, "SMALL_CHARS", 100)
    assert not skew.is_small(small)


def test_running_totals(spark):
    data = [(None if i % 11 == 0 else i % 3 and 1, i, i * 7 % 5) for i in range(1000)]
    got = skew.running_totals(spark.createDataFrame(data, "k int, t int, v int").repartition(6), ["k"], ["t"], "v")
    sums, expected = {}, []
    for k, t, v in data:
        sums[k] = sums.get(k, 0) + v
        expected.append((k, t, v, sums[k]))
    assert rows(got.select("k", "t", "v", "_total")) == sorted(expected, key=repr)
    assert sorted(r[0] for r in got.select("_index").collect()) == list(range(1000))


@pytest.mark.parametrize("n", [100, 60_000])
def test_lookup(spark, n):
    big, table = skewed(spark), spark.createDataFrame([(k, "v" * 10) for k in range(n)], "k bigint, v string")
    assert rows(skew.lookup(big, table, ["k"])) == rows(big.join(table, "k", "left"))
