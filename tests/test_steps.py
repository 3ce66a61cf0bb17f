from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from millrace.operators import steps
from tests.conftest import rows


@pytest.fixture
def records(spark):
    return spark.createDataFrame(
        [("a.b.c", 1, "x", 2.5), ("a.b", 2, "y", None), ("a.b.c\n", 3, None, 1.0)], "topic string, id int, s string, d double")


def test_regex_route_needs_the_whole_name(records):
    got = steps.route_regex(records, r"([^.]+)\.([^.]+)\.([^.\n]+)", "$3")
    assert [r["topic"] for r in got.orderBy("id").collect()] == ["c", "a.b", "a.b.c\n"]


def test_alternation_stays_inside_the_anchors(spark):
    df = spark.createDataFrame([("ab",), ("a",), ("b",)], "topic string")
    assert sorted(r[0] for r in steps.route_regex(df, "a|b", "z").collect()) == ["ab", "z", "z"]


def test_mask_uses_empty_values_by_type(spark):
    df = spark.sql("SELECT 1 AS i, 'x' AS s, true AS b, 1.5D AS d, array(1) AS a, date'2024-01-01' AS t, 2 AS keep")
    row = steps.mask_field(df, "i,s,b,d,a,t").first()
    assert (row.i, row.s, row.b, row.d, row.a, str(row.t), row.keep) == (0, "", False, 0.0, [], "1970-01-01", 2)


def test_predicate_null_is_false_and_negate_inverts(records):
    masked = steps.masked(["id"])
    assert [r["id"] for r in steps.when_predicate(records, masked, "s = 'x'").orderBy("topic", "d").collect()].count(0) == 1
    assert sorted(r["id"] for r in steps.when_predicate(records, masked, "s = 'x'", negate=True).collect()) == [0, 0, 1]


def test_filter_keeps_rows_where_the_condition_is_null(records):
    assert steps.filter_records(records, "s = 'x'").count() == 2


def test_predicate_text():
    assert steps.predicate_text("p", True) == "!predicate:p"
    with pytest.raises(KeyError):
        steps.resolve_predicate("predicate:none", {})


def test_schema_changing_step_under_a_predicate(records):
    got = steps.when_predicate(records, steps.replaced(exclude=["s"], renames={"d": "e"}), "id = 1").orderBy("id").collect()
    assert [(r["s"], r["d"], r["e"]) for r in got] == [(None, None, 2.5), ("y", None, None), (None, 1.0, None)]


def test_replace_drops_nested_fields_and_renames(spark):
    df = spark.sql("SELECT named_struct('a', 1, 'b', 2) AS v, 3 AS c")
    assert steps.replace_field(df, exclude=["v.a"], renames={"c": "d"}).first().asDict(True) == {"v": {"b": 2}, "d": 3}
    assert steps.replace_field(df, include=["c"]).columns == ["c"]


def test_flatten_keeps_arrays_and_uses_dots(spark):
    df = spark.sql("SELECT named_struct('a', named_struct('b', 1), 'c', array(1, 2)) AS v, 9 AS k")
    out = steps.flatten(df)
    assert sorted(out.columns) == ["k", "v.a.b", "v.c"]
    assert steps.apply_steps(df, [{"class": "x.Flatten$Value", "settings": {"delimiter": "_"}}]).columns.count("v_a_b") == 1


def changes(spark):
    return spark.createDataFrame([
        ("c", None, (1, "a"), 1), ("u", (1, "a"), (1, "b"), 2), ("d", (1, "b"), None, 3), (None, None, None, 4),
        ("r", None, (2, "z"), 5)],
        "op string, before struct<id:int,v:string>, after struct<id:int,v:string>, seq int")


def test_unwrap_envelopes(spark):
    got = steps.unwrap_cdc(changes(spark)).orderBy("seq").collect()
    assert [(r["id"], r["v"], r["__deleted"], r["seq"]) for r in got] == [
        (1, "a", False, 1), (1, "b", False, 2), (1, "b", True, 3), (2, "z", False, 5)]
    kept = steps.unwrap_cdc(changes(spark), drop_tombstones=False)
    assert kept.count() == 5 and kept.where("seq = 4").first()["id"] is None


def test_convert_timestamp_both_ways(spark):
    df = spark.sql("SELECT 1700000000123 AS ms")
    df = steps.convert_timestamp(df, "ms", "string", "yyyy-MM-dd HH:mm:ss.SSS", out="t")
    df = steps.convert_timestamp(df, "t", "unix", "yyyy-MM-dd HH:mm:ss.SSS", out="back")
    row = df.first()
    assert (row.t, row.back) == ("2023-11-14 22:13:20.123", 1700000000123)
    bad = spark.sql("SELECT 'nonsense' AS t")
    assert steps.convert_timestamp(bad, "t", "unix").first().t is None
    with pytest.raises(ValueError):
        steps.convert_timestamp(bad, "t", "later")


def test_chain_is_one_plan_and_flags_unknown_steps(spark):
    chain = [{"class": "a.InsertField$Value", "settings": {"static.field": "f", "static.value": "1"}},
             {"class": "b.Nothing"}, {"class": "a.Cast", "settings": {"spec": "f:int"}}]
    out = steps.apply_steps(spark.range(2), chain)
    assert out.first().asDict() == {"id": 0, "f": 1, "_placeholders": ["processor-1:b.Nothing"]}


def test_custom_step_under_a_predicate(spark):
    steps.custom_step("my.Double", lambda df: df.withColumn("id", F.col("id") * 2))
    got = steps.apply_steps(spark.range(4), [{"class": "my.Double", "predicate": "odd"}], {"odd": "id % 2 = 1"})
    assert rows(got) == [(0,), (2,), (2,), (6,)]


def test_logical_table_keeps_keys_apart(spark):
    df = spark.createDataFrame([("t_1", (5,)), ("t_2", (5,)), ("other", (5,))], "topic string, key struct<id:int>")
    got = steps.route_logical_table(df, r"(t)_\d", "$1_all")
    assert rows(got.select("topic", "key.shard", "key.id")) == [("other", None, 5), ("t_all", "t_1", 5), ("t_all", "t_2", 5)]


def test_sides_and_several_fields(spark):
    df = spark.createDataFrame([((7, 1), (8, 2), "t", "3", 5)], "key struct<id:int,n:int>, value struct<id:int,n:int>, topic string, "
                               "x string, offset long")
    k = steps.apply_steps(df, [{"class": "a.ExtractField$Key", "settings": {"field": "id"}}]).first()
    assert k["key"] == 7 and k["value"]["id"] == 8
    v = steps.apply_steps(df, [{"class": "a.ExtractField$Value", "settings": {"field": "id"}}]).first()
    assert v["value"] == 8 and v["key"]["id"] == 7
    flat = steps.apply_steps(df, [{"class": "a.Flatten$Value", "settings": {"delimiter": "_"}}])
    assert "key" in flat.columns and "value_id" in flat.columns
    flat = steps.apply_steps(df, [{"class": "a.Flatten$Key", "settings": {"delimiter": "_"}}])
    assert "key_id" in flat.columns and "value" in flat.columns
    both = {"topic.field": "t", "offset.field": "o", "static.field": "s", "static.value": "c"}
    row = steps.apply_steps(df, [{"class": "a.InsertField$Value", "settings": both}]).first()
    assert (row["t"], row["o"], row["s"]) == ("t", 5, "c")
    assert dict(steps.cast_fields(df, "x:int32,offset:float64").dtypes)["x"] == "int"
    moment = spark.createDataFrame([("2024-01-01 01:00:01",)], "at string")
    assert steps.convert_timestamp(moment, "at", "time").first()["at"] == 3_601_000


SIDES = "id int, ssn string, key struct<ssn:string,n:int,at:string>, value struct<ssn:string,n:int,at:string>, hit boolean"
BOTH = [(1, "top", ("k1", 5, "2024-01-02"), ("v1", 6, "2024-01-03"), True), (2, "top", ("k2", 7, "2024-01-02"), None, False),
        (3, "top", None, ("v3", 8, "2024-01-03"), None)]


@pytest.mark.parametrize("side", ["key", "value"])
@pytest.mark.parametrize("name, settings, expected", [
    ("MaskField", {"fields": "ssn"}, {"ssn": "", "n": 5, "at": "2024-01-02"}),
    ("ReplaceField", {"exclude": "n"}, {"ssn": "k1", "at": "2024-01-02"}),
    ("ReplaceField", {"include": "ssn"}, {"ssn": "k1"}),
    ("ReplaceField", {"renames": "n:m"}, {"ssn": "k1", "m": 5, "at": "2024-01-02"}),
    ("InsertField", {"static.field": "x", "static.value": "1"}, {"ssn": "k1", "n": 5, "at": "2024-01-02", "x": "1"}),
    ("Cast", {"spec": "n:string"}, {"ssn": "k1", "n": "5", "at": "2024-01-02"}),
    ("TimestampConverter", {"field": "at", "target.type": "string", "format": "yyyy-MM-dd"}, {"ssn": "k1", "n": 5, "at": "2024-01-02"}),
])
def test_field_steps_stay_on_their_side(spark, side, name, settings, expected):
    df = spark.createDataFrame(BOTH, SIDES)
    if side == "value" and name == "InsertField":
        return  # sets fields of the record, see above
    if side == "value":
        expected = {k: {"k1": "v1", 5: 6, "5": "6", "2024-01-02": "2024-01-03"}.get(v, v) for k, v in expected.items()}
    out = steps.apply_steps(df, [{"class": f"o.a.k.{name}${side.title()}", "settings": settings}])
    row = out.where("id = 1").first()
    assert row[side].asDict() == expected
    other = "value" if side == "key" else "key"
    assert rows(out.select("id", "ssn", other)) == rows(df.select("id", "ssn", other)) and set(out.columns) == set(df.columns)


def test_a_side_under_a_predicate(spark):
    out = steps.apply_steps(spark.createDataFrame(BOTH, SIDES), [
        {"class": "MaskField$Key", "settings": {"fields": "ssn"}, "predicate": "p"}], {"p": "hit"})
    assert {r.id: r.key and r.key.ssn for r in out.collect()}[1] == "" and {r.id: r.key.ssn for r in out.where("id = 2").collect()} == {2: "k2"}
    with pytest.raises(ValueError, match="struct"):
        steps.apply_steps(spark.createDataFrame([(1, "a")], "id int, key string"), [{"class": "MaskField$Key", "settings": {"fields": "id"}}])


def test_one_to_many(spark):
    def words(record):
        for i, word in enumerate((record["text"] or "").split()):
            yield i, word

    df = spark.createDataFrame([(1, "a b", "x"), (2, "", "x"), (3, None, "y"), (4, "c", None)], "id int, text string, kind string")
    step = steps.one_to_many(words, "place int, word string", ["id"])
    assert rows(step(df)) == [(1, 0, "a"), (1, 1, "b"), (4, 0, "c")]
    steps.custom_step("my.Words", step)
    out = steps.apply_steps(df, [{"class": "my.Words", "predicate": "p"}], {"p": "kind = 'x'"})
    assert {(r.id, r.word, r.text) for r in out.collect()} == {(1, "a", None), (1, "b", None), (3, None, None), (4, None, "c")}
    assert step(df.limit(0)).count() == 0
