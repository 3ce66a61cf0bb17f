from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from millrace.plans import flow, rollups
from tests.conftest import rows


def matched(spark, *statuses):
    return spark.createDataFrame([(s,) for s in statuses], "status string")


def test_plan_summary(spark):
    assert tuple(rollups.plan_summary(matched(spark, "supported", "partial", None)).first()) == (3, 1, 2, 0, "< 30 seconds")
    assert tuple(rollups.plan_summary(matched(spark, "manual", "unsupported")).first()) == (2, 0, 0, 2, "2-5 minutes")
    assert rollups.plan_summary(matched(spark, "x", "x", "x")).first()["downtime"] == "2-5 minutes"
    assert rollups.plan_summary(matched(spark, "x").limit(0)).first()["total"] == 0


@pytest.mark.parametrize("statuses,steps,minutes,label", [
    (["supported"], ["supported"], 45, "< 1 hour"),
    (["partial", "supported"], ["partial"], 165, "2-3 hours"),
    (["manual"], ["manual"], 360, "4-8 hours"),
    (["unsupported", "odd"], [], 600, "1-2 days"),
])
def test_effort_by_status(spark, statuses, steps, minutes, label):
    data = [(s, [(x,) for x in steps] if i == 0 else []) for i, s in enumerate(statuses)]
    df = spark.createDataFrame(data, "status string, steps array<struct<status:string>>")
    assert tuple(rollups.effort_by_status(df).first()) == (minutes, label)


@pytest.mark.parametrize("effort,minutes", [("30 minutes", 30), ("1 hour", 60), ("2-3 hours", 180), ("1-2 days", 60),
                                            ("", 60), ("some minutes", 0), ("45-90 minutes", 90)])
def test_effort_text(spark, effort, minutes):
    assert spark.range(1).select(rollups.effort_minutes(F.lit(effort))).first()[0] == minutes


def test_effort_by_catalog(spark):
    def total(*efforts):
        df = spark.createDataFrame([(e is not None, e) for e in efforts], "known boolean, effort string")
        return tuple(rollups.effort_by_catalog(df).first())

    assert total("15 minutes") == (22, "22 minutes")
    assert total(None) == (360, "6.0 hours")
    assert total(None, None) == (720, "1.5 days")


def outcomes(spark, *data):
    return spark.createDataFrame(list(data), "record_id int, class string, status string, warnings int, manual boolean, has_secret boolean")


def test_outcomes(spark):
    df = outcomes(spark, (1, "a", "success", 2, True, True), (2, "a", "success", 0, False, False),
                  (3, "b", "failed", 5, True, True), (4, "b", "success", 0, False, False))
    assert tuple(rollups.outcome_metrics(df).first()) == (4, 3, 1, 1)
    assert rollups.readiness(df).first()[0] == pytest.approx(75 - 2.5)
    advice = [r["recommendation"] for r in rollups.recommend(df).orderBy("pos").collect()]
    assert len(advice) == 5 and advice[2].startswith("1 records")
    assert rollups.recommend(df, k=3).count() == 3


def test_nothing_at_all(spark):
    none = outcomes(spark).limit(0)
    assert rollups.readiness(none).first()[0] == 0
    assert rollups.direct_share(matched(spark, "x").limit(0)).first()[0] == 0
    assert rollups.recommend(none).count() == 1


def test_readiness_never_negative(spark):
    assert rollups.readiness(outcomes(spark, (1, "a", "failed", 3, False, False))).first()[0] == 0


def heads(spark, *data):
    return spark.createDataFrame(list(data), "record_id string, name string, class string, topics array<string>")


def test_flow(spark):
    df = heads(spark, ("1", "src", "x.Source", ["t", "u"]), ("2", "cdc", "io.debezium.C", ["u"]),
               ("3", "out", "x.Sink", ["t", "u", "t"]), ("4", "lone", "x.Sink", ["z"]), ("5", "odd", "x.Other", ["t"]))
    wanted = df.select("record_id")
    assert rows(flow.dependencies_of(df, wanted)) == [("3", "cdc"), ("3", "src")]  # change capture is a source too
    edges = rows(flow.dependency_edges(df))
    assert edges == [("3", "topic:t", "t"), ("3", "topic:u", "u"), ("topic:t", "1", "t"), ("topic:u", "1", "u"),
                     ("topic:u", "2", "u")]
    plan = flow.order_plan(df).orderBy("rank").collect()
    assert [(r["name"], r["priority"], r["dependencies"], r["rank"]) for r in plan] == [
        ("cdc", 0, 0, 1), ("src", 1, 0, 2), ("lone", 2, 0, 3), ("out", 2, 3, 4), ("odd", 3, 0, 5)]
    assert flow.shared_flow(df).first()[0] is True


def test_namesakes_are_not_dependencies(spark):
    df = heads(spark, ("1", "same", "x.Source", ["t"]), ("2", "same", "x.Sink", ["t"]))
    assert flow.dependency_edges(df).count() == 0
    assert {r["dependencies"] for r in flow.order_plan(df).collect()} == {0}
    assert flow.shared_flow(df).first()[0] is True  # the second shares a topic with the first of the plan


def test_separate_flows(spark):
    df = heads(spark, ("1", "a", "x.Source", ["t"]), ("2", "b", "x.Source", ["u"]), ("3", "c", "x.Sink", ["v"]))
    assert flow.shared_flow(df).first()[0] is False
