"""Roll-ups A15-A18, A23-A25 over matched records, outcomes and issues. Every result is a partial aggregate away."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F

from millrace.functions import values


def _count(condition: Column) -> Column:
    return F.count_if(condition)


# --- A15 ---------------------------------------------------------------------------------------------------

def plan_summary(matched: DataFrame) -> DataFrame:
    """Total, direct, manual and unsupported records, and the expected downtime."""
    status = F.coalesce(F.col("status"), F.lit(""))
    blocked = status.isin("manual", "unsupported")
    counts = matched.agg(
        F.count(F.lit(1)).alias("total"), _count(status == "supported").alias("direct"),
        _count((status != "supported") & ~blocked).alias("manual"), _count(blocked).alias("unsupported"))
    slow = (F.col("manual") > 2) | (F.col("unsupported") > 0)
    return counts.withColumn("downtime", F.when(slow, "2-5 minutes").otherwise("< 30 seconds"))


# --- A16 ---------------------------------------------------------------------------------------------------

def _minutes(status: Column, table: dict[str, int], other: int) -> Column:
    out = F.lit(other)
    for name, minutes in table.items():
        out = F.when(status == name, minutes).otherwise(out)
    return out


def effort_by_status(audited: DataFrame) -> DataFrame:
    """Minutes of work for records and their ``steps``, and the range they fall in."""
    record = _minutes(F.col("status"), values.RECORD_MINUTES, values.OTHER_RECORD_MINUTES)
    steps = F.aggregate("steps", F.lit(0), lambda total, step: total + _minutes(
        step["status"], values.STEP_MINUTES, values.OTHER_STEP_MINUTES))
    total = F.col("minutes")
    hours = F.floor(total / 60)
    label = (
        F.when(total <= 60, "< 1 hour")
        .when(total <= 240, F.format_string("%d-%d hours", hours, hours + 1))
        .when(total <= 480, "4-8 hours")
        .otherwise("1-2 days")
    )
    summed = F.coalesce(F.sum((record + steps).cast("bigint")), F.lit(0))
    return audited.agg(summed.alias("minutes")).withColumn("effort", label)


# --- A17 ---------------------------------------------------------------------------------------------------

def effort_minutes(effort: Column) -> Column:
    """``N minutes``, ``N hour(s)``, or an hour for other text. A range counts with its upper bound."""
    number = F.coalesce(F.regexp_extract(effort, r"^(?:\d+-)?(\d+) (?:minutes|hour)", 1).try_cast("int"), F.lit(0))
    return (
        F.when(F.contains(effort, F.lit("minutes")), number)
        .when(F.contains(effort, F.lit("hour")), number * 60)
        .otherwise(60)
    )


def effort_by_catalog(matched: DataFrame) -> DataFrame:
    """Minutes by catalog estimates (unknown records 240), half as much again for testing, and as text."""
    each = F.when(F.col("known"), effort_minutes(F.coalesce("effort", F.lit("")))).otherwise(240)
    total = F.col("minutes")
    label = (
        F.when(total < 60, F.format_string("%d minutes", total))
        .when(total < 480, F.format_string("%.1f hours", total / 60))
        .otherwise(F.format_string("%.1f days", total / 480))
    )
    summed = F.coalesce(F.sum(each), F.lit(0))
    return matched.agg(F.floor(summed * 3 / 2).cast("bigint").alias("minutes")).withColumn("effort", label)


# --- A18, A23 ----------------------------------------------------------------------------------------------

def direct_share(matched: DataFrame) -> DataFrame:
    """Percent of records that need no manual work; 0 when there are none."""
    share = F.try_divide(_count(F.col("status") == "supported") * 100.0, F.count(F.lit(1)))
    return matched.agg(F.coalesce(share, F.lit(0.0)).alias("readiness"))


def _outcome_counts() -> list[Column]:
    ok = F.col("status") == "success"
    return [F.count(F.lit(1)).alias("total"), _count(ok).alias("successful"), _count(~ok).alias("failed"),
            _count(ok & (F.col("warnings") > 0)).alias("with_warnings")]


def outcome_metrics(outcomes: DataFrame) -> DataFrame:
    """Total, successful, failed and warned records."""
    return outcomes.agg(*_outcome_counts())


def write_observed(rows: DataFrame, path: str, metrics: Sequence[Column], mode: str = "errorifexists") -> dict[str, object]:
    """Write ``rows`` and return the metrics of what was written, counted in the pass that writes it."""
    seen = Observation()
    rows.observe(seen, *metrics).write.mode(mode).parquet(path)
    return seen.get


def write_outcomes(outcomes: DataFrame, path: str) -> dict[str, object]:
    """Write the outcomes and return their metrics without a second scan."""
    return write_observed(outcomes, path, _outcome_counts())


def class_counts(outcomes: DataFrame) -> DataFrame:
    """Records per class."""
    return outcomes.groupBy("class").agg(F.count(F.lit(1)).alias("n"))


def readiness(outcomes: DataFrame) -> DataFrame:
    """Percent successful minus 10 times the share with warnings, at least 0; 0 when there are none."""
    score = F.try_divide(F.col("successful") * 100.0 - F.col("with_warnings") * 10.0, F.col("total"))
    return outcome_metrics(outcomes).select(F.greatest(F.coalesce(score, F.lit(0.0)), F.lit(0.0)).alias("readiness"))


# --- A24 ---------------------------------------------------------------------------------------------------

def severity_rank(severity: Column) -> Column:
    return F.when(severity == "error", 0).when(severity == "warning", 1).otherwise(2)


def severity_counts(issues: DataFrame) -> DataFrame:
    """Issues per severity in the order error, warning, info."""
    return (
        issues.groupBy("severity").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("rank", severity_rank(F.col("severity"))).orderBy("rank")
    )


def severity_messages(issues: DataFrame) -> DataFrame:
    """Each distinct message of a severity with its count and number of records. No list is collected."""
    return issues.groupBy("severity", "message", "suggestion").agg(F.count(F.lit(1)).alias("n"))


# --- A25 ---------------------------------------------------------------------------------------------------

def recommend(outcomes: DataFrame, k: int | None = None, failure_rate: float = 0.2) -> DataFrame:
    """A25 (and the top ``k`` of A24): advice that follows from the outcomes, in fixed order.

    One aggregate of flags; secrets and manual work count in successful records only.
    """
    ok = F.col("status") == "success"
    failed_share = F.coalesce(F.try_divide(_count(~ok), F.count(F.lit(1))), F.lit(0.0))
    flags = outcomes.agg(
        (failed_share > failure_rate).alias("many_failed"), _count(ok & F.col("has_secret")).alias("secret"),
        _count(ok & F.col("manual")).alias("manual"), _count(ok).alias("successful"))
    advice = F.array_compact(F.array(
        F.when(F.col("many_failed"), "High failure rate. Review definitions and their compatibility."),
        F.when(F.col("secret") > 0, "Review masked credentials before deployment."),
        F.when(F.col("manual") > 0, F.format_string("%d records need manual configuration.", F.col("manual"))),
        F.when(F.col("successful") > 0, "Test in a development environment before production."),
        F.lit("Configure the schema registry again if one is used."),
    ))
    rows = flags.select(F.posexplode(advice).alias("pos", "recommendation"))
    return rows if k is None else rows.where(F.col("pos") < k)
