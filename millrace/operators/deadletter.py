"""Dead letters: W16 splits records, W17 finds breaches of the failure threshold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T, Window as W

from millrace.operators import skew

CORRUPT = "_corrupt_record"


def tag_records(df: DataFrame, column: str, schema: T.StructType, null_policy: str = "ignore",
                malformed_policy: str = "warn", out: str = "parsed") -> DataFrame:
    """Parse JSON text once and add ``out`` and ``verdict``: ``good``, ``dead``, ``delete`` or ``drop``.

    Null values: ``ignore`` drops, ``delete`` marks a deletion, ``warn`` dead-letters, ``fail`` stops the job.
    Malformed text: ``ignore`` drops, ``warn`` dead-letters, ``fail`` stops the job.
    """
    nulls = {"ignore": F.lit("drop"), "delete": F.lit("delete"), "warn": F.lit("dead"),
             "fail": F.raise_error(F.lit("null record value"))}
    broken = {"ignore": F.lit("drop"), "warn": F.lit("dead"),
              "fail": F.raise_error(F.concat(F.lit("malformed record: "), F.col(column)))}
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(column, full, {"columnNameOfCorruptRecord": CORRUPT})
    verdict = (
        F.when(F.col(column).isNull(), nulls[null_policy].cast("string"))
        .when(F.col("_parsed").isNull() | F.col(f"_parsed.{CORRUPT}").isNotNull(),
              broken[malformed_policy].cast("string"))
        .otherwise(F.lit("good"))
    )
    # ``inline`` keeps a later filter on the verdict from being pushed below the parse and parsing twice.
    return (
        df.select("*", F.inline(F.array(F.struct(parsed.alias("_parsed")))))
        .withColumn("verdict", verdict)
        .withColumn(out, F.when(F.col("verdict") == "good", F.col("_parsed").dropFields(CORRUPT)))
        .drop("_parsed")
    )


def split_bad_records(df: DataFrame, column: str, schema: T.StructType, null_policy: str = "ignore",
                      malformed_policy: str = "warn", out: str = "parsed") -> tuple[DataFrame, DataFrame]:
    """(good and deleting records, dead letters). Persist or write ``tag_records`` once to read both cheaply."""
    tagged = tag_records(df, column, schema, null_policy, malformed_policy, out)
    good = tagged.where(F.col("verdict").isin("good", "delete"))
    return good, tagged.where(F.col("verdict") == "dead").drop(out)


def check_window(size: int | None, threshold: int | None) -> bool:
    """Whether the failure threshold is on; a threshold above the window size is an error."""
    if not size:
        return False
    if threshold and threshold > size:
        raise ValueError("threshold cannot be greater than window size")
    return bool(threshold)


def nack_breaches(df: DataFrame, keys: Sequence[str], order: Sequence[str], bad: Column, size: int | None,
                  threshold: int | None, hot_rows: int = skew.HOT_ROWS) -> DataFrame:
    """Positions where the last ``size`` records of a key hold at least ``threshold`` failures.

    Off (no rows) when either number is 0 or absent. ``order`` must identify a record within its key. The count is a
    difference of two running sums, so its cost does not grow with ``size``. Keys with more than ``hot_rows`` records
    get theirs across tasks and meet the sum of ``size`` records before by a join on the place; the rest use one window
    per key.
    """
    narrow = df.select(*keys, *order, F.coalesce(bad, F.lit(False)).cast("int").alias("_bad"))
    if not check_window(size, threshold):
        return narrow.select(*keys, *order, F.lit(0).cast("bigint").alias("failures")).limit(0)

    def recent(rows: DataFrame, groups: Sequence[str], by: Sequence[str]) -> DataFrame:
        place = W.partitionBy(*groups).orderBy(*by)
        running = F.sum("_bad").over(place.rowsBetween(W.unboundedPreceding, W.currentRow))
        return (
            rows.withColumn("_sum", running)
            .withColumn("failures", F.col("_sum") - F.coalesce(F.lag("_sum", size).over(place), F.lit(0)))
        )

    def breaches(rows: DataFrame) -> DataFrame:
        return rows.where(F.col("failures") >= threshold).select(*keys, *order, "failures")

    hot = skew.hot_keys(narrow, keys, hot_rows)
    if hot is None:
        return breaches(recent(narrow, keys, order))

    cold_rows, hot_part = skew.split_hot(narrow, keys, hot)
    summed = skew.running_totals(hot_part, keys, order, "_bad", "_sum")
    past = summed.select((F.col("_index") + size).alias("_later"), F.col("_sum").alias("_past"),
                         *[F.col(k).alias(f"_k_{k}") for k in keys])
    spread = summed.join(past, (F.col("_index") == F.col("_later")) & skew.same_keys(summed, past, keys), "left")
    spread = spread.withColumn("failures", F.col("_sum") - F.coalesce("_past", F.lit(0)))
    return breaches(recent(cold_rows, keys, order)).unionByName(breaches(spread))
