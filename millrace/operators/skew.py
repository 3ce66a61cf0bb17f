"""Joins and orderings that stay balanced when one key holds a large share of the rows.

AQE can split a skewed shuffle partition only where both join inputs are plain shuffles. Many joins here
have an aggregate on one side, so the splitting is written out instead: hot keys are counted, and only
those are salted.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T, Window as W

from millrace import session

HOT_ROWS = 1_000_000       # a key with fewer rows than this fits one task
SMALL_ROWS = 50_000        # largest list of hot keys that is broadcast, in rows
SMALL_CHARS = 64 << 20     # and as JSON text
SALTS = 64


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality of ``keys``; columns of ``right`` carry the prefix ``_k_``."""
    return reduce(Column.__and__, [left[k].eqNullSafe(right[f"_k_{k}"]) for k in keys])


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """Keys holding more than ``hot_rows`` rows, whatever the size of the table; None when there are none.

    One pass over the key columns, run at once. The counts are partial before the shuffle, so a hot key costs one row
    per map task. The list is checkpointed, and broadcast only where a bounded count shows it to be small; a longer one is
    joined by a shuffle, whose skewed partitions AQE splits. With no hot key the caller's plan stays as simple as if skew
    did not exist.
    """
    session.shared_folder(df.sparkSession)
    counts = df.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.count(F.lit(1)).alias("_n"))
    hot = counts.where(F.col("_n") > hot_rows).drop("_n").checkpoint()
    if hot.isEmpty():
        return None
    return F.broadcast(hot) if is_small(hot) else hot


def split_hot(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of other keys, rows of hot keys)."""
    on = same_keys(df, hot, keys)
    return df.join(hot, on, "left_anti"), df.join(hot, on, "left_semi")


def salted_join(big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner",
                hot_rows: int = HOT_ROWS, salts: int = SALTS) -> DataFrame:
    """Equi join on ``on`` (inner, left, left_semi, left_anti) that spreads hot keys of ``big``.

    A row of a hot key goes to one of ``salts`` slots by a hash of its content, so a retried task repeats the
    choice; the matching rows of ``small`` are copied to every slot. Other keys use slot 0 and are not copied.
    Null keys never match, but they are spread too: left and anti joins keep their rows.
    """
    hot = hot_keys(big, on, hot_rows)
    if hot is None:
        return big.join(small, list(on), how)
    flag = hot.withColumn("_hot", F.lit(True))

    def marked(df: DataFrame) -> DataFrame:
        return df.join(flag, same_keys(df, flag, on), "left").drop(*[f"_k_{k}" for k in on])

    content = [f.name for f in big.schema.fields if not has_map(f.dataType)]
    slot = F.when(F.col("_hot"), F.pmod(F.xxhash64(*content), F.lit(salts))).otherwise(F.lit(0)).cast("int")
    left = marked(big).withColumn("_slot", slot).drop("_hot")
    slots = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = marked(small).withColumn("_slot", F.explode(slots)).drop("_hot")
    return left.join(right, [*on, "_slot"], how).drop("_slot")


def is_small(table: DataFrame) -> bool:
    """Whether a table stays within the row and text limits, by a count that stops at the row limit."""
    text = F.length(F.to_json(F.struct(*table.columns)))
    rows, chars = table.limit(SMALL_ROWS + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(text), F.lit(0))).first()
    return rows <= SMALL_ROWS and chars <= SMALL_CHARS


def bounded(table: DataFrame) -> DataFrame:
    """``table`` marked for a broadcast where a bounded count shows it to be small, else for a shuffle.

    For tables whose files or statistics say little about their rows in memory.
    """
    return F.broadcast(table) if is_small(table) else table.hint("merge")


def lookup(big: DataFrame, table: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join with a reference table, the same lazy plan for every size, so it also holds on a stream.

    Statistics and AQE broadcast a small table; where both sides are shuffled, AQE splits the partitions of hot keys.
    """
    return big.join(table, list(on), how)


def dense_index(df: DataFrame, order: Sequence[str], name: str = "_index") -> DataFrame:
    """``numbered`` without the partition."""
    return numbered(df, order, name).drop("_part")


def numbered(df: DataFrame, order: Sequence[str], name: str = "_index") -> DataFrame:
    """Number all rows 0, 1, 2, ... in the order of ``order`` without sorting in one task.

    Rows are range partitioned and sorted, so equal leading values still spread over tasks. The sorted rows are
    checkpointed once: partition number and place inside the partition are read twice and must agree.
    """
    session.shared_folder(df.sparkSession)
    placed = (
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .select("*", F.monotonically_increasing_id().alias("_place"))
        .checkpoint()
        .withColumn("_part", F.shiftright("_place", 33))
        .withColumn("_place", F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)))
    )
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = (  # one row per partition
        placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_place"))
        .drop("_place", "_start")
    )


def running_totals(df: DataFrame, groups: Sequence[str], order: Sequence[str], value: str, name: str = "_total",
                   index: str = "_index") -> DataFrame:
    """Add ``index`` (the place among all rows, by group and order) and the running sum of ``value`` within the group.

    A group may span many range partitions: each task adds up its own part of it, and the sums of the parts before, one
    row per partition and group, are added. No task holds more of a group than a range partition does.
    """
    placed = numbered(df, [*groups, *order], index)
    part = W.partitionBy("_part", *groups).orderBy(index).rowsBetween(W.unboundedPreceding, W.currentRow)
    before = W.partitionBy(*groups).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = placed.groupBy("_part", *groups).agg(F.sum(value).alias("_sum")).select(
        F.col("_part").alias("_from"), *[F.col(g).alias(f"_k_{g}") for g in groups],
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    summed = placed.withColumn(name, F.sum(value).over(part))
    return (
        summed.join(starts, (F.col("_part") == F.col("_from")) & same_keys(summed, starts, groups))
        .withColumn(name, F.col(name) + F.col("_start"))
        .drop("_part", "_from", "_start", *[f"_k_{g}" for g in groups])
    )


def has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.MapType):
        return True
    if isinstance(kind, T.ArrayType):
        return has_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(has_map(f.dataType) for f in kind.fields)
    return False
