"""W5, W8 and the other write modes on a stored table too large to write anew: copy-on-write by slice.

A table is a folder of Parquet files with a folder ``_slice=N`` for each slice, a bounded number of rows that are rewritten together. A batch looks up its
keys in the key column of the table alone (a semi join, so the target isn't shuffled where the batch is small), reads the slices that hold one of
them, and replaces those by Spark's dynamic partition overwrite. All other files stay as they are, under their names. New keys make new slices.

Spark writes replaced slices to a staging folder first and moves them when the job has succeeded, so a failed batch changes nothing; as every mode
here gives the same table when its batch is repeated, a job that fails while it moves folders is run again. Deleted rows stay as
tombstones, which keep a slice from becoming empty and a late, older change from bringing its row back; ``read`` leaves them out.

One writer at a time per table. Keys identify a row: a batch that repeats a key needs an ``order``, and null keys are refused.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from millrace.operators import steps, writes
from millrace.session import written

SLICE, GONE, ORDER = "_slice", "_deleted", "_order"
#: Rows of a new slice. A slice is the least that is rewritten.
SLICE_ROWS = 1_000_000


def _write(rows: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Replace the slices that ``rows`` hold; a slice is one task's work and one sorted file."""
    (rows.repartition(SLICE).sortWithinPartitions(SLICE, *keys).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(SLICE).parquet(path))


def _stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn(SLICE, F.col(SLICE).cast("long"))


def create(rows: DataFrame, path: str, keys: Sequence[str], order: str = "", slice_of: Column | None = None,
           slice_rows: int = SLICE_ROWS) -> None:
    """Store ``rows`` as a table: by ranges of the keys, or by ``slice_of``, a non-negative number per row.

    ``order`` names and types the columns that will tell older from newer versions of a row (``ts timestamp, seq bigint``). They are kept as
    hidden values, null for the first rows, which any change may replace. A table without rows holds a tombstone without keys.
    """
    new = rows.withColumn(GONE, F.lit(False)).withColumn(ORDER, F.lit(None).cast(StructType.fromDDL(order or "none boolean")))
    if slice_of is not None:
        _write(new.withColumn(SLICE, slice_of.cast("long")), path, keys)
    elif not _append(new, path, keys, 0, slice_rows):
        nothing = rows.sparkSession.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields])
        none = nothing.withColumn(GONE, F.lit(True)).withColumn(ORDER, F.lit(None).cast(new.schema[ORDER].dataType))
        _write(none.withColumn(SLICE, F.lit(0).cast("long")), path, keys)


def _append(rows: DataFrame, path: str, keys: Sequence[str], first: int, slice_rows: int) -> int:
    """Rows of new keys as slices of their own, by ranges of the keys; how many they are."""
    count = rows.count()
    if count:
        ranged = rows.repartitionByRange(-(-count // slice_rows), *keys).withColumn(SLICE, F.lit(first) + F.spark_partition_id())
        ranged.sortWithinPartitions(*keys).write.mode("append").partitionBy(SLICE).parquet(path)
    return count


def read(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a table, without tombstones and hidden columns."""
    return spark.read.parquet(path).where(~F.col(GONE)).drop(GONE, ORDER, SLICE)


def _columns(spark: SparkSession, path: str) -> list[str]:
    return [c for c in spark.read.parquet(path).columns if c not in (GONE, ORDER, SLICE)]


def places(spark: SparkSession, path: str, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys of ``rows`` that the table holds, with their slices. Reads the table's key columns only."""
    held = _stored(spark, path).select(*keys, SLICE)
    return held.join(rows.select(*keys), list(keys), "left_semi")


def _checked(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, written once: the last by ``order``, or an error where a key is null or, without an order, repeats."""
    if order:
        rows = writes.last_per_key(rows, keys, order)
    rows = written(rows, "batch")
    null_key = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    if not rows.where(null_key).isEmpty():
        raise ValueError(f"a row without {list(keys)} can't be found again")
    if not order and not rows.groupBy(*keys).count().where("count > 1").isEmpty():
        raise ValueError(f"the batch repeats {list(keys)}: give an order")
    return rows


def _apply(spark: SparkSession, path: str, rows: DataFrame, keys: Sequence[str], merged: dict[str, Column], gone: Column, order: Column,
           insert: Column | None = None, slice_rows: int = SLICE_ROWS) -> int:
    """Replace the touched slices and append the new keys; the number of slices replaced.

    ``merged`` gives a column from ``_t`` (the stored row, null for a new key) and ``_r`` (the row of the batch); ``insert`` says which new
    keys are added, all by default.
    """
    table = _stored(spark, path)
    found = written(places(spark, path, rows, keys), "places")
    # As many numbers as the table has folders at most, which Spark's driver lists anyway.
    touched = [r[0] for r in found.select(SLICE).distinct().collect()]
    columns = _columns(spark, path)

    def outcome(both: DataFrame) -> DataFrame:
        newer = F.col("_r").isNotNull() & ~F.coalesce(F.col(f"_t.{ORDER}") > order, F.lit(False))
        pick = lambda new, old: F.when(newer, new).otherwise(F.col(f"_t.{old}"))
        return both.select(*[pick(merged[c], c).cast(table.schema[c].dataType).alias(c) for c in columns],
                           pick(gone, GONE).alias(GONE), pick(order, ORDER).cast(table.schema[ORDER].dataType).alias(ORDER), SLICE)

    batch = rows.select(*keys, F.struct(*rows.columns).alias("_r"))
    last = table.agg(F.max(SLICE)).first()[0] or 0
    unseen = batch.join(found.select(*keys), list(keys), "left_anti").withColumn("_t", F.lit(None).cast(table.drop(SLICE).schema.simpleString()))
    unseen = outcome(unseen.withColumn(SLICE, F.lit(0).cast("long")).where(insert if insert is not None else F.lit(True))).drop(SLICE)
    unseen = written(unseen, "new_rows")
    if touched:
        old = table.where(F.col(SLICE).isin(touched)).select(*keys, SLICE, F.struct(*columns, GONE, ORDER).alias("_t"))
        _write(outcome(old.join(batch, list(keys), "left")), path, keys)
    _append(unseen, path, keys, last + 1, slice_rows)
    return len(touched)


def apply_changes(spark: SparkSession, path: str, changes: DataFrame, keys: Sequence[str], order: Sequence[str], slice_rows: int = SLICE_ROWS) -> int:
    """Fold change records into the table at ``path``; returns the number of slices replaced.

    The change with the greatest ``order`` per key wins, also over what an earlier batch stored, so batches may come late or twice.
    """
    return upsert(spark, path, steps.unwrap_cdc(changes, drop_tombstones=True), keys, order, F.col("_r.__deleted"), slice_rows)


def upsert(spark: SparkSession, path: str, rows: DataFrame, keys: Sequence[str], order: Sequence[str] = (), gone: Column | None = None,
           slice_rows: int = SLICE_ROWS) -> int:
    """W3 on a stored table: existing keys change, new ones are added, columns that ``rows`` lacks keep their values. ``gone`` marks deletions."""
    rows = _checked(rows, keys, order)
    stored = _columns(spark, path)
    merged = {c: F.col(f"_r.{c}") if c in rows.columns else F.col(f"_t.{c}") for c in stored}
    deleted = F.lit(False) if gone is None else F.coalesce(gone, F.lit(False))
    new_order = F.struct(*[F.col(f"_r.{c}").alias(c) for c in order]) if order else F.lit(None).cast(
        _stored(spark, path).schema[ORDER].dataType)
    # A deletion keeps the stored values: it may carry none but its keys.
    merged = {c: v if c in keys else F.when(deleted, F.col(f"_t.{c}")).otherwise(v) for c, v in merged.items()}
    return _apply(spark, path, rows, keys, merged, deleted, new_order, None, slice_rows)


def write_model(spark: SparkSession, path: str, rows: DataFrame, keys: Sequence[str], model: str = "replace_one", business_keys: Sequence[str] = (),
                now: Column | None = None, order: Sequence[str] = (), slice_rows: int = SLICE_ROWS) -> int:
    """Apply ``rows`` to the table at ``path`` under a document write model; returns the number of slices replaced."""
    if model == "replace_one_business_key":
        keys = business_keys or keys
    if model == "insert_one":
        first = (_stored(spark, path).agg(F.max(SLICE)).first()[0] or 0) + 1
        new = rows.withColumn(GONE, F.lit(False)).withColumn(ORDER, F.lit(None).cast(_stored(spark, path).schema[ORDER].dataType))
        _append(new, path, keys, first, slice_rows)
        return 0
    if model == "delete_one":
        rows = rows.select(*keys).distinct().withColumn("__deleted", F.lit(True))
        rows = _checked(rows, keys, ())
        stored = _columns(spark, path)
        return _apply(spark, path, rows, keys, {c: F.col(f"_t.{c}") for c in stored}, F.lit(True), F.col(f"_t.{ORDER}"), F.lit(False), slice_rows)
    if model == "update_one_timestamps":
        now = F.current_timestamp() if now is None else now
        rows = _checked(rows, keys, order)
        stored = _columns(spark, path)
        merged = {c: F.col(f"_r.{c}") if c in rows.columns else F.col(f"_t.{c}") for c in stored}
        alive = F.when(~F.col(f"_t.{GONE}"), F.col("_t.inserted_ts"))
        merged |= {"inserted_ts": F.coalesce(alive, now), "modified_ts": now}
        return _apply(spark, path, rows, keys, merged, F.lit(False), F.lit(None).cast(_stored(spark, path).schema[ORDER].dataType), None, slice_rows)
    return upsert(spark, path, rows, keys, order, slice_rows=slice_rows)
