"""Capture and selection S1-S9. Selections are plain filters, so they reach the scan and work on streams."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter


# --- S1 ----------------------------------------------------------------------------------------------------

class Position(NamedTuple):
    """How far a table has been read: the last timestamp and the last increasing id."""

    ts: object = None
    id: object = None


def incremental_extract(df: DataFrame, mode: str, inc_col: str | None = None, ts_col: str | None = None,
                        position: Position | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows newer than ``position``, and a one-row frame (ts, id) with the next position.

    ``incrementing`` compares the id, ``timestamp`` the time, ``timestamp+incrementing`` the time and then the id.
    ``bulk`` and any other mode read everything. Without a position everything is new.
    """
    at = position or Position()
    new: Column | None = None
    if mode == "incrementing" and at.id is not None:
        new = F.col(inc_col) > F.lit(at.id)
    elif mode == "timestamp" and at.ts is not None:
        new = F.col(ts_col) > F.lit(at.ts)
    elif mode == "timestamp+incrementing" and at.ts is not None:
        # The first conjunct alone reaches the scan as a range filter.
        ts, past = F.col(ts_col), F.lit(at.ts)
        new = (ts >= past) & ((ts > past) | (F.col(inc_col) > F.lit(at.id)))
    rows = df if new is None else df.where(new)

    no_ts, no_id = F.lit(None).cast("timestamp").alias("ts"), F.lit(None).cast("bigint").alias("id")
    if mode == "incrementing":
        found = rows.agg(F.max(inc_col).alias("id")).select(no_ts, "id")
    elif mode == "timestamp":
        found = rows.agg(F.max(ts_col).alias("ts")).select("ts", no_id)
    elif mode == "timestamp+incrementing":
        found = rows.agg(F.max(F.struct(F.col(ts_col).alias("ts"), F.col(inc_col).alias("id"))).alias("m")).select("m.*")
    else:
        found = rows.limit(0).agg(F.count(F.lit(1))).select(no_ts, no_id)
    kept = [F.coalesce(F.col(n), F.lit(v)).alias(n) if v is not None else F.col(n) for n, v in at._asdict().items()]
    return rows, found.select(*kept)


# --- S2, S4, S5 --------------------------------------------------------------------------------------------

def names(text: str | Sequence[str] | None) -> list[str]:
    """Comma text or a list, trimmed, without blanks."""
    parts = text.split(",") if isinstance(text, str) else (text or [])
    return [p.strip() for p in parts if p.strip()]


def select_tables(df: DataFrame, include: str | Sequence[str] | None = None, exclude: str | Sequence[str] | None = None,
                  table: str = "table", schemas: str | Sequence[str] | None = None, schema: str = "schema") -> DataFrame:
    """Keep rows of the included tables; the exclude list counts only when there is no include list."""
    if names(schemas):
        df = df.where(F.col(schema).isin(names(schemas)))
    if names(include):
        return df.where(F.col(table).isin(names(include)))
    if names(exclude):
        return df.where(~F.coalesce(F.col(table).isin(names(exclude)), F.lit(False)))
    return df


def subscribe(df: DataFrame, topics: str | Sequence[str] | None = None, pattern: str | None = None,
              topic: str = "topic") -> DataFrame:
    """Records of the named topics, else of topics whose whole name matches the pattern."""
    if names(topics):
        return df.where(F.col(topic).isin(names(topics)))
    if pattern:
        return df.where(F.col(topic).rlike(rf"\A(?:{pattern})\z"))
    raise ValueError("give topics or topics.regex")


def start_position(df: DataFrame, policy: str, offset: str, stored: object = None) -> DataFrame:
    """``earliest`` reads everything, ``latest`` only what lies beyond the stored offset, or beyond all that is there."""
    if policy not in ("earliest", "latest"):
        raise ValueError(f"unknown start position {policy!r}")
    if policy == "earliest":
        return df
    return df.where(F.lit(False) if stored is None else F.col(offset) > F.lit(stored))


# --- S3 ----------------------------------------------------------------------------------------------------

# Snapshot modes of change-data sources.
SNAPSHOT_MODES = ("initial", "never", "initial_only", "when_needed", "always")


def snapshot_mode(text: str | None) -> str:
    return text if text in SNAPSHOT_MODES else "initial"


def snapshot_then_changes(snapshot: DataFrame, changes: DataFrame, mode: str | None = None,
                          has_position: bool = False, op: str = "op") -> DataFrame:
    """S3: the rows one run delivers. Snapshot rows carry op ``r``.

    ``never`` skips the snapshot, ``initial_only`` the changes, ``always`` neither. ``initial`` (also for unknown text)
    and ``when_needed`` take the snapshot only when nothing has been read before.
    """
    mode = snapshot_mode(mode)
    if mode == "never" or (mode in ("initial", "when_needed") and has_position):
        return changes
    first = snapshot.withColumn(op, F.lit("r"))
    return first if mode == "initial_only" else first.unionByName(changes, allowMissingColumns=True)


# --- S6 ----------------------------------------------------------------------------------------------------

def payload_format(class_name: str | None) -> str:
    """bytes, string or json from a converter or deserializer class name; unknown names mean bytes."""
    name = (class_name or "").rsplit(".", 1)[-1]
    for part, fmt in (("ByteArray", "bytes"), ("String", "string"), ("Json", "json")):
        if part in name:
            return fmt
    return "bytes"


def decode(df: DataFrame, column: str, fmt: str, schema: T.StructType | str | None = None,
           out: str | None = None) -> DataFrame:
    """Payload bytes to text or columns. JSON that does not fit becomes null; W16 separates it."""
    raw = F.col(column)
    if fmt == "string":
        value = raw.cast("string")
    elif fmt == "json":
        value = F.from_json(raw.cast("string"), schema)
    else:
        value = raw.cast("binary")
    return df.withColumn(out or column, value)


# --- S7, S8, S9 --------------------------------------------------------------------------------------------

def read_files(spark: SparkSession, path: str, fmt: str = "json", schema: T.StructType | str | None = None,
               tail: bool = False, **options: object) -> DataFrame:
    """A file source, read once, or followed as a stream with ``tail`` (then a schema is needed)."""
    if tail and schema is None and fmt != "text":
        raise ValueError("following files needs a schema")
    reader = (spark.readStream if tail else spark.read).format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_query(spark: SparkSession, query: str | None = None, table: str | None = None,
               include: str | Sequence[str] | None = None, **views: DataFrame) -> DataFrame:
    """A query wins over a table name, which wins over a list of tables (read as one). ``views`` name inputs."""
    if query:
        return spark.sql(query, **views)
    if table:
        return views[table] if table in views else spark.table(table)
    listed = [views[n] if n in views else spark.table(n) for n in names(include)]
    if not listed:
        raise ValueError("give a query, a table or a list of tables")
    out = listed[0]
    for df in listed[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def source_pace(max_files: int | None = None, max_bytes: int | None = None) -> dict[str, object]:
    """Reader options that bound one micro-batch."""
    pairs = {"maxFilesPerTrigger": max_files, "maxBytesPerTrigger": max_bytes}
    return {k: v for k, v in pairs.items() if v is not None}


def pace(writer: DataStreamWriter, interval_ms: int | None = None) -> DataStreamWriter:
    """Poll every ``interval_ms``; without an interval, read what is there and stop."""
    if interval_ms:
        return writer.trigger(processingTime=f"{interval_ms} milliseconds")
    return writer.trigger(availableNow=True)
