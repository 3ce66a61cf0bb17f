"""Output layout W9-W14 and W18-W21: partition columns, file rolling, formats, clustering, fan-out."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, DataFrameWriter, functions as F, types as T

from millrace.operators import skew
from millrace.sources import capture


# --- W9, W10 -----------------------------------------------------------------------------------------------

def path_segments(path_format: str) -> list[tuple[str, str]]:
    """(column, date pattern) per ``/``-separated segment.

    A segment is a bare pattern or names its column: ``'name='pattern``, ``'name'=pattern`` or ``name=pattern``. ``YYYY`` is the
    calendar year, as connector configs use it.
    """
    out = []
    for i, segment in enumerate(path_format.strip("/").split("/")):
        named = re.fullmatch(r"'?([^'=]+)(?:='|'?=)(.+)", segment)
        name, pattern = named.groups() if named else (f"part{i}", segment)
        out.append((name, pattern.replace("Y", "y")))
    return out


def partition_by_time(df: DataFrame, ts: str, path_format: str) -> tuple[DataFrame, list[str]]:
    """Add one column per path segment; returns the frame and the partition columns."""
    segments = path_segments(path_format)
    return df.withColumns({n: F.date_format(ts, p) for n, p in segments}), [n for n, _ in segments]


def partition_by_field(df: DataFrame, field: str) -> tuple[DataFrame, list[str]]:
    """Partition by a record field; a dotted name is lifted out of its struct."""
    if "." in field and field not in df.columns:
        name = field.rsplit(".", 1)[-1]
        return df.withColumn(name, F.col(field)), [name]
    return df, [field]


# --- W13 ---------------------------------------------------------------------------------------------------

def cluster_layout(df: DataFrame, part_cols: str | Sequence[str], cluster_cols: str | Sequence[str] = ()) -> DataFrame:
    """Bring rows of a partition value together and sort them by the cluster columns.

    The rows are range partitioned on partition columns, then cluster columns, then a content hash. A value with a
    third of all rows therefore becomes several tasks and files, cut along the cluster columns, and small values share
    a task.
    """
    parts, clusters = _listed(part_cols), _listed(cluster_cols)
    lead = [*parts, *clusters]
    rest = [f.name for f in df.schema.fields if f.name not in lead and not skew.has_map(f.dataType)]
    spread = [F.xxhash64(*rest)] if rest else []
    return df.repartitionByRange(*lead, *spread).sortWithinPartitions(*lead)


def _as_number(df: DataFrame, name: str) -> Column:
    """A column as a double in the same order; of text, its first six bytes."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        head = F.rpad(F.hex(F.substring(F.col(name).cast("binary"), 1, 6)), 12, "0")
        return F.conv(head, 16, 10).cast("double")
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(name).cast("timestamp")).cast("double")
    return F.col(name).cast("double")


def interleaved_layout(df: DataFrame, columns: str | Sequence[str], partitions: int, bits: int = 6) -> DataFrame:
    """W13 over several columns: files that are narrow in each of them, so that a filter on any one skips most files.

    Each column is ranked into ``2 ** bits`` parts of about equally many rows, by quantiles of one aggregate over all columns; the bits of the
    ranks take turns in one number (a Z-order curve) that rows are range partitioned and sorted by. Nulls come first. A content
    hash behind the number splits values that hold very many rows.
    """
    names = _listed(columns)
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    cuts = df.agg(*[F.percentile_approx(_as_number(df, n), shares, 10_000).alias(n) for n in names]).first()
    # A rank is the number of cuts up to the value, so values that hold several cuts leave ranks out and stay in order.
    def rank_of(name: str) -> Column:
        value, rank = _as_number(df, name), F.when(F.lit(False), 0)
        for number, cut in sorted(((k + 1, cut) for k, cut in enumerate(cuts[name] or [])), reverse=True):
            rank = rank.when(value >= cut, number)
        return rank.otherwise(0)

    ranks = {f"_rank{k}": rank_of(n) for k, n in enumerate(names)}
    z = F.lit(0).cast("long")
    for bit in range(bits):
        for place, rank in enumerate(ranks):
            z = z.bitwiseOR(F.shiftleft(F.shiftright(F.col(rank).cast("long"), bit).bitwiseAND(F.lit(1)), bit * len(names) + place))
    content = [f.name for f in df.schema.fields if not skew.has_map(f.dataType)]
    ranged = df.withColumns(ranks).withColumn("_z", z).repartitionByRange(partitions, "_z", F.xxhash64(*content))
    return ranged.sortWithinPartitions("_z", *names).drop("_z", *ranks)


def bucketed_writer(df: DataFrame, buckets: int, keys: str | Sequence[str],
                    cluster_cols: str | Sequence[str] = ()) -> DataFrameWriter:
    """W13 for tables: ``saveAsTable`` keeps rows hashed by ``keys``, so later joins on them need no shuffle."""
    names = _listed(keys)
    return df.write.bucketBy(buckets, *names).sortBy(*(_listed(cluster_cols) or names))


def _listed(names: str | Sequence[str]) -> list[str]:
    return [n.strip() for n in names.split(",") if n.strip()] if isinstance(names, str) else list(names)


# --- W11, W12, W14 -----------------------------------------------------------------------------------------

def choose_format(format_class: str | None) -> str:
    """``json`` unless the class name says parquet. Avro, which this build cannot write, is refused."""
    name = (format_class or "").lower()
    if "avro" in name:
        raise ValueError(f"the format of {format_class} is not available; use parquet or json")
    return "parquet" if "parquet" in name else "json"


# Codec names of connector configs that Spark spells differently.
CODECS = {"gz": "gzip", "none": "none", "uncompressed": "none"}

# Write dispositions of warehouse sinks.
DISPOSITIONS = {"WRITE_APPEND": "append", "WRITE_TRUNCATE": "overwrite", "WRITE_EMPTY": "errorifexists"}


def write_disposition(name: str | None) -> str:
    """Spark save mode for append, truncate or fail-if-not-empty; missing means append."""
    if not name:
        return "append"
    if name.upper() not in DISPOSITIONS:
        raise ValueError(f"unknown write disposition {name!r}; use one of {sorted(DISPOSITIONS)}")
    return DISPOSITIONS[name.upper()]


def roll_files(writer: DataFrameWriter, max_rows: int | None) -> DataFrameWriter:
    """At most ``max_rows`` records per file. The rotation interval is a stream trigger, see ``pace``."""
    return writer.option("maxRecordsPerFile", max_rows) if max_rows else writer


def file_writer(df: DataFrame, format_class: str | None = None, compression: str | None = None,
                partitions: Sequence[str] = (), flush_size: int | None = None,
                disposition: str | None = None) -> DataFrameWriter:
    """W9-W14 together: a writer ready for ``save(path)``."""
    writer = df.write.format(choose_format(format_class)).mode(write_disposition(disposition))
    if compression:
        writer = writer.option("compression", CODECS.get(compression.lower(), compression.lower()))
    if partitions:
        writer = writer.partitionBy(*partitions)
    return roll_files(writer, flush_size)


# --- W18, W21 ----------------------------------------------------------------------------------------------

def target_name(name_format: str | None = None, topic: str = "topic") -> Column:
    """Target of a record: its topic, or the format text with ``${topic}`` replaced."""
    if not name_format:
        return F.col(topic)
    return F.replace(F.lit(name_format), F.lit("${topic}"), F.col(topic))


def fan_out_by_topic(df: DataFrame, name_format: str | None = None, topic: str = "topic", out: str = "target") -> DataFrame:
    """Add the target name of every record; write with ``partitionBy(out)`` to feed all targets in one job.

    With many targets apply ``cluster_layout`` on ``out`` first, else every task opens a file per target.
    """
    return df.withColumn(out, target_name(name_format, topic))


def mirror_topics(df: DataFrame, topics: str | Sequence[str] = (), pattern: str | None = None, prefix: str = "",
                  topic: str = "topic", out: str = "target") -> DataFrame:
    """Copy the selected topics to ``prefix`` + topic."""
    chosen = capture.subscribe(df, topics, pattern, topic)
    return chosen.withColumn(out, F.concat(F.lit(prefix), F.col(topic)))


# --- W19, W20 ----------------------------------------------------------------------------------------------

def to_key_value(df: DataFrame, key_field: str, value: str, ts: str, prefix: str = "", ttl_seconds: int | None = None,
                 as_of: Column | None = None, tie: Sequence[str] = ()) -> DataFrame:
    """One row per prefixed key with its last write; writes older than the time to live are gone.

    Expiry is tested on the last write after the per-key aggregate, which is partial before the shuffle.
    """
    key = F.concat(F.lit(prefix), F.col(key_field).cast("string"))
    last = df.groupBy(key.alias("key")).agg(
        F.max_by(value, F.struct(ts, *tie)).alias("value"), F.max(ts).alias("written"))
    if ttl_seconds is None:
        return last
    now = F.current_timestamp() if as_of is None else as_of
    return last.where(F.col("written") + F.make_dt_interval(secs=F.lit(ttl_seconds)) > now)


def wrap_envelope(df: DataFrame, constants: Mapping[str, str], event: Sequence[str], out: str = "body") -> DataFrame:
    """JSON body with the record under ``event`` and the constants (index, sourcetype, source) beside it."""
    fixed = [F.lit(v).alias(k) for k, v in constants.items() if v]
    return df.withColumn(out, F.to_json(F.struct(F.struct(*event).alias("event"), *fixed)))
