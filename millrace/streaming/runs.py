"""Run a stream until its source is exhausted."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from millrace.sources import capture


def finish(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def to_files(rows: DataFrame, path: str, fmt: str = "parquet", interval_ms: int | None = None) -> DataFrame:
    """Append a stream to files (exactly once through the sink's log) and return what was written."""
    writer = rows.writeStream.format(fmt).option("path", path).option("checkpointLocation", f"{path}-checkpoint")
    finish(capture.pace(writer, interval_ms).start())
    return rows.sparkSession.read.schema(rows.schema).format(fmt).load(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a table can be read at ``path``."""
    try:
        return bool(spark.read.parquet(path).columns)
    except AnalysisException:
        return False
