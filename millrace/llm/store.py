"""Intermediate tables in the shared folder, and Arrow batches for ``mapInArrow``."""

from __future__ import annotations

import ctypes
import zlib
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm.text import mix
from millrace.session import scratch_path


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: later jobs neither repeat its work nor lose it with an executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Spark's setting by which the shuffle files of a write go when it is done. Else they stay until the driver happens to collect its garbage.
SWEEP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """Within it the shuffle files of a table that is ``saved`` go as soon as it is."""
    before = spark.conf.get(SWEEP, None)
    spark.conf.set(SWEEP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SWEEP)
        else:
            spark.conf.set(SWEEP, before)


def dropped(*tables: DataFrame) -> None:
    """Delete ``saved`` tables that nothing reads any more."""
    for table in tables:
        session = table.sparkSession
        for folder in {file.rpartition("/")[0] for file in table.inputFiles()}:
            path = session._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(session._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def give_back() -> None:
    """Hand memory that this process has freed back to the system: Arrow's pool and the C library keep it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def frugal(step: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``step`` for ``mapInArrow`` whose worker keeps no freed memory between tasks.

    Spark keeps workers for later tasks. What they hold meanwhile counts beside the executor's heap, through all stages that need no Python.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from step(batches)
        finally:
            give_back()
    return run


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A column as one plain array; string views and large strings become strings."""
    found = batch.column(batch.schema.names.index(name))
    return found.cast(pa.string()) if pa.types.is_large_string(found.type) or "view" in str(found.type) else found


def slices(batches: Iterable[pa.RecordBatch], *texts: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut into pieces of about ``most`` bytes in the columns ``texts``. A longer row is a piece of its own."""
    for batch in batches:
        columns = [column(batch, t) for t in texts]
        if not batch.num_rows:
            continue
        if sum(c.nbytes for c in columns) <= most:
            yield batch
            continue
        own = sum(pc.fill_null(pc.binary_length(c), 0).to_numpy(zero_copy_only=False).astype(np.int64) for c in columns)
        first, size = 0, 0
        for k, n in enumerate(own.tolist()):
            if k > first and size + n > most:
                yield batch.slice(first, k - first)
                first, size = k, 0
            size += n
        yield batch.slice(first)


ID_BITS = 25


def _places(numbers: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte and bit of each number's hash in a bitmap."""
    at = (mix(numbers.view(np.uint64)) >> np.uint64(65 - (8 * len(marks)).bit_length())).astype(np.int64)
    return at >> 3, 7 - (at & 7).astype(np.uint8)


def bitmap(numbers: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of 2 ** ``bits`` bits with those set that the values of ``numbers`` (one column, long) hash to."""
    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros((1 << bits) // 8, np.uint8)
        for batch in batches:
            byte, bit = _places(batch.column(0).to_numpy(), own)
            np.bitwise_or.at(own, byte, np.uint8(1) << bit)
        if own.any():
            yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(own.tobytes(), 1)], pa.binary())], names=["marks"])

    found = np.zeros((1 << bits) // 8, np.uint8)
    for row in numbers.mapInArrow(frugal(marks), "marks binary").toLocalIterator():
        found |= np.frombuffer(zlib.decompress(bytes(row.marks)), np.uint8)
    return found


def marked(marks: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Which numbers a bitmap holds; of others it lets some through by chance."""
    byte, bit = _places(numbers, marks)
    return (marks[byte] >> bit & 1).astype(np.bool_)


def texts_near(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows (doc_id, text) of ``docs`` with all whose doc_id is in ``ids``, and by chance some others, to be joined on the id.

    Texts that aren't wanted stay out of the shuffle: a bitmap of the hashed ids, 4 MB whatever their number, drops them while the table
    is scanned.
    """
    marks = bitmap(ids.select("doc_id"), ID_BITS)

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = batch.filter(pa.array(marked(marks, batch.column(0).to_numpy())))
            if kept.num_rows:
                yield kept

    rows = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id is not null and text is not null")
    return rows.mapInArrow(frugal(wanted), "doc_id long, text string")


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Saved rows (doc_id, text) of ``docs`` whose doc_id is in ``ids`` (doc_id: long, distinct).

    A join on the id drops what the bitmap of ``texts_near`` let through by chance.
    """
    return saved(texts_near(docs, ids).join(ids.select("doc_id"), "doc_id"), "texts")
