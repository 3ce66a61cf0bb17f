"""Files that grow, followed line by line, as a streaming Python data source.

Offsets are the bytes read of each file, up to the last line end, so a line is read once and only when it is whole; Spark keeps them in the
query's checkpoint. New bytes are dealt out as ranges of about ``maxRangeBytes``, whatever files they belong to: one file that grows a lot is read
by many tasks, each taking the lines that begin in its range. A file shorter than its offset was replaced and is read from the start
(one as long or longer can't be told from a file that grew); a file that is gone is forgotten.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

NAME = "growing_files"
SCHEMA = "path string, position bigint, value string"
STEP = 1 << 16


class _Range(InputPartition):
    def __init__(self, path: str, start: int, stop: int, begin: int) -> None:
        self.path, self.start, self.stop, self.begin = path, start, stop, begin


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def make_folder(uri: str) -> None:
    fs, path = open_folder(uri)
    fs.create_dir(path, recursive=True)


def last_line_end(file, size: int, known: int) -> int:
    """The place behind the last line end in the bytes from ``known`` to ``size``, or ``known``; read backwards, step by step."""
    stop = size
    while stop > known:
        start = max(known, stop - STEP)
        file.seek(start)
        at = file.read(stop - start).rfind(b"\n")
        if at >= 0:
            return start + at + 1
        stop = start
    return known


def lines_from(file, start: int, stop: int, begin: int) -> Iterator[tuple[int, bytes]]:
    """(place, line) of the lines that begin in [start, stop); ``begin`` is known to be the beginning of a line."""
    file.seek(start if start == begin else start - 1)
    held, at = b"", start if start == begin else start - 1
    skip = start != begin  # the line that an earlier range begins
    while at < stop:
        more = file.read(STEP)
        if not more:
            return
        held += more
        while (end := held.find(b"\n")) >= 0:
            if not skip:
                yield at, held[:end]
            skip = False
            at, held = at + end + 1, held[end + 1:]
            if at >= stop:
                return


class _Reader(DataSourceStreamReader):
    def __init__(self, options: dict) -> None:
        self._root, self._most = options["path"], int(options.get("maxRangeBytes", 1 << 27))
        self._latest = options.get("start") == "latest"

    def _sizes(self) -> dict[str, int]:
        fs, root = open_folder(self._root)
        found = fs.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True))
        return {f.path: f.size for f in found if f.is_file and not f.base_name.startswith(("_", "."))}

    def _ends(self, known: dict[str, int]) -> dict[str, int]:
        fs, _ = open_folder(self._root)
        ends = {}
        for path, size in self._sizes().items():
            before = known.get(path, 0)
            before = before if size >= before else 0
            if size > before:
                with fs.open_input_file(path) as file:
                    before = last_line_end(file, size, before)
            ends[path] = before
        return ends

    def initialOffset(self) -> dict:
        return {"files": json.dumps(self._ends({}) if self._latest else {}, sort_keys=True)}

    def latestOffset(self) -> dict:
        self._known = self._ends(getattr(self, "_known", {}))
        return {"files": json.dumps(self._known, sort_keys=True)}

    def partitions(self, start: dict, end: dict) -> list[_Range]:
        before, out = json.loads(start["files"]), []
        for path, stop in json.loads(end["files"]).items():
            begin = before.get(path, 0)
            begin = begin if stop >= begin else 0
            out += [_Range(path, at, min(at + self._most, stop), begin) for at in range(begin, stop, self._most)]
        return out

    def read(self, partition: _Range) -> Iterator[tuple]:
        fs, _ = open_folder(self._root)
        with fs.open_input_file(partition.path) as file:
            for at, line in lines_from(file, partition.start, partition.stop, partition.begin):
                yield partition.path, at, line.rstrip(b"\r").decode("utf-8", "replace")

    def commit(self, end: dict) -> None:
        pass


class GrowingFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Reader(dict(self.options))


def follow(spark: SparkSession, path: str, start: str = "earliest", max_range_bytes: int = 1 << 27) -> DataFrame:
    """A stream of (path, position, value): the lines of all files below ``path``, those appended later included.

    ``start="latest"`` leaves out what is there when the query first starts. Paths are those of pyarrow's file systems (local and shared
    folders, S3, GCS, HDFS).
    """
    if start not in ("earliest", "latest"):
        raise ValueError(f"unknown start {start!r}")
    spark.dataSource.register(GrowingFiles)
    return spark.readStream.format(NAME).option("maxRangeBytes", max_range_bytes).option("start", start).load(path)
