"""A log that grows in place, as a streaming source: byte ranges with offsets of its own.

Spark's file stream reads a file once. An intrusion-detection system appends to one file instead. This
source keeps, for each file, how far it has been read and a mark of its first bytes. It takes complete
lines only; a half line waits. A file that has shrunk or begins differently has been replaced and is
read from its start.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..sources.flows import _stored_at

HEAD_BYTES = 256
TAIL_BYTES = 1 << 16
RANGE_BYTES = 64 << 20


@dataclass
class Range(InputPartition):
    path: str
    start: int
    end: int


class LogReader(DataSourceStreamReader):
    """Offsets: path to [bytes read, mark of the file's head, length of that head]."""

    def __init__(self, options: dict[str, str]):
        path = options["path"]
        self.files, self.root = fs.FileSystem.from_uri(_stored_at(path)) if ":" in path else (fs.LocalFileSystem(), path)
        self.from_start = options.get("from_start", "false") == "true"
        self.most = int(options["max_bytes"]) if "max_bytes" in options else None
        self.done: dict | None = None

    def _listed(self) -> list[fs.FileInfo]:
        info = self.files.get_file_info(self.root)
        if info.type == fs.FileType.Directory:
            found = self.files.get_file_info(fs.FileSelector(self.root))
            return [f for f in found if f.type == fs.FileType.File and not f.base_name.startswith(("_", "."))]
        return [info] if info.type == fs.FileType.File else []

    def _mark(self, source, size: int, length: int | None = None) -> list[int]:
        length = min(size, HEAD_BYTES) if length is None else length
        return [zlib.crc32(source.read_at(length, 0)), length]

    def _whole_lines(self, source, start: int, size: int) -> int:
        """End of the last complete line at or before ``size``, or ``start`` when there is none after it."""
        end = size
        while end > start:
            begin = max(start, end - TAIL_BYTES)
            found = source.read_at(end - begin, begin).rfind(b"\n")
            if found >= 0:
                return begin + found + 1
            end = begin
        return start

    def _now(self, limit: bool) -> dict:
        out = {}
        for info in self._listed():
            with self.files.open_input_file(info.path) as source:
                old = (self.done or {}).get(info.path)
                same = old is not None and info.size >= old[0] and self._mark(source, info.size, old[2])[0] == old[1]
                start = old[0] if same else 0
                size = min(info.size, start + self.most) if limit and self.most and self.done is not None else info.size
                end = self._whole_lines(source, start, size)
                if end == start and size < info.size:  # one line is longer than the limit
                    end = self._whole_lines(source, start, info.size)
                out[info.path] = [end, *self._mark(source, end)]
        return out

    def initialOffset(self) -> dict:
        self.done = {} if self.from_start else self._now(limit=False)
        return self.done

    def latestOffset(self) -> dict:
        return self._now(limit=True)

    def partitions(self, start: dict, end: dict) -> list[Range]:
        self.done = end
        out = []
        for path, (stop, mark, length) in sorted(end.items()):
            begin, old_mark, old_length = start.get(path, [0, 0, 0])
            if begin and (stop < begin or old_length <= length and self._changed(path, old_mark, old_length)):
                begin = 0
            out += [Range(path, at, min(at + RANGE_BYTES, stop)) for at in range(begin, stop, RANGE_BYTES)]
        return out or [Range("", 0, 0)]

    def _changed(self, path: str, mark: int, length: int) -> bool:
        with self.files.open_input_file(path) as source:
            return zlib.crc32(source.read_at(length, 0)) != mark

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        """Lines that begin in the range; the last one is read to its end."""
        if partition.start >= partition.end:
            return
        with self.files.open_input_file(partition.path) as source:
            size, begin = source.size(), partition.start
            if begin and source.read_at(1, begin - 1) != b"\n":
                begin = self._next_line(source, begin, size)
            end = partition.end if source.read_at(1, partition.end - 1) == b"\n" else self._next_line(source, partition.end, size)
            at = begin
            while at < end:
                stop = min(end, at + RANGE_BYTES // 8)
                if stop < end:
                    stop = self._next_line(source, stop, size)
                lines = source.read_at(stop - at, at).decode("utf-8", "replace").split("\n")
                lines = [line.rstrip("\r") for line in lines]
                yield pa.record_batch([pa.array(lines[:-1] if not lines[-1] else lines, pa.string())], names=["value"])
                at = stop

    @staticmethod
    def _next_line(source, at: int, size: int) -> int:
        while at < size:
            chunk = source.read_at(min(TAIL_BYTES, size - at), at)
            found = chunk.find(b"\n")
            if found >= 0:
                return at + found + 1
            at += len(chunk)
        return size


class GrowingLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "growinglog"

    def schema(self) -> str:
        return "value string"

    def streamReader(self, schema) -> LogReader:
        return LogReader(self.options)


def growing_lines(spark: SparkSession, path: str, max_bytes: int | None = None, from_start: bool = False) -> DataFrame:
    """Lines appended to a file, or to the files of a folder, since the last micro-batch.

    Unless ``from_start``, what is there at the first start is passed over. ``max_bytes`` bounds what a
    micro-batch takes of each file, save that a longer line is taken whole.
    """
    spark.dataSource.register(GrowingLog)
    reader = spark.readStream.format("growinglog").option("from_start", str(from_start).lower())
    if max_bytes is not None:
        reader = reader.option("max_bytes", str(max_bytes))
    return reader.load(path)
