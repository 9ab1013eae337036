"""Line files read by byte ranges, in batch and as a stream.

A file is cut into ranges of bytes, one partition each. A line belongs to the
range in which it starts, so lines are whole whatever the borders. A stream's
offset is the number of bytes read of each file, always at the end of a line:
what is appended later is read once, and a line still being written waits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from tallyforge.shared import filesystem

BLOCK = 1 << 20
SCHEMA = "file string, start long, value string"
NAMES = ["file", "start", "value"]


@dataclass
class Range(InputPartition):
    """Lines that start in ``start`` to ``stop`` (without it); ``end`` is where the file ends for this read."""

    uri: str
    start: int
    stop: int
    end: int

    def __init__(self, uri: str, start: int, stop: int, end: int):
        super().__init__(None)
        self.uri, self.start, self.stop, self.end = uri, start, stop, end


def files_below(uri: str) -> dict[str, int]:
    """Sizes of a file, or of the files of a folder; hidden ones, and those whose name starts with ``_``, are no input."""
    system, path = filesystem(uri)
    info = system.get_file_info(path)
    if info.type == fs.FileType.File:
        return {path: info.size}
    found = system.get_file_info(fs.FileSelector(path, recursive=True, allow_not_found=True))
    return {f.path: f.size for f in sorted(found, key=lambda f: f.path) if f.type == fs.FileType.File and not any(part[:1] in "._" for part in f.path[len(path) :].split("/") if part)}


def cut(path: str, start: int, end: int, step: int) -> list[Range]:
    return [Range(path, a, min(a + step, end), end) for a in range(start, end, step)]


def lines_of(part: Range, system: fs.FileSystem) -> Iterator[tuple[int, bytes]]:
    """Place and bytes of the lines of a range, without their ends (a line feed, also after a carriage return)."""
    with system.open_input_file(part.uri) as f:
        at = max(part.start - 1, 0)
        f.seek(at)
        # before the first line: what is left of a line that starts in the range before
        skip, open_line, line_at = part.start > 0, [], part.start
        while at < part.end:
            block = f.read(min(BLOCK, part.end - at))
            if not block:
                return
            a = 0
            while True:
                b = block.find(b"\n", a)
                if b < 0:
                    break
                if skip:
                    skip = False
                else:
                    yield line_at, b"".join([*open_line, block[a:b]]).removesuffix(b"\r")
                open_line, a, line_at = [], b + 1, at + b + 1
                if line_at >= part.stop:
                    return
            if not skip and a < len(block):
                open_line.append(block[a:])
            at += len(block)
        if open_line:
            yield line_at, b"".join(open_line).removesuffix(b"\r")


def _batches(part: Range, top: str) -> Iterator[pa.RecordBatch]:
    system, _ = filesystem(top)
    rows: list[tuple[int, str]] = []
    size = 0

    def batch() -> pa.RecordBatch:
        starts, values = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array([part.uri] * len(rows)), pa.array(starts, pa.int64()), pa.array(values, pa.string())], names=NAMES)

    for start, line in lines_of(part, system):
        rows.append((start, line.decode("utf-8", "replace")))
        size += len(line)
        if size >= BLOCK or len(rows) >= 10_000:
            yield batch()
            rows, size = [], 0
    if rows:
        yield batch()


class LineReader(DataSourceReader):
    def __init__(self, path: str, step: int):
        self.path, self.step = path, step

    def partitions(self) -> list[Range]:
        return [r for path, size in files_below(self.path).items() for r in cut(path, 0, size, self.step)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return _batches(partition, self.path)


def _whole_lines(system: fs.FileSystem, path: str, size: int) -> int:
    """Bytes up to the last line feed, searched from the end in blocks."""
    with system.open_input_file(path) as f:
        while size > 0:
            at = max(0, size - BLOCK)
            f.seek(at)
            found = f.read(size - at).rfind(b"\n")
            if found >= 0:
                return at + found + 1
            size = at
    return 0


class LineStream(DataSourceStreamReader):
    """Offsets are {file: bytes}; a file that is shorter than before is a new one and read from its start."""

    def __init__(self, path: str, step: int):
        self.path, self.step = path, step
        self.ends: dict[str, tuple[int, int]] = {}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        system, _ = filesystem(self.path)
        for path, size in files_below(self.path).items():
            if self.ends.get(path, (-1, 0))[0] != size:
                self.ends[path] = size, _whole_lines(system, path, size)
        return {path: end for path, (_, end) in self.ends.items() if end}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        out = []
        for path, stop in end.items():
            at = start.get(path, 0)
            out += cut(path, at if at <= stop else 0, stop, self.step)
        return out

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return _batches(partition, self.path)


class LineRanges(DataSource):
    """Format ``line_ranges``; options ``path`` and ``rangeBytes`` (default 64 MiB)."""

    @classmethod
    def name(cls) -> str:
        return "line_ranges"

    def schema(self) -> str:
        return SCHEMA

    def _options(self) -> tuple[str, int]:
        step = int(self.options.get("rangeBytes", 64 << 20))
        if step < 1:
            raise ValueError("rangeBytes must be positive")
        return self.options["path"], step

    def reader(self, schema) -> LineReader:
        return LineReader(*self._options())

    def streamReader(self, schema) -> LineStream:
        return LineStream(*self._options())


def lines(spark: SparkSession, path: str, range_bytes: int = 64 << 20, stream: bool = False) -> DataFrame:
    """The lines below ``path``: file, start (its byte), value. Bytes that are no UTF-8 become U+FFFD; an empty folder gives no rows."""
    spark.dataSource.register(LineRanges)
    reader = (spark.readStream if stream else spark.read).format("line_ranges").option("rangeBytes", range_bytes)
    return reader.option("path", path).load()
