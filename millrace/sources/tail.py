"""Growing text files as a stream: only what was appended is read.

The offset of the stream is the size of every file, kept in the stream's checkpoint. A micro-batch reads the
byte ranges between two offsets by seeking, cut to a bounded size; small ranges share a partition. A line belongs to
the range that holds its newline: a range begins by looking back for the beginning of its first line, and
a last line without newline is left to the range that brings it. So a cut may fall anywhere.
"""

from __future__ import annotations

import fnmatch
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SCHEMA = "file string, range_start bigint, seq bigint, start bigint, end bigint, value string"
FORMAT = "growing_lines"
SPLIT_BYTES = 64 << 20
TASK_BYTES = 8 << 20  # read by one task, in as many ranges as that takes
CHUNK_BYTES = 4 << 20
LOOK_BACK = 1 << 14
BYTE_MARK = "﻿"


@dataclass
class ByteRange(InputPartition):
    file: str
    start: int
    end: int
    last: bool  # nothing follows, so that a line without newline is whole


@dataclass
class ByteRanges(InputPartition):
    ranges: list[ByteRange]


def dealt(ranges: list[ByteRange], task_bytes: int = TASK_BYTES) -> list[InputPartition]:
    """Ranges in their order as partitions of about ``task_bytes``: a task costs far more than a small range."""
    parts, held = [], task_bytes
    for r in ranges:
        if held >= task_bytes:
            parts.append([])
            held = 0
        parts[-1].append(r)
        held += r.end - r.start
    return [ByteRanges(p) if len(p) > 1 else p[0] for p in parts]


def line_start(source: pa.NativeFile, at: int) -> int:
    """Where the line begins that the byte before ``at`` belongs to or follows."""
    stop = at
    while stop > 0:
        begin = max(0, stop - LOOK_BACK)
        source.seek(begin)
        found = source.read(stop - begin).rfind(b"\n")
        if found >= 0:
            return begin + found + 1
        stop = begin
    return 0


def lines_of(source: pa.NativeFile, part: ByteRange) -> Iterator[tuple[int, list[bytes]]]:
    """The lines whose newline is in the range, and the byte the first of them begins at, chunk by chunk."""
    at = line_start(source, part.start)
    source.seek(at)
    rest, read = b"", at
    while read < part.end:
        data = source.read(min(CHUNK_BYTES, part.end - read))
        if not data:
            break
        read += len(data)
        *lines, rest = (rest + data).split(b"\n")
        if lines:
            yield at, lines
            at = read - len(rest)
    if part.last and rest:
        yield at, [rest]


class TailReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path = options["path"]
        self.pattern = options.get("pattern", "*")
        self.split = int(options.get("splitbytes", SPLIT_BYTES))
        self.closed = options.get("closed", "false") == "true"

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        """Sizes of the files there are: one listing of the folder."""
        system, base = fs.FileSystem.from_uri(self.path)
        head = self.path[: len(self.path) - len(base)] if self.path.endswith(base) else ""
        found = system.get_file_info(fs.FileSelector(base, allow_not_found=True))
        return {
            head + f.path: f.size for f in sorted(found, key=lambda f: f.path)
            if f.type == fs.FileType.File and f.base_name[0] not in "._" and fnmatch.fnmatch(f.base_name, self.pattern)
        }

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        parts = []
        for file, size in end.items():
            at = start.get(file, 0)
            at = at if at <= size else 0  # a file that shrank was begun anew
            while at < size:
                stop = min(size, at + self.split)
                parts.append(ByteRange(file, at, stop, self.closed and stop == size))
                at = stop
        return dealt(parts)

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        for part in partition.ranges if isinstance(partition, ByteRanges) else [partition]:
            yield from self.read_range(part)

    def read_range(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        system, name = fs.FileSystem.from_uri(partition.file)
        seq = 0
        with system.open_input_file(name) as source:
            for at, lines in lines_of(source, partition):
                sizes = np.fromiter(map(len, lines), np.int64, len(lines)) + 1
                ends = at + np.cumsum(sizes)
                starts = ends - sizes
                if partition.last:
                    ends = np.minimum(ends, partition.end)
                values = [line.decode("utf-8", "replace") for line in lines]
                if at == 0:
                    values[0] = values[0].removeprefix(BYTE_MARK)
                n = len(lines)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([partition.file] * n), pa.array(np.full(n, partition.start)), pa.array(np.arange(seq, seq + n)),
                        pa.array(starts), pa.array(ends), pa.array(values, pa.string()),
                    ],
                    ["file", "range_start", "seq", "start", "end", "value"],
                )
                seq += n

    def commit(self, end: dict) -> None:
        pass


class TailSource(DataSource):
    """Options: ``path`` (a folder), ``pattern`` of file names, ``splitBytes``, and ``closed``: the files grow no more, so
    that a last line without newline is read."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> TailReader:
        return TailReader({k.lower(): v for k, v in self.options.items()})


def tail_lines(
    spark: SparkSession, folder: str, pattern: str = "*", split_bytes: int = SPLIT_BYTES, closed: bool = False
) -> DataFrame:
    """A stream of the lines that are appended to the files of a folder.

    ``start`` and ``end`` are byte positions in ``file``, ``range_start`` names the range a line was read in and ``seq``
    counts the lines of the range from 0. A byte mark is counted but not returned, bytes that are not UTF-8 become
    U+FFFD. A file that is shorter than it was is read from its beginning. The checkpoint holds a
    number for each file in the folder: remove files that are done.
    """
    spark.dataSource.register(TailSource)
    reader = spark.readStream.format(FORMAT).option("pattern", pattern).option("splitBytes", split_bytes)
    return reader.option("closed", str(closed).lower()).load(folder)
