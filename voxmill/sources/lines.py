"""JSON lines as a row source of their own: byte-range partitions, pushed filters, early stop, streams."""

from __future__ import annotations

import io
import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
)

FORMAT = "review_lines"
SPLIT_BYTES = 64 << 20
#: A position is the file's number in name order, then the line's first byte in so many bits.
OFFSET_BITS = 43
#: The end of a growing file is looked for its last whole line in steps of this size.
TAIL_BYTES = 1 << 16
BUFFER = 1 << 20

_COMPARE = {
    EqualTo: lambda a, b: a == b, GreaterThan: lambda a, b: a > b, GreaterThanOrEqual: lambda a, b: a >= b,
    LessThan: lambda a, b: a < b, LessThanOrEqual: lambda a, b: a <= b, In: lambda a, b: a in b,
}


@dataclass(frozen=True)
class ByteRange(InputPartition):
    """The lines of a file that begin in [start, end)."""

    path: str
    number: int
    start: int
    end: int


def _files(path: str):
    """(file system, [(path, size)]) of a file or a folder, hidden files left out; any address pyarrow
    knows, so executors need no common local folder."""
    from pyarrow import fs

    system, place = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (
        fs.LocalFileSystem(), path)
    info = system.get_file_info(place)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(f"No table at '{path}'.")
    found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(place, recursive=True))
    files = [(f.path, f.size) for f in found if f.type == fs.FileType.File and f.base_name[0] not in "._"]
    return system, sorted(files)


def _value(record: dict, field: T.StructField, line: bytes):
    value = record.get(field.name)
    kind = field.dataType
    if value is None:
        return None
    if isinstance(kind, T.StringType):
        return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return float(value) if isinstance(value, (int, float)) and not isinstance(value, bool) else None
    if isinstance(kind, (T.LongType, T.IntegerType)):
        return value if isinstance(value, int) and not isinstance(value, bool) else None
    if isinstance(kind, T.BooleanType):
        return value if isinstance(value, bool) else None
    return value


class _Lines:
    """Reading of one byte range, shared by batches and streams."""

    def __init__(self, schema: T.StructType, options: dict):
        self.schema = schema
        self.path = options["path"]
        self.split = int(options.get("splitbytes", SPLIT_BYTES))
        self.limit = int(options["limit"]) if "limit" in options else None
        self.failing = options.get("mode", "failfast").lower() == "failfast"
        self.filters: list[Filter] = []

    def ranges(self, path: str, number: int, start: int, end: int) -> list[ByteRange]:
        return [ByteRange(path, number, at, min(at + self.split, end)) for at in range(start, end, self.split)]

    def wanted(self, row: tuple) -> bool:
        for test in self.filters:
            value = row[self.schema.names.index(test.attribute[0])]
            if value is None or not isinstance(test, IsNotNull) and not _COMPARE[type(test)](value, test.value):
                return False
        return True

    def rows(self, part: ByteRange) -> Iterator[tuple]:
        """Rows of the lines that begin in the range; ``row_id``, where the schema has one and the file
        none, is the line's position. Stops after ``limit`` rows."""
        system, _ = _files(self.path)
        count = 0
        with io.BufferedReader(system.open_input_file(part.path), BUFFER) as file:
            at = max(part.start - 1, 0)
            file.seek(at)
            if part.start:
                at += len(file.readline())  # the line before the range, to its end
            while at < part.end and (self.limit is None or count < self.limit):
                line = file.readline()
                if not line:
                    return
                begin, at = at, at + len(line)
                if not line.strip():
                    continue
                try:
                    record = json.loads(line)
                    if not isinstance(record, dict):
                        raise ValueError("a line must hold an object")
                except ValueError as error:
                    if self.failing:
                        raise ValueError(f"{part.path}, byte {begin}: {error}") from error
                    continue
                record.setdefault("row_id", (part.number << OFFSET_BITS) | begin)
                row = tuple(_value(record, f, line) for f in self.schema.fields)
                if self.wanted(row):
                    count += 1
                    yield row


class LinesReader(_Lines, DataSourceReader):
    def pushFilters(self, filters: list[Filter]):
        """Comparisons of plain columns are tested as lines are read; Spark tests the others."""
        for test in filters:
            simple = type(test) in _COMPARE or isinstance(test, IsNotNull)
            if simple and len(test.attribute) == 1:
                self.filters.append(test)
            else:
                yield test

    def partitions(self) -> list[ByteRange]:
        _, files = _files(self.path)
        return [r for number, (path, size) in enumerate(files) for r in self.ranges(path, number, 0, size)]

    def read(self, partition: ByteRange | None) -> Iterator[tuple]:
        return self.rows(partition) if partition else iter(())  # an empty folder has no range


class LinesStreamReader(_Lines, DataSourceStreamReader):
    """Offsets are the bytes of each file that have been read, so lines appended to a file are new."""

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        system, files = _files(self.path)
        return {path: self._whole(system, path, size) for path, size in files}

    @staticmethod
    def _whole(system, path: str, size: int) -> int:
        """Where the last whole line of a file ends."""
        with system.open_input_file(path) as file:
            end = size
            while end > 0:
                start = max(0, end - TAIL_BYTES)
                file.seek(start)
                found = file.read(end - start).rfind(b"\n")
                if found >= 0:
                    return start + found + 1
                end = start
        return 0

    def partitions(self, start: dict, end: dict) -> list[ByteRange]:
        numbers = {path: i for i, path in enumerate(sorted(end))}
        return [r for path in sorted(end) for r in self.ranges(path, numbers[path], start.get(path, 0), end[path])]

    def read(self, partition: ByteRange | None) -> Iterator[tuple]:
        return self.rows(partition) if partition else iter(())  # an empty folder has no range


class LinesSource(DataSource):
    """Options: path; splitBytes; limit (rows after which a range stops); mode (failfast, or
    dropmalformed)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        raise ValueError("name the schema of the lines")

    def reader(self, schema: T.StructType) -> LinesReader:
        return LinesReader(schema, {k.lower(): v for k, v in self.options.items()})

    def streamReader(self, schema: T.StructType) -> LinesStreamReader:
        return LinesStreamReader(schema, {k.lower(): v for k, v in self.options.items()})


def register(spark: SparkSession) -> None:
    spark.dataSource.register(LinesSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
