"""A data source for dumps of a collection: JSON lines, each file in the order of the key, as stores export them.

The order stands in for the store's index. Keys probed at even distances in a file are its quantiles; the ranges between
them are the partitions, each a stretch of bytes that one task seeks and reads. Filters on the key drop ranges before any
task is made and find their ends by bisection, so a lookup reads a few lines of a file whatever its size.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)

RANGE_BYTES = 64 << 20
BATCH_ROWS = 2_000
_PUSH = "spark.sql.python.filterPushdown.enabled"


@dataclass
class KeyRange(InputPartition):
    """The lines of a file that begin from ``begin`` to before ``end``: those of keys from ``low`` to before ``high`` (None: to the last)."""

    path: str
    begin: int
    end: int
    low: Any
    high: Any


def _key(line: bytes, key: str) -> Any:
    """The key of a document, also in a typed wrapper."""
    value = json.loads(line).get(key)
    return next(iter(value.values())) if isinstance(value, dict) and len(value) == 1 else value


def _line_from(file: pa.NativeFile, at: int) -> int:
    """Where the first line begins that begins at ``at`` or after it."""
    if at == 0:
        return 0
    file.seek(at - 1)
    while block := file.read(1 << 16):
        if (i := block.find(b"\n")) >= 0:
            return at + i
        at += len(block)
    return at


def _line_at(file: pa.NativeFile, at: int) -> bytes:
    file.seek(at)
    out = b""
    while block := file.read(1 << 16):
        if (i := block.find(b"\n")) >= 0:
            return out + block[:i]
        out += block
    return out


class DumpReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.options = options
        self.key = options.get("key", "_id")
        self.range_bytes = int(options.get("rangebytes", options.get("rangeBytes", RANGE_BYTES)))
        self.least: list[Any] = []  # every key asked for is as large as each of these
        self.most: list[Any] = []  # and no larger than each of these

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Filters on the key narrow what is read. All go back to Spark, which applies them to the rows."""
        for f in filters:
            if getattr(f, "attribute", None) == (self.key,):
                if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)) and f.value is not None:
                    self.least.append(f.value)
                if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)) and f.value is not None:
                    self.most.append(f.value)
                if isinstance(f, In) and (asked := [v for v in f.value if v is not None]):
                    self.least.append(min(asked))
                    self.most.append(max(asked))
            yield f

    def _bisect(self, file: pa.NativeFile, begin: int, end: int, value: Any, after: bool) -> int:
        """Where the keys not less than (or, ``after``, greater than) ``value`` begin among the lines of a stretch."""
        while begin < end:
            at = _line_from(file, (begin + end) // 2)
            if at >= end:  # one line is left that begins before the middle
                at = begin
            line = _line_at(file, at)
            here = _key(line, self.key)
            if here < value or (after and here == value):
                begin = min(end, at + len(line) + 1)
            else:
                end = at
        return begin

    def partitions(self) -> list[KeyRange]:
        store, root = fs.FileSystem.from_uri(self.options["path"])
        found, out = store.get_file_info(fs.FileSelector(root, recursive=True)), []
        for info in found:
            if info.type != fs.FileType.File or not info.size or info.base_name.startswith(("_", ".")):
                continue
            with store.open_input_file(info.path) as file:
                begin, end = 0, info.size
                if self.least:
                    begin = self._bisect(file, 0, end, max(self.least), False)
                if self.most:
                    end = self._bisect(file, begin, end, min(self.most), True)
                bounds = [_line_from(file, at) for at in range(begin, end, self.range_bytes)]
                bounds = [b for b in dict.fromkeys(bounds) if b < end]
                keys = [_key(_line_at(file, b), self.key) for b in bounds]
                for i, b in enumerate(bounds):
                    last = i + 1 == len(bounds)
                    out.append(KeyRange(info.path, b, end if last else bounds[i + 1], keys[i], None if last else keys[i + 1]))
        return out

    def read(self, partition: KeyRange) -> Iterator[pa.RecordBatch]:
        if partition is None or not isinstance(partition, KeyRange):  # nothing is left to read
            return
        store, _ = fs.FileSystem.from_uri(self.options["path"])
        kind = pa.int64() if self.options.get("keytype", self.options.get("keyType", "string")) == "long" else pa.string()
        keys: list[Any] = []
        lines: list[str] = []

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys, kind), pa.array(lines, pa.string())], names=[self.key, "doc"])

        with store.open_input_file(partition.path) as file:
            file.seek(partition.begin)
            left, at, rest, before = partition.end - partition.begin, 0, b"", partition.low
            while at < left and (block := file.read(min(1 << 20, left - at))):
                at += len(block)
                *whole, rest = (rest + block).split(b"\n")
                if at >= left and rest:
                    whole, rest = [*whole, rest], b""
                for line in whole:
                    if not line.strip():
                        continue
                    here = _key(line, self.key)
                    if here < before:
                        raise ValueError(f"{partition.path} is not in the order of {self.key}: {here!r} after {before!r}")
                    before = here
                    keys.append(here)
                    lines.append(line.decode("utf-8"))
                    if len(keys) >= BATCH_ROWS:
                        yield batch()
                        keys, lines = [], []
        if keys:
            yield batch()


class DocumentDump(DataSource):
    """Options: ``path``, ``key`` (``_id``), ``keyType`` (string or long), ``rangeBytes``. Rows: the key, and the document's text as ``doc``.

    Every line is a JSON object that has the key, which is not null. Empty files and lines are passed over.
    """

    @classmethod
    def name(cls) -> str:
        return "document_dump"

    def schema(self) -> T.StructType:
        options = dict(self.options)
        long = options.get("keytype", options.get("keyType", "string")) == "long"
        return T.StructType([T.StructField(options.get("key", "_id"), T.LongType() if long else T.StringType()), T.StructField("doc", T.StringType())])

    def reader(self, schema: T.StructType) -> DumpReader:
        return DumpReader(dict(self.options))


def read_dump(spark: SparkSession, path: str, key: str = "_id", key_type: str = "string", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(key, doc) of every document of a dump. Filters on the key reach the source, in this session from now on."""
    spark.dataSource.register(DocumentDump)
    spark.conf.set(_PUSH, "true")
    reader = spark.read.format(DocumentDump.name()).option("key", key).option("keyType", key_type)
    return reader.option("rangeBytes", str(range_bytes)).option("path", path).load()
