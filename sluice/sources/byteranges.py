"""Ranges of bytes of files, as partitions: reading at any place, lines of ranges, block checksums.

A Python data source plans the ranges from the files' sizes; each task opens its file and reads its
range alone. Files are opened through pyarrow's file systems: local paths, and those of stores that
pyarrow knows (hdfs:// by way of libhdfs, s3://, gs://). Contents go from the tasks to Spark in
pieces, so a task holds some megabytes whatever a range's size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .files import SourceError

PIECE = 1 << 22
#: Bytes that have a checksum of their own, the size of a block, and the polynomials of
#: CRC32C and CRC32, as they stand in reflected form.
CHUNK, BLOCK = 512, 128 << 20
POLYNOMIALS = {"CRC32C": 0x82F63B78, "CRC32": 0xEDB88320}
SCHEMAS = {"bytes": "path string, start long, data binary", "lines": "path string, start long, value string", "crcs": "path string, start long, md5 binary"}


def _opened(path: str):
    from pyarrow import fs

    # Spark writes file:/x as well as file:///x.
    return fs.FileSystem.from_uri("file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path)


@dataclass
class Range(InputPartition):
    path: str
    start: int
    end: int
    size: int


class RangeReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.mode = options["path"], options.get("mode", "bytes")
        self.step = int(options.get("size", BLOCK))
        self.offset, self.length = int(options.get("offset", 0)), int(options.get("length", -1))
        self.polynomial = POLYNOMIALS[options.get("polynomial", "CRC32C")]

    def partitions(self) -> list[Range]:
        from pyarrow import fs

        store, path = _opened(self.path)
        info = store.get_file_info(path)
        if info.type == fs.FileType.NotFound:
            raise SourceError(f"no file {self.path}")
        files = [info]
        if info.type == fs.FileType.Directory:
            found = store.get_file_info(fs.FileSelector(path, recursive=True))
            files = sorted((f for f in found if f.type == fs.FileType.File and f.base_name[0] not in "._"), key=lambda f: f.path)
        out = []
        for f in files:
            first = f.size + self.offset if self.offset < 0 else self.offset
            first = max(0, first) if self.length >= 0 and self.offset < 0 and self.mode != "bytes" else first
            if first < 0 or first > f.size:
                raise SourceError(f"{f.path} has no byte {self.offset}")
            last = f.size if self.length < 0 else min(f.size, first + self.length)
            cuts = [first, *range(first - first % self.step + self.step, last, self.step), last] if last > first else [first, first]
            out += [Range(f.path, a, b, f.size) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return out

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        store, _ = _opened(self.path)
        with store.open_input_file(partition.path) as file:
            yield from {"bytes": self._bytes, "lines": self._lines, "crcs": self._crcs}[self.mode](file, partition)

    @staticmethod
    def _pieces(file, start: int, end: int, piece: int = PIECE) -> Iterator[tuple[int, bytes]]:
        for at in range(start, end, piece):
            n = min(piece, end - at)
            data = file.read_at(n, at)
            if len(data) != n:
                raise SourceError("a file became shorter while it was read")
            yield at, data

    def _batch(self, name: str, kind, path: str, starts: list[int], values: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([path] * len(starts)), pa.array(starts, pa.int64()), pa.array(values, kind)], names=["path", "start", name])

    def _bytes(self, file, part: Range) -> Iterator[pa.RecordBatch]:
        for at, data in self._pieces(file, part.start, part.end):
            yield self._batch("data", pa.binary(), part.path, [at], [data])

    def _lines(self, file, part: Range) -> Iterator[pa.RecordBatch]:
        """Lines that begin in the range; the last is read to its end, wherever that is."""
        if part.start == part.end:
            return
        held, begin = b"", part.start
        skip = part.start > 0 and file.read_at(1, part.start - 1) != b"\n"
        for at, data in self._pieces(file, part.start, part.size, 1 << 20):
            if skip:
                cut = data.find(b"\n")
                if cut < 0:
                    if at + len(data) >= part.end:
                        return
                    continue
                data, begin, skip = data[cut + 1 :], at + cut + 1, False
            lines = (held + data).split(b"\n")
            held = lines.pop()
            starts, values = [], []
            for line in lines:
                if begin >= part.end:
                    break
                starts.append(begin)
                values.append(line.decode("utf-8", "replace"))
                begin += len(line) + 1
            if starts:
                yield self._batch("value", pa.string(), part.path, starts, values)
            if begin >= part.end:
                return
        if held and begin < part.end and not skip:
            yield self._batch("value", pa.string(), part.path, [begin], [held.decode("utf-8", "replace")])

    def _crcs(self, file, part: Range) -> Iterator[pa.RecordBatch]:
        md5 = hashlib.md5() if part.end > part.start else None
        for _, data in self._pieces(file, part.start, part.end):
            md5.update(chunk_crcs(data, self.polynomial).astype(">u4").tobytes())
        yield self._batch("md5", pa.binary(), part.path, [part.start], [md5.digest() if md5 else None])


class ByteRanges(DataSource):
    @classmethod
    def name(cls) -> str:
        return "byte_ranges"

    def schema(self) -> str:
        return SCHEMAS[self.options.get("mode", "bytes")]

    def reader(self, schema) -> RangeReader:
        return RangeReader(dict(self.options))


def crc_table(polynomial: int) -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(polynomial), table >> 1).astype(np.uint32)
    return table


def chunk_crcs(data: bytes, polynomial: int = POLYNOMIALS["CRC32C"], chunk: int = CHUNK) -> np.ndarray:
    """The checksum of each chunk; all chunks go on byte by byte, side by side."""
    table = crc_table(polynomial)
    raw = np.frombuffer(data, np.uint8)
    whole = len(raw) // chunk
    out = []
    for part in (raw[: whole * chunk].reshape(whole, chunk), raw[whole * chunk :].reshape(1, -1)):
        if part.size:
            state = np.full(len(part), 0xFFFFFFFF, np.uint32)
            for column in np.ascontiguousarray(part.T):
                state = table[(state ^ column) & 0xFF] ^ (state >> 8)
            out.append(state ^ np.uint32(0xFFFFFFFF))
    return np.concatenate([np.zeros(0, np.uint32), *out])


def _ranges(spark: SparkSession, path: str, **options) -> DataFrame:
    spark.dataSource.register(ByteRanges)
    reader = spark.read.format("byte_ranges")
    for name, value in {"path": path, **options}.items():
        reader = reader.option(name, value)
    return reader.load()


def read_at(spark: SparkSession, path: str, offset: int, length: int = -1, whence: int = 0) -> DataFrame:
    """(path, start, data): bytes of a file, or of each file of a folder, in pieces. whence 0: offset
    is from the beginning, 2: from the end. length -1: to the end; else at most so many. An offset
    outside of a file is an error."""
    if whence not in (0, 2) or (whence == 0 and offset < 0) or (whence == 2 and offset > 0):
        raise SourceError(f"no such place: {offset}, {whence}")
    if whence == 2 and offset == 0:
        return _ranges(spark, path, offset=0, length=0)
    return _ranges(spark, path, offset=offset, length=length)


def read_ranges(spark: SparkSession, path: str, size: int = BLOCK) -> DataFrame:
    """(path, start, value): lines and the bytes they begin at, a task for each `size` bytes. A line
    belongs to the range it begins in, so each comes once, also over borders."""
    return _ranges(spark, path, mode="lines", size=size)


def head_bytes(spark: SparkSession, path: str, n: int) -> DataFrame:
    return read_at(spark, path, 0, n)


def tail_bytes(spark: SparkSession, path: str, n: int) -> DataFrame:
    """The last n bytes of a file; all, if it has no more. Nothing else is read."""
    store, name = _opened(path)
    return read_at(spark, path, -min(n, store.get_file_info(name).size), -1, 2)


def tail_lines(spark: SparkSession, path: str, n: int, first: int = 1 << 16) -> DataFrame:
    """(path, start, value): the last n lines of a file, read from its end on in ever larger pieces."""
    store, name = _opened(path)
    size, back = store.get_file_info(name).size, first
    while True:
        lines = _ranges(spark, path, mode="lines", offset=max(0, size - back), length=min(size, back))
        if back >= size or lines.count() >= n:
            return lines.orderBy(F.desc("start")).limit(n).orderBy("start")
        back *= 8


def block_checksums(spark: SparkSession, path: str, block: int = BLOCK, polynomial: str = "CRC32C") -> DataFrame:
    """(path, blocks, checksum): for each file the MD5 of the MD5s of its blocks' checksums, as stores of
    blocks keep them: a checksum for each 512 bytes, big-endian; an MD5 of those of each block; those,
    filled up with zeros to a power of two of at least 32 bytes; the MD5 of that, in hex. A task
    reads a block. block: a multiple of 512."""
    blocks = _ranges(spark, path, mode="crcs", size=block, polynomial=polynomial)
    each = blocks.groupBy("path").agg(F.sort_array(F.collect_list(F.when(F.col("md5").isNotNull(), F.struct("start", F.hex("md5").alias("md5"))))).alias("md5s"))
    held = F.size("md5s") * 16
    filled = F.when(held <= 32, 32).otherwise(F.call_function("shiftleft", F.lit(1), F.length(F.bin((held - 1).cast("long")))))
    text = F.concat(F.array_join(F.transform("md5s", lambda b: b["md5"]), ""), F.repeat(F.lit("00"), filled - held))
    return each.select("path", F.size("md5s").cast("long").alias("blocks"), F.md5(F.unhex(text)).alias("checksum"))
