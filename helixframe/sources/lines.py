"""Text files as numbered lines, compressed or not."""

from __future__ import annotations

import bz2
import gzip
import json
import lzma
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Bytes of a file that a task reads, if the file can be split.
SPLIT_BYTES = 64 << 20
READ_BYTES = 1 << 20
BATCH_LINES = 10_000
#: Lines of a file that have ids of their own.
FILE_LINES = 1 << 40

# How compressed files begin
MAGIC = {
    "gzip": b"\x1f\x8b",
    "bzip2": b"BZh",
    "zstd": b"\x28\xb5\x2f\xfd",
    "xz": b"\xfd7zXZ\x00",
}
# Header of a block of block-compressed gzip, and the length of its trailer
BLOCK_MAGIC = b"\x1f\x8b\x08\x04"
BLOCK_FIELD = b"BC\x02\x00"
BLOCK_HEADER, BLOCK_TRAILER, LARGEST_BLOCK = 18, 8, 1 << 16


@dataclass
class Split(InputPartition):
    """Part of a file: what begins in ``[start, end)``."""

    file: str
    number: int
    split: int
    kind: str
    start: int
    end: int


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def _compression(head: bytes) -> str:
    """How a file is compressed, by what it begins with and not by its name."""
    if head[:4] == BLOCK_MAGIC and head[12:16] == BLOCK_FIELD:
        return "blocks"
    return next((kind for kind, magic in MAGIC.items() if head.startswith(magic)), "plain")


def splits(paths: list[str], split_bytes: int) -> list[Split]:
    """The parts of all files, or of the files of folders, in the order of their names."""
    found = []
    for path in paths:
        system, root = _file_system(path)
        info = system.get_file_info(root)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(path)
        listed = [info] if info.is_file else system.get_file_info(fs.FileSelector(root))
        prefix = path[: len(path) - len(root)] if path.endswith(root) and path != root else ""
        for it in listed:
            if it.is_file and (info.is_file or not it.base_name.startswith(("_", "."))):
                found.append((f"{prefix}{it.path}", system, it))
    out = []
    for number, (name, system, info) in enumerate(sorted(found, key=lambda it: it[0])):
        with system.open_input_file(info.path) as stream:
            kind = _compression(stream.read(BLOCK_HEADER))
        step = split_bytes if kind in ("plain", "blocks") else max(1, info.size)
        for split, start in enumerate(range(0, max(1, info.size), step)):
            out.append(Split(name, number, split, kind, start, min(start + step, info.size)))
    return out


# Bytes of a split: those before its end, and then as many as its last line needs


def _plain(stream: pa.NativeFile, start: int, end: int) -> Iterator[tuple[bytes, bool]]:
    """Bytes from ``start`` on, and whether they come before ``end``."""
    stream.seek(start)
    at = start
    while data := stream.read(min(READ_BYTES, end - at) if at < end else READ_BYTES):
        yield data, at < end
        at += len(data)


def _block_size(header: bytes) -> int | None:
    """Bytes of the block that begins here, or None if none does."""
    if len(header) < BLOCK_HEADER or header[:4] != BLOCK_MAGIC or header[12:16] != BLOCK_FIELD:
        return None
    return struct.unpack("<H", header[16:18])[0] + 1


def _inflated(block: bytes) -> bytes | None:
    """Content of a block, or None if it isn't one."""
    try:
        data = zlib.decompress(block[BLOCK_HEADER:-BLOCK_TRAILER], wbits=-15)
    except zlib.error:
        return None
    check, size = struct.unpack("<II", block[-BLOCK_TRAILER:])
    return data if size == len(data) and check == zlib.crc32(data) else None


def _first_block(stream: pa.NativeFile, start: int) -> int:
    """Where the first block at or after ``start`` begins; bytes that look like one may not be."""
    stream.seek(start)
    data = stream.read(2 * LARGEST_BLOCK + BLOCK_HEADER)
    at = data.find(BLOCK_MAGIC)
    while at >= 0:
        size = _block_size(data[at : at + BLOCK_HEADER])
        if size is not None and _inflated(data[at : at + size]) is not None:
            return start + at
        at = data.find(BLOCK_MAGIC, at + 1)
    return start + len(data)


def _blocks(stream: pa.NativeFile, start: int, end: int) -> Iterator[tuple[bytes, bool]]:
    """Content of the blocks from ``start`` on, and whether they begin before ``end``."""
    at = _first_block(stream, start) if start else 0
    while True:
        stream.seek(at)
        header = stream.read(BLOCK_HEADER)
        if not header:
            return
        size = _block_size(header)
        data = None if size is None else _inflated(header + stream.read(size - BLOCK_HEADER))
        if data is None:
            raise ValueError(f"no block of compressed data at {at}")
        if data:
            yield data, at < end
        at += size


def _whole(stream: BinaryIO, kind: str) -> Iterator[tuple[bytes, bool]]:
    """Content of a compressed file of one or more members."""
    if kind == "gzip":
        reader = gzip.GzipFile(fileobj=stream)
    elif kind == "bzip2":
        reader = bz2.BZ2File(stream)
    elif kind == "xz":
        reader = lzma.LZMAFile(stream)
    else:
        reader = zstandard.ZstdDecompressor().stream_reader(stream, read_across_frames=True)
    while data := reader.read(READ_BYTES):
        yield data, True


def split_lines(chunks: Iterator[tuple[bytes, bool]], skip_first: bool) -> Iterator[list[bytes]]:
    """Lines that end with the first line feed at or after the split's end, in lists.

    What comes before the first line feed of a split belongs to the split before, unless it is the first.
    """
    rest: list[bytes] = []
    skipping = skip_first
    for data, inside in chunks:
        if skipping or not inside:
            cut = data.find(b"\n")
            if cut < 0:
                if not skipping:
                    rest.append(data)
                continue
            if not inside:
                # The split's last line, if any of it has begun to be read
                if not skipping:
                    yield [b"".join([*rest, data[:cut]])]
                return
            data, skipping = data[cut + 1 :], False
        *lines, last = data.split(b"\n")
        if lines:
            lines[0] = b"".join([*rest, lines[0]])
            rest = []
            yield lines
        rest.append(last)
    if any(rest):
        yield [b"".join(rest)]


def _text(lines: list[bytes]) -> pa.Array:
    try:
        return pa.array(lines, pa.binary()).cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([it.decode("utf-8", "replace") for it in lines], pa.string())


class LineReader(DataSourceReader):
    def __init__(self, paths: list[str], split_bytes: int):
        self.paths, self.split_bytes = paths, split_bytes

    def partitions(self) -> list[Split]:
        return splits(self.paths, self.split_bytes)

    def read(self, partition: Split | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # there are no files
            return
        system, path = _file_system(partition.file)
        row = 0
        with system.open_input_file(path) as stream:
            if partition.kind in ("plain", "blocks"):
                read = _plain if partition.kind == "plain" else _blocks
                chunks = read(stream, partition.start, partition.end)
            else:
                chunks = _whole(stream, partition.kind)
            for lines in split_lines(chunks, partition.split > 0):
                for at in range(0, len(lines), BATCH_LINES):
                    some = lines[at : at + BATCH_LINES]
                    count = len(some)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([partition.file] * count, pa.string()),
                            pa.array([partition.number] * count, pa.int64()),
                            pa.array([partition.split] * count, pa.int64()),
                            pa.array(range(row, row + count), pa.int64()),
                            _text(some),
                        ],
                        names=["file", "number", "split", "row", "value"],
                    )
                    row += count


class LineSource(DataSource):
    """Lines of text files: ``(file, number, split, row, value)``.

    ``number`` counts the files in the order of their names, ``split`` the parts of a file, and
    ``row`` the lines of a part.
    """

    @classmethod
    def name(cls) -> str:
        return "helixframe_lines"

    def schema(self) -> str:
        return "file string, number long, split long, row long, value string"

    def reader(self, schema) -> LineReader:
        return LineReader(json.loads(self.options["paths"]), int(self.options["splitbytes"]))


def lines_of_splits(
    spark: SparkSession, path: str | list[str], split_bytes: int = SPLIT_BYTES
) -> DataFrame:
    """Lines of text files as ``LineSource`` reads them, in one scan.

    Compression (gzip, bzip2, zstd, xz) is recognised by content. Plain files and block-compressed ones
    are dealt out in parts of ``split_bytes``; other compressed files are read by one task each.
    """
    paths = [path] if isinstance(path, str) else list(path)
    spark.dataSource.register(LineSource)
    reader = spark.read.format(LineSource.name()).option("paths", json.dumps(paths))
    return reader.option("splitBytes", split_bytes).load()


def with_line_numbers(lines: DataFrame) -> DataFrame:
    """Add ``line``, counted from 0 within each file.

    Only files of several splits need the number of lines in the splits before, one row each; the
    splits of a file are known by their place in it, and so are the same in every scan.
    """
    counts = lines.groupBy("file", "split").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select("file", "split", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_shift"))
    shifts = shifts.where("split > 0")
    joined = lines.join(shifts, ["file", "split"], "left")
    return joined.withColumn("line", F.col("row") + F.coalesce("_shift", F.lit(0))).drop("_shift")


def read_lines(
    spark: SparkSession, path: str | list[str], split_bytes: int = SPLIT_BYTES
) -> DataFrame:
    """Lines with the number of their file, and of the line in it: ``(file, number, line, value)``."""
    paths = [path] if isinstance(path, str) else list(path)
    lines = lines_of_splits(spark, paths, split_bytes)
    if any(it.split for it in splits(paths, split_bytes)):
        numbered = with_line_numbers(lines)
    else:
        numbered = lines.withColumn("line", F.col("row"))
    return numbered.select("file", "number", "line", "value")


def numbered_lines(
    spark: SparkSession, path: str | list[str], split_bytes: int = SPLIT_BYTES
) -> DataFrame:
    """Lines of text files: ``(file, line, value)``, numbered from 0 within each file."""
    return read_lines(spark, path, split_bytes).drop("number")


def write_lines(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write a single text column, one line per row, in the order of the partitions."""
    lines.write.mode(mode).text(path)
