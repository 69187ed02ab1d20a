"""Lines of files, in parts of any size and compressed in any way."""

from __future__ import annotations

import bz2
import gzip
import lzma
import random
import struct
import zlib

import pytest
import zstandard

from helixframe.sources import lines, sam, tables


def block_compressed(data: bytes, size: int) -> bytes:
    """Blocks with their length in an extra field of the header, and an empty one at the end."""
    out = []
    for at in [*range(0, len(data), size), len(data)]:
        part = data[at : at + size]
        packer = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = packer.compress(part) + packer.flush()
        header = b"\x1f\x8b\x08\x04" + bytes(6) + struct.pack("<H", 6) + b"BC\x02\x00"
        total = len(header) + 2 + len(body) + 8
        trailer = struct.pack("<II", zlib.crc32(part), len(part))
        out.append(header + struct.pack("<H", total - 1) + body + trailer)
    return b"".join(out)


def members(data: bytes) -> bytes:
    half = len(data) // 2
    return gzip.compress(data[:half]) + gzip.compress(data[half:])


KINDS = {
    "plain": lambda data: data,
    "gzip": gzip.compress,
    "members": members,
    "bzip2": bz2.compress,
    "xz": lzma.compress,
    "zstd": lambda data: zstandard.ZstdCompressor().compress(data),
    "blocks": lambda data: block_compressed(data, 700),
}


def text_lines(seed: int) -> list[str]:
    rng = random.Random(seed)
    long = "x" * 5000
    return [rng.choice(["", "a", "éü 漢字", "tab\there", "b" * 90, "\r", long]) for _ in range(400)]


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("end", ["\n", ""])
@pytest.mark.parametrize("split_bytes", [97, 4096, 1 << 26])
def test_lines_of_splits(tmp_path, kind, end, split_bytes):
    """Every split of a file by itself, without Spark: no line is lost or read twice."""
    expected = [*text_lines(3), "last"]
    (tmp_path / "no-extension").write_bytes(KINDS[kind](("\n".join(expected) + end).encode()))
    reader = lines.LineReader([str(tmp_path)], split_bytes)
    parts = reader.partitions()
    assert (len(parts) > 1) == (split_bytes < 1 << 26 and kind in ("plain", "blocks"))
    found = [row["value"] for part in parts for batch in reader.read(part) for row in batch.to_pylist()]
    assert found == expected


@pytest.mark.parametrize("seed", range(4))
def test_splits_at_any_byte(tmp_path, seed):
    rng = random.Random(seed)
    text = "".join(rng.choice("ab\n") for _ in range(60)).encode()
    (tmp_path / "f").write_bytes(text)
    expected = text.decode().split("\n")
    if expected[-1] == "":
        expected.pop()
    for step in range(1, 62):
        reader = lines.LineReader([str(tmp_path / "f")], step)
        found = [r for part in reader.partitions() for b in reader.read(part) for r in b.column("value").to_pylist()]
        assert found == expected, step


@pytest.mark.parametrize("split_bytes", [200, 1 << 26])
def test_numbers_of_lines(spark, tmp_path, split_bytes):
    texts = {"a.txt": [f"a{k}" for k in range(300)], "b.gz": [], "c": ["c0", "", "c2"]}
    for name, text in texts.items():
        data = "".join(f"{it}\n" for it in text).encode()
        (tmp_path / name).write_bytes(gzip.compress(data) if name == "c" else data)
    (tmp_path / "_SUCCESS").write_text("")
    rows = lines.read_lines(spark, str(tmp_path), split_bytes).collect()
    found = {(r["number"], r["line"]): r["value"] for r in rows}
    assert found == {
        (k, at): value for k, text in enumerate(texts.values()) for at, value in enumerate(text)
    }
    plan = lines.numbered_lines(spark, str(tmp_path))._jdf.queryExecution().toString()
    assert plan.split("== Physical Plan ==")[1].count("BatchScan") == 1


def test_damaged_blocks_fail(tmp_path):
    data = bytearray(block_compressed(b"line\n" * 1000, 700))
    data[len(data) // 2] ^= 255
    (tmp_path / "f").write_bytes(bytes(data))
    reader = lines.LineReader([str(tmp_path / "f")], 1 << 26)
    with pytest.raises((ValueError, zlib.error)):
        [batch for part in reader.partitions() for batch in reader.read(part)]
    with pytest.raises(FileNotFoundError):
        lines.splits([str(tmp_path / "missing")], 1)


def test_compressed_alignments_without_extension(spark, tmp_path):
    header = "@SQ\tSN:c1\tLN:50\n@RG\tID:r1\tSM:s\n"
    body = "".join(f"q{k}\t0\tc1\t{k + 1}\t30\t2M\t*\t0\t0\tAC\tII\tRG:Z:r1\n" for k in range(20))
    (tmp_path / "one").write_bytes(gzip.compress((header + body).encode()))
    (tmp_path / "two").write_bytes(block_compressed((header + body).encode(), 100))
    records, contigs, readgroups = sam.read_alignments(spark, str(tmp_path))
    assert records.select("read_id").distinct().count() == records.count() == 40
    ordered = [r["qname"] for r in records.orderBy("read_id").collect()]
    assert ordered == [f"q{k}" for k in range(20)] * 2
    assert [tuple(r) for r in contigs.collect()] == [(0, "c1", 50)] and readgroups.count() == 1


def test_tables_of_several_files(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("# note\nx\ty\n1\t\n\n")
    (tmp_path / "b.gz").write_bytes(gzip.compress(b"x\ty\n2\tb\n"))
    rows = tables.read_tsv(spark, str(tmp_path)).collect()
    assert sorted(tuple(r) for r in rows) == [("1", None), ("2", "b")]
    (tmp_path / "c").write_text("z\ty\n")
    with pytest.raises(ValueError, match="different headers"):
        tables.read_tsv(spark, str(tmp_path))
    with pytest.raises(ValueError, match="no header"):
        tables.read_tsv(spark, [])
