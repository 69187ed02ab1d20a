"""Archives: exact round trips, and files that were damaged on purpose."""

from __future__ import annotations

import base64
import hashlib
import struct
from pathlib import Path

import pytest
import zstandard

from helixframe.llm import warc

HTML = "<html><body><p>{}</p></body></html>"


@pytest.fixture
def pages(spark):
    rows = [(k, f"http://h{k % 3}.org/{k}", HTML.format(f"text {k % 40} " * (k % 50))) for k in range(300)]
    rows += [
        (400, None, None),
        (401, "", ""),
        (402, "http://a b\r\nWARC-Type: x", "odd url"),
        (403, "http://x", "Ünïcode   漢字 \u0000 text"),
        (404, "http://long", "long " * 400_000),
        (405, "http://r", "repeated row"),
        (405, "http://r", "repeated row"),
        (None, "http://null", "null id, alone"),
        (None, "http://null", rows[7][2]),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return df.selectExpr("*", "1 AS digest", "2 AS payload", "3 AS first").repartition(3)


def expected(rows, min_bytes=0):
    out, first = [], {}
    for row in rows:
        data = (row["html"] or "").encode()
        if row["page_id"] is not None:
            first[data] = min(first.get(data, row["page_id"]), row["page_id"])
    for row in rows:
        data = (row["html"] or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        target = first.get(data) if len(data) >= min_bytes else None
        revisit = target is not None and target != row["page_id"]
        kind = "revisit" if revisit else "response"
        out.append((row["page_id"], len(data), digest, kind, target if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("min_bytes", [0, 100])
def test_round_trip(pages, tmp_path, min_bytes):
    found = warc.round_trip(pages, str(tmp_path / "out"), min_bytes).collect()
    assert all(row["error"] is None for row in found)
    assert sorted((tuple(row)[:5] for row in found), key=str) == expected(pages.collect(), min_bytes)
    urls = {row["page_id"]: row["target_uri"] for row in found}
    assert urls[400] is None and urls[402] == "http://a%20b%0D%0AWARC-Type:%20x"


def test_payloads_come_back(pages, tmp_path):
    manifest = warc.write_archives(pages, str(tmp_path), archive_bytes=2000)
    listed = manifest.collect()
    # Several archives per task, each one complete
    assert len(listed) > 6 and not list(tmp_path.glob("*.part"))
    assert sum(row["records"] for row in listed) == pages.count()
    assert all((tmp_path / row["archive"]).stat().st_size == row["bytes"] for row in listed)
    records = [row.asDict() for row in warc.read_archives(manifest, str(tmp_path)).collect()]
    held = {row["payload_digest"]: row["payload"] for row in records if row["type"] == "response"}
    for row in pages.collect():
        data = (row["html"] or "").encode()
        assert held[warc.sha1_base32(data)] == data
    revisits = [row for row in records if row["type"] == "revisit"]
    assert revisits and all(row["payload"] is None and row["refers_to"] for row in revisits)


def test_archives_outside_of_the_manifest_do_not_count(pages, tmp_path):
    manifest = warc.write_archives(pages, str(tmp_path))
    (tmp_path / "left-by-a-lost-executor.warc.zst").write_bytes(b"junk")
    assert warc.read_archives(manifest, str(tmp_path)).where("error IS NOT NULL").count() == 0


def test_no_pages(pages, tmp_path):
    assert warc.round_trip(pages.where("false"), str(tmp_path)).count() == 0


def archive(payloads: list[bytes], dictionary: bytes = b"") -> list[bytes]:
    pack = warc.compressor(dictionary)
    digests = map(warc.sha1_base32, payloads)
    both = zip(payloads, digests, strict=True)
    frames = [pack.compress(warc.record_bytes(k, "http://x", it, d, None)) for k, (it, d) in enumerate(both)]
    return [warc.dictionary_frame(dictionary), *frames]


@pytest.fixture(scope="module")
def dictionary() -> bytes:
    samples = [HTML.format(f"sample {k} of some words {k * 7} " * 20).encode() for k in range(200)]
    return zstandard.train_dictionary(4096, samples).as_bytes()


def test_dictionary_frame(dictionary):
    payloads = [HTML.format(f"sample {k} of some words " * 9).encode() for k in range(20)]
    plain, packed = archive(payloads), archive(payloads, dictionary)
    assert [row["payload"] for row in warc.parse_archive(b"".join(packed))] == payloads
    assert [row["payload"] for row in warc.parse_archive(b"".join(plain))] == payloads
    # An uncompressed dictionary is allowed, too
    raw = struct.pack("<II", warc.SKIPPABLE_MAGIC, len(dictionary)) + dictionary
    assert [row["payload"] for row in warc.parse_archive(raw + b"".join(packed[1:]))] == payloads
    # Without its dictionary a frame can't be read
    assert "error" in warc.parse_archive(b"".join(packed[1:]))[0]
    offsets = [row["offset"] for row in warc.parse_archive(b"".join(packed))]
    assert offsets[0] == len(packed[0]) and offsets[1] - offsets[0] == len(packed[1])


def test_frames_of_any_size(monkeypatch, dictionary):
    payloads = [b"x" * k * 1000 for k in (0, 1, 500, 3)]
    whole = b"".join(archive(payloads, dictionary))
    for step in (1, 7, 1 << 20):
        monkeypatch.setattr(warc, "READ_BYTES", step)
        assert [row["payload"] for row in warc.parse_archive(whole)] == payloads


def problems(data: bytes) -> list[str | None]:
    return [row.get("error") for row in warc.parse_archive(data)]


def test_damage_is_noticed(dictionary):
    head, *frames = archive([b"one payload", b"another payload", b"third"], dictionary)
    assert problems(head + b"".join(frames)) == [None, None, None]
    assert problems((head + b"".join(frames))[:-3])[-1] == "frame is cut off"
    assert problems(head[: len(head) // 2]) == ["dictionary frame is cut off"]
    bad = bytearray(frames[1])
    bad[-1] ^= 1  # the frame's checksum
    found = problems(head + frames[0] + bytes(bad) + frames[2])
    assert found[0] is None and found[1] is not None
    assert problems(b"junk that is no frame") != [None]
    assert problems(b"") == []


RECORD = warc.record_bytes(1, "http://x", b"payload", warc.sha1_base32(b"payload"), None)


@pytest.mark.parametrize(
    ("old", "new", "problem"),
    [
        (b"WARC/1.1", b"WARC/0.9", "not a WARC record"),
        (b"WARC-Type: response\r\n", b"", "warc-type is missing"),
        (b"WARC-Date", b"WARC Date", "malformed header field"),
        (b"payload\r\n\r\n", b"payloads\r\n\r\n", "Content-Length does not fit"),
        (b"payload\r\n\r\n", b"payl0ad\r\n\r\n", "block digest does not fit"),
        (b"\r\n\r\n", b"\r\n", "Content-Length does not fit"),
        (b"sha1:", b"md5:", "warc-block-digest is not a SHA-1"),
    ],
)
def test_checks_of_a_record(old, new, problem):
    assert warc.parse_record(RECORD)["payload"] == b"payload"
    damaged = RECORD.replace(old, new)
    if problem == "Content-Length does not fit" and old == b"\r\n\r\n":
        damaged = RECORD[:-2]
    with pytest.raises(ValueError, match=problem):
        warc.parse_record(damaged)


def test_revisits_without_response(spark, pages, tmp_path):
    manifest = warc.write_archives(pages, str(tmp_path))
    records = warc.read_archives(manifest, str(tmp_path), payloads=False)
    revisited = warc.resolve_revisits(records.where("type = 'revisit'"))
    assert revisited.where("error IS NULL").count() == 0 < revisited.count()


def test_base32_column(spark):
    texts = ["", "a", "Ünïcode", "x" * 1000]
    df = spark.createDataFrame([(it,) for it in texts], "t string")
    found = [row[0] for row in df.select(warc.sha1_base32_column(df.t)).collect()]
    assert found == [warc.sha1_base32(it.encode()) for it in texts]


def test_archives_are_removed_by_the_query(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(warc, "checkpoint_folder", lambda spark: str(tmp_path))
    assert warc.warc_archives(spark, "/root/testdata/sf0.001").count() == 50
    assert list(Path(tmp_path).iterdir()) == []
