"""Zstandard-compressed web archives: a writer and a validating reader.

An archive begins with a skippable frame that holds the dictionary; every record is a frame of its
own. Tasks write archives of about ``ARCHIVE_BYTES`` each, below one folder that all tasks share. An
archive gets a name of its own at every attempt and is renamed when it is complete; the manifest, a
table written by Spark, lists those of the attempts that counted, and only these are read. The folder
is reached through Arrow's file systems (local, HDFS, S3, GS), as Spark has no writer for such files.

The reader streams a file record by record: it loads the dictionary, decodes one frame, checks the
version line, the header fields and their lengths, the digests of block and payload, and what HTTP says of
the payload's length. A record that fails a check has a row that says why in ``error``; so has a file whose
rest can't be decoded. Without a dictionary frame the records are read as plain frames.

Of pages with equal payloads (same SHA-1 and same 64-bit hash) the one with the smallest ``page_id`` is
the response, and the others are revisits that hold no payload; payloads of less than ``min_bytes``
are all responses. A null html is an empty payload. A null id is larger than all others and leaves no field
in the header. Pages that are equal in id and payload are equal records. Spaces and control characters
in a url are percent-encoded; a null url leaves no field. An empty table gives no archives and an empty
result; columns besides ``page_id``, ``url`` and ``html`` are never looked at.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
import zstandard
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm.common import checkpoint_folder, checkpointed, filled, read
from helixframe.llm.queries import query
from helixframe.plans.skew import skew_join

#: Payloads below this size are never replaced by a revisit.
MIN_BYTES = 0
#: Compressed size at which a task begins another archive.
ARCHIVE_BYTES = 256 << 20
#: The dictionary is trained on the beginnings of at most so many pages; it changes sizes only.
DICTIONARY_PAGES = 256
DICTIONARY_PAGE_CHARS = 16_384
DICTIONARY_BYTES = 64 << 10
#: Payload bytes after which the reader hands on what it has decoded.
BATCH_BYTES = 8 << 20
BATCH_RECORDS = 1000
READ_BYTES = 1 << 16
DATE = "2020-01-01T00:00:00Z"

# Fixed values of the formats
SKIPPABLE_MAGIC = 0x184D2A5D
DICTIONARY_MAGIC = b"\x37\xa4\x30\xec"
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

PAGE_FIELD = "X-Page-ID"
RECORD_COLUMNS = (
    "archive string, record long, offset long, type string, record_id string, page_id long, "
    "target_uri string, refers_to string, payload_digest string, payload_bytes long, "
    "payload binary, error string"
)
_NAMES = [it.split()[0] for it in RECORD_COLUMNS.split(", ")]
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data, usedforsecurity=False).digest()).decode()


def sha1_base32_column(data: Column) -> Column:
    """Upper-case base32 of the SHA-1, 40 bits at a time."""
    sha = F.sha1(data)
    numbers = [F.conv(F.substring(sha, at, 10), 16, 32) for at in (1, 11, 21, 31)]
    digits = F.concat(*(F.lpad(number, 8, "0") for number in numbers))
    return F.translate(digits, "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32_DIGITS)


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


# Writing


def planned_records(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Pages with the digest of their payload, and the page they revisit if they do."""
    payload = F.encode(filled("html"), "UTF-8")
    pages = pages.select("page_id", "url", payload.alias("payload"))
    known = pages.withColumns(
        {"digest": sha1_base32_column(F.col("payload")), "hash": F.xxhash64("payload")}
    )
    # Only payloads that occur again have a first page; one digest may hold a third of all pages
    first = (
        known.where(F.octet_length("payload") >= min_bytes)
        .groupBy("digest", "hash")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 AND first IS NOT NULL")
        .drop("n")
    )
    first = checkpointed(first)
    joined = skew_join(known, first, ["digest", "hash"], "left", salt_by=["page_id", "url"])
    revisits = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return joined.select("page_id", "url", "payload", "digest", revisits.alias("first"))


def train_dictionary(pages: DataFrame) -> bytes:
    """A dictionary from the beginnings of a bounded number of pages, or none if there are too few."""
    ids = pages.select("page_id").where("page_id IS NOT NULL").orderBy(F.xxhash64("page_id"), "page_id")
    ids = [row[0] for row in ids.limit(DICTIONARY_PAGES).collect()]
    start = F.substring("html", 1, DICTIONARY_PAGE_CHARS).alias("html")
    chosen = pages.where(F.col("page_id").isin(ids) & F.col("html").isNotNull()).select("page_id", start)
    chosen = chosen.orderBy("page_id", "html").limit(DICTIONARY_PAGES).collect()
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, [row["html"].encode() for row in chosen]).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _uri(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda it: f"%{ord(it[0]):02X}", url)


def record_bytes(
    page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None
) -> bytes:
    """A response record, or without its payload a revisit of the page ``first``."""
    revisit = first is not None
    block = _HTTP.format(len(payload)).encode() + (b"" if revisit else payload)
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id, digest)),
        ("WARC-Date", DATE),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", _uri(url)))
    if page_id is not None:
        fields.append((PAGE_FIELD, str(page_id)))
    if revisit:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(first, digest))]
    fields += [
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    header = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return b"WARC/1.1\r\n" + header.encode() + b"\r\n" + block + b"\r\n\r\n"


def dictionary_frame(dictionary: bytes) -> bytes:
    """The leading frame of an archive; the dictionary is compressed in it, without one of its own."""
    if not dictionary:
        return b""
    packed = zstandard.ZstdCompressor().compress(dictionary)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(packed)) + packed


def compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    trained = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=3, dict_data=trained, write_checksum=True)


def write_archives(
    pages: DataFrame, folder: str, min_bytes: int = MIN_BYTES, archive_bytes: int = ARCHIVE_BYTES
) -> DataFrame:
    """Write the pages below ``folder``; returns the manifest (archive, records, bytes)."""
    spark = pages.sparkSession
    dictionary = train_dictionary(pages)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, root = fs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        pack, head = compressor(dictionary), dictionary_frame(dictionary)
        done, out, name, records, size = [], None, "", 0, 0

        def close() -> None:
            out.close()
            files.move(f"{root}/{name}.part", f"{root}/{name}")
            done.append((name, records, size))

        for batch in batches:
            for row in batch.itertuples(index=False):
                page_id, first = (None if pd.isna(it) else int(it) for it in (row.page_id, row.first))
                if out is None:
                    name, records, size = f"{uuid.uuid4().hex}.warc.zst", 0, len(head)
                    out = files.open_output_stream(f"{root}/{name}.part", compression=None)
                    out.write(head)
                frame = pack.compress(record_bytes(page_id, row.url, row.payload, row.digest, first))
                out.write(frame)
                records, size = records + 1, size + len(frame)
                if size >= archive_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        if done:
            yield pd.DataFrame(done, columns=["archive", "records", "bytes"])

    # Ids as text: a null would turn whole numbers into floating ones on their way to pandas
    planned = planned_records(pages, min_bytes).withColumns(
        {name: F.col(name).cast("string") for name in ("page_id", "first")}
    )
    written = planned.mapInPandas(write, "archive string, records long, bytes long")
    written.write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


# Reading


class _Frames:
    """The frames of an archive one after another, whatever their size, and its dictionary."""

    def __init__(self, stream: BinaryIO):
        self.stream, self.rest, self.offset = stream, b"", 0
        trained = None
        if self._has(8) and struct.unpack("<I", self.rest[:4])[0] == SKIPPABLE_MAGIC:
            size = struct.unpack("<I", self.rest[4:8])[0]
            if not self._has(8 + size):
                raise ValueError("dictionary frame is cut off")
            data, self.rest, self.offset = self.rest[8 : 8 + size], self.rest[8 + size :], 8 + size
            if data[:4] == FRAME_MAGIC:
                data = zstandard.ZstdDecompressor().decompressobj().decompress(data)
            if data[:4] != DICTIONARY_MAGIC:
                raise ValueError("dictionary frame holds no dictionary")
            trained = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_FULLDICT)
        self.decompressor = zstandard.ZstdDecompressor(dict_data=trained)

    def _has(self, size: int) -> bool:
        while len(self.rest) < size:
            more = self.stream.read(max(READ_BYTES, size - len(self.rest)))
            if not more:
                return False
            self.rest += more
        return True

    def __iter__(self) -> Iterator[tuple[int, bytes]]:
        while self._has(1):
            frame, parts, begin = self.decompressor.decompressobj(), [], self.offset
            while not frame.eof:
                if not self._has(1):
                    raise ValueError("frame is cut off")
                chunk, self.rest = self.rest, b""
                parts.append(frame.decompress(chunk))
                self.rest = frame.unused_data
                self.offset += len(chunk) - len(self.rest)
            yield begin, b"".join(parts)


def _digest_field(fields: dict[str, str], name: str) -> str:
    kind, _, value = fields.get(name, "").partition(":")
    if kind.lower() != "sha1" or not value:
        raise ValueError(f"{name} is not a SHA-1")
    return value


def _length(fields: dict[str, str]) -> int:
    value = fields.get("content-length", "")
    if not re.fullmatch("[0-9]+", value):
        raise ValueError("Content-Length is not a number")
    return int(value)


def _fields(lines: list[str]) -> dict[str, str]:
    fields = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon or not re.fullmatch(r"[!-9;-~]+", name):
            raise ValueError("malformed header field")
        fields[name.lower()] = value.strip(" \t")
    return fields


def parse_record(data: bytes) -> dict:
    """The fields of one record; raises ValueError where a check fails."""
    header, gap, rest = data.partition(b"\r\n\r\n")
    if not gap:
        raise ValueError("header has no end")
    version, *lines = header.decode().split("\r\n")
    if version not in ("WARC/1.0", "WARC/1.1"):
        raise ValueError("not a WARC record")
    fields = _fields(lines)
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise ValueError(f"{name} is missing")
    size = _length(fields)
    block, end = rest[:size], rest[size:]
    if len(block) != size or end != b"\r\n\r\n":
        raise ValueError("Content-Length does not fit")
    if "warc-block-digest" in fields and _digest_field(fields, "warc-block-digest") != sha1_base32(block):
        raise ValueError("block digest does not fit")
    record = {
        "type": fields["warc-type"],
        "record_id": fields["warc-record-id"],
        "page_id": fields.get(PAGE_FIELD.lower()),
        "target_uri": fields.get("warc-target-uri"),
        "refers_to": fields.get("warc-refers-to"),
    }
    if record["type"] in ("response", "revisit"):
        http, gap, payload = block.partition(b"\r\n\r\n")
        if not gap or not http.startswith(b"HTTP/"):
            raise ValueError("HTTP header has no end")
        said = _length(_fields(http.decode("latin-1").split("\r\n")[1:]))
        digest = _digest_field(fields, "warc-payload-digest")
        if record["type"] == "response":
            if said != len(payload) or digest != sha1_base32(payload):
                raise ValueError("payload does not fit")
            record["payload"] = payload
        elif payload or record["refers_to"] is None:
            raise ValueError("revisit with a payload or without a response")
        record |= {"payload_digest": digest, "payload_bytes": said}
    return record


def decoded_records(stream: BinaryIO) -> Iterator[dict]:
    """All records of an archive in order, those that fail a check with their ``error``."""
    number, offset = 0, 0
    try:
        frames = _Frames(stream)
        for offset, data in frames:
            try:
                yield {"record": number, "offset": offset} | parse_record(data)
            except ValueError as problem:
                yield {"record": number, "offset": offset, "error": str(problem)}
            number, offset = number + 1, frames.offset
    except (ValueError, zstandard.ZstdError) as problem:
        yield {"record": number, "offset": offset, "error": str(problem)}


def read_archives(manifest: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """One row per record of the archives of a manifest, and of those that can't be read.

    Archives are dealt one to a task as far as hashing allows. Without ``payloads`` their column is
    null, while all checks are made.
    """

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, root = fs.FileSystem.from_uri(folder)
        for name in (it for batch in batches for it in batch["archive"]):
            found, size = [], 0
            with files.open_input_stream(f"{root}/{name}", compression=None, buffer_size=READ_BYTES << 4) as stream:
                for record in decoded_records(stream):
                    if not payloads:
                        record.pop("payload", None)
                    found.append(record | {"archive": name})
                    size += len(record.get("payload", b""))
                    if size >= BATCH_BYTES or len(found) >= BATCH_RECORDS:
                        yield _frame(found)
                        found, size = [], 0
            yield _frame(found)

    archives = manifest.select("archive")
    dealt = archives.repartition(max(1, archives.count()), "archive")
    return dealt.mapInPandas(decode, RECORD_COLUMNS)


def _frame(records: list[dict]) -> pd.DataFrame:
    frame = pd.DataFrame(records, columns=_NAMES)
    return frame.assign(
        page_id=pd.array([_number(it.get("page_id")) for it in records], "Int64"),
        payload_bytes=pd.array([it.get("payload_bytes") for it in records], "Int64"),
    ).astype({name: object for name in _NAMES if name not in ("record", "offset", "page_id", "payload_bytes")})


def _number(text: str | None) -> int | None:
    return int(text) if text is not None and re.fullmatch("-?[0-9]{1,19}", text) else None


def parse_archive(data: bytes) -> list[dict]:
    """The records of one archive in memory, for tests and small files."""
    return list(decoded_records(io.BytesIO(data)))


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Records with the page that they revisit, found by the id of its record.

    A revisit whose response is missing, or has another digest or length, gets an ``error``.
    """
    valid = records.where("type = 'response' AND error IS NULL")
    responses = valid.groupBy(F.col("record_id").alias("refers_to")).agg(
        F.min("page_id").alias("first"), F.min(F.struct("payload_digest", "payload_bytes")).alias("held")
    )
    referred = records.select("refers_to").where("refers_to IS NOT NULL").distinct()
    responses = checkpointed(responses.join(referred, "refers_to"))
    joined = skew_join(records, responses, ["refers_to"], "left", salt_by=["archive", "record"])
    fits = F.struct("payload_digest", "payload_bytes") == F.col("held")
    lost = (F.col("type") == "revisit") & ~F.coalesce(fits, F.lit(False))
    problem = F.coalesce("error", F.when(lost, F.lit("response of the revisit is missing")))
    return joined.withColumn("error", problem).drop("held")


def round_trip(pages: DataFrame, folder: str, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Write the pages, read the archives back, and return what they say about each page."""
    manifest = write_archives(pages, folder, min_bytes)
    records = checkpointed(read_archives(manifest, folder, payloads=False))
    return resolve_revisits(records).select(
        "page_id",
        "payload_bytes",
        "payload_digest",
        F.col("type").alias("record_type"),
        F.col("first").alias("refers_to"),
        "target_uri",
        "error",
    )


SQL = f"""
WITH payloads AS (
    SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(encode(coalesce(html, ''))) AS sha FROM pages
),
digests AS (
    SELECT page_id, octet_length(payload) AS payload_bytes, sha,
           list_aggregate(list_transform(range(32), lambda k: substr('{BASE32_DIGITS}', 1 + CAST(
               (CAST('0x' || substr(sha, 10 * CAST(k // 8 AS INTEGER) + 1, 10) AS BIGINT)
                >> CAST(35 - 5 * (k % 8) AS BIGINT)) & 31 AS INTEGER), 1)), 'string_agg', '') AS payload_digest
    FROM payloads
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM (SELECT *, min(page_id) OVER (PARTITION BY sha) AS first FROM digests WHERE payload_bytes >= {MIN_BYTES}
      UNION ALL SELECT *, page_id FROM digests WHERE payload_bytes < {MIN_BYTES})
"""


@query("op12_warc_archives", SQL)
def warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{checkpoint_folder(spark)}/warc-{uuid.uuid4().hex}"
    found = round_trip(read(spark, sf_dir, "pages"), folder)
    # What the archives said is in the checkpoint by now
    files, root = fs.FileSystem.from_uri(folder)
    files.delete_dir(root)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
