"""Substring deduplication by content-defined chunks.

A gear hash rolls over the last ``WINDOW`` bytes; where its upper bits are zero, a chunk ends. As
boundaries depend on nothing but these bytes, a passage has the same chunks wherever it stands,
except for those at its ends, and insertions shift no boundary after them. Chunks are compared by a
128-bit digest. Adjacent repeated chunks form runs, and runs of at least ``LEAST_RUN`` bytes count
as repeated; shorter ones are phrases that meet by chance.

Of a repeated chunk, the first occurrence in the document with the smallest id stays (a null id
comes last; documents that share the smallest id all keep theirs), the other ones are removed if
they stand in such a run and at least as many bytes in a row are to go. Null texts are empty. A row equal to another one in id and text is
reported with the repeats of both. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm.common import byte_array, checkpointed, filled, prefix_hashes, read, span_hashes
from helixframe.llm.queries import query
from helixframe.llm.spans import merge_spans

#: Bytes that the rolling hash covers: each shifts it by two bits.
WINDOW = 16
#: A chunk ends at one byte in 2**CUT_BITS.
CUT_BITS = 5
LONGEST_CHUNK = 4096
LEAST_RUN = 64

_random = np.random.default_rng(11)
_GEAR = _random.integers(0, 1 << 32, 256, dtype=np.uint32)
_OTHER_CODES = _random.integers(1, 1 << 63, 256, dtype=np.uint64)
_LAST = (1 << 63) - 1


def chunk_ends(data: np.ndarray) -> np.ndarray:
    """Where chunks end; the last one ends with the text."""
    gear = _GEAR[data]
    reach = 1
    while reach < WINDOW:
        before = np.zeros_like(gear)
        before[reach:] = gear[:-reach] << np.uint32(2 * reach)
        gear = gear + before
        reach *= 2
    cut = np.flatnonzero((gear >> np.uint32(32 - CUT_BITS)) == 0) + 1
    ends = np.unique(np.append(cut, len(data)))
    starts = np.concatenate(([0], ends[:-1]))
    if (ends - starts).max(initial=0) > LONGEST_CHUNK:
        pieces = [np.append(np.arange(a + LONGEST_CHUNK, b, LONGEST_CHUNK), b) for a, b in zip(starts, ends, strict=True)]
        ends = np.concatenate(pieces)
    return ends


def chunk_table(docs: DataFrame) -> DataFrame:
    """All chunks: (row, owner, start, end, digest_a, digest_b)."""

    def chunk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [(k, byte_array(text)) for k, text in enumerate(batch["text"]) if text]
            if not texts:
                continue
            found = []
            for _, data in texts:
                ends = chunk_ends(data)
                starts = np.concatenate(([0], ends[:-1]))
                digests = (
                    span_hashes(sums, starts, ends).view(np.int64)
                    for sums in (prefix_hashes(data), prefix_hashes(data, _OTHER_CODES))
                )
                found.append((starts, ends, *digests))
            own = np.repeat([k for k, _ in texts], [len(columns[0]) for columns in found])
            columns = [np.concatenate(it) for it in zip(*found, strict=True)]
            rows = {name: batch[name].to_numpy()[own] for name in ("row", "owner")}
            names = ("start", "end", "digest_a", "digest_b")
            yield pd.DataFrame(rows | dict(zip(names, columns, strict=True)))

    return _rows(docs, "text").mapInPandas(
        chunk, "row long, owner long, start int, end int, digest_a long, digest_b long"
    )


def _rows(docs: DataFrame, *columns: str) -> DataFrame:
    """Documents by a 64-bit hash of id and text, and the order in which they own chunks."""
    text = filled("text")
    return docs.select(
        F.xxhash64("doc_id", text).alias("row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("owner"),
        *(text.alias("text") if name == "text" else F.col(name) for name in columns),
    )


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """Per document (row) its chunks that occur more than once, with those that are not its own."""
    chunks = chunk_table(docs)
    digest = ["digest_a", "digest_b"]
    repeated = chunks.groupBy(*digest).agg(
        F.count("*").alias("times"), F.min("owner").alias("first_owner")
    )
    # Materialised, so that Spark can split a hot chunk in the join
    repeated = checkpointed(repeated.where("times > 1").drop("times"))
    hits = chunks.join(repeated, digest)
    chunk = F.struct("start", "end", "digest_a", (F.col("owner") == F.col("first_owner")).alias("own"))
    return hits.groupBy("row").agg(F.collect_set(chunk).alias("chunks"))


def find_spans(chunks: list) -> tuple[int, np.ndarray, np.ndarray]:
    """Bytes in long runs of repeated chunks, and the spans to remove."""
    ordered = sorted((it["start"], it["end"], it["digest_a"], it["own"]) for it in chunks)
    starts = np.array([it[0] for it in ordered], np.int64)
    ends = np.array([it[1] for it in ordered], np.int64)
    run_starts, run_ends = merge_spans(starts, ends)
    long = run_ends - run_starts >= LEAST_RUN
    in_run = long[np.searchsorted(run_starts, starts, side="right") - 1]
    seen: set[int] = set()
    gone = np.zeros(len(ordered), bool)
    for place, (_, _, digest, own) in enumerate(ordered):
        gone[place] = in_run[place] and (not own or digest in seen)
        seen.add(digest)
    # Very short chunks follow those around them
    cut_starts, cut_ends = merge_spans(*(it[gone | (in_run & (ends - starts < WINDOW))] for it in (starts, ends)))
    cut = cut_ends - cut_starts >= LEAST_RUN
    return int((run_ends - run_starts)[long].sum()), cut_starts[cut], cut_ends[cut]


def count_repeats(docs: DataFrame) -> DataFrame:
    """Per document its bytes, those in repeated runs, and the bytes and spans to be removed."""
    length = F.octet_length("text").cast("long").alias("n_bytes")
    joined = _rows(docs, "doc_id", "text").select("doc_id", "row", length)
    joined = joined.join(repeated_chunks(docs), "row", "left").drop("row")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for chunks in batch.pop("chunks"):
                if chunks is None:
                    rows.append((0, 0, 0))
                    continue
                repeated, starts, ends = find_spans(chunks)
                rows.append((repeated, int((ends - starts).sum()), len(starts)))
            names = ["n_repeated", "n_removed", "n_spans"]
            yield pd.concat([batch, pd.DataFrame(rows, columns=names, index=batch.index)], axis=1)

    schema = joined.drop("chunks").schema
    for name in ("n_repeated", "n_removed", "n_spans"):
        schema = schema.add(name, "long")
    return joined.mapInPandas(count, schema)


def deduplicated(docs: DataFrame) -> DataFrame:
    """(doc_id, text) without the removed spans. A character cut in half is replaced."""
    joined = _rows(docs, "doc_id", "text").join(repeated_chunks(docs), "row", "left")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = []
            for text, chunks in zip(batch["text"], batch["chunks"], strict=True):
                data, at, kept = text.encode("utf-8", "replace"), 0, []
                _, starts, ends = find_spans(chunks) if chunks is not None else (0, [], [])
                for start, end in zip(starts, ends, strict=True):
                    kept.append(data[at:start])
                    at = end
                texts.append(b"".join([*kept, data[at:]]).decode("utf-8", "replace"))
            yield batch[["doc_id"]].assign(text=texts)

    return joined.select("doc_id", "text", "chunks").mapInPandas(
        cut, joined.select("doc_id", "text").schema
    )


@query("op4_substring_dedup")
def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_repeats(read(spark, sf_dir, "documents"))
