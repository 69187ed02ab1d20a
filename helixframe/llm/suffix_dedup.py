"""Removal of long repeated strings by run-compressed suffix indices.

Every byte that lies in a string of ``LENGTH`` bytes which also starts anywhere else is removed.
Two equal strings of that length have the same smallest hash of a quarter of their bytes in them, at the same
place. These minimizers are the anchors of a document. An anchor that occurs once is part of no
repeat. For the others, the region which can hold a repeat around an anchor is looked at:

* Regions equal to another one are repeated as a whole, and known by their digest.
* One of each of the different regions of an anchor goes into an index. Regions are gathered by
  anchor into blocks of about ``BLOCK_BYTES``; regions of one document that overlap are joined.
  Of a block the Burrows-Wheeler transform is built and compressed to its runs. A match that can't
  be extended to the left lies at the border of two runs, so the ends of runs are all samples that
  are needed: streaming from one border to the next, the lengths of their matches give the matching
  statistics of all positions in between, and those of ``LENGTH`` or more are marked.
* An anchor with more than ``CROWD`` different regions, such as a common line, is too much for a
  block. A repeated string has three quarters of its bytes in common at one of three places around
  the anchor: two quarters after it, two before it, or one on either side. Regions that meet in none
  of these cores are dropped, the others go into blocks by their core. Where even a core has more
  than ``CROWD`` regions, the hashes of all their strings of ``LENGTH`` bytes are counted by Spark.

Texts are UTF-8 bytes, null being empty, and matches never cross documents. A row equal to another
one in id and text counts as a document of its own, and both are removed. Texts below ``LENGTH``
bytes are kept. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm.common import (
    ROW_KEY,
    byte_array,
    checkpointed,
    prefix_hashes,
    read,
    span_hashes,
    with_row_key,
)
from helixframe.llm.queries import query
from helixframe.llm.spans import cut_documents, merge_spans

LENGTH = 400
BLOCK_BYTES = 1 << 19
CROWD = 4000


#: Bits of a place in the part of a text that is looked at once; the upper bits of a hash go before them.
PLACE_BITS = 28
#: Regions to a task, where their strings are counted or an index is built of them.
TASK_REGIONS = 2000
#: Most tasks that blocks are dealt to.
MAX_TASKS = 20_000
#: Regions whose strings make one frame.
STRING_REGIONS = 64


def _least_places(hashes: np.ndarray, width: int) -> np.ndarray:
    places = np.arange(len(hashes), dtype=np.uint64)
    bits = np.uint64(PLACE_BITS)
    least = (hashes >> bits << bits) | places
    reach = 1
    while reach < width:
        step = min(reach, width - reach)
        least = np.minimum(least[:-step], least[step:])
        reach += step
    return (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


def anchors(hashes: np.ndarray, width: int) -> np.ndarray:
    """Places of the leftmost smallest hash of every window of so many hashes.

    Windows of a long text are looked at in parts, whose places fit their bits; hashes are compared alike
    in texts of any length.
    """
    windows = (1 << PLACE_BITS) - width
    at = np.concatenate(
        [
            _least_places(hashes[start : start + windows + width - 1], width) + start
            for start in range(0, len(hashes) - width + 1, windows)
        ]
    )
    return at[np.concatenate(([True], at[1:] != at[:-1]))]


def _anchor_columns(data: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Anchors of one text: hash, digest of the region with the anchor's place in it, region, place."""
    sums = prefix_hashes(data)
    gram = length // 4
    starts = np.arange(len(data) - gram + 1)
    hashes = span_hashes(sums, starts, starts + gram)
    at = anchors(hashes, length - gram + 1)
    low = np.maximum(at - (length - gram), 0)
    high = np.minimum(at + length, len(data))
    digest = span_hashes(sums, low, high) + ((at - low) << 20).astype(np.uint64)
    return hashes[at].view(np.int64), digest.view(np.int64), low, high, at


def anchor_table(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """All anchors: (row key, anchor, digest, low, high, place)."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = map(byte_array, batch["text"])
            found = [(k, _anchor_columns(it, length)) for k, it in enumerate(texts) if len(it) >= length]
            if not found:
                continue
            times = [len(columns[0]) for _, columns in found]
            own = np.repeat([k for k, _ in found], times)
            columns = [np.concatenate(it) for it in zip(*(columns for _, columns in found), strict=True)]
            rows = {name: batch[name].to_numpy()[own] for name in ROW_KEY}
            names = ("anchor", "digest", "low", "high", "place")
            yield pd.DataFrame(rows | dict(zip(names, columns, strict=True)))

    return with_row_key(docs, "text").mapInPandas(
        find, "row_a long, row_b long, anchor long, digest long, low long, high long, place long"
    )


def suffix_array(codes: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and ranks by their first 6, 12, 24, .. codes, at most ``keep``.

    Codes are 1 to 256, and 0 after the end of each text; a suffix ends with its text. The rank of
    a suffix is the number of smaller ones.
    """
    size = len(codes)
    padded = np.concatenate((codes, np.zeros(6, np.int64)))
    key, inside = np.zeros(size, np.int64), np.ones(size, bool)
    for step in range(6):
        here = padded[step : step + size]
        inside &= here > 0
        key = key * 512 + np.where(inside, here, 0)
    order = np.argsort(key)
    change = np.concatenate(([True], np.diff(key[order]) != 0))
    # Texts that end here are different from all others
    ended = ~inside[order]
    change |= ended
    change[1:] |= ended[:-1]
    index = np.arange(size)
    rank = np.empty(size, np.int64)
    rank[order] = np.maximum.accumulate(np.where(change, index, 0))
    kept, depth = rank, 6
    open_ = np.arange(size)
    while True:
        # Only suffixes that share their rank are still to be ordered
        open_ = open_[np.bincount(rank[open_], minlength=size)[rank[open_]] > 1]
        if not len(open_):
            break
        key = rank[open_] * size + rank[open_ + depth]
        inner = np.argsort(key)
        key, at = key[inner], open_[inner]
        group = key // size
        index = np.arange(len(at))
        first = np.concatenate(([True], np.diff(group) != 0))
        change = np.concatenate(([True], np.diff(key) != 0))
        place = np.maximum.accumulate(np.where(change, index, 0))
        place -= np.maximum.accumulate(np.where(first, index, 0))
        rank = rank.copy()
        rank[at] = group + place
        depth *= 2
        if depth <= keep:
            kept = rank
    order = np.empty(size, np.int64)
    order[rank] = np.arange(size)
    return order, kept


def long_matches(texts: list[bytes], length: int = LENGTH) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text the spans of strings of at least ``length`` bytes that start elsewhere, too."""
    arrays = [np.concatenate((np.frombuffer(it, np.uint8).astype(np.int64) + 1, [0])) for it in texts]
    codes = np.concatenate(arrays)
    size = len(codes)
    order, kept = suffix_array(codes, length)
    before = np.where(order > 0, codes[order - 1], 0)
    # Border of two runs of the transform; nothing stands before the start of a text
    border = (before[1:] != before[:-1]) | (before[1:] == 0)
    left, right = order[:-1][border], order[1:][border]
    alike = kept[left] == kept[right]
    left, right = left[alike], right[alike]
    matched = np.zeros(len(left), np.int64)
    active = np.arange(len(left))
    while len(active):
        a, b = left[active] + matched[active], right[active] + matched[active]
        same = (np.maximum(a, b) < size) & (codes[np.minimum(a, size - 1)] == codes[np.minimum(b, size - 1)])
        same &= codes[np.minimum(a, size - 1)] > 0
        active = active[same]
        matched[active] += 1
    far = matched >= length
    starts = np.concatenate((left[far], right[far]))
    ends = starts + np.concatenate((matched[far], matched[far]))
    starts, ends = merge_spans(starts, ends)
    offsets = np.concatenate(([0], np.cumsum([len(it) for it in arrays])))
    cuts = np.searchsorted(starts, offsets)
    return [
        (starts[cuts[k] : cuts[k + 1]] - offsets[k], ends[cuts[k] : cuts[k + 1]] - offsets[k])
        for k in range(len(texts))
    ]


def joined_parts(lows: np.ndarray, parts: list[bytes]) -> list[tuple[int, bytes]]:
    """Parts of one text joined where they overlap or touch, as (place, bytes)."""
    out: list[tuple[int, bytearray]] = []
    for place in np.argsort(lows, kind="stable"):
        low, part = int(lows[place]), parts[place]
        if out and low <= out[-1][0] + len(out[-1][1]):
            out[-1][1].extend(part[max(0, out[-1][0] + len(out[-1][1]) - low) :])
        else:
            out.append((low, bytearray(part)))
    return [(low, bytes(part)) for low, part in out]


def index_block(block: pd.DataFrame, length: int) -> pd.DataFrame:
    """Spans of long matches within the texts of a block."""
    keys, lows, parts = [], [], []
    for key, own in block.groupby(ROW_KEY, sort=False):
        for low, part in joined_parts(own["low"].to_numpy(), list(own["part"])):
            keys.append(key)
            lows.append(low)
            parts.append(part)
    found = long_matches(parts, length)
    times = [len(starts) for starts, _ in found]
    row_a, row_b = np.repeat(np.array(keys, np.int64).reshape(-1, 2), times, axis=0).T
    shift = np.repeat(np.array(lows, np.int64), times)
    starts, ends = (np.concatenate(it) + shift for it in zip(*found, strict=True))
    return pd.DataFrame({"row_a": row_a, "row_b": row_b, "start": starts, "end": ends})


def _cores(data: np.ndarray, place: int, length: int) -> list[int]:
    """Hashes of the three cores around an anchor, as far as the text has them."""
    quarter, found = length // 4, []
    for before in range(3):
        start = place - before * quarter
        if start >= 0 and start + 3 * quarter <= len(data):
            sums = prefix_hashes(data[start : start + 3 * quarter])
            value = span_hashes(sums, np.array([0]), np.array([3 * quarter]))[0]
            found.append(int((value + np.uint64(before)).view(np.int64)))
    return found


def _strings(part: bytes, low: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the strings of a region."""
    data = np.frombuffer(part, np.uint8)
    starts = np.arange(len(data) - length + 1)
    if not len(starts):
        return starts, starts
    return starts + low, span_hashes(prefix_hashes(data), starts, starts + length).view(np.int64)


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Spans of repeated strings: (row key, start, end); they may overlap."""
    table = anchor_table(docs, length)
    repeated = (
        table.groupBy("anchor")
        .agg(F.count("*").alias("n"), F.min("digest").alias("a"), F.max("digest").alias("b"))
        .where("n > 1")
        .select("anchor", (F.col("a") != F.col("b")).alias("differs"))
    )
    # Materialised, so that Spark can split a hot anchor in the join
    repeated = checkpointed(repeated)
    hits = checkpointed(table.join(repeated, "anchor"))
    regions = checkpointed(
        hits.groupBy("anchor", "digest", "differs").agg(
            F.count("*").alias("n"), F.min(F.struct(*ROW_KEY, "low", "high", "place")).alias("one")
        )
    )
    equal = regions.where("n > 1").select("anchor", "digest")
    whole = hits.join(equal, ["anchor", "digest"]).where(F.col("high") - F.col("low") >= length)
    whole = whole.select(*ROW_KEY, F.col("low").alias("start"), F.col("high").alias("end"))

    different = regions.where("differs").select("anchor", "one.*")
    crowds = different.groupBy("anchor").agg(F.count("*").alias("regions"))
    different = checkpointed(different.join(crowds, "anchor"))
    total = different.agg(F.sum(F.col("high") - F.col("low")).alias("bytes")).first()["bytes"] or 0
    blocks = max(1, -(-total // BLOCK_BYTES))
    anchor_blocks = blocks
    block = F.when(F.col("regions") <= CROWD, F.pmod(F.xxhash64("anchor"), F.lit(blocks)))
    listed = different.groupBy(*ROW_KEY).agg(
        F.collect_list(F.struct(block.alias("block"), "low", "high", "place")).alias("regions")
    )
    # Rows equal in id and text have equal regions, of which one was chosen
    texts = with_row_key(docs, "text").join(listed, ROW_KEY).dropDuplicates(ROW_KEY)

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for row_a, row_b, text, regions in batch[[*ROW_KEY, "text", "regions"]].itertuples(index=False):
                data = text.encode("utf-8", "replace")
                by_block: dict[int, list] = {}
                for region in regions:
                    low, high = region["low"], region["high"]
                    if region["block"] is None:
                        cores = _cores(np.frombuffer(data, np.uint8), region["place"], length)
                        rows.append((row_a, row_b, None, low, data[low:high], cores))
                    else:
                        by_block.setdefault(region["block"], []).append((low, high))
                for number, spans in by_block.items():
                    low, high = np.array(spans, np.int64).T
                    for start, end in zip(*merge_spans(low, high), strict=True):
                        rows.append((row_a, row_b, number, int(start), data[start:end], []))
            out = pd.DataFrame(rows, columns=[*ROW_KEY, "block", "low", "part", "cores"])
            yield out.astype({"block": "Int64"})

    pieces = checkpointed(
        texts.mapInPandas(
            parts, "row_a long, row_b long, block long, low long, part binary, cores array<long>"
        )
    )

    def indexed(rows: DataFrame, count: int) -> DataFrame:
        # By number: the work of a block is in its index and not in its bytes, which few tasks would take
        tasks = min(MAX_TASKS, max(1, count))
        return (
            rows.select("block", *ROW_KEY, "low", "part")
            .repartition(tasks, "block")
            .groupBy("block")
            .applyInPandas(
                lambda block: index_block(block, length),
                "row_a long, row_b long, start long, end long",
            )
        )

    crowded = pieces.where("block IS NULL").withColumn("core", F.explode("cores"))
    cores = crowded.groupBy("core").agg(
        F.count("*").alias("n"), F.sum(F.octet_length("part")).alias("bytes")
    )
    cores = checkpointed(cores.where("n > 1"))
    sums = cores.agg(
        F.sum(F.when(F.col("n") <= CROWD, F.col("bytes"))).alias("bytes"),
        F.sum(F.when(F.col("n") > CROWD, F.col("n"))).alias("regions"),
    ).first()
    blocks = max(1, -(-(sums["bytes"] or 0) // BLOCK_BYTES))
    met = crowded.drop("block", "cores").join(cores.select("core", "n"), "core")
    by_core = met.where(F.col("n") <= CROWD).withColumn(
        "block", F.pmod(F.xxhash64("core"), F.lit(blocks))
    )

    def strings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), STRING_REGIONS):
                some = batch.iloc[at : at + STRING_REGIONS]
                found = [_strings(part, low, length) for part, low in zip(some["part"], some["low"], strict=True)]
                times = [len(starts) for starts, _ in found]
                rows = {name: np.repeat(some[name].to_numpy(), times) for name in ROW_KEY}
                start, string = (np.concatenate(it) for it in zip(*found, strict=True))
                yield pd.DataFrame(rows | {"start": start, "string": string})

    tasks = min(MAX_TASKS, max(1, (sums["regions"] or 0) // TASK_REGIONS))
    many = (
        met.where(F.col("n") > CROWD)
        .select(*ROW_KEY, "low", "part")
        .repartition(tasks, *ROW_KEY, "low")
        .mapInPandas(strings, "row_a long, row_b long, start long, string long")
    )
    many = many.distinct()
    again = checkpointed(many.groupBy("string").agg(F.count("*").alias("n")).where("n > 1"))
    counted = many.join(again, "string").select(
        *ROW_KEY, "start", (F.col("start") + length).alias("end")
    )
    both = indexed(pieces.where("block IS NOT NULL"), anchor_blocks).unionByName(indexed(by_core, blocks))
    return whole.unionByName(both).unionByName(counted)


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per document its bytes, removed bytes and runs, and the digest of what is left."""
    return cut_documents(docs, repeated_spans(docs, length))


@query("op10_suffix_array_dedup")
def suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents"))
