"""N-gram Jaccard join: MinHash banding finds candidates, exact sets decide.

Texts are sets of shingles of five lower-cased words. Texts with equal sets are one node, however
many copies there are. Each has ``TREES`` bands; nodes that share a whole band are candidates. The
length of all bands is chosen once: the longest one up to ``DEPTH`` at which two texts at the
threshold meet with the probability ``RECALL``. Nothing is shortened for what a node has met, as an
LSH forest would.

Candidates are gathered by connected components of the shared bands, components are cut
into blocks, and every pair of blocks compares its sets exactly. What leaves a pair of blocks is one
row per node: the number of its links, and the node it hangs together with; pairs are never written
out. The classes are the components of the verified links.

Texts of one to four words have a single shingle, the whole text. Texts without words, null ones
included, link to nothing. Rows equal in id and text are copies like any others. An empty table
gives an empty result; columns besides ``doc_id`` and ``text`` are passed over.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from helixframe.llm.common import (
    ROW_KEY,
    byte_array,
    checkpointed,
    mixed,
    prefix_hashes,
    read,
    span_hashes,
    with_row_key,
)
from helixframe.llm.components import components
from helixframe.llm.queries import query

WORDS = 5
THRESHOLD = 0.8
TREES, DEPTH = 40, 8
RECALL = 0.99999
#: Nodes in a block of a component.
BLOCK = 256
SEED = 3

_random = np.random.default_rng(SEED)
_FACTORS = _random.integers(0, 1 << 31, TREES * DEPTH, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_FLIPS = _random.integers(0, 1 << 32, TREES * DEPTH, dtype=np.uint32)
_PLACES = _random.integers(1, 1 << 63, WORDS, dtype=np.uint64) | np.uint64(1)


def prefix_length(threshold: float = THRESHOLD, recall: float = RECALL) -> int:
    """The longest prefix at which texts of this similarity meet in a trie often enough."""
    for length in range(DEPTH, 1, -1):
        if 1 - (1 - threshold**length) ** TREES >= recall:
            return length
    return 1


def shingles(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word 5-grams."""
    data = byte_array(text.lower())
    solid = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edges = np.flatnonzero(np.diff(np.concatenate(([False], solid, [False])).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    words = span_hashes(prefix_hashes(data), starts, ends)
    count = min(WORDS, len(words))
    value = np.zeros(len(words) - count + 1, np.uint64)
    for place in range(count):
        value += words[place : place + len(value)] * _PLACES[place]
    return np.unique(mixed(value + np.uint64(count)))


def trie_labels(hashes: np.ndarray, length: int) -> np.ndarray:
    """The prefix of this length in each trie, as one 64-bit label per trie."""
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    labels = np.full(TREES, 0, np.uint64)
    for step in range(length):
        least = np.full(TREES, np.iinfo(np.uint32).max, np.uint32)
        own = slice(step * TREES, (step + 1) * TREES)
        flips, factors = _FLIPS[own, None], _FACTORS[own, None]
        for start in range(0, len(short), 4096):
            part = short[None, start : start + 4096] ^ flips
            part *= factors
            part ^= part >> np.uint32(15)
            np.minimum(least, part.min(axis=1), out=least)
        labels = mixed(labels * np.uint64(0x9E3779B97F4A7C15) + least.astype(np.uint64) + np.uint64(1))
    return mixed(labels + np.arange(TREES, dtype=np.uint64))


def _set_hash(hashes: np.ndarray) -> np.uint64:
    return np.bitwise_xor.reduce(mixed(hashes * np.uint64(3) + np.uint64(len(hashes))))


def signatures(docs: DataFrame) -> DataFrame:
    """Per document its row key, node (the hash of its set) and trie labels."""
    length = prefix_length()

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            nodes, labels = [], []
            for own, text in zip(batch["row_a"], batch.pop("text"), strict=True):
                hashes = shingles(text)
                if len(hashes):
                    nodes.append(int(_set_hash(hashes).astype(np.int64)))
                    labels.append(trie_labels(hashes, length).astype(np.int64))
                else:
                    nodes.append(own)
                    labels.append(np.zeros(0, np.int64))
            batch["node"] = nodes
            batch["labels"] = labels
            yield batch

    rows = with_row_key(docs, "doc_id", "text")
    schema = rows.drop("text").schema.add("node", "long").add("labels", ArrayType(LongType()))
    return rows.mapInPandas(sign, schema)


def candidate_components(nodes: DataFrame) -> DataFrame:
    """(node, root) of the nodes (with labels) that share a prefix with another one."""
    shared = nodes.select("node", F.explode("labels").alias("label"))
    buckets = (
        shared.groupBy("label")
        .agg(F.min("node").alias("a"), F.max("node").alias("most"))
        .where("a <> most")
    )
    # Materialised, so that Spark can split a hot label in the join
    edges = shared.join(checkpointed(buckets), "label").select("a", F.col("node").alias("b"))
    return components(edges.where("a <> b"))


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Size of the intersection of every two sets."""
    owner = np.repeat(np.arange(len(sets)), [len(it) for it in sets])
    values, column = np.unique(np.concatenate(sets), return_inverse=True)
    counts = np.zeros((len(sets), len(sets)), np.float64)
    # Values of a single set take part in no intersection between sets
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    width = 4096
    for start in range(0, len(values), width):
        begin, end = np.searchsorted(column, [start, start + width])
        present = np.zeros((len(sets), min(width, len(values) - start)), np.float32)
        present[owner[begin:end], column[begin:end] - start] = 1
        counts += present @ present.T
    return counts


def _compare(group: pd.DataFrame) -> pd.DataFrame:
    """Per node of a pair of blocks: links to the other nodes, and a node that it hangs together with."""
    sets = [np.frombuffer(it, np.uint64) for it in group["hashes"]]
    block, copies = group["block"].to_numpy(), group["copies"].to_numpy()
    low, high = group["low"].iloc[0], group["high"].iloc[0]
    common = _overlaps(sets)
    sizes = np.array([len(it) for it in sets])
    union = sizes[:, None] + sizes[None, :] - common
    # Nodes differ in their sets, but for the same hash in theory
    linked = common * 10 >= union * round(THRESHOLD * 10)
    np.fill_diagonal(linked, False)
    if low != high:
        linked &= block[:, None] != block[None, :]
    links = linked @ copies

    hangs = np.arange(len(sets))
    while True:
        lower = np.where(linked, hangs[None, :], len(sets)).min(axis=1)
        lower = np.minimum(hangs, lower)
        lower = lower[lower]
        if (lower == hangs).all():
            break
        hangs = lower
    node = group["node"].to_numpy()
    return pd.DataFrame({"node": node, "links": links, "hangs": node[hangs]})


def verified(docs: DataFrame, nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """(node, links, hangs): verified links of the candidate nodes, one row per pair of blocks."""
    sizes = roots.groupBy("root").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    chosen = roots.join(sizes, "root").join(nodes.drop("labels"), "node")

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["hashes"] = [shingles(text).tobytes() for text in batch.pop("text")]
            yield batch

    texts = with_row_key(docs, "text").join(chosen, ROW_KEY).drop(*ROW_KEY)
    # Rows equal in id and text would give a node twice
    texts = texts.dropDuplicates(["node"])
    schema = texts.drop("text").schema.add("hashes", "binary")
    block = F.pmod(F.xxhash64("node"), F.col("blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    paired = (
        texts.mapInPandas(gather, schema)
        .withColumn("block", block)
        .select("*", other)
        .withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    )
    return paired.groupBy("root", "low", "high").applyInPandas(_compare, "node long, links long, hangs long")


def near_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents as (doc_id, row key, node), and nodes as (node, root, links, copies)."""
    rows = checkpointed(signatures(docs))
    nodes = rows.groupBy("node").agg(
        F.count("*").alias("copies"), F.min(F.struct(*ROW_KEY, "labels")).alias("one")
    )
    nodes = checkpointed(nodes.select("node", "copies", "one.*"))
    roots = checkpointed(candidate_components(nodes))
    found = checkpointed(verified(docs, nodes, roots))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(found.select(F.col("node").alias("a"), F.col("hangs").alias("b")))
    nodes = nodes.select("node", "copies").join(links, "node", "left").join(classes, "node", "left")
    nodes = nodes.select(
        "node",
        F.coalesce("root", "node").alias("root"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    return rows.drop("labels"), checkpointed(nodes)


def join_near(docs: DataFrame) -> DataFrame:
    """One row per document: its class (the smallest id in it), its links, and whether it stays.

    Of a class the document with the smallest id stays; null ids come last, and of rows equal in id
    and text all have ``kept`` if one has.
    """
    rows, nodes = near_classes(docs)
    joined = checkpointed(rows.join(nodes, "node").drop("node"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *ROW_KEY)
    first = joined.groupBy("root").agg(F.min(order).alias("first"), F.count("*").alias("class_size"))
    first = checkpointed(first)
    kept = (F.col("row_a") == F.col("first.row_a")) & (F.col("row_b") == F.col("first.row_b"))
    return joined.join(first, "root").select(
        "doc_id",
        F.col("first.doc_id").alias("class_id"),
        "n_links",
        "class_size",
        kept.alias("kept"),
        *ROW_KEY,
    )


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """One document of each class, with all columns of ``docs``; of rows equal in id and text one."""
    kept = join_near(docs).where("kept").groupBy(*ROW_KEY).agg(F.count("*").alias("times_"))
    doc = F.struct(*(docs[name] for name in docs.columns)).alias("doc")
    text = F.coalesce(docs["text"], F.lit(""))
    rows = docs.select(
        doc, F.xxhash64(docs["doc_id"], text).alias("row_a"), F.xxhash64(text, docs["doc_id"]).alias("row_b")
    ).join(kept, ROW_KEY)
    single = rows.where("times_ = 1").select("doc")
    repeated = rows.where("times_ > 1").groupBy(*ROW_KEY).agg(F.max_by("doc", F.md5(F.to_json("doc"))).alias("doc"))
    return single.unionByName(repeated.select("doc")).select("doc.*")


@query("op8_ngram_jaccard_join")
def ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_near(read(spark, sf_dir, "documents")).drop(*ROW_KEY)
