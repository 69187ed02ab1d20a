"""Exact deduplication by a two-pass Bloom filter.

The first pass sets two bits per text in a blocked Bloom filter and keeps the bits that were set
by two rows or more. In the second pass a row whose bits are all kept is possibly repeated; only
such rows are shuffled and compared, all others go straight through. A full filter makes more rows
"possibly repeated", and never changes the result.

Texts are equal if they are after lower-casing A-Z. A null text counts as empty, so null and empty
texts are copies of each other. Of equal texts the row with the largest ``doc_id`` stays, a null id
being the smallest; of rows that share text and id exactly one stays. An empty table gives an empty
result, and columns besides ``doc_id`` and ``text`` are never looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm.common import checkpointed, filled, read
from helixframe.llm.queries import query

#: Bits of the filter per row; one row in 70 is then taken for a repeat without being one.
BITS_PER_ROW = 16
#: Bits in a block of the filter, as in Spark's bitmaps.
BLOCK_BITS = 32_768
#: Most blocks, of 4 KB each: what is broadcast stays below 64 MB.
MAX_BLOCKS = 1 << 14


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII texts take the faster built-in."""
    upper = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, upper, upper.lower())
    )


def _with_bits(rows: DataFrame, blocks: int) -> DataFrame:
    """The block of a row's digest, and its two bits in there."""
    rest = F.xxhash64(F.lit(1), "digest")
    mask = F.lit(BLOCK_BITS - 1)
    return rows.withColumns(
        {
            "block": F.pmod(F.xxhash64("digest"), F.lit(blocks)),
            "bit_a": rest.bitwiseAND(mask),
            "bit_b": F.shiftrightunsigned(rest, 15).bitwiseAND(mask),
        }
    )


def repeat_filter(digests: DataFrame, blocks: int) -> DataFrame:
    """First pass: a bitmap per block with the bits that at least two rows have set."""
    bits = F.explode(F.array_distinct(F.array("bit_a", "bit_b")))
    return (
        _with_bits(digests.select("digest"), blocks)
        .select("block", bits.alias("bit"))
        .groupBy("block", "bit")
        .agg(F.count("*").alias("hits"))
        .where("hits > 1")
        .groupBy("block")
        .agg(F.bitmap_construct_agg("bit").alias("bitmap"))
    )


def _is_set(bitmap: Column, bit: Column) -> Column:
    byte = F.substring(bitmap, F.shiftright(bit, 3).cast("int") + 1, F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("long")
    return F.coalesce(F.getbit(value, bit.bitwiseAND(F.lit(7)).cast("int")) == 1, F.lit(False))


def flag_possible_repeats(rows: DataFrame, digests: DataFrame, count: int) -> DataFrame:
    """Second pass: ``rows`` (with a ``digest``) and whether another row may have the same one.

    ``digests`` are those of all rows, and ``count`` is their number.
    """
    blocks = min(MAX_BLOCKS, max(1, -(-count * BITS_PER_ROW // BLOCK_BITS)))
    repeats = checkpointed(repeat_filter(digests, blocks))
    flagged = _with_bits(rows, blocks).join(F.broadcast(repeats), "block", "left")
    both = _is_set(F.col("bitmap"), F.col("bit_a")) & _is_set(F.col("bitmap"), F.col("bit_b"))
    return flagged.withColumn("possible", both).drop("block", "bit_a", "bit_b", "bitmap")


def mark_copies(docs: DataFrame) -> DataFrame:
    """One row per document with the id that stays of its text, and the digest of the text."""
    digest = F.unhex(F.sha2(ascii_lower(filled("text")), 256))
    rows = checkpointed(
        docs.select("doc_id", digest.alias("digest")).withColumn(
            "row", F.monotonically_increasing_id()
        )
    )
    flagged = flag_possible_repeats(rows, rows, rows.count())
    shape = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    sha = F.lower(F.hex("digest")).alias("text_sha256")

    single = flagged.where("not possible").select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        sha,
    )
    possible = flagged.where("possible")
    groups = possible.groupBy("digest").agg(
        F.max(F.struct("doc_id", "row")).alias("last"), F.count("*").alias("group_size")
    )
    # Materialised, so that Spark can split a hot digest in the join
    copies = possible.join(checkpointed(groups), "digest").select(
        "doc_id",
        F.col("last.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("last.row")).alias("kept"),
        sha,
    )
    return single.unionByName(copies).select(*shape)


def drop_copies(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns.

    Only possibly repeated documents are shuffled. Ties of ``doc_id`` are broken by the remaining
    columns, so that it doesn't matter how the rows are partitioned.
    """
    text = ascii_lower(filled("text"))
    digests = docs.select(F.xxhash64(text).alias("digest"))
    rows = docs.select(F.struct(*(docs[name] for name in docs.columns)).alias("doc"))
    text = ascii_lower(F.coalesce(F.col("doc.text"), F.lit("")))
    rows = rows.withColumn("digest", F.xxhash64(text))
    flagged = flag_possible_repeats(rows, digests, docs.count())
    order = F.struct(F.col("doc.doc_id"), F.md5(F.to_json("doc")))
    last = (
        flagged.where("possible")
        .groupBy(F.sha2(text, 256).alias("sha"))
        .agg(F.max_by("doc", order).alias("doc"))
    )
    return flagged.where("not possible").select("doc").unionByName(last.select("doc")).select("doc.*")


SQL = """
WITH digests AS (
    SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
    FROM documents
)
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       text_sha256
FROM digests
WINDOW same AS (PARTITION BY text_sha256)
"""


@query("op1_exact_dedup", SQL)
def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mark_copies(read(spark, sf_dir, "documents"))
