"""Operators on alignment records: filters, cleanup, read-groups, counts and order."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixframe.functions import cigar as C
from helixframe.functions import flags as fl
from helixframe.functions import hashing
from helixframe.plans.intervals import lag_value, overlap_join
from helixframe.plans.session import cut_lineage
from helixframe.plans.skew import skew_join

#: Sample and library of records without a (known) read-group.
NO_GROUP = "<NA>"


def with_ends(alignments: DataFrame) -> DataFrame:
    """Add ``ref_end``, the end of the half-open aligned span."""
    return alignments.withColumn("ref_end", F.col("pos") + C.reference_length(F.col("cigar")))


def exclude_default_flags(alignments: DataFrame) -> DataFrame:
    return alignments.where(fl.has_none("flag", fl.DEFAULT_EXCLUDED))


def filter_unaligned(alignments: DataFrame) -> DataFrame:
    return alignments.where(fl.has_none("flag", fl.NOT_PRIMARY_ALIGNED))


def filter_flags(alignments: DataFrame, require: int = 0, exclude: int = 0) -> DataFrame:
    """Keep records with all required and no excluded bits.

    For unpaired records the bits that only concern pairs are left out of both masks.
    """
    flag, single = F.col("flag"), ~fl.has_any("flag", fl.PAIRED)

    def mask(bits: int) -> Column:
        return F.when(single, F.lit(bits & ~fl.PAIR_ONLY)).otherwise(F.lit(bits))

    return alignments.where(
        (flag.bitwiseAND(mask(exclude)) == 0) & (flag.bitwiseAND(mask(require)) == mask(require))
    )


def filter_mapq_aligned(alignments: DataFrame, min_quality: int) -> DataFrame:
    """Drop mapped records with a low mapping quality."""
    return alignments.where(fl.has_any("flag", fl.UNMAPPED) | (F.col("mapq") >= min_quality))


def cleanup_records(alignments: DataFrame) -> DataFrame:
    """Reset the fields that have no meaning given the flags of a record.

    Unpaired: no mate bits, mate or template length. Paired with an unmapped mate: no ``MC`` tag.
    Unmapped: no quality, CIGAR, secondary, supplementary or proper-pair bit, and placed at the
    mate, if that is mapped. Mapped with an unmapped mate: the mate is placed at the record.
    """
    paired = fl.has_any("flag", fl.PAIRED)
    unmapped = fl.has_any("flag", fl.UNMAPPED)
    mate_unmapped = fl.has_any("flag", fl.MATE_UNMAPPED)
    nowhere, no_pos = F.lit(None).cast("string"), F.lit(-1).cast("long")

    step = alignments.withColumns(
        {
            "flag": F.when(~paired, fl.clear(F.col("flag"), fl.PAIR_ONLY)).otherwise(F.col("flag")),
            "mate_contig": F.when(~paired, nowhere).otherwise(F.col("mate_contig")),
            "mate_pos": F.when(~paired, no_pos).otherwise(F.col("mate_pos")),
            "tlen": F.when(~paired, 0).otherwise(F.col("tlen")),
            "tags": F.when(
                paired & mate_unmapped, F.map_filter("tags", lambda key, _: key != "MC")
            ).otherwise(F.col("tags")),
        }
    )
    # The bits of the record after the first step decide the second
    lost_pair = unmapped & mate_unmapped
    step = step.withColumns(
        {
            "mate_contig": F.when(lost_pair, nowhere).otherwise(F.col("mate_contig")),
            "mate_pos": F.when(lost_pair, no_pos).otherwise(F.col("mate_pos")),
        }
    )
    lone_mate = ~unmapped & mate_unmapped
    cleaned = fl.PROPER_PAIR | fl.SECONDARY | fl.SUPPLEMENTARY
    return step.withColumns(
        {
            "mapq": F.when(unmapped, 0).otherwise(F.col("mapq")),
            "cigar": F.when(~unmapped, F.col("cigar")),
            "flag": F.when(unmapped, fl.clear(F.col("flag"), cleaned)).otherwise(F.col("flag")),
            "contig": F.when(unmapped, F.col("mate_contig")).otherwise(F.col("contig")),
            "pos": F.when(unmapped, F.col("mate_pos")).otherwise(F.col("pos")),
            "mate_contig": F.when(lone_mate, F.col("contig")).otherwise(F.col("mate_contig")),
            "mate_pos": F.when(lone_mate, F.col("pos")).otherwise(F.col("mate_pos")),
            "tlen": F.when(unmapped | mate_unmapped, 0).otherwise(F.col("tlen")),
        }
    )


def set_read_group(alignments: DataFrame, rg: str) -> DataFrame:
    """Replace any ``RG`` tag by the given one."""
    tag = F.struct(F.lit("Z").alias("type"), F.lit(rg).alias("value"))
    return alignments.withColumns(
        {
            "tags": F.map_concat(
                F.map_filter("tags", lambda key, _: key != "RG"), F.create_map(F.lit("RG"), tag)
            ),
            "rg": F.lit(rg),
        }
    )


def fix_single_base_quality(alignments: DataFrame) -> DataFrame:
    """Restore the quality of single-base reads, whose ``*`` was taken for missing qualities."""
    lost = (F.length("seq") == 1) & F.col("quals").isNull()
    return alignments.withColumn("quals", F.when(lost, F.array(F.lit(9))).otherwise(F.col("quals")))


def tag_value(name: str, tag_type: str | None = None) -> Column:
    """Value of a tag, null if it is absent or not of the wanted type."""
    tag = F.try_element_at("tags", F.lit(name))
    return tag["value"] if tag_type is None else F.when(tag["type"] == tag_type, tag["value"])


def read_groups_table(readgroups: DataFrame, ignore_readgroups: bool = False) -> DataFrame:
    """(rg, sample, library) of the header, with the group of records without read-group."""
    none = (
        readgroups.sparkSession.range(1)
        .select(
            F.lit(None).cast("string").alias("rg"),
            F.lit(NO_GROUP).alias("sample"),
            F.lit(NO_GROUP).alias("library"),
        )
    )
    if ignore_readgroups:
        return none
    return none.unionByName(readgroups.select("rg", "sample", "library"))


def attach_readgroups(
    rows: DataFrame, readgroups: DataFrame, ignore_readgroups: bool = False
) -> DataFrame:
    """Add sample and library; unknown and missing read-groups share one fallback group."""
    if ignore_readgroups:
        return rows.withColumns({"sample": F.lit(NO_GROUP), "library": F.lit(NO_GROUP)})
    known = readgroups.select("rg", "sample", "library")
    return skew_join(rows, known, ["rg"], "left").fillna(
        {"sample": NO_GROUP, "library": NO_GROUP}
    )


def sample_names(readgroups: DataFrame) -> DataFrame:
    return readgroups.select("sample").distinct()


def union_alignments(inputs: Sequence[DataFrame]) -> DataFrame:
    """Records of several inputs; missing columns are null.

    Ids are interleaved: a record keeps its place within its input, and no two share an id.
    """
    count = len(inputs)
    numbered = [
        rows.withColumn("read_id", F.col("read_id") * count + index)
        if "read_id" in rows.columns
        else rows
        for index, rows in enumerate(inputs)
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), numbered)


def sort_coordinates(alignments: DataFrame, contigs: DataFrame) -> DataFrame:
    """Order of the header's contigs, then position; records without a position come last."""
    tids = contigs.select("contig", "tid")
    return skew_join(alignments, tids, ["contig"], "left").orderBy(
        F.col("tid").asc_nulls_last(), "pos", "read_id"
    )


def check_sorted(
    rows: DataFrame, file: str = "file", ordinal: str = "ordinal", width: int = 1 << 16
) -> DataFrame:
    """Rows of a file that sort before their predecessor, by ``(tid, pos)``.

    Unplaced records (``tid`` -1) are expected to trail, and so sort last.
    """
    key = F.struct(
        F.when(F.col("tid") < 0, F.lit(2**31 - 1)).otherwise(F.col("tid")).cast("int").alias("tid"),
        F.when(F.col("tid") < 0, F.lit(0)).otherwise(F.col("pos")).cast("long").alias("pos"),
    )
    keyed = rows.withColumn("_key", key)
    return lag_value(keyed, [file], ordinal, "_key", width).where(
        F.col("_previous") > F.col("_key")
    ).drop("_key", "_previous")


def flagstat(alignments: DataFrame) -> DataFrame:
    """Records per flag category, split by QC outcome: ``(category, qc_passed, qc_failed)``."""
    primary = fl.has_none("flag", fl.SECONDARY | fl.SUPPLEMENTARY)
    paired = primary & fl.has_any("flag", fl.PAIRED)
    mapped = fl.has_none("flag", fl.UNMAPPED)
    both = paired & mapped & fl.has_none("flag", fl.MATE_UNMAPPED)
    other = both & F.coalesce(F.col("mate_contig") != F.col("contig"), F.lit(False))
    categories = {
        "total": F.lit(True),
        "primary": primary,
        "secondary": fl.has_any("flag", fl.SECONDARY),
        "supplementary": fl.has_any("flag", fl.SUPPLEMENTARY) & fl.has_none("flag", fl.SECONDARY),
        "duplicates": fl.has_any("flag", fl.DUPLICATE),
        "primary duplicates": primary & fl.has_any("flag", fl.DUPLICATE),
        "mapped": mapped,
        "primary mapped": primary & mapped,
        "paired": paired,
        "read1": paired & fl.has_any("flag", fl.MATE_1),
        "read2": paired & fl.has_any("flag", fl.MATE_2),
        "properly paired": paired & mapped & fl.has_any("flag", fl.PROPER_PAIR),
        "with itself and mate mapped": both,
        "singletons": paired & mapped & fl.has_any("flag", fl.MATE_UNMAPPED),
        "mate on a different contig": other,
        "mate on a different contig (mapq>=5)": other & (F.col("mapq") >= 5),
    }
    failed = fl.has_any("flag", fl.QC_FAIL)
    counts = alignments.agg(
        *(
            F.struct(
                F.lit(label).alias("category"),
                F.count_if(test & ~failed).alias("qc_passed"),
                F.count_if(test & failed).alias("qc_failed"),
            ).alias(label)
            for label, test in categories.items()
        )
    )
    return counts.select(F.inline(F.array(*(F.col(f"`{label}`") for label in categories))))


def idxstats(alignments: DataFrame, contigs: DataFrame) -> DataFrame:
    """Mapped and placed-but-unmapped records per contig, and a ``*`` row for the unplaced."""
    unmapped = fl.has_any("flag", fl.UNMAPPED)
    counts = alignments.groupBy(F.coalesce("contig", F.lit("*")).alias("contig")).agg(
        F.count_if(~unmapped).alias("mapped"), F.count_if(unmapped).alias("unmapped")
    )
    unplaced = contigs.sparkSession.range(1).select(
        F.lit("*").alias("contig"), F.lit(0).cast("long").alias("length")
    )
    known = contigs.select("contig", F.col("length").cast("long")).unionByName(unplaced)
    return known.join(counts, "contig", "left").fillna(0, ["mapped", "unmapped"])


def partition_by_predicate(rows: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """(matching, other) rows; null counts as not matching."""
    matches = F.coalesce(predicate, F.lit(False))
    return rows.where(matches), rows.where(~matches)


def reservoir_sample(
    rows: DataFrame, size: int, row_id: str, seed: int = 0, digits: int = 4
) -> DataFrame:
    """Uniform sample of exactly ``min(size, n)`` rows.

    The rows with the smallest hash values are the sample. A count per leading hash digits finds
    the bucket that holds the last of them, so that only that bucket must be ordered: nothing of
    the size of the sample or of the input passes through one task.
    """
    if not isinstance(size, int) or isinstance(size, bool) or size < 0:
        raise ValueError("sample size must be a non-negative integer")

    hashed = rows.withColumn("_hash", hashing.digest(seed, F.col(row_id))).withColumn(
        "_bucket", hashing.leading_bits(F.col("_hash"), digits)
    )
    per_bucket = hashed.groupBy("_bucket").agg(F.count("*").alias("_n"))
    # At most 16**digits rows
    upto = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    running = per_bucket.withColumn("_upto", F.sum("_n").over(upto))
    last = (
        running.where(F.col("_upto") >= size)
        .agg(F.min(F.struct("_bucket", (F.col("_upto") - F.col("_n")).alias("before"))))
        .scalar()
    )
    marked = hashed.withColumn("_last", last)
    whole = marked.where(
        F.col("_last").isNull() | (F.col("_bucket") < F.col("_last")["_bucket"])
    )
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy("_hash", row_id))
    partial = (
        marked.where(F.col("_bucket") == F.col("_last")["_bucket"])
        .withColumn("_rank", rank)
        .where(F.col("_rank") + F.col("_last")["before"] <= size)
        .drop("_rank")
    )
    return whole.unionByName(partial).drop("_hash", "_bucket", "_last")


def downsample_alignments(alignments: DataFrame, size: int, seed: int = 0) -> DataFrame:
    """Sample of the records that pass the default flag filter."""
    return reservoir_sample(exclude_default_flags(alignments), size, "read_id", seed)


def weighted_sample(
    items: DataFrame,
    draws: DataFrame,
    item_id: str,
    weight: str,
    draw_id: str = "draw",
    seed: int = 0,
    buckets: int | None = None,
) -> DataFrame:
    """One item per row of ``draws``, with replacement and a probability ∝ weight.

    Weights are positive numbers. Items lie side by side on a line of length Σ weight, and a draw is
    a point on it, in steps of 2**-52 of its length. The line is laid out in hashed buckets, as many
    as the square root of the number of items by default, so that the cumulative weights need one
    window per bucket and a scan of one row per bucket. The draws find their bucket, and in it their
    item, by interval joins on the line. Without items there is nothing to draw from: an error.
    """
    if buckets is None:
        buckets = max(1, math.isqrt(items.count()))
    checked = items.select(
        item_id,
        F.when(F.col(weight) > 0, F.col(weight).cast("double"))
        .otherwise(F.raise_error(F.lit("weights must be positive")).cast("double"))
        .alias("_w"),
        F.pmod(F.col(item_id), F.lit(buckets)).alias("_bucket"),
    )
    totals = checked.groupBy("_bucket").agg(F.sum("_w").alias("_total"))
    upto = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    # One row per bucket; an offset is the sum up to its predecessor, so that no gap is left
    running = cut_lineage(totals.select("_bucket", F.sum("_total").over(upto).alias("_end")))
    length = running.agg(F.max("_end")).first()[0]
    if length is None:
        raise ValueError("nothing to draw from")
    offsets = running.select(
        "_bucket", F.coalesce(F.lag("_end").over(Window.orderBy("_bucket")), F.lit(0.0)).alias("_offset"), "_end"
    )
    inside = Window.partitionBy("_bucket").orderBy(item_id)
    within = F.sum("_w").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    is_last = F.lead(F.lit(1)).over(inside).isNull()
    ends = (
        checked.withColumn("_upto", within)
        .withColumn("_is_last", is_last)
        .join(F.broadcast(offsets), "_bucket")
        .withColumn("_to", F.when(F.col("_is_last"), F.col("_end")).otherwise(F.least(F.col("_offset") + F.col("_upto"), "_end")))
    )
    before = F.coalesce(F.lag("_to").over(inside), F.col("_offset"))
    line = ends.select(item_id, "_bucket", before.alias("_from"), "_to")

    points = draws.withColumn("_point", hashing.fine_uniform(seed, F.col(draw_id)) * length)
    # Both sides of the joins lie on a grid of whole numbers
    grid = float(buckets) * 64 / length
    parts = points.withColumns(
        {
            "_line": F.lit(0),
            "_at": F.floor(F.col("_point") * grid).cast("long"),
            "_at_end": F.floor(F.col("_point") * grid).cast("long") + 1,
        }
    )
    cells = line.select(
        F.lit(0).alias("_line"),
        item_id,
        "_from",
        "_to",
        F.floor(F.col("_from") * grid).cast("long").alias("_cell"),
        (F.floor(F.col("_to") * grid) + 1).cast("long").alias("_cell_end"),
    )
    joined = overlap_join(cells, parts, ("_cell", "_cell_end"), ("_at", "_at_end"), contig="_line")
    return joined.where("_point >= _from AND _point < _to").drop(
        "_line", "_from", "_to", "_point", "_cell", "_cell_end", "_at", "_at_end"
    )
