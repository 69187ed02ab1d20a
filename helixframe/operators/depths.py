"""Depth histograms per sample, library and contig or region."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helixframe.functions import cigar as C
from helixframe.operators.alignments import NO_GROUP, attach_readgroups, exclude_default_flags
from helixframe.operators.coverage import collapse_contigs, dense_groups, reference_sizes
from helixframe.plans.intervals import BIN_WIDTH, depth_runs, overlap_join

#: Depths above this are pooled in the table of fractions.
MAX_DEPTH = 200
KEYS = ["sample", "library", "contig"]


def aligned_block_rows(alignments: DataFrame, *columns: str) -> DataFrame:
    """One row per gap-free aligned block: the given columns, contig, ref_start, ref_end."""
    return alignments.where(F.col("cigar").isNotNull()).select(
        *columns, "contig", F.inline(C.aligned_blocks(F.col("pos"), F.col("cigar")))
    )


def site_depths(
    alignments: DataFrame,
    readgroups: DataFrame,
    ignore_readgroups: bool = False,
    width: int = BIN_WIDTH,
) -> DataFrame:
    """Runs of equal depth per (sample, library), per sample and overall, along each contig."""
    reads = exclude_default_flags(alignments).select("rg", "contig", "pos", "cigar")
    grouped = attach_readgroups(reads, readgroups, ignore_readgroups)
    blocks = aligned_block_rows(grouped, "sample", "library")
    return depth_runs(blocks, [["sample", "library"], ["sample"], []], width=width)


def depth_histogram(
    alignments: DataFrame,
    readgroups: DataFrame,
    contigs: DataFrame,
    regions: DataFrame | None = None,
    max_contigs: int | None = None,
    ignore_readgroups: bool = False,
    width: int = BIN_WIDTH,
) -> DataFrame:
    """Number of sites by depth (1 or more), per sample, library and contig, with ``*`` totals.

    The depth at a ``*`` library or sample is the sum over its members at the site; a ``*``
    contig sums the sites of all contigs. A site inside two regions counts for both.
    """
    runs = site_depths(alignments, readgroups, ignore_readgroups, width)
    if regions is not None:
        # Runs of the number of regions of a name at a site: pairs grow with the runs, not with overlapping regions
        spans = depth_runs(regions, [["name"]], span=("start", "end"), width=width).select(
            "contig",
            "name",
            F.col("run_start").alias("_start"),
            F.col("run_end").alias("_end"),
            F.col("depth").alias("_times"),
        )
        runs = (
            overlap_join(runs, spans, ("run_start", "run_end"), ("_start", "_end"))
            .withColumn("run_start", F.greatest("run_start", "_start"))
            .withColumn("run_end", F.least("run_end", "_end"))
            .withColumn("contig", F.col("name"))
        )
    else:
        runs = runs.withColumn("_times", F.lit(1))
    counts = runs.groupBy(*KEYS, "depth").agg(
        F.sum((F.col("run_end") - F.col("run_start")) * F.col("_times")).alias("n_sites")
    )
    if regions is None:
        labels = collapse_contigs(contigs, max_contigs).select("contig", "label")
        counts = counts.join(labels, "contig").withColumn("contig", F.col("label"))
    return (
        counts.groupingSets(
            [[*KEYS, "depth"], ["sample", "library", "depth"]], *KEYS, "depth"
        )
        .agg(F.sum("n_sites").alias("n_sites"), F.grouping("contig").alias("_total"))
        .withColumn("contig", F.when(F.col("_total") == 1, "*").otherwise(F.col("contig")))
        .drop("_total")
        .select(*KEYS, "depth", "n_sites")
    )


def max_depth(histogram: DataFrame) -> DataFrame:
    """Depth below which all but the 0.5% most covered sites lie; null if there is none."""
    by_depth = Window.partitionBy(*KEYS).orderBy("depth")
    before = F.sum("n_sites").over(by_depth.rowsBetween(Window.unboundedPreceding, -1))
    total = F.sum("n_sites").over(Window.partitionBy(*KEYS))
    return (
        histogram.withColumn("_left", (total - F.coalesce(before, F.lit(0))) / total)
        .groupBy(*KEYS)
        .agg(F.min(F.when(F.col("_left") < 0.005, F.col("depth") - 1)).alias("max_depth"))
    )


def depth_fractions(histogram: DataFrame, sizes: DataFrame) -> DataFrame:
    """Fraction of sites with at least ``depth`` bases, for every depth from 1 to 200.

    ``sizes`` holds (sample, library, contig, size), and decides which rows exist.
    """
    pooled = (
        histogram.groupBy(*KEYS, F.least("depth", F.lit(MAX_DEPTH)).cast("int").alias("d"))
        .agg(F.sum("n_sites").alias("n"))
        .groupBy(*KEYS)
        .agg(F.collect_list(F.struct("d", "n")).alias("_counts"))
    )
    empty = F.array().cast("array<struct<d:int,n:bigint>>")
    return (
        sizes.join(pooled, KEYS, "left")
        .withColumn("_counts", F.coalesce("_counts", empty))
        .withColumn("depth", F.explode(F.sequence(F.lit(1), F.lit(MAX_DEPTH))))
        .withColumn(
            "n_sites",
            F.aggregate(
                "_counts",
                F.lit(0).cast("long"),
                lambda acc, it: acc + F.when(it["d"] >= F.col("depth"), it["n"]).otherwise(0),
            ),
        )
        .select(*KEYS, "size", "depth", (F.col("n_sites") / F.col("size")).alias("fraction"))
    )


def depths_sizes(
    histogram: DataFrame,
    contigs: DataFrame,
    readgroups: DataFrame,
    regions: DataFrame | None = None,
    max_contigs: int | None = None,
    ignore_readgroups: bool = False,
) -> DataFrame:
    """All (sample, library, contig) rows of the output with their size.

    The group of reads without read-group is left out if nothing was counted for it.
    """
    references = reference_sizes(contigs, regions, max_contigs)
    dense = dense_groups(references, readgroups, ignore_readgroups)
    if not ignore_readgroups:
        seen = histogram.where(F.col("sample") == NO_GROUP).agg(F.count("*")).scalar()
        dense = dense.where((F.col("sample") != NO_GROUP) | (seen > 0))
    total_size = references.agg(F.sum("size")).scalar()
    return (
        dense.groupingSets(
            [KEYS, ["sample", "library"], ["sample", "contig"], ["sample"], ["contig"], []], *KEYS
        )
        .agg(
            F.max("size").alias("_size"),
            *(F.grouping(key).alias(f"_g_{key}") for key in KEYS),
        )
        .select(
            *(
                F.when(F.col(f"_g_{key}") == 1, "*").otherwise(F.col(key)).alias(key)
                for key in KEYS
            ),
            F.when(F.col("_g_contig") == 1, total_size).otherwise(F.col("_size")).alias("size"),
        )
    )


def depths_table(
    alignments: DataFrame,
    contigs: DataFrame,
    readgroups: DataFrame,
    regions: DataFrame | None = None,
    name: str = "genome",
    max_contigs: int | None = None,
    ignore_readgroups: bool = False,
) -> DataFrame:
    """Wide output table: keys, size, max_depth (``NA`` if none) and ``MD_001`` .. ``MD_200``."""
    histogram = depth_histogram(
        alignments, readgroups, contigs, regions, max_contigs, ignore_readgroups
    )
    sizes = depths_sizes(histogram, contigs, readgroups, regions, max_contigs, ignore_readgroups)
    wide = (
        depth_fractions(histogram, sizes)
        .groupBy(*KEYS, "size")
        .pivot("depth", list(range(1, MAX_DEPTH + 1)))
        .agg(F.format_string("%.4f", F.first("fraction")))
    )
    return (
        wide.withColumnsRenamed({str(k): f"MD_{k:03d}" for k in range(1, MAX_DEPTH + 1)})
        .join(max_depth(histogram), KEYS, "left")
        .withColumn("max_depth", F.coalesce(F.col("max_depth").cast("string"), F.lit("NA")))
        .withColumn("name", F.lit(name))
        .select(
            "name",
            *KEYS,
            "size",
            "max_depth",
            *(f"MD_{k:03d}" for k in range(1, MAX_DEPTH + 1)),
        )
    )
