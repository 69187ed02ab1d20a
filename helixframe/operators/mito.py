"""Consensus of small (mitochondrial) genomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.functions import cigar as C
from helixframe.functions import flags as fl

BASES = ("A", "C", "G", "T", "N")
#: Bases per row of the consensus; more than a mitochondrial genome has.
CHUNK = 1 << 16


def base_counts(
    alignments: DataFrame,
    min_base_quality: int = 0,
    exclude_flags: int = fl.UNMAPPED | fl.SECONDARY | fl.QC_FAIL | fl.DUPLICATE,
) -> DataFrame:
    """Number of reads with each base, per contig and position (0-based).

    Base qualities are only looked at if a minimum is given; reads without qualities then pass.
    """
    reads = alignments.where(
        fl.has_none("flag", exclude_flags) & F.col("cigar").isNotNull()
    )
    blocks = reads.select(
        "contig", "seq", "quals", F.inline(C.aligned_blocks(F.col("pos"), F.col("cigar")))
    )
    length = (F.col("ref_end") - F.col("ref_start")).cast("int")
    bases = F.split(F.substring(F.col("seq"), F.col("query_start") + 1, length), "")
    columns = ["contig", "ref_start"]
    if min_base_quality:
        quals = F.slice("quals", F.col("query_start") + 1, length)
        good = F.transform(quals, lambda it: it >= min_base_quality)
        blocks = blocks.withColumn("_good", F.coalesce(good, F.array().cast("array<boolean>")))
        columns.append("_good")
    sites = blocks.select(*columns, F.posexplode(bases).alias("_i", "base")).where("base != ''")
    if min_base_quality:
        sites = sites.where(
            F.coalesce(F.try_element_at("_good", F.col("_i") + 1), F.lit(True))
        )
    return sites.groupBy("contig", (F.col("ref_start") + F.col("_i")).alias("pos")).agg(
        *(F.count_if(F.col("base") == base).alias(base) for base in BASES)
    )


def fold_padding(counts: DataFrame, lengths: DataFrame, padding: int) -> DataFrame:
    """Add the counts of the last ``padding`` positions to the first ones.

    Circular genomes are padded with their own start, so that reads across the origin align.
    """
    origin = F.col("length") - padding
    folded = F.when(F.col("pos") >= origin, F.col("pos") - origin).otherwise(F.col("pos"))
    return (
        counts.join(lengths.select("contig", "length"), "contig")
        .groupBy("contig", folded.alias("pos"))
        .agg(*(F.sum(base).alias(base) for base in BASES))
    )


def majority_base():
    """The most frequent base, ``N`` on ties and without any."""
    top = F.greatest(*BASES[:4])
    n_top = sum((F.when(F.col(base) == top, 1).otherwise(0) for base in BASES[:4]), F.lit(0))
    best = F.lit("N")
    for base in BASES[:4]:
        best = F.when(F.col(base) == top, base).otherwise(best)
    return F.when((top > 0) & (n_top == 1), best).otherwise("N")


def consensus(
    counts: DataFrame, lengths: DataFrame, padding: int = 0, chunk: int = CHUNK
) -> DataFrame:
    """Consensus of every contig: ``(contig, chunk, sequence)``, ``N`` where there are no reads.

    A row holds up to ``chunk`` bases; ``whole_consensus`` puts the rows of a contig together. Only called
    sites are rows: a chunk is written as its called bases, each after as many ``N`` as lie between
    it and the one before.
    """
    size = F.col("length").cast("long") - padding
    sizes = lengths.select("contig", size.alias("_size")).where("_size > 0")
    numbers = F.sequence(F.lit(0), F.ceil(F.col("_size") / chunk).cast("int") - 1)
    rows = sizes.select("contig", "_size", F.explode(numbers).alias("chunk"))
    called = (
        counts.withColumn("base", majority_base())
        .where("base <> 'N'")
        .select("contig", F.col("pos").cast("long").alias("pos"), "base")
        .join(sizes, "contig")
        .where("pos >= 0 AND pos < _size")
        .groupBy("contig", F.floor(F.col("pos") / chunk).cast("int").alias("chunk"))
        .agg(F.array_sort(F.collect_list(F.struct((F.col("pos") % chunk).cast("int").alias("at"), "base"))).alias("_sites"))
    )

    def written(site: Column, k: Column) -> Column:
        before = F.coalesce(F.get(F.col("_sites"), k - 1)["at"], F.lit(-1))
        return F.concat(F.repeat(F.lit("N"), site["at"] - before - 1), site["base"])

    text = F.coalesce(F.array_join(F.transform("_sites", written), ""), F.lit(""))
    width = F.least(F.lit(chunk), F.col("_size") - F.col("chunk").cast("long") * chunk).cast("int")
    return rows.join(called, ["contig", "chunk"], "left").select(
        "contig", "chunk", F.rpad(text, width, F.lit("N")).alias("sequence")
    )


def whole_consensus(rows: DataFrame) -> DataFrame:
    """One row per contig, for contigs that fit into a row: ``(contig, sequence)``."""
    ordered = F.array_sort(F.collect_list(F.struct("chunk", "sequence")))
    return rows.groupBy("contig").agg(
        F.array_join(F.transform(ordered, lambda it: it["sequence"]), "").alias("sequence")
    )


def consensus_statistics(counts: DataFrame, lengths: DataFrame, padding: int = 0) -> DataFrame:
    """Length, bases, covered sites and their share, and mean coverage, per contig."""
    depth = F.col("A") + F.col("C") + F.col("G") + F.col("T")
    sums = counts.groupBy("contig").agg(
        F.sum(depth).alias("nucleotides"), F.count_if(depth > 0).alias("covered_sites")
    )
    size = F.col("length") - padding
    return (
        lengths.join(sums, "contig", "left")
        .fillna(0, ["nucleotides", "covered_sites"])
        .select(
            F.col("contig").alias("sequence_name"),
            size.alias("sequence_len"),
            "nucleotides",
            "covered_sites",
            F.bround(100.0 * F.col("covered_sites") / size, 1).alias("covered_pct"),
            F.bround(F.col("nucleotides") / size, 1).alias("mean_coverage"),
        )
    )
