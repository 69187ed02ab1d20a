"""Coverage per sample, library and contig or region."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.functions import cigar as C
from helixframe.functions import flags as fl
from helixframe.operators.alignments import (
    NO_GROUP,
    attach_readgroups,
    exclude_default_flags,
    read_groups_table,
    with_ends,
)
from helixframe.plans.intervals import BIN_WIDTH, overlap_join, running_sums
from helixframe.plans.session import cut_lineage
from helixframe.plans.skew import skew_join

#: Label of the single row used when there are many contigs.
GENOME = "<Genome>"
COUNTERS = ("se", "pe_1", "pe_2", "collapsed", "m", "i", "d")


def read_class(qname: str = "qname", flag: str = "flag") -> Column:
    """``collapsed`` (merged mates, by name prefix), ``pe_1``, ``pe_2`` or ``se``."""
    name = F.col(qname)
    return (
        F.when(name.startswith("M_") | name.startswith("MT_"), "collapsed")
        .when(fl.has_any(flag, fl.MATE_1), "pe_1")
        .when(fl.has_any(flag, fl.MATE_2), "pe_2")
        .otherwise("se")
    )


def collapse_contigs(contigs: DataFrame, max_contigs: int | None = None) -> DataFrame:
    """(contig, label): the contig itself, or one common label if there are more than wanted."""
    if max_contigs is None:
        return contigs.withColumn("label", F.col("contig"))
    total = contigs.agg(F.count("*")).scalar()
    return contigs.withColumn(
        "label", F.when(total > max_contigs, GENOME).otherwise(F.col("contig"))
    )


def reference_sizes(
    contigs: DataFrame, regions: DataFrame | None = None, max_contigs: int | None = None
) -> DataFrame:
    """(contig, size) of every output row: per region name, per contig, or of the whole genome."""
    if regions is not None:
        return regions.groupBy(F.col("name").alias("contig")).agg(
            F.sum(F.col("end") - F.col("start")).cast("long").alias("size")
        )
    return (
        collapse_contigs(contigs, max_contigs)
        .groupBy(F.col("label").alias("contig"))
        .agg(F.sum("length").cast("long").alias("size"))
    )


def dense_groups(references: DataFrame, readgroups: DataFrame, ignore_readgroups: bool) -> DataFrame:
    """A row per reference and (sample, library) of the header, whether or not reads were seen.

    The header's (sample, library) pairs travel as one array value and are exploded per row.
    """
    table = read_groups_table(readgroups, ignore_readgroups)
    pairs = table.agg(F.collect_set(F.struct("sample", "library"))).scalar()
    return references.select("contig", "size", F.inline(pairs))


def coverage_counts(
    alignments: DataFrame,
    regions: DataFrame | None = None,
    contigs: DataFrame | None = None,
    max_contigs: int | None = None,
) -> DataFrame:
    """Hits by read class and aligned, inserted and deleted bases per (contig or region, rg).

    Bases of a region are the bases whose reference position lies inside it. Reads are counted
    once per region they overlap. Counts are per read-group, so nothing is joined to the reads.
    """
    reads = exclude_default_flags(alignments).where(F.col("contig").isNotNull())
    if regions is None:
        counts = (
            reads.select(
                "contig",
                "rg",
                read_class().alias("_class"),
                C.mapped_bases(F.col("cigar")).alias("m"),
                C.total_length(F.col("cigar"), C.INSERTION).alias("i"),
                C.total_length(F.col("cigar"), C.DELETION).alias("d"),
            )
            .groupBy("contig", "rg")
            .agg(
                *(F.count_if(F.col("_class") == name).alias(name) for name in COUNTERS[:4]),
                *(F.sum(name).cast("long").alias(name) for name in COUNTERS[4:]),
            )
        )
    else:
        counts = _region_counts(reads, regions)
    if regions is None and contigs is not None:
        labels = collapse_contigs(contigs, max_contigs).select("contig", "label")
        counts = (
            counts.join(labels, "contig")
            .groupBy(F.col("label").alias("contig"), "rg")
            .agg(*(F.sum(name).alias(name) for name in COUNTERS))
        )
    return counts


def _region_counts(reads: DataFrame, regions: DataFrame) -> DataFrame:
    """Counts per (region name, rg).

    Reads are cut into the pieces that matter: the aligned span, of which there is one per read,
    and the rare insertions, deletions and skipped stretches. No pairs of piece and region are made: of
    the pieces that meet a region are those that start before its end, less those that end at or before
    its start, and the bases inside are those below its end, less those below its start. So the sums
    along a contig are looked up at the edges of regions, which are counted by name before.
    """
    kind, sign = F.col("kind"), F.col("edge.sign")
    pieces = (
        with_ends(reads)
        .select(
            "contig",
            "rg",
            F.col("ref_end").alias("_read_end"),
            F.inline(C.pieces(F.col("pos"), F.col("cigar"), read_class())),
        )
        .where("piece_start < piece_end")
    )
    # An insertion may reach past the end of its read
    past = F.when(
        F.col("piece_end") > F.col("_read_end"),
        _edge(F.col("_read_end"), 1, F.col("piece_end")),
    )
    edges = F.array(_edge(F.col("piece_start"), 1), _edge(F.col("piece_end"), -1), past)
    span = kind.isin(*COUNTERS[:4])
    sums = {
        **{f"opened_{it}": (kind == it) & (sign == 1) for it in COUNTERS[:4]},
        **{f"closed_{it}": (kind == it) & (sign == -1) for it in COUNTERS[:4]},
    }
    steps = {
        "m": F.when(span, sign).when(kind.isin("d", "n"), -sign).otherwise(0),
        "i": F.when(kind == "i", sign).otherwise(0),
        "d": F.when(kind == "d", sign).otherwise(0),
    }
    events = cut_lineage(
        pieces.select("contig", "rg", "kind", F.explode(edges).alias("edge"))
        .where("edge IS NOT NULL")
        .groupBy("contig", "rg", F.col("edge.at").alias("at"), F.col("edge.past").alias("past"))
        .agg(
            *(F.count_if(test).alias(name) for name, test in sums.items()),
            *(F.sum(step).cast("long").alias(f"step_{name}") for name, step in steps.items()),
        )
    )
    counted = [*sums, *(f"step_{name}" for name in steps)]
    places = events.where("past IS NULL").drop("past")
    spans = regions.where(F.col("start") < F.col("end")).select(
        "contig", "name", F.col("start").cast("long").alias("_start"), F.col("end").cast("long").alias("_end")
    )
    opens, closes = (F.struct(F.col(at).alias("at"), F.lit(it).alias("sign")) for at, it in (("_start", -1), ("_end", 1)))
    bounds = (
        spans.select("contig", "name", F.explode(F.array(opens, closes)).alias("edge"))
        .groupBy("contig", "name", F.col("edge.at").alias("at"))
        .agg(F.count_if(sign == -1).alias("_opens"), F.count_if(sign == 1).alias("_closes"))
    )
    groups = places.select("contig", "rg").distinct()
    asked = skew_join(bounds.select("contig", "at").distinct(), groups, ["contig"], salt_by=["at"])
    asked = asked.select("contig", "rg", "at", *(F.lit(0).cast("long").alias(it) for it in counted), F.lit(True).alias("_asked"))
    rows = (
        places.withColumn("_asked", F.lit(False))
        .unionByName(asked)
        .groupBy("contig", "rg", "at")
        .agg(*(F.sum(it).alias(it) for it in counted), F.bool_or("_asked").alias("_asked"))
        .withColumns({f"moment_{it}": F.col("at") * F.col(f"step_{it}") for it in steps})
    )
    running = running_sums(rows, ["contig", "rg"], "at", [*counted, *(f"moment_{it}" for it in steps)], BIN_WIDTH)
    found = skew_join(running.where("_asked"), bounds, ["contig", "at"], salt_by=["rg"])

    def met(name: str) -> Column:
        before = F.col(f"_sum_opened_{name}") - F.col(f"opened_{name}")
        return F.sum(F.col("_closes") * before - F.col("_opens") * F.col(f"_sum_closed_{name}")).alias(name)

    def bases(name: str) -> Column:
        below = F.col("at") * F.col(f"_sum_step_{name}") - F.col(f"_sum_moment_{name}")
        return F.sum((F.col("_closes") - F.col("_opens")) * below).alias(name)

    counts = found.groupBy(F.col("name").alias("contig"), "rg").agg(
        *map(met, COUNTERS[:4]), *map(bases, COUNTERS[4:])
    )
    late = events.where("past IS NOT NULL").select("contig", "rg", "at", "past", "step_i")
    if not late.isEmpty():
        counts = _without_late(counts, late, spans)
    return counts.where(" OR ".join(f"{it} <> 0" for it in COUNTERS))


def _edge(at: Column, sign: int, past: Column | None = None) -> Column:
    past = F.lit(None).cast("long") if past is None else past
    return F.struct(at.alias("at"), F.lit(sign).alias("sign"), past.alias("past"))


def _without_late(counts: DataFrame, late: DataFrame, spans: DataFrame) -> DataFrame:
    """Take inserted bases off regions that start at or after the end of the read, which they reach past."""
    spans = spans.groupBy("contig", "name", "_start", "_end").agg(F.count("*").alias("_times"))
    inside = (F.least("past", "_end") - F.col("_start")) * F.col("step_i") * F.col("_times")
    taken = (
        overlap_join(late, spans, ("at", "past"), ("_start", "_end"))
        .where(F.col("_start") >= F.col("at"))
        .groupBy(F.col("name").alias("contig"), "rg")
        .agg(*((-F.sum(inside) if it == "i" else F.lit(0).cast("long")).alias(it) for it in COUNTERS))
    )
    return counts.unionByName(taken).groupBy("contig", "rg").agg(*(F.sum(it).alias(it) for it in COUNTERS))


def coverage_table(
    alignments: DataFrame,
    contigs: DataFrame,
    readgroups: DataFrame,
    regions: DataFrame | None = None,
    name: str = "genome",
    max_contigs: int | None = None,
    ignore_readgroups: bool = False,
) -> DataFrame:
    """Coverage of every sample, library and contig, with ``*`` rows for the totals.

    The reads are reduced to one row per contig and read-group before anything else happens; the
    dense grid, the totals and the ratios are computed from that small table.
    """
    counts = coverage_counts(alignments, regions, contigs, max_contigs)
    grouped = (
        attach_readgroups(counts, readgroups, ignore_readgroups)
        .groupBy("sample", "library", "contig")
        .agg(*(F.sum(it).alias(it) for it in COUNTERS))
    )
    references = reference_sizes(contigs, regions, max_contigs)
    dense = (
        dense_groups(references, readgroups, ignore_readgroups)
        .join(grouped, ["sample", "library", "contig"], "left")
        .fillna(0, list(COUNTERS))
    )
    total_size = references.agg(F.sum("size")).scalar()
    keys = ["sample", "library", "contig"]
    totals = dense.groupingSets(
        [keys, ["sample", "library"], ["sample", "contig"], ["sample"], ["contig"], []], *keys
    ).agg(
        F.max("size").alias("_size"),
        *(F.sum(it).alias(it) for it in COUNTERS),
        *(F.grouping(key).alias(f"_g_{key}") for key in keys),
    )
    table = totals.select(
        F.lit(name).alias("name"),
        *(F.when(F.col(f"_g_{key}") == 1, "*").otherwise(F.col(key)).alias(key) for key in keys),
        F.when(F.col("_g_contig") == 1, total_size).otherwise(F.col("_size")).alias("size"),
        (F.col("se") + F.col("pe_1") + F.col("pe_2") + F.col("collapsed")).alias("hits"),
        *COUNTERS,
    ).withColumn("coverage", F.col("m") / F.col("size"))
    return table if ignore_readgroups else drop_empty_na_group(table)


def drop_empty_na_group(table: DataFrame) -> DataFrame:
    """Drop the rows of reads without read-group, if nothing was counted in any of them."""
    counted = sum((F.col(it) for it in COUNTERS), F.lit(0))
    is_none = F.col("sample") == NO_GROUP
    seen = table.where(is_none).agg(F.max(counted)).scalar()
    return table.where(~is_none | (seen > 0))
