"""Pass/fail evaluation of alignments, and statistics of the outcome."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.functions import cigar as C
from helixframe.functions import flags as fl
from helixframe.plans.session import cut_lineage
from helixframe.plans.skew import skew_join


@dataclass(frozen=True)
class FilterOptions:
    min_insert_size: int = 0
    max_insert_size: int | None = None
    min_matches: int = 0
    min_mapped_fraction: float = 0.0
    min_mapping_quality: int = 0
    allow_orphan_mates: bool = False
    allow_improper_pairs: bool = False
    #: Larger insert sizes are counted at this one; without it each size is counted by itself
    insert_size_cap: int | None = None

    @property
    def single_filters(self) -> dict[str, int]:
        """Bits that must be clear, by label, for unpaired reads."""
        # Names as in reports
        return {
            "unmapped": fl.UNMAPPED,
            "secondary": fl.SECONDARY,
            "qc_failed": fl.QC_FAIL,
            "pcr_duplicate": fl.DUPLICATE,
            "supplementary": fl.SUPPLEMENTARY,
        }

    @property
    def pair_filters(self) -> dict[str, int]:
        """The same for paired reads; the proper-pair bit is tested inverted."""
        filters = self.single_filters
        if not self.allow_orphan_mates:
            filters["unmapped_mate"] = fl.MATE_UNMAPPED
        if not self.allow_improper_pairs:
            filters["improper_pair"] = fl.PROPER_PAIR
        return filters


#: Filters that do not come from single bits, as named in reports
DERIVED_FILTERS = (
    "low_mapping_quality",
    "low_mapped_fraction",
    "few_mapped",
    "bad_insert_size",
    "orphan_reads",
)


def finalize_flag_filter(options: FilterOptions) -> Column:
    """True if no filtered bit is set."""
    flipped = F.col("flag").bitwiseXOR(F.lit(fl.PROPER_PAIR))
    return F.when(
        fl.has_any("flag", fl.PAIRED), fl.has_none(flipped, sum(options.pair_filters.values()))
    ).otherwise(fl.has_none(flipped, sum(options.single_filters.values())))


def evaluate_alignments(alignments: DataFrame, options: FilterOptions = FilterOptions()) -> DataFrame:
    """Add ``passes``, the derived filters, ``matches``, ``query_length`` and ``insert_size``.

    Insert sizes are only judged for reads that passed everything else. Reads that pass while no
    read of the other mate with their name does are orphans, and fail.
    """
    cigar, query_length = F.col("cigar"), C.query_length(F.col("cigar"))
    low_fraction = F.col("matches") / F.col("query_length") < options.min_mapped_fraction
    insert = F.when(
        fl.has_any("flag", fl.PAIRED) & (F.col("tlen") != 0), F.abs(F.col("tlen"))
    )
    within = insert >= options.min_insert_size
    if options.max_insert_size is not None:
        within = within & (insert <= options.max_insert_size)
    rows = (
        alignments.withColumns(
            {
                "matches": C.mapped_bases(cigar),
                "query_length": F.coalesce(query_length, F.length("seq")),
            }
        )
        .withColumns(
            {
                "low_mapping_quality": F.col("mapq") < options.min_mapping_quality,
                "low_mapped_fraction": F.coalesce(low_fraction, F.lit(False)),
                "few_mapped": F.coalesce(F.col("matches") < options.min_matches, F.lit(False)),
            }
        )
        .withColumn(
            "_passes",
            finalize_flag_filter(options)
            & ~F.col("low_mapping_quality")
            & ~F.col("low_mapped_fraction")
            & ~F.col("few_mapped"),
        )
        .withColumn("insert_size", F.when(F.col("_passes"), insert))
        .withColumn("bad_insert_size", F.coalesce(F.col("_passes") & ~within, F.lit(False)))
        .withColumn("passes", F.col("_passes") & ~F.col("bad_insert_size"))
        .drop("_passes")
    )
    if options.allow_orphan_mates:
        return rows.withColumn("orphan_reads", F.lit(False))

    orphan = F.col("_orphan_name") & F.col("passes") & fl.mate_number().isNotNull()
    marked = pair_mates(rows)
    return (
        marked.withColumn("orphan_reads", F.coalesce(orphan, F.lit(False)))
        .withColumn("passes", F.col("passes") & ~F.col("orphan_reads"))
        .drop("_orphan_name")
    )


def orphan_names(rows: DataFrame) -> DataFrame:
    """Names for which only first or only second mates pass."""
    mate = fl.mate_number()
    return (
        rows.where(F.col("passes") & mate.isNotNull())
        .groupBy("qname")
        .agg(F.bool_or(mate == 1).alias("first"), F.bool_or(mate == 2).alias("second"))
        .where(F.col("first") != F.col("second"))
        .select("qname")
    )


def pair_mates(rows: DataFrame) -> DataFrame:
    """Add ``_orphan_name``: whether the name of the record lost its other mate.

    Only the few names without both mates are joined back, not all names. They are materialised,
    since their number decides how they are joined.
    """
    names = cut_lineage(orphan_names(rows)).withColumn("_orphan_name", F.lit(True))
    return skew_join(rows, names, ["qname"], "left", salt_by=["read_id"]).withColumn(
        "_orphan_name", F.coalesce("_orphan_name", F.lit(False))
    )


def split_outcomes(evaluated: DataFrame) -> DataFrame:
    """Add ``outcome`` (passed/failed), by which the records can be written to two outputs."""
    return evaluated.withColumn("outcome", F.when(F.col("passes"), "passed").otherwise("failed"))


def _by_group(counts: DataFrame, readgroups: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    """Counts per read-group to counts per kind of read (the read-group's description)."""
    kinds = readgroups.select("rg", F.col("description").alias("group"))
    return (
        skew_join(counts, kinds, ["rg"], "left")
        .withColumn("group", F.coalesce("group", F.lit("<NA>")))
        .groupBy("group", *keys)
        .agg(*(F.sum(name).alias(name) for name in sums))
    )


def _with_total(rows: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    """Add the group ``*``, the sum over all groups."""
    return (
        rows.groupingSets([["group", *keys], keys], "group", *keys)
        .agg(*(F.sum(name).alias(name) for name in sums), F.grouping("group").alias("_all"))
        .withColumn("group", F.when(F.col("_all") == 1, "*").otherwise(F.col("group")))
        .drop("_all")
    )


def filter_counts(
    evaluated: DataFrame, readgroups: DataFrame, options: FilterOptions = FilterOptions()
) -> DataFrame:
    """Reads hit by each filter: ``(group, filter, count)``; a read may be hit by several."""
    flipped = F.col("flag").bitwiseXOR(F.lit(fl.PROPER_PAIR))
    paired = fl.has_any("flag", fl.PAIRED)
    single, labels = options.single_filters, options.pair_filters
    tests = {
        label: fl.has_any(flipped, mask) & (paired | F.lit(label in single))
        for label, mask in labels.items()
    } | {label: F.col(label) for label in DERIVED_FILTERS}
    counts = evaluated.groupBy("rg").agg(
        *(F.count_if(test).alias(label) for label, test in tests.items())
    )
    names = list(tests)
    grouped = _by_group(counts, readgroups, [], names)
    total = _with_total(grouped, [], names)
    return total.unpivot("group", names, "filter", "count")


def outcome_histograms(
    evaluated: DataFrame, readgroups: DataFrame, options: FilterOptions = FilterOptions()
) -> DataFrame:
    """Histograms by outcome: ``(group, outcome, metric, key, count)``.

    Both mates of a pair count the same insert size, so these counts are halved.
    """
    percent = F.floor(F.col("matches") * 100 / F.col("query_length"))
    outcome = F.when(F.col("passes"), "passed").otherwise("failed")
    size_outcome = F.when(F.col("bad_insert_size"), "failed").otherwise("passed")
    insert_size = F.col("insert_size")
    if options.insert_size_cap:
        cap = F.lit(options.insert_size_cap)
        insert_size = F.when(insert_size > cap, cap).otherwise(insert_size)
    values = {
        "query_lengths": (outcome, F.col("query_length")),
        "mapping_quality": (outcome, F.col("mapq")),
        "matches": (outcome, F.col("matches")),
        "matches_pct": (outcome, percent),
        "insert_sizes": (size_outcome, insert_size),
    }
    entries = F.array(
        *(
            F.struct(
                F.lit(metric).alias("metric"),
                result.alias("outcome"),
                value.cast("long").alias("key"),
            )
            for metric, (result, value) in values.items()
        )
    )
    keys = ["outcome", "metric", "key"]
    counts = (
        evaluated.select("rg", F.inline(entries))
        .where(F.col("key").isNotNull())
        .groupBy("rg", *keys)
        .agg(F.count("*").alias("count"))
    )
    grouped = _by_group(counts, readgroups, keys, ["count"]).withColumn(
        "count",
        F.when(F.col("metric") == "insert_sizes", F.floor(F.col("count") / 2))
        .otherwise(F.col("count"))
        .cast("long"),
    )
    return _with_total(grouped, keys, ["count"])


def filter_totals(evaluated: DataFrame, readgroups: DataFrame, contigs: DataFrame) -> DataFrame:
    """``(group, outcome, reads, bases, coverage)``, with the group ``*`` for the sum."""
    outcome = F.when(F.col("passes"), "passed").otherwise("failed").alias("outcome")
    counts = evaluated.groupBy("rg", outcome).agg(
        F.count("*").alias("reads"),
        F.coalesce(F.sum("matches"), F.lit(0)).cast("long").alias("bases"),
    )
    sums = ["reads", "bases"]
    grouped = _by_group(counts, readgroups, ["outcome"], sums)
    genome_size = contigs.agg(F.sum("length")).scalar()
    return _with_total(grouped, ["outcome"], sums).withColumn(
        "coverage", F.col("bases") / genome_size
    )
