"""Text output of the result tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.functions.sequences import panel_alleles, sex_code
from helixframe.operators.depths import MAX_DEPTH

# Column titles of the output tables
COVERAGE_COLUMNS = {
    "name": "Name",
    "sample": "Sample",
    "library": "Library",
    "contig": "Contig",
    "size": "Size",
    "hits": "Hits",
    "se": "SE",
    "pe_1": "PE_1",
    "pe_2": "PE_2",
    "collapsed": "Collapsed",
    "m": "M",
    "i": "I",
    "d": "D",
    "coverage": "Coverage",
}
DEPTH_COLUMNS = {
    "name": "Name",
    "sample": "Sample",
    "library": "Library",
    "contig": "Contig",
    "size": "Size",
    "max_depth": "MaxDepth",
} | {f"MD_{k:03d}": f"MD_{k:03d}" for k in range(1, MAX_DEPTH + 1)}


def _grouped_lines(table: DataFrame, columns: dict[str, str], after_sample: int) -> DataFrame:
    """Ordered lines: the titles, the rows, and ``#`` lines after each library and sample."""
    top = F.lit("\U0010ffff")  # sorts after every name
    line = F.concat_ws("\t", *(F.col(name).cast("string") for name in columns))
    rows = table.select("name", "sample", "library", "contig", line.alias("value"))
    separator = F.lit("#").alias("value")
    libraries = table.select("name", "sample", "library").distinct()
    per_library = libraries.select("name", "sample", "library", top.alias("contig"), separator)
    per_sample = (
        table.select("name", "sample")
        .distinct()
        .select("name", "sample", top.alias("library"), top.alias("contig"), separator)
    )
    titles = table.sparkSession.range(1).select(
        *(F.lit("").alias(name) for name in ("name", "sample", "library", "contig")),
        F.lit("\t".join(columns.values())).alias("value"),
    )
    lines = titles.unionByName(rows).unionByName(per_library)
    for _ in range(after_sample):
        lines = lines.unionByName(per_sample)
    return lines.orderBy("name", "sample", "library", "contig").select("value")


def coverage_lines(table: DataFrame) -> DataFrame:
    """Lines of the coverage table."""
    return _grouped_lines(table, COVERAGE_COLUMNS, after_sample=1)


def depths_lines(table: DataFrame) -> DataFrame:
    """Lines of the table of depths."""
    return _grouped_lines(table, DEPTH_COLUMNS, after_sample=1)


def filter_json(
    counts: DataFrame, histograms: DataFrame, totals: DataFrame, contigs: DataFrame
) -> DataFrame:
    """Statistics of the pass/fail evaluation as JSON, one row per group: ``(group, value)``.

    Entries are sorted by their keys, as texts.
    """

    def entries(*columns: str | Column) -> Column:
        return F.map_from_entries(F.array_sort(F.collect_list(F.struct(*columns))))

    def by_name(name: str, value: str) -> Column:
        pairs = F.collect_list(F.struct(name, value))
        return F.array_sort(
            pairs,
            lambda a, b: F.when(a[name] < b[name], -1).when(a[name] > b[name], 1).otherwise(0),
        )

    filters = counts.groupBy("group").agg(entries("filter", "count").alias("filters"))
    metric = histograms.groupBy("group", "metric", "outcome").agg(
        entries(F.col("key").cast("string").alias("key"), "count").alias("_counts")
    )
    # Maps have no order of their own, and texts do
    outcomes = metric.groupBy("group", "metric").agg(
        F.map_from_entries(by_name("outcome", "_counts")).alias("_outcomes")
    )
    metrics = outcomes.groupBy("group").agg(
        F.map_from_entries(by_name("metric", "_outcomes")).alias("histograms")
    )
    summary = totals.groupBy("group").agg(
        entries("outcome", F.struct("reads", "bases", "coverage").alias("sums")).alias("totals")
    )
    genome = contigs.agg(
        F.struct(F.count("*").alias("ncontigs"), F.sum("length").alias("size"))
    ).scalar()
    return (
        summary.join(filters, "group", "left")
        .join(metrics, "group", "left")
        .select(
            "group",
            F.to_json(F.struct("filters", genome.alias("genome"), "histograms", "totals")).alias(
                "value"
            ),
        )
    )


def write_split(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write records to one folder per ``outcome``."""
    rows.write.mode(mode).partitionBy("outcome").parquet(path)


def tped_line() -> Column:
    """A sampled site: contig, name, dummy, position, two alleles per sample, the sampled base."""
    contig = F.col("contig")
    return F.concat_ws(
        " ",
        contig,
        F.concat(F.lit("chr"), contig, F.lit("_"), F.col("pos").cast("string")),
        F.lit("0"),
        F.col("pos").cast("string"),
        panel_alleles(F.col("genotypes")),
        F.col("base"),
        F.col("base"),
    )


def tfam_lines(samples: DataFrame, test_sample: str) -> DataFrame:
    """Sample rows in panel order, the one under test last; ``samples`` holds (idx, id, sex)."""

    def line(name: Column, code: Column) -> Column:
        return F.concat_ws(" ", name, name, F.lit("0"), F.lit("0"), code, F.lit("-9"))

    last = samples.sparkSession.range(1).select(
        F.lit(2**62).alias("idx"), line(F.lit(test_sample), F.lit("0")).alias("value")
    )
    rows = samples.select(
        F.col("idx").cast("long").alias("idx"),
        line(F.col("id"), sex_code(F.col("sex")).cast("string")).alias("value"),
    )
    return rows.unionByName(last).orderBy("idx").select("value")


def treemix_line(samples: list[str]) -> Column:
    """Counts of all samples of a site; the title row is the sorted sample names."""
    return F.concat_ws(" ", *(F.col(name) for name in sorted(samples)))


def panel_contig_lines(contigs: DataFrame) -> DataFrame:
    """``ID, Size, Ns, Checksum`` rows; ``contigs`` holds (name, size, ns)."""
    return contigs.select(
        F.concat_ws(
            "\t", F.col("name"), F.col("size").cast("string"), F.col("ns").cast("string"), F.lit("NA")
        ).alias("value")
    )


def panel_sample_lines(samples: DataFrame) -> DataFrame:
    """Template rows to be completed by hand; ``samples`` holds (name)."""
    fields = ("-", "-", "NA", "NA")
    return samples.select(
        F.concat_ws(
            "\t", F.col("name"), *(F.lit(it) for it in fields), F.col("name"), F.lit("NA")
        ).alias("value")
    )


def panel_genotype_lines(sites: DataFrame) -> DataFrame:
    """``contig, pos, ref, genotypes`` rows in genome order."""
    return sites.orderBy("contig", "pos").select(
        F.concat_ws("\t", "contig", F.col("pos").cast("string"), "ref", "genotypes").alias("value")
    )
