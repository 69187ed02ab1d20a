"""Tab-separated tables: sample sheets, panels, simulations and results of external solvers.

Parsers take string columns as read from a file and return typed columns. Rows that break a rule
carry a text in ``error``; ``valid_or_fail`` turns such rows into a failure of the job.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.functions.sequences import autosome_or_sex_name
from helixframe.operators.admixture import TEST_SAMPLE
from helixframe.plans.skew import skew_join
from helixframe.sources.lines import FILE_LINES, numbered_lines, read_lines

# What a sample may be called, and the columns that the tables must have
SAMPLE_NAME = "^[A-Za-z0-9._-]+$"
CONTIG_COLUMNS = ("ID", "Size", "Checksum")
SAMPLE_COLUMNS = ("ID", "Species", "Sex", "SampleID", "Publication")
SIMULATION_COLUMNS = ("NReads", "K", "Sample1", "Sample2", "HasTS", "Percentile", "Value")


def read_tsv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Table with a header row; comments and blank lines are skipped, ragged rows fail.

    The first row of every file is its header, and all files must have the same one.
    """
    lines = numbered_lines(spark, path).where((F.trim("value") != "") & ~F.col("value").startswith("#"))
    first = lines.groupBy("file").agg(F.min("line").alias("_first"))
    # One row per file
    headers = lines.join(first, "file").where("line = _first").select("value").distinct().limit(2).collect()
    if len(headers) != 1:
        raise ValueError("files have different headers" if headers else "table has no header")
    names = headers[0]["value"].split("\t")
    fields = F.split("value", "\t", -1)
    ragged = F.raise_error(F.concat(F.lit("ragged row: "), F.substring("value", 1, 100))).cast("array<string>")
    rows = lines.join(first, "file").where("line > _first").select(
        F.when(F.size(fields) == len(names), fields).otherwise(ragged).alias("_fields")
    )
    return rows.select(*(F.nullif(F.col("_fields")[k], F.lit("")).alias(name) for k, name in enumerate(names)))


def require_columns(table: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    missing = [name for name in columns if name not in table.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return table


def valid_or_fail(table: DataFrame, column: str) -> DataFrame:
    """Drop ``error``, failing on the first row that has one."""
    failure = F.raise_error(F.col("error")).cast(table.schema[column].dataType)
    return table.withColumn(
        column, F.when(F.col("error").isNotNull(), failure).otherwise(F.col(column))
    ).drop("error")


def parse_fai(lines: DataFrame) -> DataFrame:
    """Contigs of a FASTA index that have a usable name: ``(name, real_name, size, error)``.

    Two contigs with the same usable name are an error.
    """
    fields = F.split("value", "\t")
    contigs = lines.select(
        autosome_or_sex_name(fields[0]).alias("name"),
        fields[0].alias("real_name"),
        fields[1].cast("long").alias("size"),
    ).where(F.col("name").isNotNull())
    return _flag_duplicates(contigs, "name", "contig name is not unique")


def _flag_duplicates(table: DataFrame, key: str, message: str) -> DataFrame:
    """Set ``error`` for rows whose key occurs more than once."""
    repeated = (
        table.groupBy(key)
        .agg(F.count("*").alias("_n"))
        .where(F.col("_n") > 1)
        .select(key, F.lit(message).alias("_repeated"))
    )
    known = F.col("error") if "error" in table.columns else F.lit(None).cast("string")
    return (
        skew_join(table, repeated, [key], "left")
        .withColumn("error", F.coalesce(known, F.col("_repeated")))
        .drop("_repeated")
    )


def parse_lanes(table: DataFrame) -> DataFrame:
    """Sample sheet with (Sample, Library, Lane, Files); a lane may be listed once."""
    require_columns(table, ("Sample", "Library", "Lane", "Files"))
    keyed = table.withColumn("_key", F.concat_ws("\t", "Sample", "Library", "Lane"))
    return _flag_duplicates(keyed, "_key", "lane is listed more than once").drop("_key")


def parse_sample_files(lines: DataFrame) -> DataFrame:
    """Lines with a sample name and one or two files: ``(sample, files, error)``."""
    fields = F.filter(F.split(F.trim("value"), r"\s+"), lambda it: it != "")
    table = lines.where((F.trim("value") != "") & ~F.col("value").startswith("#")).select(
        fields[0].alias("sample"), F.slice(fields, F.lit(2), F.greatest(F.size(fields) - 1, F.lit(0))).alias("files")
    )
    error = F.when(~F.col("sample").rlike(SAMPLE_NAME), "invalid sample name").when(
        ~F.size("files").between(1, 2), "expected one or two files"
    )
    return _flag_duplicates(table.withColumn("error", error), "sample", "sample name is not unique")


def parse_panel_contigs(table: DataFrame) -> DataFrame:
    """``(id, size, ns, checksum, error)``; sizes are positive and names unique."""
    require_columns(table, CONTIG_COLUMNS)
    size = F.col("Size").try_cast("long")
    ns = F.col("Ns").try_cast("long") if "Ns" in table.columns else F.lit(None).cast("long")
    typed = table.select(
        F.col("ID").alias("id"), size.alias("size"), ns.alias("ns"), F.col("Checksum").alias("checksum")
    ).withColumn(
        "error", F.when(F.col("size").isNull() | (F.col("size") <= 0), "size must be positive")
    )
    return _flag_duplicates(typed, "id", "contig is not unique")


def parse_panel_samples(table: DataFrame) -> DataFrame:
    """``(id, species, sex, sample_id, publication, error)``."""
    require_columns(table, SAMPLE_COLUMNS)
    typed = table.select(
        F.col("ID").alias("id"),
        F.col("Species").alias("species"),
        F.upper("Sex").alias("sex"),
        F.col("SampleID").alias("sample_id"),
        F.col("Publication").alias("publication"),
    ).withColumn("error", F.when(~F.col("sex").isin("MALE", "FEMALE", "NA"), "unknown sex"))
    return _flag_duplicates(typed, "id", "sample is not unique")


def group_columns(table: DataFrame) -> dict[str, int]:
    """The columns ``Group(K)`` and their K, which must be from 2 to 7."""
    found = {name: re.fullmatch(r"Group\((\d+)\)", name) for name in table.columns}
    groups = {name: int(match.group(1)) for name, match in found.items() if match}
    if not groups or not all(2 <= k <= 7 for k in groups.values()):
        raise ValueError(f"expected columns Group(K) with K from 2 to 7, found {sorted(groups)}")
    return groups


def parse_panel_groups(table: DataFrame) -> DataFrame:
    """Groups in long form: ``(sample, k, group)``; a column of only ``-`` is left out."""
    groups = group_columns(table)
    entries = F.array(
        *(
            F.struct(F.lit(k).alias("k"), F.col(f"`{name}`").alias("group"))
            for name, k in groups.items()
        )
    )
    long = table.select(F.col("ID").alias("sample"), F.inline(entries))
    used = long.where(F.col("group") != "-").select("k").distinct()
    return long.join(F.broadcast(used), "k", "left_semi").select("sample", "k", "group")


def wrong_group_counts(groups: DataFrame) -> DataFrame:
    """Values of K whose number of groups is not K."""
    return (
        groups.groupBy("k")
        .agg(F.count_distinct("group").alias("n_groups"))
        .where(F.col("n_groups") != F.col("k"))
    )


def parse_panel_genotypes(lines: DataFrame, header: str) -> tuple[list[str], DataFrame]:
    """Sample order of the header's last column, and ``(contig, pos, ref, genotypes)``."""
    samples = header.rstrip("\r\n").split("\t")[-1].split(";")
    if len(set(samples)) != len(samples):
        raise ValueError("samples of the panel are not unique")
    fields = F.split(F.rtrim("value"), "\t")
    rows = lines.where(F.col("value") != header).select(
        fields[0].alias("contig"),
        fields[1].cast("long").alias("pos"),
        fields[2].alias("ref"),
        F.element_at(fields, -1).alias("genotypes"),
    )
    return samples, rows


def validate_mitochondria(sequences: DataFrame) -> DataFrame:
    """Upper-case sequences with ``error`` for other characters than ``ACGTN-``."""
    upper = sequences.withColumn("sequence", F.upper("sequence")).withColumn(
        "error", F.when(~F.col("sequence").rlike("^[ACGTN-]*$"), "invalid characters")
    )
    return _flag_duplicates(upper, "name", "sequence name is not unique")


def mitochondria_lengths(sequences: DataFrame, padding: int) -> DataFrame:
    """Lengths that occur, and whether they are one, or two that differ by the padding."""
    return sequences.agg(
        F.count_distinct(F.length("sequence")).alias("n_lengths"),
        F.min(F.length("sequence")).alias("shortest"),
        F.max(F.length("sequence")).alias("longest"),
    ).withColumn(
        "valid",
        (F.col("n_lengths") == 1)
        | ((F.col("n_lengths") == 2) & (F.col("longest") - F.col("shortest") == padding)),
    )


def parse_simulations(table: DataFrame, groups: DataFrame) -> DataFrame:
    """Typed simulations, with ``error`` for bad values and unknown samples.

    ``groups`` holds (k, group); ``-`` stands for no sample.
    """
    require_columns(table, SIMULATION_COLUMNS)
    typed = table.select(
        F.col("NReads").try_cast("long").alias("n_reads"),
        F.col("K").try_cast("long").alias("k"),
        F.col("Sample1").alias("sample1"),
        F.col("Sample2").alias("sample2"),
        F.when(F.upper("HasTS") == "TRUE", True)
        .when(F.upper("HasTS") == "FALSE", False)
        .alias("has_ts"),
        F.col("Percentile").try_cast("double").alias("percentile"),
        F.col("Value").try_cast("double").alias("value"),
    )
    known = groups.select(F.col("k").cast("long").alias("k"), "group").distinct()
    for name in ("sample1", "sample2"):
        marked = known.withColumnRenamed("group", name).withColumn(f"_{name}", F.lit(True))
        typed = skew_join(typed, marked, ["k", name], "left")

    def unknown(name: str) -> Column:
        return (F.col(name) != "-") & F.col(f"_{name}").isNull()

    values = ("n_reads", "k", "has_ts", "percentile", "value")
    broken = sum((F.col(name).isNull().cast("int") for name in values), F.lit(0)) > 0
    error = F.when(broken, "invalid value").when(
        unknown("sample1") | unknown("sample2"), "unknown sample"
    )
    return typed.withColumn("error", error).select(
        "n_reads", "k", "sample1", "sample2", "has_ts", "percentile", "value", "error"
    )


def parse_freq_table(lines: DataFrame) -> DataFrame:
    """White-space table of allele frequencies: ``(chrom, snp, sample, mac, nchroms)``."""
    fields = F.split(F.trim("value"), r"\s+")
    return lines.where(F.col("line") > 0).select(
        fields[0].alias("chrom"),
        fields[1].alias("snp"),
        fields[2].alias("sample"),
        fields[6].cast("long").alias("mac"),
        fields[7].cast("long").alias("nchroms"),
    )


def parse_admixture_q(lines: DataFrame, samples: list[str]) -> DataFrame:
    """Fractions per sample and component from a Q matrix: ``(file, sample, component, fraction)``.

    The rows are the given samples and then the one under test; another number of rows fails.
    """
    names = [*samples, TEST_SAMPLE]
    counts = lines.groupBy("file").agg(F.count("*").alias("_n"))
    order = F.array(*(F.lit(name) for name in names))
    name = F.when(
        F.col("_n") == len(names), F.try_element_at(order, (F.col("line") + 1).cast("int"))
    ).otherwise(F.raise_error(F.lit("unexpected number of rows")).cast("string"))
    return (
        skew_join(lines, counts, ["file"], "left")
        .select(
            "file", name.alias("sample"), F.posexplode(F.split(F.trim("value"), r"\s+")).alias("component", "_text")
        )
        .select("file", "sample", "component", F.col("_text").cast("double").alias("fraction"))
    )


def read_freq_table(spark: SparkSession, path: str) -> DataFrame:
    return parse_freq_table(numbered_lines(spark, path))


def read_admixture_q(spark: SparkSession, path: str, samples: list[str]) -> DataFrame:
    return parse_admixture_q(numbered_lines(spark, path), samples)


def read_trees(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One tree per line: ``(tree_id, newick)``; ids are lines, counted on over several files."""
    lines = read_lines(spark, path).where(F.trim("value") != "")
    return lines.select((F.col("number") * FILE_LINES + F.col("line")).alias("tree_id"), F.col("value").alias("newick"))
