"""Checks of input files and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.functions.sequences import COMPLEMENT_FROM
from helixframe.plans.intervals import lag_value, running_before

# Fixed value: what the name of a sequence may start with
NAME_PATTERN = "^[!-()+-<>-~]"


def fastq_summary(records: DataFrame, collapsed: bool = False) -> DataFrame:
    """Number of reads and bases, and of collapsed reads."""
    n_reads = F.count("*")
    return records.agg(
        n_reads.alias("seq_retained_reads"),
        F.coalesce(F.sum(F.length("sequence")), F.lit(0)).cast("long").alias("seq_retained_nts"),
        (n_reads if collapsed else F.lit(0).cast("long")).alias("seq_collapsed"),
    )


def quality_offset(records: DataFrame, file: str = "file") -> DataFrame:
    """Encoding of the quality scores of each file, from the characters that occur.

    Some characters occur only with an offset of 33, others only with 64; the rest is ambiguous.
    """
    return (
        records.groupBy(file)
        .agg(
            F.bool_or(F.col("qualities").rlike("[!-:]")).alias("low"),
            F.bool_or(F.col("qualities").rlike("[;-J]")).alias("middle"),
            F.bool_or(F.col("qualities").rlike("[K-h]")).alias("high"),
        )
        .select(
            file,
            F.when(F.col("low") & F.col("high"), "BOTH")
            .when(F.col("low"), "33")
            .when(F.col("high"), "64")
            .when(F.col("middle"), "AMBIGUOUS")
            .otherwise("MISSING")
            .alias("offset"),
        )
    )


def validate_fastq(
    records: DataFrame, expected_offset: str = "33", allow_empty: bool = False, file: str = "file"
) -> DataFrame:
    """Files whose quality encoding is mixed, missing or not the expected one."""
    fine = [expected_offset, "AMBIGUOUS"] + (["MISSING"] if allow_empty else [])
    return quality_offset(records, file).where(~F.col("offset").isin(*fine))


def validate_fasta(lines: DataFrame, width: int = 1 << 16) -> DataFrame:
    """First error of each file: ``(file, line, error)``; valid files have no row.

    ``lines`` holds (file, line, value), where ``line`` orders the lines of a file. What a line
    may be depends on the line before it and on the first line of its record; both are found with
    windows over ``width`` lines rather than over whole files.
    """
    value = F.col("value")
    kind = F.when(value.startswith(">"), "header").when(value == "", "blank").otherwise("bases")
    typed = lines.select(
        "file", "line", "value", F.struct(kind.alias("kind"), F.length("value").alias("len")).alias("row")
    )
    before = F.col("_previous.kind")
    ordered = lag_value(typed, ["file"], "line", "row", width)

    # The last line with content tells whether a blank line ends a record or breaks it
    content = F.when(
        F.col("row.kind") != "blank", F.struct("line", F.col("row.kind").alias("kind"))
    )
    opening = F.when(
        (F.col("row.kind") == "bases") & (before == "header"),
        F.struct("line", F.col("row.len").alias("len")),
    )
    ordered = ordered.withColumns({"_content": content, "_opening": opening})
    ordered = running_before(ordered, ["file"], "line", "_content", width).withColumnRenamed(
        "_running", "_last_content"
    )
    ordered = running_before(ordered, ["file"], "line", "_opening", width).withColumnRenamed(
        "_running", "_record"
    )
    name = F.regexp_extract("value", r"^>([^ ]*)", 1)
    headers = ordered.where(F.col("row.kind") == "header").select("file", "line", name.alias("name"))
    seen_first = headers.groupBy("file", "name").agg(F.min("line").alias("line"))
    repeated = headers.join(seen_first, ["file", "line"], "left_anti").select(
        "file", "line", F.lit(True).alias("_repeated")
    )
    is_kind = F.col("row.kind")
    letters = COMPLEMENT_FROM.replace("X", "")
    allowed = f"^[{letters}{letters.lower()}]*$"
    last = F.col("_last_content.kind")
    wrong_length = (before == "bases") & (
        (F.col("row.len") > F.col("_record.len"))
        | (F.col("_previous.len") != F.col("_record.len"))
    )
    error = (
        F.when(value.endswith("\r"), "line ends in CR")
        .when((is_kind == "header") & (before == "header"), "header follows header")
        .when((is_kind == "header") & (F.col("name") == ""), "header has no name")
        .when((is_kind == "header") & ~F.col("name").rlike(NAME_PATTERN), "name breaks the SAM pattern")
        .when((is_kind == "header") & F.col("_repeated").isNotNull(), "name seen before")
        .when((is_kind == "bases") & last.isNull(), "bases before any header")
        .when((is_kind == "bases") & (before == "blank"), "bases follow blank line")
        .when((is_kind == "bases") & ~value.rlike(allowed), "letters other than nucleotide codes")
        .when((is_kind == "bases") & wrong_length, "uneven line width")
        .when((is_kind == "blank") & (before == "header"), "blank line after header")
    )
    per_line = (
        ordered.withColumn("name", name)
        .join(repeated, ["file", "line"], "left")
        .select("file", "line", is_kind.alias("kind"), error.alias("error"))
    )
    result = per_line.groupBy("file").agg(
        F.min(F.when(F.col("error").isNotNull(), F.struct("line", "error"))).alias("first"),
        F.max(F.when(F.col("kind") != "blank", F.struct("line", "kind"))).alias("last"),
        F.max("line").alias("end"),
    )
    return result.select(
        "file",
        F.coalesce("first.line", "end").alias("line"),
        F.coalesce(
            F.col("first.error"),
            F.when(F.col("last").isNull(), "no content").when(
                F.col("last.kind") == "header", "no bases after last header"
            ),
        ).alias("error"),
    ).where(F.col("error").isNotNull())


def duplicate_inputs(records: DataFrame) -> DataFrame:
    """Files used more than once: an error within a sample, otherwise a warning.

    ``records`` holds (sample, path).
    """
    per_sample = records.groupBy("path", "sample").agg(F.count("*").alias("n"))
    return (
        per_sample.groupBy("path")
        .agg(
            F.sum("n").alias("n_records"),
            F.count("*").alias("n_samples"),
            F.max("n").alias("most"),
        )
        .where(F.col("n_records") > 1)
        .select(
            "path",
            "n_records",
            "n_samples",
            F.when(F.col("most") > 1, "error").otherwise("warning").alias("severity"),
        )
    )


def colliding_names(samples: DataFrame, name: str = "sample") -> DataFrame:
    """Different sample names that only differ in case."""
    return (
        samples.select(name)
        .distinct()
        .groupBy(F.lower(name).alias("folded"))
        .agg(F.count("*").alias("n"), F.min(name).alias("first"), F.max(name).alias("last"))
        .where(F.col("n") > 1)
    )


def symmetric_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys present on one side only: ``(key, side)``."""
    a, b = left.select(key).distinct(), right.select(key).distinct()
    return a.join(b, key, "left_anti").withColumn("side", F.lit("left")).unionByName(
        b.join(a, key, "left_anti").withColumn("side", F.lit("right"))
    )
