"""BED intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.plans.skew import skew_join
from helixframe.sources.lines import lines_of_splits


def parse_bed(lines: DataFrame) -> DataFrame:
    """Intervals from lines with three to six columns (further ones are ignored).

    Blank lines and comments are skipped. ``error`` tells what is wrong with a line, else null.
    """
    fields = F.split(F.rtrim("value"), "\t")

    def field(index: int) -> Column:
        return F.try_element_at(fields, F.lit(index + 1))

    text = lines.where((F.trim("value") != "") & ~F.col("value").startswith("#"))
    parsed = text.withColumns(
        {
            "contig": field(0),
            "start": field(1).try_cast("long"),
            "end": field(2).try_cast("long"),
            "name": field(3),
            "score": field(4).try_cast("int"),
            "strand": field(5),
            "_bad_score": field(4).isNotNull() & field(4).try_cast("int").isNull(),
            "_n": F.size(fields),
        }
    )
    error = (
        F.when(F.col("_n") < 3, "not enough columns")
        .when(F.col("start").isNull() | F.col("end").isNull(), "coordinates must be integers")
        .when(F.col("start") < 0, "start must not be negative")
        .when(F.col("end") <= F.col("start"), "end must be greater than start")
        .when(F.col("_bad_score"), "score must be an integer")
        .when(F.col("strand").isNotNull() & ~F.col("strand").isin("+", "-"), "invalid strand")
    )
    return parsed.withColumn("error", error).drop("_bad_score", "_n")


def check_contigs(regions: DataFrame, sizes: DataFrame) -> DataFrame:
    """Set ``error`` for intervals on unknown contigs or beyond the end of their contig.

    ``sizes`` holds (contig, length).
    """
    known = sizes.select("contig", F.col("length").alias("_length"))
    problem = F.when(F.col("_length").isNull(), "unknown contig").when(
        F.col("end") > F.col("_length"), "interval exceeds the contig"
    )
    return (
        skew_join(regions, known, ["contig"], "left")
        .withColumn("error", F.coalesce("error", problem))
        .drop("_length")
    )


def valid_or_fail(regions: DataFrame) -> DataFrame:
    """Drop ``error``; a row with an error fails the job."""
    checked = F.when(
        F.col("error").isNotNull(),
        F.raise_error(F.concat_ws(": ", "error", "value")).cast("string"),
    ).otherwise(F.col("contig"))
    return regions.withColumn("contig", checked).drop("error", "value")


def read_bed(spark: SparkSession, path: str, sizes: DataFrame | None = None) -> DataFrame:
    regions = parse_bed(lines_of_splits(spark, path).select("value"))
    if sizes is not None:
        regions = check_contigs(regions, sizes)
    return valid_or_fail(regions)


def bed_line() -> Column:
    """An interval as a line without trailing missing columns.

    Missing columns before others become an empty name or the score 0.
    """
    has_score = F.col("score").isNotNull() | F.col("strand").isNotNull()
    has_name = F.col("name").isNotNull() | has_score
    return F.concat_ws(
        "\t",
        F.col("contig"),
        F.col("start").cast("string"),
        F.col("end").cast("string"),
        F.when(has_name, F.coalesce("name", F.lit(""))),
        F.when(has_score, F.coalesce(F.col("score").cast("string"), F.lit("0"))),
        F.col("strand"),
    )


def format_bed(regions: DataFrame) -> DataFrame:
    return regions.select(bed_line().alias("value"))


def interval_list_to_bed(lines: DataFrame, one_based: bool = False) -> DataFrame:
    """First three columns of an interval list, without its header.

    Coordinates are copied unchanged unless ``one_based`` is set, which subtracts one from the
    start.
    """
    fields = F.split("value", "\t")
    start = fields[1]
    if one_based:
        start = (start.cast("long") - 1).cast("string")
    return lines.where(~F.col("value").startswith("@")).select(
        F.concat_ws("\t", fields[0], start, fields[2]).alias("value")
    )
