"""Alignments in SAM text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helixframe.functions.cigar import format_cigar, parse_cigar
from helixframe.sources.lines import FILE_LINES, lines_of_splits, read_lines


def parse_alignments(lines: DataFrame) -> DataFrame:
    """Records of the lines below the header; ``line`` becomes the id of the record."""
    f = F.split("value", "\t")
    contig = F.when(f[2] != "*", f[2])
    tags = F.map_from_entries(
        F.transform(
            F.slice(f, F.lit(12), F.greatest(F.size(f) - 11, F.lit(0))),
            lambda it: F.struct(
                F.substring(it, 1, 2).alias("key"),
                F.struct(
                    F.substring(it, 4, 1).alias("type"), F.substr(it, F.lit(6)).alias("value")
                ).alias("value"),
            ),
        )
    )
    quals = F.when(
        f[10] != "*",
        F.transform(
            F.filter(F.split(f[10], ""), lambda it: it != ""), lambda it: F.ascii(it) - 33
        ),
    )
    records = lines.where(~F.col("value").startswith("@")).select(
        F.col("line").alias("read_id"),
        f[0].alias("qname"),
        f[1].cast("int").alias("flag"),
        contig.alias("contig"),
        (f[3].cast("long") - 1).alias("pos"),
        f[4].cast("int").alias("mapq"),
        parse_cigar(f[5]).alias("cigar"),
        F.when(f[6] == "=", contig).when(f[6] != "*", f[6]).alias("mate_contig"),
        (f[7].cast("long") - 1).alias("mate_pos"),
        f[8].cast("int").alias("tlen"),
        F.when(f[9] != "*", f[9]).alias("seq"),
        quals.alias("quals"),
        tags.alias("tags"),
    )
    return records.withColumn("rg", F.try_element_at("tags", F.lit("RG"))["value"])


def _header(lines: DataFrame, kind: str) -> DataFrame:
    return lines.where(F.col("value").startswith(f"@{kind}\t")).select(
        "line", F.str_to_map("value", F.lit("\t"), F.lit(":")).alias("h")
    )


def parse_contigs(lines: DataFrame) -> DataFrame:
    """(tid, contig, length) of the header, in its order."""
    # Header lines only
    order = F.row_number().over(Window.orderBy("line"))
    return _header(lines, "SQ").select(
        (order - 1).alias("tid"),
        F.col("h")["SN"].alias("contig"),
        F.col("h")["LN"].cast("long").alias("length"),
    )


def parse_readgroups(lines: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    names = {
        "ID": "rg",
        "SM": "sample",
        "LB": "library",
        "PU": "platform_unit",
        "PL": "platform",
        "DS": "description",
    }
    return _header(lines, "RG").select(
        *keep, *(F.try_element_at("h", F.lit(key)).alias(name) for key, name in names.items())
    )


def sort_order(lines: DataFrame) -> DataFrame:
    return _header(lines, "HD").select(F.try_element_at("h", F.lit("SO")).alias("sort_order"))


def _merged(header: DataFrame, key: str, what: str) -> DataFrame:
    """Header rows of several files, each key once; files must agree. Header rows are few."""
    values = [name for name in header.columns if name not in (key, "line")]
    rows = header.groupBy(key).agg(
        F.min("line").alias("line"),
        F.count_distinct(F.to_json(F.struct(*values))).alias("_n"),
        *(F.min(name).alias(name) for name in values),
    )
    fault = F.raise_error(F.lit(f"files disagree on a {what}")).cast("string")
    kept = F.when(F.col("_n") > 1, fault).otherwise(F.col(key).cast("string"))
    return rows.withColumn(key, kept).drop("_n")


def read_alignments(
    spark: SparkSession, path: str | list[str]
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(alignments, contigs, readgroups) of SAM text files or folders of them.

    Ids are unique over all files: the number of the file in order of names, then the line. The
    headers are merged: contigs in order of their first appearance, and read-groups. Files that
    disagree on the length of a contig or on a read-group are an error.
    """
    lines = read_lines(spark, path)
    numbered = lines.select("file", (F.col("number") * FILE_LINES + F.col("line")).alias("line"), "value")
    # The header needs no numbers of lines, only their order
    header = lines_of_splits(spark, path).where(F.col("value").startswith("@"))
    header = header.select(F.struct("number", "split", "row").alias("line"), "value")
    contigs = _merged(
        _header(header, "SQ").select(
            "line", F.col("h")["SN"].alias("contig"), F.col("h")["LN"].cast("long").alias("length")
        ),
        "contig",
        "contig",
    )
    tid = F.row_number().over(Window.orderBy("line")) - 1
    contigs = contigs.select(tid.alias("tid"), "contig", "length")
    readgroups = _merged(parse_readgroups(header, keep=["line"]), "rg", "read-group").drop("line")
    return parse_alignments(numbered), contigs, readgroups


def format_alignments(alignments: DataFrame) -> DataFrame:
    """Records as SAM lines."""

    def or_star(column: Column) -> Column:
        return F.coalesce(column, F.lit("*"))

    quality = F.array_join(F.transform("quals", lambda it: F.chr(it + 33)), "")
    tags = F.array_sort(
        F.transform(
            F.map_entries("tags"),
            lambda it: F.concat_ws(":", it["key"], it["value"]["type"], it["value"]["value"]),
        )
    )
    mate = F.when(F.col("mate_contig") == F.col("contig"), "=").otherwise(F.col("mate_contig"))
    return alignments.select(
        F.concat_ws(
            "\t",
            or_star(F.col("qname")),
            F.col("flag").cast("string"),
            or_star(F.col("contig")),
            (F.col("pos") + 1).cast("string"),
            F.col("mapq").cast("string"),
            format_cigar(F.col("cigar")),
            or_star(mate),
            (F.col("mate_pos") + 1).cast("string"),
            F.col("tlen").cast("string"),
            or_star(F.col("seq")),
            or_star(quality),
            tags,
        ).alias("value")
    )
