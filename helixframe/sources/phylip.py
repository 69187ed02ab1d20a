"""Interleaved PHYLIP text of alignments of sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.plans.skew import skew_join

# The layout of the text
MAX_NAME = 30
BLOCK = 10
SPACING = 2
BLOCKS_PER_LINE = 6

_STEP = BLOCK + SPACING
_LINE = BLOCKS_PER_LINE * _STEP - SPACING


def _blocks(bases: Column) -> Column:
    """Bases in blocks, with spaces between them."""
    return F.rtrim(F.regexp_replace(bases, f"(.{{{BLOCK}}})", "$1" + " " * SPACING))


def phylip_lines(sequences: DataFrame) -> DataFrame:
    """Lines ``(msa, section, name, value)``, in the order of the text.

    A text starts with the number of sequences and their length (section -1). Each section begins
    with an empty line and has one line per sequence, by name. Names are cut to 30 characters, and
    stand in front of the first section's lines only, which are shorter by so many blocks.
    Alignments of sequences of several lengths, or with repeated names, are errors.
    """
    length = F.length("sequence")
    shape = sequences.groupBy("msa").agg(
        F.count("*").alias("_count"),
        F.count_distinct("name").alias("_names"),
        F.min(length).alias("_shortest"),
        F.max(length).alias("_bases"),
        F.max(F.least(F.length("name"), F.lit(MAX_NAME))).alias("_name"),
    )
    problem = F.when(F.col("_shortest") < F.col("_bases"), "sequences differ in length").when(
        F.col("_names") < F.col("_count"), "names are not unique"
    )
    margin = F.ceil((F.col("_name") + 2) / _STEP) * _STEP - SPACING
    shape = shape.select(
        "msa",
        F.when(problem.isNotNull(), F.raise_error(problem).cast("long"))
        .otherwise(F.col("_count"))
        .alias("_count"),
        "_bases",
        margin.cast("int").alias("_margin"),
        (F.floor((_LINE - margin) / _STEP) * BLOCK).cast("int").alias("_first"),
    )
    per_line = BLOCKS_PER_LINE * BLOCK
    more = F.ceil(F.greatest(F.col("_bases") - F.col("_first"), F.lit(0)) / per_line).cast("int")
    shape = shape.withColumn("_more", more)

    rows = skew_join(sequences.select("msa", "name", "sequence"), shape, ["msa"])
    name = F.rpad(F.substring("name", 1, MAX_NAME), F.col("_margin"), F.lit(" "))
    start = _blocks(F.substring("sequence", F.lit(1), F.col("_first")))
    opening = F.concat(name, F.when(start == "", "").otherwise(F.concat(F.lit(" " * SPACING), start)))
    following = F.transform(
        F.sequence(F.lit(1), F.col("_more")),
        lambda k: _blocks(
            F.substring("sequence", F.col("_first") + (k - 1) * per_line + 1, F.lit(per_line))
        ),
    )
    texts = F.when(F.col("_more") > 0, F.concat(F.array(opening), following)).otherwise(F.array(opening))
    no_name = F.lit(None).cast("string").alias("name")
    header = shape.select(
        "msa", F.lit(-1).alias("section"), no_name, F.concat_ws(" ", "_count", "_bases").alias("value")
    )
    gaps = shape.select(
        "msa",
        F.explode(F.sequence(F.lit(0), F.col("_more"))).alias("section"),
        no_name,
        F.lit("").alias("value"),
    )
    lines = rows.select("msa", "name", F.posexplode(texts).alias("section", "value"))
    return header.unionByName(gaps).unionByName(lines).orderBy("msa", "section", "name")
