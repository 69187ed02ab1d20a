"""FASTA and FASTQ records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helixframe.functions.flags import UNMAPPED
from helixframe.functions.sequences import uncalled_bases
from helixframe.plans.intervals import running_before
from helixframe.plans.session import cut_lineage
from helixframe.plans.skew import fits_broadcast
from helixframe.sources.lines import numbered_lines

#: Lines of a record that are joined into one row.
CHUNK_LINES = 1 << 14
#: Bits of a read's id below the number of its file.
FILE_SHIFT = 40
#: Files, one narrow row each, that are broadcast if their bytes allow it; combined lines are shuffled then.
BROADCAST_FILES = 2_000_000
#: FASTQ records of a file that go to a task together where files are too many for that.
BLOCK_RECORDS = 1 << 14


def _fail(message: str) -> Column:
    return F.raise_error(F.lit(message)).cast("string")


def parse_fasta(
    lines: DataFrame, chunk_lines: int = CHUNK_LINES, width: int = 1 << 16
) -> DataFrame:
    """Records from lines: ``(file, record, name, meta, chunk, sequence)``.

    ``record`` is the number of the header line. Sequences of more than ``chunk_lines`` lines
    have several rows, so that a chromosome is neither one row nor one task.
    """
    is_header = F.col("value").startswith(">")
    text = lines.withColumn("_header", F.when(is_header, F.struct("line", "value")))
    # The header of a line comes from a scan and not from a join, in which long records would
    # be hot keys; the aggregation combines it on the map side
    placed = running_before(text, ["file"], "line", "_header", width, inclusive=True)
    record = F.col("_running.line")
    checked = F.when(record.isNull(), _fail("sequence without header").cast("long")).otherwise(record)
    body = F.when(~is_header, F.struct("line", F.trim("value").alias("value")))
    parts = F.array_sort(F.collect_list(body))
    title = r"^>\s*(\S*)\s*(.*)$"
    records = (
        placed.where(F.trim("value") != "")
        .withColumn("record", checked)
        .groupBy(
            "file",
            "record",
            F.floor(F.greatest(F.col("line") - record - 1, F.lit(0)) / chunk_lines)
            .cast("int")
            .alias("chunk"),
        )
        .agg(
            F.first("_running.value").alias("_title"),
            F.array_join(F.transform(parts, lambda it: it["value"]), "").alias("_sequence"),
        )
    )
    name = F.regexp_extract("_title", title, 1)
    return records.select(
        "file",
        "record",
        F.when(name == "", _fail("unnamed sequence")).otherwise(name).alias("name"),
        F.regexp_extract("_title", title, 2).alias("meta"),
        "chunk",
        F.when(F.col("_sequence") == "", _fail("empty sequence"))
        .otherwise(F.col("_sequence"))
        .alias("sequence"),
    )


def read_fasta(spark: SparkSession, path: str, chunk_lines: int = CHUNK_LINES) -> DataFrame:
    return parse_fasta(numbered_lines(spark, path), chunk_lines)


def whole_sequences(records: DataFrame) -> DataFrame:
    """One row per record, for sequences that fit into a row: ``(name, meta, sequence)``."""
    parts = F.array_sort(F.collect_list(F.struct("chunk", "sequence")))
    return (
        records.groupBy("file", "record")
        .agg(
            F.first("name").alias("name"),
            F.first("meta").alias("meta"),
            F.array_join(F.transform(parts, lambda it: it["sequence"]), "").alias("sequence"),
        )
        .select("name", "meta", "sequence")
    )


def contig_sizes(records: DataFrame) -> DataFrame:
    return records.groupBy("name").agg(F.sum(F.length("sequence")).alias("size"))


def uncalled_counts(records: DataFrame) -> DataFrame:
    """Size and number of uncalled bases per sequence."""
    return records.groupBy("name").agg(
        F.sum(F.length("sequence")).alias("size"),
        F.sum(uncalled_bases(F.col("sequence"))).alias("ns"),
    )


def fasta_record(width: int = 60) -> Column:
    """A record as text, wrapped at ``width``."""
    title = F.when(
        F.coalesce("meta", F.lit("")) != "", F.concat_ws(" ", "name", "meta")
    ).otherwise(F.col("name"))
    wrapped = F.array_join(
        F.regexp_extract_all("sequence", F.lit(f".{{1,{width}}}"), F.lit(0)), "\n"
    )
    return F.concat(F.lit(">"), title, F.lit("\n"), wrapped)


def format_fasta(sequences: DataFrame, width: int = 60) -> DataFrame:
    """Records as text, one header per record.

    A record in several rows (``chunk``) is written as one, in the order of its chunks: each row
    leaves the letters that complete the line before to its predecessor, if there is one.
    """
    if "chunk" not in sequences.columns:
        return sequences.select(fasta_record(width).alias("value"))
    keys = ["file", "record"]
    window = Window.partitionBy(*keys).orderBy("chunk")
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    # Lengths and a line of each chunk, not the sequences
    ends = sequences.select(
        *keys, "chunk", F.length("sequence").alias("_n"), F.substring("sequence", 1, width).alias("_line")
    )
    ends = ends.withColumn(
        "_skip", F.pmod(-F.coalesce(F.sum("_n").over(before), F.lit(0)), F.lit(width)).cast("int")
    )
    following = F.lead(F.expr("substring(_line, 1, _skip)"), 1, "").over(window)
    ends = ends.select(*keys, "chunk", "_skip", following.alias("_rest"))
    title = F.when(
        F.coalesce("meta", F.lit("")) != "", F.concat_ws(" ", "name", "meta")
    ).otherwise(F.col("name"))
    body = F.expr("concat(substring(sequence, _skip + 1), _rest)")
    wrapped = F.array_join(F.regexp_extract_all(body, F.lit(f".{{1,{width}}}"), F.lit(0)), "\n")
    header = F.when(F.col("chunk") == 0, F.concat(F.lit(">"), title, F.lit("\n"))).otherwise("")
    joined = sequences.join(ends, [*keys, "chunk"]).orderBy(*keys, "chunk")
    return joined.select(F.concat(header, wrapped).alias("value")).where("value <> ''")


def _with_files(rows: DataFrame, files: DataFrame, record: Column, how: str, max_rows: int) -> DataFrame:
    """Join what is known of each file; ``files`` is read more than once.

    Where there are too many files to broadcast, rows meet it by file and block of records, so that a
    long file is not one task; ``_block`` is added then, and rows of a record stay together.
    """
    if fits_broadcast(files, max_rows):
        return rows.join(F.broadcast(files), ["file"], how)
    block = F.coalesce(F.floor(record / BLOCK_RECORDS), F.lit(-1))
    dealt = rows.withColumn("_block", block)
    blocks = dealt.select("file", "_block").distinct().join(files, ["file"])
    # Hashed, as the rows need no order
    return dealt.join(blocks.hint("shuffle_hash"), ["file", "_block"], how)


def parse_fastq(lines: DataFrame, max_rows: int = BROADCAST_FILES) -> DataFrame:
    """Records of four lines: ``(file, record, name, meta, sequence, qualities)``.

    An empty line in place of a header ends the file. Incomplete and malformed records fail. Lines are
    shuffled once, also where more than ``max_rows`` files end so.
    """
    position, record = F.col("line") % 4, F.floor(F.col("line") / 4)
    stop = cut_lineage(
        lines.where((position == 0) & (F.trim("value") == ""))
        .groupBy("file")
        .agg(F.min("line").alias("_stop"))
    )
    kept = _with_files(lines, stop, record, "left", max_rows).where(
        F.col("_stop").isNull() | (F.col("line") < F.col("_stop"))
    )
    # By these the rows are dealt already
    dealt = [name for name in ("file", "_block") if name in kept.columns]

    def part(index: int) -> Column:
        return F.max(F.when(position == index, F.rtrim("value")))

    records = kept.groupBy(*dealt, record.alias("record")).agg(
        part(0).alias("_header"),
        part(1).alias("sequence"),
        part(2).alias("_separator"),
        part(3).alias("qualities"),
    )
    problem = (
        F.when(~F.col("_header").startswith("@"), "invalid FASTQ header")
        .when(F.col("qualities").isNull(), "partial FASTQ record")
        .when(~F.col("_separator").startswith("+"), "missing FASTQ separator")
        .when(F.length("sequence") != F.length("qualities"), "sequence and qualities differ in length")
    )
    return records.select(
        "file",
        "record",
        F.when(problem.isNotNull(), F.raise_error(problem).cast("string"))
        .otherwise(F.regexp_extract("_header", r"^@(\S*)\s*(.*)$", 1))
        .alias("name"),
        F.regexp_extract("_header", r"^@(\S*)\s*(.*)$", 2).alias("meta"),
        "sequence",
        "qualities",
    )


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    return parse_fastq(numbered_lines(spark, path))


def format_fastq(records: DataFrame) -> DataFrame:
    title = F.when(
        F.coalesce("meta", F.lit("")) != "", F.concat_ws(" ", "name", "meta")
    ).otherwise(F.col("name"))
    return records.select(
        F.concat_ws(
            "\n", F.concat(F.lit("@"), title), F.col("sequence"), F.lit("+"), F.col("qualities")
        ).alias("value")
    )


def _file_numbers(records: DataFrame) -> DataFrame:
    """(file, _file): the number of each file in the order of their names, counted range by range."""
    ordered = records.select("file").distinct().orderBy("file")
    ranges = cut_lineage(ordered.withColumn("_range", F.spark_partition_id()))
    sizes = ranges.groupBy("_range").agg(F.count("*").alias("_n"))
    # One row per range
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy("file")) - 1
    number = (F.col("_start") + inside).cast("long").alias("_file")
    return ranges.join(F.broadcast(starts), "_range").select("file", number)


def unmapped_records(
    records: DataFrame, rg: str, offset: int = 33, max_rows: int = BROADCAST_FILES
) -> DataFrame:
    """FASTQ records as alignments without a position, in the given read-group.

    ``read_id`` is the number of the file, in the order of their names, and that of the record.
    """
    files = cut_lineage(_file_numbers(records))
    codes = F.transform(
        F.filter(F.split("qualities", ""), lambda it: it != ""), lambda it: F.ascii(it) - offset
    )
    nothing, no_pos = F.lit(None), F.lit(-1).cast("long")
    tag = F.struct(F.lit("Z").alias("type"), F.lit(rg).alias("value"))
    return _with_files(records, files, F.col("record"), "inner", max_rows).select(
        (F.shiftleft("_file", FILE_SHIFT) + F.col("record")).alias("read_id"),
        F.col("name").alias("qname"),
        F.lit(UNMAPPED).alias("flag"),
        nothing.cast("string").alias("contig"),
        no_pos.alias("pos"),
        F.lit(0).alias("mapq"),
        nothing.cast("array<struct<op:int,len:int>>").alias("cigar"),
        nothing.cast("string").alias("mate_contig"),
        no_pos.alias("mate_pos"),
        F.lit(0).alias("tlen"),
        F.col("sequence").alias("seq"),
        codes.alias("quals"),
        F.create_map(F.lit("RG"), tag).alias("tags"),
        F.lit(rg).alias("rg"),
    )
