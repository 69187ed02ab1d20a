"""Queries that write the tables as files of some format, and read them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.catalog import panels
from helixframe.catalog import views as v
from helixframe.catalog.registry import query
from helixframe.functions.cigar import format_cigar
from helixframe.plans.session import scratch_folder
from helixframe.sources import fasta, reports, sam, tables


def _text_file(lines: DataFrame, compression: str) -> str:
    """Write lines as compressed text; readers go by the content of files, not by their names."""
    folder = scratch_folder(lines.sparkSession)
    lines.write.option("compression", compression).text(folder)
    return folder


@query(
    "read_alignments_files",
    v.with_views("reads")
    + """SELECT qname, flag, contig, pos, mapq, cigar_text AS cigar, mate_contig, mate_pos, tlen, seq, rg,
        (SELECT CAST(sum(length) AS BIGINT) FROM (SELECT DISTINCT contig, 10000 AS length FROM reads
         WHERE contig IS NOT NULL)) AS genome FROM reads""",
)
def read_alignments_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = v.alignments(spark, sf_dir)
    names = records.select("contig").where("contig IS NOT NULL").distinct()
    header = names.select(F.concat(F.lit("@SQ\tSN:"), "contig", F.lit("\tLN:10000")).alias("value"))
    # Two inputs: the header comes first in one of them, the other one has none
    path = [_text_file(header.coalesce(1), "none"), _text_file(sam.format_alignments(records), "gzip")]
    read, contigs, _ = sam.read_alignments(spark, path)
    genome = contigs.agg(F.sum("length")).scalar()
    return read.select(
        "qname",
        "flag",
        "contig",
        "pos",
        "mapq",
        format_cigar(F.col("cigar")).alias("cigar"),
        "mate_contig",
        "mate_pos",
        "tlen",
        "seq",
        "rg",
        genome.alias("genome"),
    )


@query(
    "read_tsv_files",
    """SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, CASE WHEN c_custkey % 5 > 0 THEN c_mktsegment END
        AS segment, CAST(c_nationkey AS VARCHAR) AS nation FROM customer""",
)
def read_tsv_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = v.table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS id",
        "c_name AS name",
        "CASE WHEN c_custkey % 5 > 0 THEN c_mktsegment END AS segment",
        "c_nationkey AS nation",
    )
    folder = scratch_folder(spark)
    options = {"sep": "\t", "header": "true", "quote": "", "nullValue": "", "compression": "bzip2"}
    rows.write.options(**options).csv(folder)
    return tables.read_tsv(spark, folder)


@query(
    "read_trees_files",
    v.with_views(extra=panels.tree_views())
    + """SELECT concat('((', a, ',', b, '),(', c, ',', d, '):0.5,', e, ':1);') AS newick, count(*) AS n
        FROM labelled GROUP BY ALL""",
)
def read_trees_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _text_file(panels.trees(spark, sf_dir).select("newick"), "gzip")
    found = tables.read_trees(spark, folder)
    # Ids are unique over all files
    return found.groupBy("newick").agg(F.count_distinct("tree_id").alias("n"))


@query(
    "read_fastq_files",
    v.with_views("reads")
    + """SELECT qname AS name, seq AS sequence, count(*) AS n FROM reads WHERE quals IS NOT NULL GROUP BY ALL""",
)
def read_fastq_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    reads = v.alignments(spark, sf_dir).where("quals IS NOT NULL")
    quality = F.array_join(F.transform("quals", lambda it: F.chr(it + 33)), "")
    record = F.concat_ws("\n", F.concat(F.lit("@"), "qname"), "seq", F.lit("+"), quality)
    found = fasta.read_fastq(spark, _text_file(reads.select(record.alias("value")), "gzip"))
    return found.groupBy("name", "sequence").agg(F.count("*").alias("n"))


@query(
    "write_split_files",
    """SELECT l_returnflag AS outcome, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS keys
        FROM lineitem GROUP BY l_returnflag""",
)
def write_split_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark)
    rows = v.table(spark, sf_dir, "lineitem").withColumnRenamed("l_returnflag", "outcome")
    reports.write_split(rows, folder)
    parts = spark.read.parquet(folder).groupBy("outcome")
    return parts.agg(F.count("*").alias("n"), F.sum("l_orderkey").alias("keys"))
