"""Queries on sequences, alignments of sequences, intervals and text formats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.catalog import views as v
from helixframe.catalog.registry import query
from helixframe.functions import sequences as sq
from helixframe.functions.cigar import format_cigar
from helixframe.operators import intervals as iv
from helixframe.operators import msa as m
from helixframe.operators import validate as va
from helixframe.operators.alignments import tag_value
from helixframe.plans import intervals as plan
from helixframe.sources import bed, fasta, phylip, sam

# Intervals ----------------------------------------------------------------------------------

_MERGED = {
    "marked": """SELECT contig, "start", "end", CASE WHEN "start" > max("end") OVER (
            PARTITION BY contig ORDER BY "start", "end"
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS opens FROM spans""",
    "numbered": """SELECT *, sum(opens) OVER (PARTITION BY contig ORDER BY "start", "end"
            ROWS UNBOUNDED PRECEDING) AS island FROM marked""",
}
# Wide apart, so that there is something between the islands
_SPARSE = """SELECT * REPLACE ("start" * 40 AS "start", "start" * 39 + "end" AS "end") FROM regions"""


def _sparse(spark: SparkSession, sf_dir: str, named: bool = True) -> DataFrame:
    rows = v.regions(spark, sf_dir, named)
    moved = {"start": F.col("start") * 40, "end": F.col("start") * 39 + F.col("end")}
    return rows.withColumns(moved)


@query(
    "merge_regions",
    v.with_views("regions", extra={"spans": _SPARSE} | _MERGED)
    + """SELECT contig, min("start") AS "start", max("end") AS "end" FROM numbered
        GROUP BY contig, island""",
)
def merge_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iv.merge_regions(_sparse(spark, sf_dir))


@query(
    "scatter_regions",
    v.with_views(
        "regions",
        "contigs",
        extra={"spans": _SPARSE}
        | _MERGED
        | {
            "islands": """SELECT contig, min("start") AS "start", max("end") AS "end" FROM numbered
                GROUP BY contig, island""",
            "laid": """SELECT islands.*, "end" - "start" AS n, sum("end" - "start") OVER () AS total,
                sum("end" - "start") OVER (ORDER BY tid, "start" ROWS UNBOUNDED PRECEDING)
                - ("end" - "start") AS laid_at FROM islands JOIN contigs USING (contig)""",
            "parts": """SELECT k, k * total // 37 AS low, (k + 1) * total // 37 AS high
                FROM range(37) AS t(k), (SELECT max(total) AS total FROM laid)""",
        },
    )
    + """SELECT k AS part, contig, CAST("start" + greatest(low - laid_at, 0) AS BIGINT) AS "start",
        CAST("start" + least(high - laid_at, n) AS BIGINT) AS "end"
        FROM laid JOIN parts ON low < laid_at + n AND high > laid_at""",
)
def scatter_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iv.scatter_regions(_sparse(spark, sf_dir), 37, v.contigs(spark, sf_dir), 4096)


@query(
    "pad_regions",
    v.with_views("regions", "contigs")
    + """SELECT contig, greatest(0, "start" - 300) AS "start", least("end" + 300, length) AS "end"
        FROM regions JOIN contigs USING (contig)
        UNION ALL SELECT contig, "start" + 35, "end" - 35 FROM regions WHERE "end" - "start" > 70""",
)
def pad_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions, contigs = v.regions(spark, sf_dir), v.contigs(spark, sf_dir)
    grown = iv.pad_regions(regions, 300, contigs)
    return grown.unionByName(iv.pad_regions(regions, -35))


@query(
    "sort_regions",
    v.with_views("regions", "contigs")
    + """SELECT CASE WHEN contig <> 'chr2' THEN 4 - tid END AS tid, contig, "start", "end"
        FROM regions JOIN contigs USING (contig)""",
)
def sort_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = (
        v.contigs(spark, sf_dir)
        .where("contig <> 'chr2'")
        .withColumn("tid", 4 - F.col("tid"))
    )
    return iv.sort_regions(v.regions(spark, sf_dir), order).select("tid", "contig", "start", "end")


@query(
    "name_regions",
    v.with_views("regions") + 'SELECT region_id, name FROM regions',
)
def name_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iv.name_regions(v.regions(spark, sf_dir, named=False)).select("region_id", "name")


@query(
    "bed_order",
    v.with_views("regions")
    + """SELECT contig, "start", "end", name, CAST(region_id % 50 AS INT) AS score,
        CASE WHEN region_id % 2 = 0 THEN '+' ELSE '-' END AS strand FROM regions
        ORDER BY contig, "start", "end", name, score, strand""",
)
def bed_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("region_id")
    rows = v.regions(spark, sf_dir).select(
        "contig",
        "start",
        "end",
        "name",
        (key % 50).cast("int").alias("score"),
        F.when(key % 2 == 0, "+").otherwise("-").alias("strand"),
    )
    return iv.bed_order(rows)


@query(
    "split_before",
    """SELECT conv_id, turn, max(turn) FILTER (role = 'user') OVER (PARTITION BY conv_id ORDER BY turn
        ROWS UNBOUNDED PRECEDING) AS "group" FROM conversations""",
)
def split_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = v.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    grouped = plan.split_before(turns, ["conv_id"], "turn", F.col("role") == "user", width=2)
    return grouped.select("conv_id", "turn", "group")


@query(
    "chunk_rows",
    """SELECT doc_id, CAST(k AS INT) AS chunk, rpad(substr(text, k * 1000 + 1, 1000), 1000, '*') AS piece
        FROM (SELECT doc_id, text, unnest(range(0, (len(text) + 999) // 1000)) AS k FROM documents)""",
)
def chunk_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select(
        "doc_id", F.posexplode(sq.fragments(F.col("text"), 1000, "*")).alias("chunk", "piece")
    )


_BED_LINES = """SELECT region_id, CASE region_id % 9
        WHEN 0 THEN '# comment' WHEN 1 THEN ''
        WHEN 2 THEN concat_ws('\t', contig, "end", "start")
        WHEN 3 THEN concat_ws('\t', contig, "start")
        WHEN 4 THEN concat_ws('\t', contig, "start", 'x')
        WHEN 5 THEN concat_ws('\t', contig, "start", "end", name, region_id, '+', 'more')
        WHEN 6 THEN concat_ws('\t', contig, "start", "end", name, 'z')
        WHEN 7 THEN concat_ws('\t', contig, "start", "end", name, 7, '?')
        ELSE concat_ws('\t', contig, "start", "end" + 1000) END AS value FROM regions"""


def _bed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    v.regions(spark, sf_dir).createOrReplaceTempView("bed_regions")
    return spark.sql(_BED_LINES.replace('"', "`").replace("FROM regions", "FROM bed_regions"))


@query(
    "read_bed",
    v.with_views("regions")
    + """SELECT region_id, contig, CASE WHEN region_id % 9 = 2 THEN "end" ELSE "start" END AS "start",
        CASE region_id % 9 WHEN 2 THEN "start" WHEN 3 THEN NULL WHEN 4 THEN NULL WHEN 8 THEN "end" + 1000
            ELSE "end" END AS "end",
        CASE WHEN region_id % 9 BETWEEN 5 AND 7 THEN name END AS name,
        CASE region_id % 9 WHEN 5 THEN CAST(region_id AS INT) WHEN 7 THEN 7 END AS score,
        CASE region_id % 9 WHEN 5 THEN '+' WHEN 7 THEN '?' END AS strand,
        CASE region_id % 9 WHEN 2 THEN 'end must be greater than start'
            WHEN 3 THEN 'not enough columns' WHEN 4 THEN 'coordinates must be integers'
            WHEN 6 THEN 'score must be an integer' WHEN 7 THEN 'invalid strand'
            WHEN 8 THEN CASE WHEN "end" + 1000 > 10000 THEN 'interval exceeds the contig' END END AS error
        FROM regions WHERE region_id % 9 > 1""",
)
def read_bed(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = bed.parse_bed(_bed_lines(spark, sf_dir))
    return bed.check_contigs(parsed, v.contigs(spark, sf_dir)).drop("value")


@query(
    "write_bed",
    v.with_views("regions")
    + """SELECT region_id, CASE region_id % 4
        WHEN 0 THEN concat_ws('\t', contig, "start", "end")
        WHEN 1 THEN concat_ws('\t', contig, "start", "end", name)
        WHEN 2 THEN concat_ws('\t', contig, "start", "end", '', 5)
        ELSE concat_ws('\t', contig, "start", "end", '', 0, '-') END AS value FROM regions""",
)
def write_bed(spark: SparkSession, sf_dir: str) -> DataFrame:
    form = F.col("region_id") % 4
    regions = v.regions(spark, sf_dir).select(
        "region_id",
        "contig",
        "start",
        "end",
        F.when(form == 1, F.col("name")).alias("name"),
        F.when(form == 2, 5).alias("score"),
        F.when(form == 3, "-").alias("strand"),
    )
    return regions.select("region_id", bed.bed_line().alias("value"))


@query(
    "interval_list_to_bed",
    v.with_views("regions")
    + """SELECT concat_ws('\t', contig, "start" - 1, "end") AS value FROM regions WHERE region_id % 9 <> 0""",
)
def interval_list_to_bed(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = v.regions(spark, sf_dir).select(
        F.when(F.col("region_id") % 9 == 0, F.lit("@SQ\tSN:chr1\tLN:1"))
        .otherwise(
            F.concat_ws(
                "\t", "contig", F.col("start").cast("string"), F.col("end").cast("string"), F.lit("+")
            )
        )
        .alias("value")
    )
    return bed.interval_list_to_bed(lines, one_based=True)


# Scalar functions on whole texts -------------------------------------------------------------

# Fixed values for the SQL: codes with a complement, and the complements
_KNOWN = "ABCDGHKMNRSTVWXYabcdghkmnrstvwxy"
_OPPOSITE = "TVGHCDMKNYSABWXRtvghcdmknysabwxr"
_COMPLEMENT = f"translate(regexp_replace(text, '[^{_KNOWN}]', 'N', 'g'), '{_KNOWN}', '{_OPPOSITE}')"


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.table(spark, sf_dir, "documents").select("doc_id", "text")


@query("complement", f"SELECT doc_id, {_COMPLEMENT} AS complement FROM documents")
def complement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", sq.complement(F.col("text")).alias("complement"))


@query(
    "reverse_complement",
    "SELECT doc_id, array_to_string(list_reverse(string_split(c, '')), '') AS reverse_complement "
    f"FROM (SELECT doc_id, {_COMPLEMENT} AS c FROM documents)",
)
def reverse_complement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select(
        "doc_id", sq.reverse_complement(F.col("text")).alias("reverse_complement")
    )


@query(
    "complexity",
    """SELECT doc_id, CAST(1 + len([i FOR i IN range(2, len(chars) + 1) IF chars[i] <> chars[i - 1]]) AS INT)
        AS complexity FROM (SELECT doc_id, string_split(text, '') AS chars FROM documents)""",
)
def complexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", sq.complexity(F.col("text")).alias("complexity"))


@query(
    "mask_fasta",
    "SELECT doc_id, regexp_replace(text, '[bdefh-mo-su-zBDEFH-MO-SU-Z]', 'N', 'g') AS masked FROM documents",
)
def mask_fasta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", sq.mask_letters(F.col("text")).alias("masked"))


@query(
    "split_positions",
    """SELECT doc_id, array_to_string([chars[i] FOR i IN range(1, len(chars) + 1) IF i % 3 <> 0], '') AS pos_1,
        array_to_string([chars[i] FOR i IN range(1, len(chars) + 1) IF i % 3 = 0], '') AS pos_2
        FROM (SELECT doc_id, string_split(text, '') AS chars FROM documents)""",
)
def split_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = sq.split_positions(F.col("text"), "112")
    return _documents(spark, sf_dir).select(
        "doc_id", parts["1"].alias("pos_1"), parts["2"].alias("pos_2")
    )


_PAIR_CODES = {"AC": "M", "AG": "R", "AT": "W", "CG": "S", "CT": "Y", "GT": "K"}


@query(
    "encode_genotype",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, code, CASE code """
    + v.sql_cases(v.CODE_LETTERS, "WHEN '{0}' THEN '{1}'")
    + """ END AS decoded FROM (SELECT *, CASE WHEN a = b THEN a """
    + " ".join(
        f"WHEN least(a, b) = '{bases[0]}' AND greatest(a, b) = '{bases[1]}' THEN '{code}'"
        for bases, code in _PAIR_CODES.items()
    )
    + """ END AS code FROM (SELECT *, substr('ACGT', CAST(l_partkey % 4 + 1 AS INT), 1) AS a,
        substr('ACGT', CAST(l_suppkey % 4 + 1 AS INT), 1) AS b FROM lineitem))""",
)
def encode_genotype(spark: SparkSession, sf_dir: str) -> DataFrame:
    bases = [
        F.substring(F.lit("ACGT"), (F.col(name) % 4 + 1).cast("int"), F.lit(1))
        for name in ("l_partkey", "l_suppkey")
    ]
    rows = v.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        sq.encode_genotype(F.concat(bases[0], F.lit(","), bases[1])).alias("code"),
    )
    return rows.withColumn("decoded", sq.decode_genotype(F.col("code")))


_CONTIG_FORMS = """concat(CASE l_partkey % 4 WHEN 0 THEN 'chr' WHEN 1 THEN 'Chr' WHEN 2 THEN '' ELSE 'scaffold' END,
        CASE l_suppkey % 5 WHEN 0 THEN 'X' WHEN 1 THEN 'y' WHEN 2 THEN 'XY' ELSE CAST(l_suppkey AS STRING) END)"""


@query(
    "plink_contig_name",
    f"""SELECT contig, plink, coalesce(regexp_matches(plink, '^[0-9]+$'), false) AS autosome, n FROM (
        SELECT contig, nullif(upper(regexp_extract(contig, '^(?:[cC]hr)?([0-9]+|[XxYy])$', 1)), '') AS plink,
        count(*) AS n FROM (SELECT {_CONTIG_FORMS} AS contig FROM lineitem) GROUP BY contig)""",
)
def plink_contig_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    contig = F.col("contig")
    return (
        v.table(spark, sf_dir, "lineitem")
        .select(F.expr(_CONTIG_FORMS).alias("contig"))
        .groupBy("contig")
        .agg(F.count("*").alias("n"))
        .select(
            "contig",
            sq.autosome_or_sex_name(contig).alias("plink"),
            sq.is_autosome(contig).alias("autosome"),
            "n",
        )
    )


# Alignments of sequences ----------------------------------------------------------------------

_CELLS = {
    "cells": """SELECT msa, name, meta, unnest(range(1, len(sequence) + 1)) AS i,
        unnest(string_split(sequence, '')) AS base FROM sequences""",
}


@query(
    "msa_reduce",
    v.with_views(
        "sequences",
        extra=_CELLS
        | {
            "kept": """SELECT msa, i FROM cells GROUP BY msa, i
                HAVING bool_or(base NOT IN ('N', 'n', '-'))"""
        },
    )
    + """SELECT msa, name, meta, string_agg(base, '' ORDER BY i) AS sequence
        FROM cells JOIN kept USING (msa, i) GROUP BY msa, name, meta""",
)
def msa_reduce(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.msa_reduce(v.documents_as_sequences(spark, sf_dir))


_DECODE = "CASE base " + v.sql_cases(v.CODE_SETS, leave_out="N") + " ELSE 0 END"
_ENCODE = (
    "CASE both WHEN 0 THEN 'N' "
    + v.sql_cases(v.CODE_SETS, "WHEN {1} THEN '{0}'", leave_out="N")
    + " END"
)


@query(
    "msa_filter_singletons",
    v.with_views(
        "sequences",
        extra=_CELLS
        | {
            "allowed": f"""SELECT msa, i, bit_or({_DECODE}) AS mask FROM cells
                WHERE CAST(name AS BIGINT) % 3 <> 0 GROUP BY msa, i""",
            "filtered": f"""SELECT c.*, base, CASE WHEN mask IS NULL OR base IN ('N', '-') THEN base
                ELSE CASE WHEN {_ENCODE.replace("both", f"(({_DECODE}) & mask)")} = base THEN base
                ELSE lower({_ENCODE.replace("both", f"(({_DECODE}) & mask)")}) END END AS out
                FROM cells c LEFT JOIN allowed a ON c.msa = a.msa AND c.i = a.i""",
        },
    )
    + """SELECT msa, name, meta, string_agg(CASE WHEN CAST(name AS BIGINT) % 3 = 0 THEN out ELSE base END,
        '' ORDER BY i) AS sequence FROM filtered GROUP BY msa, name, meta""",
)
def msa_filter_singletons(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = F.col("name").cast("long") % 3 == 0
    return m.msa_filter_singletons(v.documents_as_sequences(spark, sf_dir), target, ~target)


@query(
    "msa_split",
    v.with_views("sequences", extra=_CELLS)
    + """SELECT msa, name, CAST((i - 1) % 3 + 1 AS VARCHAR) AS key,
        string_agg(base, '' ORDER BY i) AS sequence FROM cells GROUP BY msa, name, (i - 1) % 3""",
)
def msa_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = m.msa_split(v.documents_as_sequences(spark, sf_dir))
    return parts.where(F.col("sequence") != "")


@query(
    "msa_join",
    v.with_views("sequences")
    + """SELECT name, concat(sequence, sequence, sequence) AS sequence FROM sequences""",
)
def msa_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    sequences = v.documents_as_sequences(spark, sf_dir)
    return m.msa_join([sequences, sequences, sequences])


@query(
    "msa_select",
    v.with_views("sequences")
    + """SELECT name, 'selected' AS part, sequence FROM sequences
        WHERE CAST(name AS BIGINT) IN (SELECT doc_id FROM labels WHERE toxic = 1)
        UNION ALL SELECT name, 'excluded', sequence FROM sequences
        WHERE CAST(name AS BIGINT) NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)""",
)
def msa_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    sequences = v.documents_as_sequences(spark, sf_dir)
    names = (
        v.table(spark, sf_dir, "labels")
        .where("toxic = 1")
        .select(F.col("doc_id").cast("string").alias("name"))
    )
    selected = m.msa_select(sequences, names).withColumn("part", F.lit("selected"))
    excluded = m.msa_exclude(sequences, names).withColumn("part", F.lit("excluded"))
    return selected.unionByName(excluded).select("name", "part", "sequence")


@query(
    "msa_exclude_flagged",
    """SELECT CAST(doc_id AS VARCHAR) AS name FROM documents WHERE doc_id % 4 NOT IN (1, 2)""",
)
def msa_exclude_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("doc_id") % 4
    meta = (
        F.when(key == 1, F.concat("source", F.lit(";EXCLUDE;"), "lang"))
        .when(key == 2, F.lit("exclude"))
        .when(key == 3, F.concat(F.lit("NOT_EXCLUDED;"), "lang"))
    )
    rows = v.table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("name"), meta.alias("meta")
    )
    return m.msa_exclude_flagged(rows).select("name")


@query(
    "msa_truncate",
    v.with_views("sequences") + "SELECT msa, name, substr(sequence, 1, 100) AS sequence FROM sequences",
)
def msa_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.msa_truncate(v.documents_as_sequences(spark, sf_dir), 100).select(
        "msa", "name", "sequence"
    )


@query(
    "msa_shape",
    v.with_views("sequences")
    + """SELECT msa, count(*) AS n_sequences, count(DISTINCT name) AS n_names,
        CAST(msa AS INT) AS min_length, CAST(msa AS INT) AS max_length FROM sequences GROUP BY msa""",
)
def msa_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.msa_shape(v.documents_as_sequences(spark, sf_dir))


@query(
    "unique_names",
    """SELECT lang, source AS name, count(*) AS n FROM documents GROUP BY ALL HAVING count(*) > 1""",
)
def unique_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = v.table(spark, sf_dir, "documents").select("lang", F.col("source").alias("name"))
    return m.unique_names(rows, ["lang"])


@query(
    "align_to_reference",
    v.with_views(
        "sequences",
        extra=_CELLS
        | {
            "solid": """SELECT name, i, row_number() OVER (PARTITION BY name ORDER BY i) AS k,
                count(*) OVER (PARTITION BY name) AS n, base FROM cells WHERE base <> '-'""",
            "spread": """SELECT c.name, c.i, coalesce(r.base, '-') AS base FROM cells c
                LEFT JOIN solid s ON c.name = s.name AND c.i = s.i
                LEFT JOIN solid r ON s.name = r.name AND r.k = s.n + 1 - s.k
                WHERE c.i <= (SELECT max(i) FROM solid x WHERE x.name = c.name)""",
        },
    )
    + "SELECT name, string_agg(base, '' ORDER BY i) AS aligned FROM spread GROUP BY name",
)
def align_to_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    majority = F.reverse(F.translate("sequence", "-", ""))
    aligned = m.align_to_reference(F.col("sequence"), majority).alias("aligned")
    return (
        v.documents_as_sequences(spark, sf_dir).select("name", aligned).where(F.col("aligned") != "")
    )


# Text formats --------------------------------------------------------------------------------


@query(
    "uncalled_bases",
    v.with_views("sequences")
    + """SELECT meta AS name, CAST(sum(len(sequence)) AS BIGINT) AS size,
        CAST(sum(len(regexp_replace(sequence, '[^nN-]', '', 'g'))) AS BIGINT) AS ns
        FROM sequences GROUP BY meta""",
)
def uncalled_bases(spark: SparkSession, sf_dir: str) -> DataFrame:
    sequences = v.documents_as_sequences(spark, sf_dir)
    return fasta.uncalled_counts(sequences.select(F.col("meta").alias("name"), "sequence"))


def _fasta_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of one FASTA file per source: every document is a record."""
    sequences = v.table(spark, sf_dir, "documents").select(
        "source",
        "doc_id",
        F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("name"),
        F.when(F.col("doc_id") % 2 == 0, F.col("lang")).alias("meta"),
        v.dna(F.col("text")).alias("sequence"),
    )
    formatted = sequences.select("source", "doc_id", fasta.fasta_record(60).alias("value"))
    return formatted.select(
        F.col("source").alias("file"),
        F.posexplode(F.split("value", "\n")).alias("_k", "value"),
        "doc_id",
    ).select("file", (F.col("doc_id") * 4096 + F.col("_k")).alias("line"), "value")


@query(
    "read_fasta",
    v.with_views("sequences")
    + """SELECT concat('doc', name) AS name, CASE WHEN CAST(name AS BIGINT) % 2 = 0 THEN meta ELSE '' END AS meta,
        sequence FROM sequences""",
)
def read_fasta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fasta.whole_sequences(fasta.parse_fasta(_fasta_text(spark, sf_dir), chunk_lines=64))


@query(
    "contig_sizes",
    v.with_views("sequences")
    + "SELECT concat('doc', name) AS name, CAST(len(sequence) AS BIGINT) AS size FROM sequences",
)
def contig_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fasta.contig_sizes(fasta.parse_fasta(_fasta_text(spark, sf_dir), chunk_lines=64))


@query(
    "write_fasta",
    v.with_views("sequences", extra=_CELLS)
    + """, wrapped AS (SELECT name, meta, (i - 1) // 60 AS row, string_agg(base, '' ORDER BY i) AS part
            FROM cells GROUP BY ALL)
        SELECT name, concat('>', name, ' ', meta, chr(10), string_agg(part, chr(10) ORDER BY row)) AS value
        FROM wrapped GROUP BY name, meta""",
)
def write_fasta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.documents_as_sequences(spark, sf_dir).select(
        "name", fasta.fasta_record(60).alias("value")
    )


def _fastq_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One FASTQ file per document: two records, the second after an empty line if even."""
    docs = v.table(spark, sf_dir, "documents").select("doc_id", v.dna(F.col("text")).alias("s"))
    name = F.concat(F.lit("@r"), F.col("doc_id").cast("string"))
    quality = F.translate("s", "ACGTRYMKSWN-", "!#5;@FJKTadh")
    lines = F.array(
        F.concat(name, F.lit(" first read")),
        F.col("s"),
        F.lit("+"),
        quality,
        F.when(F.col("doc_id") % 2 == 0, F.lit("")).otherwise(name),
        F.reverse("s"),
        F.lit("+again"),
        F.reverse(quality),
    )
    return docs.select(
        F.col("doc_id").cast("string").alias("file"), F.posexplode(lines).alias("line", "value")
    ).withColumn("line", F.col("line").cast("long"))


_FASTQ = """SELECT name AS file, CAST(0 AS BIGINT) AS record, concat('r', name) AS name,
    'first read' AS meta, sequence, translate(sequence, 'ACGTRYMKSWN-', '!#5;@FJKTadh') AS qualities
    FROM sequences
    UNION ALL SELECT name, 1, concat('r', name), '',
    array_to_string(list_reverse(string_split(sequence, '')), ''),
    array_to_string(list_reverse(string_split(translate(sequence, 'ACGTRYMKSWN-', '!#5;@FJKTadh'), '')), '')
    FROM sequences WHERE CAST(name AS BIGINT) % 2 = 1"""


@query("read_fastq", v.with_views("sequences") + _FASTQ)
def read_fastq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fasta.parse_fastq(_fastq_lines(spark, sf_dir))


@query(
    "write_fastq",
    v.with_views("sequences", extra={"records": _FASTQ})
    + """SELECT CASE WHEN meta = '' THEN concat_ws(chr(10), concat('@', name), sequence, '+', qualities)
        ELSE concat_ws(chr(10), concat('@', name, ' ', meta), sequence, '+', qualities) END AS value
        FROM records""",
)
def write_fastq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fasta.format_fastq(fasta.parse_fastq(_fastq_lines(spark, sf_dir)))


@query(
    "unmapped_records",
    v.with_views("sequences", extra={"records": _FASTQ})
    + """SELECT (dense_rank() OVER (ORDER BY file) - 1) * 1099511627776 + record AS read_id,
        name AS qname, 4 AS flag, -1 AS pos, sequence AS seq, 'g1' AS rg,
        CAST(list_sum([ascii(c) - 33 FOR c IN string_split(qualities, '')]) AS BIGINT) AS sum_quality
        FROM records""",
)
def unmapped_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    reads = fasta.unmapped_records(fasta.parse_fastq(_fastq_lines(spark, sf_dir)), "g1")
    total = F.aggregate("quals", F.lit(0).cast("long"), lambda acc, it: acc + it)
    return reads.select(
        "read_id", "qname", "flag", F.col("pos").cast("int"), "seq", tag_value("RG").alias("rg"),
        total.alias("sum_quality"),
    )


@query(
    "write_phylip",
    v.with_views(
        "sequences",
        extra={
            "shapes": """SELECT msa, count(*) AS n, max(len(sequence)) AS bases,
                CAST(ceil((max(len(name)) + 2) / 12.0) AS BIGINT) * 12 - 2 AS margin
                FROM sequences GROUP BY msa""",
            "sizes": """SELECT *, (70 - margin) // 12 * 10 AS first,
                greatest(bases - (70 - margin) // 12 * 10 + 59, 0) // 60 AS more FROM shapes""",
            "lines": """SELECT msa, name, sequence, first, margin,
                unnest(range(0, more + 1)) AS section FROM sequences JOIN sizes USING (msa)""",
        },
    )
    + """SELECT msa, -1 AS section, NULL AS name, concat(n, ' ', bases) AS value FROM sizes
        UNION ALL SELECT msa, CAST(unnest(range(0, more + 1)) AS INT), NULL, '' FROM sizes
        UNION ALL SELECT msa, CAST(section AS INT), name, CASE WHEN section = 0
            THEN concat(rpad(name, CAST(margin + 2 AS INT), ' '),
                rtrim(regexp_replace(substr(sequence, 1, first), '(.{10})', '\\1  ', 'g')))
            ELSE rtrim(regexp_replace(substr(sequence, first + (section - 1) * 60 + 1, 60),
                '(.{10})', '\\1  ', 'g')) END FROM lines""",
)
def write_phylip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phylip.phylip_lines(v.documents_as_sequences(spark, sf_dir))


@query(
    "fastq_summary",
    v.with_views("sequences", extra={"records": _FASTQ})
    + """SELECT count(*) AS seq_retained_reads, CAST(sum(len(sequence)) AS BIGINT) AS seq_retained_nts,
        count(*) AS seq_collapsed FROM records""",
)
def fastq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return va.fastq_summary(fasta.parse_fastq(_fastq_lines(spark, sf_dir)), collapsed=True)


@query(
    "quality_offset",
    """WITH chars AS (SELECT conv_id, role, ascii(unnest(string_split(regexp_replace(text, '[^;-~]', '', 'g'), ''))) AS c
            FROM conversations WHERE role <> 'assistant'
            UNION ALL SELECT conv_id, role, ascii(unnest(string_split(regexp_replace(text, '[^!-J]', '', 'g'), ''))) AS c
            FROM conversations WHERE role = 'assistant'),
        files AS (SELECT DISTINCT concat(role, conv_id) AS file FROM conversations),
        seen AS (SELECT concat(role, conv_id) AS file, bool_or(c BETWEEN 33 AND 58) AS low,
            bool_or(c BETWEEN 59 AND 74) AS mid, bool_or(c BETWEEN 75 AND 104) AS high
            FROM chars GROUP BY ALL)
        SELECT file, CASE WHEN low AND high THEN 'BOTH' WHEN low THEN '33' WHEN high THEN '64'
            WHEN mid THEN 'AMBIGUOUS' ELSE 'MISSING' END AS "offset" FROM files LEFT JOIN seen USING (file)""",
)
def quality_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(
        F.col("role") == "assistant", F.regexp_replace("text", "[^!-J]", "")
    ).otherwise(F.regexp_replace("text", "[^;-~]", ""))
    rows = v.table(spark, sf_dir, "conversations").select(
        F.concat("role", F.col("conv_id").cast("string")).alias("file"), text.alias("qualities")
    )
    return va.quality_offset(rows)


_CHECK_LINES = """SELECT doc_id // 3 AS file, doc_id * 100000 + k AS line, value FROM (
    SELECT doc_id, unnest(range(0, len(parts))) AS k, unnest(parts) AS value FROM (
        SELECT doc_id, list_concat([concat(CASE doc_id % 17 WHEN 5 THEN '> ' WHEN 6 THEN '>=' ELSE '>' END,
                CASE WHEN doc_id % 11 = 2 THEN 'same' ELSE concat('doc', doc_id) END, ' ', lang)],
            CASE doc_id % 13 WHEN 1 THEN ['ACGT', 'AC', 'ACGT'] WHEN 3 THEN ['', 'ACGT']
                WHEN 4 THEN ['ACGT', '', 'ACGT'] WHEN 5 THEN ['ACGT', ''] WHEN 6 THEN []
                WHEN 7 THEN [] ELSE ['ACGT', 'NNNN', 'ry'] END || string_split(text, chr(10))) AS parts
        FROM documents))"""


def _check_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("doc_id")

    def texts(*values: str):
        return F.array(*(F.lit(value) for value in values)).cast("array<string>")

    first = F.concat(
        F.when(key % 17 == 5, "> ").when(key % 17 == 6, ">=").otherwise(">"),
        F.when(key % 11 == 2, "same").otherwise(F.concat(F.lit("doc"), key.cast("string"))),
        F.lit(" "),
        "lang",
    )
    body = (
        F.when(key % 13 == 1, texts("ACGT", "AC", "ACGT"))
        .when(key % 13 == 3, texts("", "ACGT"))
        .when(key % 13 == 4, texts("ACGT", "", "ACGT"))
        .when(key % 13 == 5, texts("ACGT", ""))
        .when(key % 13 == 6, texts())
        .when(key % 13 == 7, texts())
        .otherwise(texts("ACGT", "NNNN", "ry"))
    )
    body = F.concat(body, F.split("text", "\n"))
    return (
        v.table(spark, sf_dir, "documents")
        .select(
            "doc_id", F.posexplode(F.concat(F.array(first), body)).alias("k", "value")
        )
        .select(
            F.floor(key / 3).alias("file"), (key * 100000 + F.col("k")).alias("line"), "value"
        )
    )


@query(
    "validate_fasta",
    f"""WITH lines AS ({_CHECK_LINES}),
        typed AS (SELECT *, CASE WHEN starts_with(value, '>') THEN 'h' WHEN value = '' THEN 'b' ELSE 's' END AS kind,
            regexp_extract(value, '^>([^ ]*)', 1) AS name FROM lines),
        lagged AS (SELECT *, lag(kind) OVER w AS before, lag(len(value)) OVER w AS before_len,
            count(*) FILTER (kind = 'h') OVER w AS record,
            count(*) FILTER (kind <> 'b') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS content
            FROM typed WINDOW w AS (PARTITION BY file ORDER BY line)),
        firsts AS (SELECT file, record, len(value) AS first_len FROM lagged WHERE kind = 's' AND before = 'h'),
        errors AS (SELECT l.file, line, CASE
            WHEN ends_with(value, chr(13)) THEN 'line ends in CR'
            WHEN kind = 'h' AND before = 'h' THEN 'header follows header'
            WHEN kind = 'h' AND name = '' THEN 'header has no name'
            WHEN kind = 'h' AND name LIKE '=%' THEN 'name breaks the SAM pattern'
            WHEN kind = 'h' AND EXISTS (SELECT 1 FROM typed t WHERE t.file = l.file AND t.kind = 'h'
                AND t.name = l.name AND t.line < l.line) THEN 'name seen before'
            WHEN kind = 's' AND content = 0 THEN 'bases before any header'
            WHEN kind = 's' AND before = 'b' THEN 'bases follow blank line'
            WHEN kind = 's' AND NOT regexp_full_match(value, '[ACGTNRYKMSWBVDHacgtnrykmswbvdh]*')
                THEN 'letters other than nucleotide codes'
            WHEN kind = 's' AND before = 's' AND (len(value) > first_len OR before_len <> first_len)
                THEN 'uneven line width'
            WHEN kind = 'b' AND before = 'h' THEN 'blank line after header' END AS error
            FROM lagged l LEFT JOIN firsts f ON l.file = f.file AND l.record = f.record),
        ends AS (SELECT file, max(line) AS line, CASE WHEN arg_max(kind, line) FILTER (kind <> 'b') = 'h'
            THEN 'no bases after last header' END AS error FROM typed GROUP BY file)
        SELECT file, arg_min(line, place) AS line, arg_min(error, place) AS error FROM (
            SELECT file, line, 2 * line AS place, error FROM errors WHERE error IS NOT NULL
            UNION ALL SELECT file, line, 2 * line + 1, error FROM ends WHERE error IS NOT NULL) GROUP BY file""",
)
def validate_fasta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return va.validate_fasta(_check_lines(spark, sf_dir), width=1 << 17)


@query(
    "read_alignments",
    v.with_views("reads")
    + """SELECT qname, flag, contig, pos, mapq, cigar_text AS cigar, mate_contig, mate_pos, tlen, seq,
        CAST(list_sum(quals) AS BIGINT) AS sum_quals, rg, CAST(xp AS VARCHAR) AS xp FROM reads""",
)
def read_alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = sam.format_alignments(v.alignments(spark, sf_dir))
    lines = text.withColumn("line", F.monotonically_increasing_id())
    return sam.parse_alignments(lines).select(
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
        F.aggregate("quals", F.lit(0).cast("long"), lambda acc, it: acc + it).alias("sum_quals"),
        "rg",
        tag_value("XP", "i").alias("xp"),
    )


# Checks of tables ------------------------------------------------------------------------------


@query(
    "duplicate_inputs",
    """WITH files AS (SELECT url AS path, page_id % 3 AS sample FROM pages
            UNION ALL SELECT url, page_id % 2 FROM pages),
        n AS (SELECT path, sample, count(*) AS n FROM files GROUP BY ALL)
        SELECT path, CAST(sum(n) AS BIGINT) AS n_records, count(*) AS n_samples,
            CASE WHEN max(n) > 1 THEN 'error' ELSE 'warning' END AS severity
        FROM n GROUP BY path HAVING sum(n) > 1""",
)
def duplicate_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = v.table(spark, sf_dir, "pages")
    files = [
        pages.select(F.col("url").alias("path"), (F.col("page_id") % n).alias("sample"))
        for n in (3, 2)
    ]
    files = files[0].unionByName(files[1])
    return va.duplicate_inputs(files)


@query(
    "colliding_names",
    """SELECT lower(name) AS folded, count(*) AS n, min(name) AS first, max(name) AS last FROM (
        SELECT DISTINCT CASE WHEN p_partkey % 3 = 0 THEN upper(p_brand) ELSE p_brand END AS name
        FROM part) GROUP BY folded HAVING count(*) > 1""",
)
def colliding_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("p_brand")
    rows = v.table(spark, sf_dir, "part").select(
        F.when(F.col("p_partkey") % 3 == 0, F.upper(name)).otherwise(name).alias("sample")
    )
    return va.colliding_names(rows)


@query(
    "symmetric_difference",
    """SELECT c_custkey AS custkey, 'left' AS side FROM customer
        WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')
        UNION ALL SELECT DISTINCT o_custkey, 'right' FROM orders WHERE o_orderstatus = 'F'
        AND o_custkey NOT IN (SELECT c_custkey FROM customer)""",
)
def symmetric_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = v.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"))
    right = (
        v.table(spark, sf_dir, "orders")
        .where("o_orderstatus = 'F'")
        .select(F.col("o_custkey").alias("custkey"))
    )
    return va.symmetric_difference(left, right, "custkey")


_QUALITIES = """CASE o_custkey % 5 WHEN 0 THEN '!5;' WHEN 1 THEN 'hK;' WHEN 2 THEN
    CASE WHEN o_orderkey % 2 = 0 THEN '#' ELSE 'Z' END WHEN 3 THEN ';AJ' ELSE '' END"""


@query(
    "validate_fastq",
    f"""WITH seen AS (SELECT o_custkey % 50 AS file, {_QUALITIES} AS q FROM orders),
        marks AS (SELECT file, bool_or(regexp_matches(q, '[!-:]')) AS low, bool_or(q <> '') AS any_,
            bool_or(regexp_matches(q, '[K-h]')) AS high FROM seen GROUP BY file),
        offsets AS (SELECT file, CASE WHEN low AND high THEN 'BOTH' WHEN low THEN '33' WHEN high THEN '64'
            WHEN any_ THEN 'AMBIGUOUS' ELSE 'MISSING' END AS "offset" FROM marks)
        SELECT file, "offset" FROM offsets WHERE "offset" NOT IN ('33', 'AMBIGUOUS')""",
)
def validate_fastq(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = v.table(spark, sf_dir, "orders").selectExpr("o_custkey % 50 AS file", f"{_QUALITIES} AS qualities")
    return va.validate_fastq(records)
