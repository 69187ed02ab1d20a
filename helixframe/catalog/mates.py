"""Queries on the mate fields and mismatch tags of records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.catalog import views as v
from helixframe.catalog.registry import query
from helixframe.functions import flags as fl
from helixframe.operators.alignments import tag_value
from helixframe.operators.mates import fix_mates
from helixframe.operators.mismatches import set_mismatch_tags


@query(
    "fix_mates",
    v.with_views(
        "pair_reads",
        extra={
            # Some records are unmapped, secondary or on another contig than their mate
            "given": """SELECT * REPLACE (
                CASE WHEN read_id % 9 = 0 THEN flag | 4 WHEN read_id % 23 = 0 THEN flag | 256 ELSE flag END AS flag,
                CASE WHEN read_id % 8 = 1 THEN 'chr9' ELSE contig END AS contig) FROM pair_reads""",
            "prim": """SELECT *, CASE flag & 192 WHEN 64 THEN 1 WHEN 128 THEN 2 END AS number,
                CASE WHEN flag & 16 = 16 THEN ref_end ELSE pos END AS five FROM given
                WHERE flag & 1 = 1 AND flag & 2304 = 0""",
            "whole": """SELECT qname FROM prim GROUP BY qname
                HAVING count(*) FILTER (number = 1) = 1 AND count(*) FILTER (number = 2) = 1""",
            "linked": """SELECT a.read_id, b.read_id IS NOT NULL AS found, a.flag & 4 = 0 AS maps,
                coalesce(b.flag & 4 = 0, false) AS mate_maps, b.contig AS m_contig, b.pos AS m_pos,
                coalesce(b.flag & 16 = 16, false) AS m_reverse, b.cigar_text AS m_cigar, b.mapq AS m_mapq,
                coalesce(a.flag & 4 = 0 AND b.flag & 4 = 0 AND a.contig = b.contig, false) AS together,
                b.five - a.five AS ahead
                FROM prim a LEFT JOIN (SELECT * FROM prim WHERE qname IN (SELECT qname FROM whole)) b
                ON a.qname = b.qname AND a.number = 3 - b.number""",
        },
    )
    + """SELECT g.read_id, CAST(CASE WHEN l.read_id IS NULL THEN flag ELSE (flag & ~42)
            + CASE WHEN flag & 2 = 2 AND together AND (flag & 16 = 16) <> m_reverse
                AND CASE WHEN m_reverse THEN ahead >= 0 ELSE ahead <= 0 END THEN 2 ELSE 0 END
            + CASE WHEN mate_maps THEN 0 ELSE 8 END + CASE WHEN m_reverse THEN 32 ELSE 0 END END AS INT) AS flag,
        CASE WHEN mate_maps AND NOT maps THEN m_contig ELSE contig END AS contig,
        CAST(CASE WHEN mate_maps AND NOT maps THEN m_pos ELSE pos END AS BIGINT) AS pos,
        CASE WHEN l.read_id IS NULL THEN mate_contig WHEN found AND maps AND NOT mate_maps THEN contig
            ELSE m_contig END AS mate_contig,
        CAST(CASE WHEN l.read_id IS NULL THEN mate_pos WHEN found AND maps AND NOT mate_maps THEN pos
            ELSE coalesce(m_pos, -1) END AS BIGINT) AS mate_pos,
        CAST(CASE WHEN l.read_id IS NULL THEN tlen WHEN together THEN ahead ELSE 0 END AS INT) AS tlen,
        CASE WHEN l.read_id IS NULL THEN m1 || 'M' WHEN mate_maps THEN m_cigar END AS mc,
        CASE WHEN mate_maps THEN CAST(m_mapq AS VARCHAR) END AS mq
        FROM given g LEFT JOIN linked l ON g.read_id = l.read_id""",
)
def mate_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag, own = F.col("flag"), F.col("read_id")
    given = v.alignments(spark, sf_dir, "pair_reads").withColumns(
        {
            "flag": F.when(own % 9 == 0, flag.bitwiseOR(F.lit(fl.UNMAPPED)))
            .when(own % 23 == 0, flag.bitwiseOR(F.lit(fl.SECONDARY)))
            .otherwise(flag),
            "contig": F.when(own % 8 == 1, "chr9").otherwise(F.col("contig")),
        }
    )
    return fix_mates(given).select(
        "read_id",
        "flag",
        "contig",
        "pos",
        "mate_contig",
        "mate_pos",
        "tlen",
        tag_value("MC", "Z").alias("mc"),
        tag_value("MQ", "i").alias("mq"),
    )


# Rows of 100 bases, each starting elsewhere in the repeat of which the reads are made as well
_REFERENCE = """
    SELECT contig, CAST(start AS BIGINT) AS start,
        substr(repeat('{repeat}', 12), CAST(1 + (start / 100) % 13 AS INT), 100) AS sequence
    FROM {starts}"""
_COMPARED = """CASE WHEN substr(seq, CAST({query} + i + 1 AS INT), 1) = substr(bases, CAST({at} + i + 1 AS INT), 1)
    AND substr(bases, CAST({at} + i + 1 AS INT), 1) <> 'N' THEN '=' ELSE substr(bases, CAST({at} + i + 1 AS INT), 1) END"""
_FIRST, _SECOND = (
    f"array_to_string([{_COMPARED.format(query=q, at=at)} for i in range(CAST({n} AS BIGINT))], '')"
    for q, at, n in (("clip", "0", "m1"), ("clip + m1 + ins", "m1 + del", "m2"))
)


@query(
    "set_mismatch_tags",
    v.with_views(
        "reads",
        "contigs",
        extra={
            "genome": f"""SELECT contig, string_agg(sequence, '' ORDER BY start) AS whole FROM ({_REFERENCE.format(
                repeat=v.REPEAT,
                starts="(SELECT contig, unnest(range(0, length, 100)) AS start FROM contigs)",
            ).replace(" / ", " // ")}) GROUP BY contig""",
            "placed": """SELECT r.*, substr(whole, CAST(pos + 1 AS INT), m1 + del + m2) AS bases
                FROM reads r JOIN genome USING (contig) WHERE flag & 4 = 0""",
            "compared": f"""SELECT read_id, ins + del AS indels, {_FIRST} || CASE WHEN del > 0
                THEN '^' || substr(bases, m1 + 1, del) || '!' ELSE '' END || {_SECOND} AS text FROM placed""",
            "edited": r"""SELECT *, string_split_regex(text, '\^[A-Z]+!|[A-Z]') AS runs,
                regexp_extract_all(text, '\^[A-Z]+!|[A-Z]') AS edits FROM compared""",
            "tagged": r"""SELECT read_id,
                CAST(indels + len(regexp_replace(text, '\^[A-Z]+!|=', '', 'g')) AS VARCHAR) AS nm,
                array_to_string([CAST(len(runs[i]) AS VARCHAR) || coalesce(rtrim(edits[i], '!'), '')
                    for i in range(1, len(runs) + 1)], '') AS md FROM edited""",
        },
    )
    + "SELECT r.read_id, nm, md FROM reads r LEFT JOIN tagged t ON r.read_id = t.read_id",
)
def mismatch_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    starts = v.contigs(spark, sf_dir).selectExpr("contig", "explode(sequence(0, length - 1, 100)) AS start")
    text = f"substr(repeat('{v.REPEAT}', 12), cast(1 + (start div 100) % 13 as int), 100)"
    reference = starts.selectExpr("contig", "start", f"{text} AS sequence")
    return set_mismatch_tags(v.alignments(spark, sf_dir), reference).select(
        "read_id", tag_value("NM", "i").alias("nm"), tag_value("MD", "Z").alias("md")
    )
