"""Queries on duplicates and on the pass/fail evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.catalog import views as v
from helixframe.catalog.registry import query
from helixframe.operators import alignments as al
from helixframe.operators import duplicates as du
from helixframe.operators import finalize as fz

_RANDOM = """-(('0x' || substr(md5(concat('0|', read_id)), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"""


def _collapsed_views(source: str, extra_key: str = "") -> dict[str, str]:
    key = f"{extra_key}contig, reverse, first, last"
    return {
        "eligible": f"""SELECT *, flag & 16 <> 0 AS reverse, pos - clip AS first, ref_end AS last,
            (ins > 0)::INT + (del > 0)::INT + (clip > 0)::INT + 2 AS n_ops,
            coalesce(CAST(list_sum(quals[clip + 1:]) AS DOUBLE), {_RANDOM}) AS quality
            FROM {source} WHERE flag & 2821 = 0""",
        "sized": f"""SELECT *, count(*) OVER (PARTITION BY {key}) AS n,
            sum(coalesce(xp, 0)) OVER (PARTITION BY {key}) AS old,
            count(*) OVER (PARTITION BY {key}, cigar_text) AS cigar_n,
            min(read_id) OVER (PARTITION BY {key}, cigar_text) AS cigar_seen FROM eligible""",
        "ranked": f"""SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY cigar_n DESC, n_ops,
            quality DESC, cigar_seen, read_id) AS place FROM sized""",
    }


_MARKED = {
    "marked": """SELECT d.read_id, d.contig, d.pos,
        CAST(CASE WHEN place = 1 THEN d.flag & ~1024 WHEN place > 1 THEN d.flag | 1024
             ELSE d.flag END AS INT) AS flag,
        CASE WHEN place = 1 THEN CAST(CASE WHEN n = 1 THEN 1 ELSE n + old END AS VARCHAR)
             ELSE CAST(d.xp AS VARCHAR) END AS xp
        FROM dup_reads d LEFT JOIN ranked r ON d.read_id = r.read_id"""
}


@query(
    "mark_duplicates_collapsed",
    v.with_views("dup_reads", extra=_collapsed_views("dup_reads") | _MARKED)
    + "SELECT read_id, flag, xp FROM marked",
)
def mark_duplicates_collapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = du.mark_duplicates_collapsed(v.alignments(spark, sf_dir, "dup_reads"))
    return marked.select("read_id", "flag", al.tag_value("XP").alias("xp"))


@query(
    "remove_duplicates",
    v.with_views("dup_reads", extra=_collapsed_views("dup_reads") | _MARKED)
    + "SELECT read_id, contig, pos FROM marked WHERE flag & 1024 = 0",
)
def remove_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = du.mark_duplicates_collapsed(v.alignments(spark, sf_dir, "dup_reads"))
    return du.remove_duplicates(marked).select("read_id", "contig", "pos")


@query(
    "copy_numbers",
    v.with_views("dup_reads", extra=_collapsed_views("dup_reads"))
    + """SELECT read_id, CAST(CASE WHEN n = 1 THEN 1 ELSE n + old END AS BIGINT) AS copies
        FROM ranked WHERE place = 1""",
)
def copy_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return du.copy_numbers(v.alignments(spark, sf_dir, "dup_reads"))


def _paired_views(source: str, by: str = "") -> dict[str, str]:
    return {
        "ends": f"""SELECT {by} read_id, qname,
            CASE WHEN flag & 193 = 65 THEN 1 WHEN flag & 193 = 129 THEN 2 END AS mate,
            {{'contig': contig, 'at': CASE WHEN flag & 16 <> 0 THEN ref_end ELSE pos - clip END,
              'reverse': flag & 16 <> 0}} AS fin,
            coalesce(list_sum([q FOR q IN quals IF q >= 15]), 0) AS quality
            FROM {source} WHERE flag & 2820 = 0""",
        "templates": f"""SELECT {by} qname, sum(quality) AS quality, min(read_id) AS first_read,
            least(max(fin) FILTER (mate = 1), max(fin) FILTER (mate = 2)) AS low,
            greatest(max(fin) FILTER (mate = 1), max(fin) FILTER (mate = 2)) AS high
            FROM ends WHERE mate IS NOT NULL GROUP BY {by} qname
            HAVING count(*) FILTER (mate = 1) = 1 AND count(*) FILTER (mate = 2) = 1""",
        "pair_ranks": f"""SELECT *, row_number() OVER (PARTITION BY {by} low, high
            ORDER BY quality DESC, first_read) AS place FROM templates""",
        "singles": f"""SELECT *, row_number() OVER (PARTITION BY {by} fin
            ORDER BY quality DESC, read_id) AS place FROM ends e
            WHERE NOT (mate IS NOT NULL AND EXISTS (SELECT 1 FROM templates t
                WHERE t.qname = e.qname {"AND t.library = e.library" if by else ""}))""",
        "taken": f"""SELECT {by} low AS fin FROM templates UNION SELECT {by} high FROM templates""",
        "paired_keep": f"""SELECT read_id FROM ends e JOIN pair_ranks p USING ({by} qname)
            WHERE place = 1 AND mate IS NOT NULL
            UNION ALL SELECT read_id FROM singles s WHERE place = 1 AND NOT EXISTS
            (SELECT 1 FROM taken t WHERE t.fin = s.fin {"AND t.library = s.library" if by else ""})""",
    }


@query(
    "mark_duplicates_paired",
    v.with_views("pair_reads", extra=_paired_views("pair_reads"))
    + """SELECT r.read_id, CAST(CASE WHEN r.flag & 2820 <> 0 THEN r.flag
        WHEN k.read_id IS NULL THEN r.flag | 1024 ELSE r.flag & ~1024 END AS INT) AS flag
        FROM pair_reads r LEFT JOIN paired_keep k ON r.read_id = k.read_id""",
)
def mark_duplicates_paired(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = du.mark_duplicates_paired(v.alignments(spark, sf_dir, "pair_reads"))
    return marked.select("read_id", "flag")


@query(
    "dedup_library",
    v.with_views(
        "dup_reads",
        "readgroups",
        extra={
            "librarized": """SELECT d.*, coalesce(g.library, '<NA>') AS library
                FROM dup_reads d LEFT JOIN readgroups g ON d.rg = g.rg""",
            "merged": "SELECT * FROM librarized WHERE starts_with(qname, 'M_')",
            "unmerged": "SELECT * FROM librarized WHERE NOT starts_with(qname, 'M_')",
        }
        | _collapsed_views("merged", "library, ")
        | _paired_views("unmerged", "library,"),
    )
    + """SELECT m.read_id, m.library, CAST(CASE WHEN place = 1 THEN m.flag & ~1024
            WHEN place > 1 THEN m.flag | 1024 ELSE m.flag END AS INT) AS flag
        FROM merged m LEFT JOIN ranked r ON m.read_id = r.read_id
        UNION ALL SELECT u.read_id, u.library, CAST(CASE WHEN u.flag & 2820 <> 0 THEN u.flag
            WHEN k.read_id IS NULL THEN u.flag | 1024 ELSE u.flag & ~1024 END AS INT)
        FROM unmerged u LEFT JOIN paired_keep k ON u.read_id = k.read_id""",
)
def dedup_library(spark: SparkSession, sf_dir: str) -> DataFrame:
    reads = al.attach_readgroups(
        v.alignments(spark, sf_dir, "dup_reads"), v.readgroups(spark, sf_dir)
    )
    return du.dedup_library(reads).select("read_id", "library", "flag")


# Reads included more than once: all reads, and the same ones again in reverse order of ids
_AGAIN = 10**18
_CHECKED = f"""SELECT * FROM dup_reads UNION ALL
    SELECT * REPLACE ({_AGAIN} - read_id AS read_id) FROM dup_reads"""
_CHECKED_KEY = "{name} contig, pos, flag & 16, seq, coalesce(CAST(quals AS VARCHAR), '*')"


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = v.alignments(spark, sf_dir, "dup_reads")
    return rows.unionByName(rows.withColumn("read_id", _AGAIN - F.col("read_id")))


def _groups_sql(name: str) -> str:
    return f"""SELECT min(read_id) AS first_read, count(*) AS n_reads,
        count(*) FILTER (len(regexp_replace(regexp_replace(regexp_replace(regexp_replace(seq,
            'A+', 'A', 'g'), 'C+', 'C', 'g'), 'G+', 'G', 'g'), 'T+', 'T', 'g')) >= 4) AS n_complex
        FROM checked WHERE flag & 2308 = 0 AND len(seq) > 0
        GROUP BY {_CHECKED_KEY.format(name=name)} HAVING count(*) > 1"""


@query(
    "duplicate_read_groups",
    v.with_views("dup_reads", extra={"checked": _CHECKED}) + _groups_sql("qname,"),
)
def duplicate_read_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = du.duplicate_read_groups(_checked(spark, sf_dir), min_complexity=4)
    return groups.select("first_read", "n_reads", "n_complex")


@query(
    "duplicate_read_groups_any_name",
    v.with_views("dup_reads", extra={"checked": _CHECKED, "found": _groups_sql("")})
    + """SELECT count(*) AS total, count(*) FILTER (n_complex > 0) AS filtered FROM found""",
)
def duplicate_read_groups_any_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return du.duplicate_totals(
        du.duplicate_read_groups(_checked(spark, sf_dir), any_query_name=True, min_complexity=4)
    )


@query(
    "min_complexity_filter",
    v.with_views("dup_reads", extra={"checked": _CHECKED})
    + """SELECT read_id, seq FROM (SELECT read_id, seq, string_split(seq, '') AS b FROM checked WHERE len(seq) > 0)
        WHERE 1 + len([i FOR i IN range(2, len(b) + 1) IF b[i] <> b[i - 1]]) >= 4""",
)
def min_complexity_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return du.min_complexity_filter(_checked(spark, sf_dir), 4).select("read_id", "seq")


@query(
    "limit_report",
    v.with_views("dup_reads", extra={"checked": _CHECKED, "found": _groups_sql("qname,")})
    + """SELECT first_read, n_reads, n_complex FROM found WHERE n_complex > 0""",
)
def limit_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = du.duplicate_read_groups(_checked(spark, sf_dir), min_complexity=4)
    return du.limit_report(groups).select("first_read", "n_reads", "n_complex")


@query(
    "duplicate_report",
    v.with_views("dup_reads", "readgroups", extra={"checked": _CHECKED})
    + f"""SELECT first_read, f.read_id, contig, pos,
        CASE WHEN flag & 65 = 65 THEN 'first mate' WHEN flag & 129 = 129 THEN 'second mate'
            ELSE 'single read' END AS read_type,
        coalesce(sample, '?') AS sample, coalesce(library, '?') AS library,
        coalesce(platform_unit, '?') AS platform_unit, qname, seq AS sequence,
        array_to_string([chr(CAST(33 + q AS INT)) FOR q IN quals], '') AS qualities
        FROM (SELECT *, min(read_id) OVER w AS first_read, count(*) OVER w AS n FROM checked
            WHERE flag & 2308 = 0 AND len(seq) > 0
            WINDOW w AS (PARTITION BY {_CHECKED_KEY.format(name="qname,")})) f
        LEFT JOIN readgroups g ON f.rg = g.rg WHERE n > 1""",
)
def duplicate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _checked(spark, sf_dir)
    groups = du.duplicate_read_groups(rows)
    return du.duplicate_report(rows, v.readgroups(spark, sf_dir), groups)


# Pass/fail evaluation ------------------------------------------------------------------------

OPTIONS = fz.FilterOptions(
    min_insert_size=10,
    max_insert_size=500,
    min_matches=41,
    min_mapped_fraction=0.96,
    min_mapping_quality=5,
)
_EVALUATED = {
    "first": """SELECT *, xor(flag, 2) AS x, m1 + m2 AS matches,
        CASE WHEN flag & 193 = 65 THEN 1 WHEN flag & 193 = 129 THEN 2 END AS mate FROM pair_reads""",
    "second": """SELECT *, mapq < 5 AS low_mapping_quality,
        matches / CAST(query_len AS DOUBLE) < 0.96 AS low_mapped_fraction,
        matches < 41 AS few_mapped, CASE WHEN flag & 1 <> 0 THEN x & (3844 | 8 | 2) = 0
            ELSE x & 3844 = 0 END AS clean FROM first""",
    "third": """SELECT *, clean AND NOT low_mapping_quality AND NOT low_mapped_fraction
        AND NOT few_mapped AS good FROM second""",
    "fourth": """SELECT *, CASE WHEN good AND flag & 1 <> 0 AND tlen <> 0 THEN abs(tlen) END AS insert_size
        FROM third""",
    "fifth": """SELECT *, coalesce(insert_size < 10 OR insert_size > 500, false) AS bad_insert_size,
        good AND NOT coalesce(insert_size < 10 OR insert_size > 500, false) AS fine FROM fourth""",
    "evaluated": """SELECT f.*, fine AND NOT lost AS passes, lost AS orphan_reads,
        coalesce(description, '<NA>') AS "group"
        FROM (SELECT *, fine AND ((mate = 1 AND NOT bool_or(fine AND coalesce(mate = 2, false)) OVER w)
            OR (coalesce(mate = 2, false) AND NOT bool_or(fine AND coalesce(mate = 1, false)) OVER w))
            IS TRUE AS lost FROM fifth WINDOW w AS (PARTITION BY qname)) f
        LEFT JOIN readgroups g ON f.rg = g.rg""",
}


def _evaluated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fz.evaluate_alignments(v.alignments(spark, sf_dir, "pair_reads"), OPTIONS)


def _finalize(select: str, *views: str, extra: dict[str, str] | None = None) -> str:
    return v.with_views("pair_reads", "readgroups", *views, extra=_EVALUATED | (extra or {})) + select


@query(
    "finalize_outcomes",
    _finalize("""SELECT read_id, passes, orphan_reads, bad_insert_size, low_mapped_fraction,
        CASE WHEN passes THEN 'passed' ELSE 'failed' END AS outcome FROM evaluated"""),
)
def finalize_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fz.split_outcomes(_evaluated(spark, sf_dir)).select(
        "read_id", "passes", "orphan_reads", "bad_insert_size", "low_mapped_fraction", "outcome"
    )


@query(
    "orphans",
    _finalize("SELECT DISTINCT qname FROM evaluated WHERE orphan_reads"),
)
def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _evaluated(spark, sf_dir)
    return rows.where("orphan_reads").select("qname").distinct()


_FILTER_TESTS = {
    "unmapped": "x & 4 <> 0",
    "secondary": "x & 256 <> 0",
    "qc_failed": "x & 512 <> 0",
    "pcr_duplicate": "x & 1024 <> 0",
    "supplementary": "x & 2048 <> 0",
    "unmapped_mate": "flag & 1 <> 0 AND x & 8 <> 0",
    "improper_pair": "flag & 1 <> 0 AND x & 2 <> 0",
    "low_mapping_quality": "low_mapping_quality",
    "low_mapped_fraction": "low_mapped_fraction",
    "few_mapped": "few_mapped",
    "bad_insert_size": "bad_insert_size",
    "orphan_reads": "orphan_reads",
}


@query(
    "finalize_filter_counts",
    _finalize(
        " UNION ALL ".join(
            f"""SELECT coalesce("group", '*') AS "group", '{label}' AS filter,
                count(*) FILTER ({test}) AS count FROM evaluated GROUP BY ROLLUP ("group")"""
            for label, test in _FILTER_TESTS.items()
        )
    ),
)
def finalize_filter_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fz.filter_counts(_evaluated(spark, sf_dir), v.readgroups(spark, sf_dir), OPTIONS)


_OUTCOME = "CASE WHEN passes THEN 'passed' ELSE 'failed' END"


@query(
    "finalize_histograms",
    _finalize(
        """SELECT coalesce("group", '*') AS "group", outcome, metric, key,
            CAST(sum(n) AS BIGINT) AS count FROM per_group
            GROUP BY GROUPING SETS (("group", outcome, metric, key), (outcome, metric, key))""",
        extra={
            "entries": " UNION ALL ".join(
                f"""SELECT "group", {outcome} AS outcome, '{metric}' AS metric,
                    CAST({key} AS BIGINT) AS key FROM evaluated"""
                for metric, outcome, key in (
                    ("query_lengths", _OUTCOME, "query_len"),
                    ("mapping_quality", _OUTCOME, "mapq"),
                    ("matches", _OUTCOME, "matches"),
                    ("matches_pct", _OUTCOME, "matches * 100 // query_len"),
                    (
                        "insert_sizes",
                        "CASE WHEN bad_insert_size THEN 'failed' ELSE 'passed' END",
                        "insert_size",
                    ),
                )
            ),
            "per_group": """SELECT "group", outcome, metric, key,
                CASE WHEN metric = 'insert_sizes' THEN count(*) // 2 ELSE count(*) END AS n
                FROM entries WHERE key IS NOT NULL GROUP BY "group", outcome, metric, key""",
        },
    ),
)
def finalize_histograms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fz.outcome_histograms(_evaluated(spark, sf_dir), v.readgroups(spark, sf_dir), OPTIONS)


@query(
    "finalize_totals",
    _finalize(
        f"""SELECT coalesce("group", '*') AS "group", outcome, count(*) AS reads,
            CAST(sum(matches) AS BIGINT) AS bases,
            CAST(sum(matches) AS DOUBLE) / (SELECT sum(length) FROM contigs) AS coverage
            FROM (SELECT *, {_OUTCOME} AS outcome FROM evaluated)
            GROUP BY GROUPING SETS (("group", outcome), (outcome))""",
        "contigs",
    ),
)
def finalize_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fz.filter_totals(
        _evaluated(spark, sf_dir), v.readgroups(spark, sf_dir), v.contigs(spark, sf_dir)
    )
