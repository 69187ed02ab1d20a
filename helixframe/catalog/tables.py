"""Queries on tables and text reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.catalog import duplicates as dq
from helixframe.catalog import views as v
from helixframe.catalog.panels import SAMPLES
from helixframe.catalog.registry import ORACLES, query
from helixframe.operators import coverage as cov
from helixframe.operators import depths as dp
from helixframe.operators import finalize as fz
from helixframe.operators import panel as pn
from helixframe.sources import reports, sam, tables


def _lines(df: DataFrame, expression: str) -> DataFrame:
    return df.selectExpr(f"{expression} AS value")


@query(
    "read_fai",
    """WITH named AS (SELECT concat(CASE s_suppkey % 3 WHEN 0 THEN 'chr' WHEN 1 THEN 'scaffold' ELSE '' END,
            s_suppkey // 2) AS real_name, CAST(1000 + s_suppkey AS BIGINT) AS size FROM supplier),
        used AS (SELECT *, regexp_replace(real_name, 'chr', '') AS name FROM named
            WHERE real_name NOT LIKE 'scaffold%')
        SELECT name, real_name, size, CASE WHEN count(*) OVER (PARTITION BY name) > 1
            THEN 'contig name is not unique' END AS error FROM used""",
)
def read_fai(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(
        v.table(spark, sf_dir, "supplier"),
        """concat_ws('\t', concat(CASE s_suppkey % 3 WHEN 0 THEN 'chr' WHEN 1 THEN 'scaffold' ELSE '' END,
            s_suppkey div 2), 1000 + s_suppkey, 6, 60, 61)""",
    )
    return tables.parse_fai(lines)


@query(
    "read_sample_sheet",
    """WITH rows AS (SELECT CASE WHEN c_custkey % 7 = 0 THEN 'bad name!' WHEN c_custkey % 5 = 0 THEN c_mktsegment
            ELSE concat('s', c_custkey) END AS sample, c_custkey % 4 AS n FROM customer),
        fixed AS (SELECT CASE WHEN sample LIKE 'bad%' THEN 'bad' ELSE sample END AS sample,
            CASE WHEN sample LIKE 'bad%' THEN 1 + n ELSE n END AS n FROM rows)
        SELECT sample, CAST(n AS INT) AS n_files, CASE WHEN n NOT BETWEEN 1 AND 2 THEN 'expected one or two files'
            WHEN count(*) OVER (PARTITION BY sample) > 1 THEN 'sample name is not unique' END AS error FROM fixed""",
)
def read_sample_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(
        v.table(spark, sf_dir, "customer"),
        """concat(CASE WHEN c_custkey % 7 = 0 THEN 'bad name!' WHEN c_custkey % 5 = 0 THEN c_mktsegment
            ELSE concat('s', c_custkey) END, repeat(' file.bam', cast(c_custkey % 4 as int)))""",
    )
    return tables.parse_sample_files(lines).select(
        "sample", F.size("files").alias("n_files"), "error"
    )


@query(
    "read_lanes",
    """WITH lanes AS (SELECT concat('S', c_nationkey) AS Sample, c_mktsegment AS Library,
            concat('L', c_custkey % 50) AS Lane, concat('f', c_custkey) AS Files FROM customer)
        SELECT *, CASE WHEN count(*) OVER (PARTITION BY Sample, Library, Lane) > 1
            THEN 'lane is listed more than once' END AS error FROM lanes""",
)
def read_lanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    sheet = v.table(spark, sf_dir, "customer").selectExpr(
        "concat('S', c_nationkey) AS Sample",
        "c_mktsegment AS Library",
        "concat('L', c_custkey % 50) AS Lane",
        "concat('f', c_custkey) AS Files",
    )
    return tables.parse_lanes(sheet)


@query(
    "read_panel_contigs",
    """WITH rows AS (SELECT concat('c', s_suppkey // 2 * 2 + (CASE WHEN s_suppkey % 6 = 0 THEN 1 ELSE s_suppkey % 2 END)) AS id,
            CASE WHEN s_suppkey % 9 = 0 THEN 0 WHEN s_suppkey % 9 = 1 THEN NULL ELSE s_suppkey * 10 END AS size,
            CAST(s_suppkey AS BIGINT) AS ns, 'NA' AS checksum FROM supplier)
        SELECT id, CAST(size AS BIGINT) AS size, ns, checksum, CASE WHEN coalesce(size, 0) <= 0 THEN 'size must be positive'
            WHEN count(*) OVER (PARTITION BY id) > 1 THEN 'contig is not unique' END AS error FROM rows""",
)
def read_panel_contigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = v.table(spark, sf_dir, "supplier").selectExpr(
        "concat('c', s_suppkey div 2 * 2 + (CASE WHEN s_suppkey % 6 = 0 THEN 1 ELSE s_suppkey % 2 END)) AS ID",
        "CASE s_suppkey % 9 WHEN 0 THEN '0' WHEN 1 THEN 'x' ELSE cast(s_suppkey * 10 as string) END AS Size",
        "cast(s_suppkey as string) AS Ns",
        "'NA' AS Checksum",
    )
    return tables.parse_panel_contigs(rows)


_PANEL_SAMPLES = [
    "concat('p', c_custkey) AS ID",
    "concat('A', c_custkey % 2) AS `Group(2)`",
    "concat('B', c_custkey % 4) AS `Group(3)`",
    "'-' AS `Group(4)`",
    "c_mktsegment AS Species",
    "CASE c_custkey % 4 WHEN 0 THEN 'male' WHEN 1 THEN 'FEMALE' WHEN 2 THEN 'NA' ELSE 'other' END AS Sex",
    "c_name AS SampleID",
    "'NA' AS Publication",
]


@query(
    "read_panel_samples",
    """SELECT concat('p', c_custkey) AS id, c_mktsegment AS species,
        CASE c_custkey % 4 WHEN 0 THEN 'MALE' WHEN 1 THEN 'FEMALE' WHEN 2 THEN 'NA' ELSE 'OTHER' END AS sex,
        c_name AS sample_id, 'NA' AS publication,
        CASE WHEN c_custkey % 4 = 3 THEN 'unknown sex' END AS error FROM customer""",
)
def read_panel_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.parse_panel_samples(
        v.table(spark, sf_dir, "customer").selectExpr(*_PANEL_SAMPLES)
    )


@query(
    "read_panel_groups",
    """SELECT concat('p', c_custkey) AS sample, CAST(2 AS INT) AS k, concat('A', c_custkey % 2) AS "group" FROM customer
        UNION ALL SELECT concat('p', c_custkey), 3, concat('B', c_custkey % 4) FROM customer""",
)
def read_panel_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.parse_panel_groups(v.table(spark, sf_dir, "customer").selectExpr(*_PANEL_SAMPLES))


@query(
    "wrong_group_counts",
    """SELECT CAST(3 AS INT) AS k, count(DISTINCT c_custkey % 4) AS n_groups FROM customer""",
)
def wrong_group_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = v.table(spark, sf_dir, "customer").selectExpr(*_PANEL_SAMPLES)
    return tables.wrong_group_counts(tables.parse_panel_groups(rows))


@query(
    "read_panel_genotypes",
    v.with_views("panel_sites") + "SELECT contig, pos, ref, genotypes FROM panel_sites",
)
def read_panel_genotypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    header = "Chrom\tPos\tRef\tA;B;C;D;E"
    lines = reports.panel_genotype_lines(v.panel_sites(spark, sf_dir))
    return tables.parse_panel_genotypes(lines, header)[1]


@query(
    "read_panel_mitochondria",
    """WITH rows AS (SELECT s_suppkey * 3 // 4 AS name, upper(concat(repeat('acgtn-', CAST(s_suppkey % 5 + 1 AS INT)),
            CASE WHEN s_suppkey % 7 = 0 THEN 'x' ELSE '' END)) AS sequence, s_suppkey % 7 = 0 AS bad FROM supplier)
        SELECT name, sequence, CASE WHEN bad THEN 'invalid characters' WHEN count(*) OVER (PARTITION BY name) > 1
            THEN 'sequence name is not unique' END AS error FROM rows""",
)
def read_panel_mitochondria(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = (
        v.table(spark, sf_dir, "supplier")
        .selectExpr(
            "s_suppkey * 3 div 4 AS name",
            """concat(repeat('acgtn-', cast(s_suppkey % 5 + 1 as int)),
                CASE WHEN s_suppkey % 7 = 0 THEN 'x' ELSE '' END) AS sequence""",
        )
    )
    return tables.validate_mitochondria(rows)


@query(
    "mitochondria_lengths",
    """SELECT count(DISTINCT len(text)) AS n_lengths, CAST(min(len(text)) AS INT) AS shortest,
        CAST(max(len(text)) AS INT) AS longest, false AS valid FROM benchmark""",
)
def mitochondria_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = v.table(spark, sf_dir, "benchmark").selectExpr("text AS sequence")
    return tables.mitochondria_lengths(rows, 30)


@query(
    "read_simulations",
    """SELECT CASE WHEN event_id % 11 <> 0 THEN user_id END AS n_reads, CAST(2 AS BIGINT) AS k,
        CASE event_id % 3 WHEN 0 THEN '-' ELSE concat('A', event_id % 4) END AS sample1, 'A1' AS sample2,
        CASE event_id % 5 WHEN 0 THEN true WHEN 1 THEN NULL ELSE false END AS has_ts,
        event_id % 1000 / 1000.0::DOUBLE AS percentile, value,
        CASE WHEN event_id % 11 = 0 OR event_id % 5 = 1 THEN 'invalid value'
            WHEN event_id % 3 <> 0 AND event_id % 4 > 1 THEN 'unknown sample' END AS error FROM events""",
)
def read_simulations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = v.table(spark, sf_dir, "events").selectExpr(
        "CASE WHEN event_id % 11 = 0 THEN '' ELSE cast(user_id as string) END AS NReads",
        "'2' AS K",
        "CASE event_id % 3 WHEN 0 THEN '-' ELSE concat('A', event_id % 4) END AS Sample1",
        "'A1' AS Sample2",
        "CASE event_id % 5 WHEN 0 THEN 'TRUE' WHEN 1 THEN 'maybe' ELSE 'false' END AS HasTS",
        "cast(event_id % 1000 / 1000.0D as string) AS Percentile",
        "cast(value as string) AS Value",
    )
    groups = tables.parse_panel_groups(
        v.table(spark, sf_dir, "customer").selectExpr(*_PANEL_SAMPLES)
    )
    return tables.parse_simulations(rows, groups)


@query(
    "read_freq_table",
    """SELECT CAST(l_suppkey % 5 AS VARCHAR) AS chrom, concat('rs', l_partkey) AS snp,
        concat('s', l_linenumber) AS sample, CAST(l_quantity AS BIGINT) AS mac,
        CAST(l_quantity AS BIGINT) + 50 AS nchroms FROM lineitem""",
)
def read_freq_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = _lines(
        v.table(spark, sf_dir, "lineitem"),
        """concat('  ', l_suppkey % 5, '   rs', l_partkey, ' s', l_linenumber, '  A  G 0.5 ',
            cast(l_quantity as bigint), '  ', cast(l_quantity as bigint) + 50)""",
    )
    return tables.parse_freq_table(body.withColumn("line", F.monotonically_increasing_id() + 1))


@query(
    "read_admixture_q",
    """SELECT vec_id AS file, CASE line WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE '-' END AS sample,
        CAST(i - 1 AS INT) AS component, CAST(CAST(embedding[i] AS DOUBLE) AS DOUBLE) AS fraction
        FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings),
            range(3) AS lines(line)""",
)
def read_admixture_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = v.table(spark, sf_dir, "embeddings")
    lines = vectors.select(
        F.col("vec_id").alias("file"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(2).cast("long"))).alias("line"),
        F.array_join(F.col("embedding").cast("array<double>").cast("array<string>"), " ").alias("value"),
    )
    return tables.parse_admixture_q(lines, ["a", "b"])


@query(
    "read_header",
    v.with_views("readgroups")
    + """SELECT rg, sample, library, platform_unit, CAST(NULL AS VARCHAR) AS platform, description FROM readgroups""",
)
def read_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = v.readgroups(spark, sf_dir).select(
        F.concat_ws(
            "\t",
            F.lit("@RG"),
            *(
                F.concat(F.lit(f"{tag}:"), name)
                for tag, name in (
                    ("ID", "rg"),
                    ("SM", "sample"),
                    ("LB", "library"),
                    ("PU", "platform_unit"),
                    ("DS", "description"),
                )
            ),
        ).alias("value"),
        F.lit(0).alias("line"),
    )
    return sam.parse_readgroups(lines)


@query(
    "write_tped",
    v.with_views("panel_sites")
    + """SELECT concat_ws(' ', contig, concat('chr', contig, '_', pos), '0', pos, array_to_string([CASE c
            WHEN 'R' THEN 'A G' WHEN 'Y' THEN 'C T' WHEN 'S' THEN 'C G' WHEN 'W' THEN 'A T' WHEN 'K' THEN 'G T'
            WHEN 'M' THEN 'A C' ELSE concat(c, ' ', c) END FOR c IN string_split(genotypes, '')], ' '), ref, ref)
        AS value FROM panel_sites""",
)
def write_tped(spark: SparkSession, sf_dir: str) -> DataFrame:
    sites = v.panel_sites(spark, sf_dir).withColumn("base", F.col("ref"))
    return sites.select(reports.tped_line().alias("value"))


@query(
    "write_tfam",
    """SELECT concat_ws(' ', concat('p', c_custkey), concat('p', c_custkey), 0, 0, CASE c_custkey % 3
            WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 0 END, -9) AS value FROM customer
        UNION ALL SELECT 'test test 0 0 0 -9'""",
)
def write_tfam(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = v.table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS idx",
        "concat('p', c_custkey) AS id",
        "CASE c_custkey % 3 WHEN 0 THEN 'MALE' WHEN 1 THEN 'female' ELSE 'NA' END AS sex",
    )
    return reports.tfam_lines(samples, "test")


@query(
    "write_treemix",
    v.with_views(
        extra={
            "frequencies": """SELECT l_partkey AS snp, concat('s', l_suppkey % 5) AS sample,
            CAST(sum(l_linenumber % 3) AS BIGINT) AS mac, 2 * count(*) AS nchrobs FROM lineitem GROUP BY ALL"""
        }
    )
    + "SELECT concat_ws(' ', "
    + ", ".join(f"max(concat(mac, ',', nchrobs - mac)) FILTER (sample = '{name}')" for name in SAMPLES)
    + ") AS value FROM frequencies GROUP BY snp",
)
def write_treemix(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = (
        v.table(spark, sf_dir, "lineitem")
        .groupBy(
            F.col("l_partkey").alias("snp"),
            F.concat(F.lit("s"), (F.col("l_suppkey") % 5).cast("string")).alias("sample"),
        )
        .agg(
            F.sum(F.col("l_linenumber") % 3).alias("mac"),
            (2 * F.count("*")).alias("nchrobs"),
        )
    )
    return pn.treemix_counts(counts, SAMPLES).select(reports.treemix_line(SAMPLES).alias("value"))


@query(
    "write_panel",
    """SELECT concat_ws(chr(9), concat('c', s_suppkey), 1000 + s_suppkey, s_suppkey, 'NA') AS value FROM supplier
        UNION ALL SELECT concat_ws(chr(9), s_name, '-', '-', 'NA', 'NA', s_name, 'NA') FROM supplier""",
)
def write_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = v.table(spark, sf_dir, "supplier")
    contigs = suppliers.selectExpr(
        "concat('c', s_suppkey) AS name", "1000 + s_suppkey AS size", "s_suppkey AS ns"
    )
    samples = suppliers.selectExpr("s_name AS name")
    return reports.panel_contig_lines(contigs).unionByName(reports.panel_sample_lines(samples))


_SEPARATORS = """
    UNION ALL SELECT '#' FROM (SELECT DISTINCT sample, library FROM lines)
    UNION ALL SELECT '#' FROM (SELECT DISTINCT sample FROM lines)"""


@query(
    "write_coverage_table",
    f"""WITH lines AS ({ORACLES["coverage_contig"]})
        SELECT concat_ws(chr(9), 'Name', 'Sample', 'Library', 'Contig', 'Size', 'Hits', 'SE', 'PE_1',
            'PE_2', 'Collapsed', 'M', 'I', 'D', 'Coverage') AS value
        UNION ALL SELECT concat_ws(chr(9), name, sample, library, contig, size, hits, se, pe_1, pe_2,
            collapsed, m, i, d, coverage) FROM lines {_SEPARATORS}""",
)
def write_coverage_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = cov.coverage_table(
        v.alignments(spark, sf_dir), v.contigs(spark, sf_dir), v.readgroups(spark, sf_dir)
    )
    return reports.coverage_lines(table)


@query(
    "write_filter_json",
    f"""WITH counts AS ({ORACLES["finalize_filter_counts"]}),
        histograms AS ({ORACLES["finalize_histograms"]}),
        totals AS ({ORACLES["finalize_totals"]}),
        keys AS (SELECT "group", metric, outcome, string_agg(concat('"', key, '":', count), ','
            ORDER BY CAST(key AS VARCHAR)) AS body FROM histograms GROUP BY ALL),
        outcomes AS (SELECT "group", metric, string_agg(concat('"', outcome, '":{{', body, '}}'), ','
            ORDER BY outcome) AS body FROM keys GROUP BY ALL),
        metrics AS (SELECT "group", string_agg(concat('"', metric, '":{{', body, '}}'), ','
            ORDER BY metric) AS body FROM outcomes GROUP BY ALL),
        filters AS (SELECT "group", string_agg(concat('"', filter, '":', count), ',' ORDER BY filter) AS body
            FROM counts GROUP BY ALL),
        sums AS (SELECT "group", string_agg(concat('"', outcome, '":{{"reads":', reads, ',"bases":', bases,
            ',"coverage":', coverage, '}}'), ',' ORDER BY outcome) AS body FROM totals GROUP BY ALL)
        SELECT sums."group", concat('{{"filters":{{', filters.body, '}},"genome":{{"ncontigs":', genome.n,
            ',"size":', genome.size, '}},"histograms":{{', metrics.body, '}},"totals":{{', sums.body, '}}}}') AS value
        FROM sums JOIN filters USING ("group") JOIN metrics USING ("group"),
            (SELECT count(*) AS n, count(*) * 10000 AS size FROM region) AS genome""",
)
def write_filter_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    evaluated = fz.evaluate_alignments(v.alignments(spark, sf_dir, "pair_reads"), dq.OPTIONS)
    groups, contigs = v.readgroups(spark, sf_dir), v.contigs(spark, sf_dir)
    return reports.filter_json(
        fz.filter_counts(evaluated, groups, dq.OPTIONS),
        fz.outcome_histograms(evaluated, groups, dq.OPTIONS),
        fz.filter_totals(evaluated, groups, contigs),
        contigs,
    )


@query(
    "write_depths_table",
    f"""WITH fractions AS ({ORACLES["depth_fractions"]}), tops AS ({ORACLES["max_depth"]}),
        lines AS (SELECT sample, library, contig, size,
            string_agg(printf('%.4f', fraction), chr(9) ORDER BY depth) AS cells
            FROM fractions GROUP BY ALL)
        SELECT concat_ws(chr(9), 'Name', 'Sample', 'Library', 'Contig', 'Size', 'MaxDepth',
            (SELECT string_agg(printf('MD_%03d', k), chr(9) ORDER BY k) FROM range(1, 201) AS t(k))) AS value
        UNION ALL SELECT concat_ws(chr(9), 'genome', sample, library, contig, size,
            coalesce(CAST(max_depth AS VARCHAR), 'NA'), cells)
            FROM lines LEFT JOIN tops USING (sample, library, contig) {_SEPARATORS}""",
)
def write_depths_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = dp.depths_table(
        v.alignments(spark, sf_dir), v.contigs(spark, sf_dir), v.readgroups(spark, sf_dir)
    )
    return reports.depths_lines(table)
