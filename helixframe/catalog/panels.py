"""Queries on site panels, consensus sequences, genotype tables, admixture and trees."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helixframe.catalog import views as v
from helixframe.catalog.registry import query
from helixframe.operators import admixture as ad
from helixframe.operators import mito
from helixframe.operators import msa
from helixframe.operators import panel as pn
from helixframe.operators import pca
from helixframe.operators import trees as tr

# Sites ---------------------------------------------------------------------------------------

_AT_SITES = {
    "at_sites": """SELECT s.contig, s.pos, s.ref, s.genotypes, r.read_id, CASE
            WHEN s.pos - 1 < r.pos + m1 THEN substr(seq, CAST(clip + s.pos - r.pos AS BIGINT), 1)
            ELSE substr(seq, CAST(clip + ins - del + s.pos - r.pos AS BIGINT), 1) END AS base
        FROM reads r JOIN panel_sites s ON r.contig = s.contig AND s.pos - 1 >= r.pos
            AND s.pos - 1 < r.ref_end AND NOT (s.pos - 1 >= r.pos + m1 AND s.pos - 1 < r.pos + m1 + del)
        WHERE flag & 3844 = 0""",
    "bases": "SELECT * FROM at_sites WHERE base <> 'N'",
    "alleles": """SELECT contig, pos, unnest(string_split(genotypes, '')) AS code FROM panel_sites""",
    "site_sets": "SELECT contig, pos, bit_or(CASE code "
    + v.sql_cases(v.CODE_SETS)
    + " END) AS alleles FROM alleles GROUP BY contig, pos",
}
_BIT = "CASE base WHEN 'A' THEN 1 WHEN 'C' THEN 2 WHEN 'G' THEN 4 ELSE 8 END"


def _bases(spark: SparkSession, sf_dir: str) -> DataFrame:
    sites = pn.with_alleles(v.panel_sites(spark, sf_dir))
    return pn.reads_at_sites(v.alignments(spark, sf_dir), sites)


@query(
    "reads_at_sites",
    v.with_views("reads", "panel_sites", extra=_AT_SITES)
    + "SELECT contig, pos, read_id, base FROM bases",
)
def reads_at_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bases(spark, sf_dir).select("contig", "pos", "read_id", "base")


@query(
    "observed_allele_filter",
    v.with_views("reads", "panel_sites", extra=_AT_SITES)
    + f"""SELECT contig, pos, read_id, base FROM bases JOIN site_sets USING (contig, pos)
        WHERE alleles & ({_BIT}) <> 0""",
)
def observed_allele_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = pn.observed_allele_filter(_bases(spark, sf_dir))
    return kept.select("contig", "pos", "read_id", "base")


@query(
    "exclude_transitions",
    v.with_views("panel_sites", extra={k: _AT_SITES[k] for k in ("alleles", "site_sets")})
    + """SELECT contig, pos, genotypes FROM panel_sites JOIN site_sets USING (contig, pos)
        WHERE alleles NOT IN (5, 10)""",
)
def exclude_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pn.exclude_transitions(v.panel_sites(spark, sf_dir)).select("contig", "pos", "genotypes")


# One site after another: its reads in order of their hash, and those that sites before it have used up
_WALK = {
    "choices": f"""SELECT contig, pos, read_id, base, md5(concat_ws('|', '5', read_id, pos)) AS rank,
        alleles & ({_BIT}) <> 0 AS allowed FROM bases JOIN site_sets USING (contig, pos)""",
    "site_lists": """SELECT contig, pos, row_number() OVER (PARTITION BY contig ORDER BY pos) AS k,
        list({'read_id': read_id, 'base': base, 'allowed': allowed} ORDER BY rank, read_id) AS choices
        FROM choices GROUP BY contig, pos""",
    "walk": """SELECT contig, CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS used, CAST(NULL AS BIGINT) AS pos,
            CAST(NULL AS BIGINT) AS read_id, CAST(NULL AS VARCHAR) AS base, false AS taken
        FROM (SELECT DISTINCT contig FROM site_lists)
        UNION ALL
        SELECT contig, k, CASE WHEN pick.allowed THEN list_append(used, pick.read_id) ELSE used END, pos,
            pick.read_id, pick.base, coalesce(pick.allowed, false)
        FROM (SELECT s.contig, s.k, s.pos, w.used,
                list_filter(s.choices, lambda it: NOT list_contains(w.used, it.read_id))[1] AS pick
            FROM walk w JOIN site_lists s ON s.contig = w.contig AND s.k = w.k + 1)""",
}


@query(
    "sample_panel_sites",
    v.with_views("reads", "panel_sites", extra=_AT_SITES | _WALK).replace("WITH ", "WITH RECURSIVE ", 1)
    + "SELECT contig, pos, read_id, base FROM walk WHERE taken",
)
def sample_panel_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pn.sample_panel_sites(_bases(spark, sf_dir), seed=5).select(
        "contig", "pos", "read_id", "base"
    )


@query(
    "site_statistics",
    v.with_views("reads", "panel_sites", extra=_AT_SITES)
    + f"""SELECT (SELECT count(*) FROM reads WHERE flag & 3844 = 0) AS n_reads,
        (SELECT count(DISTINCT read_id) FROM bases) AS n_reads_used,
        count(*) AS n_sites_incl_ts, count(*) FILTER (alleles NOT IN (5, 10)) AS n_sites_excl_ts
        FROM site_sets WHERE (contig, pos) IN (SELECT (contig, pos) FROM bases
            JOIN site_sets USING (contig, pos) WHERE alleles & ({_BIT}) <> 0)""",
)
def site_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    bases = _bases(spark, sf_dir)
    covered = pn.observed_allele_filter(bases).select("contig", "pos").distinct()
    return pn.site_statistics(
        v.alignments(spark, sf_dir), v.panel_sites(spark, sf_dir), bases, covered
    )


@query(
    "treemix_block_size",
    v.with_views("contigs", "panel_sites")
    + """SELECT distance, greatest(1, CAST(ceil(distance / ((SELECT CAST(sum(length) AS DOUBLE) FROM contigs) /
        (SELECT count(*) FROM panel_sites))) AS BIGINT)) AS k
        FROM (SELECT CAST(10 * n_nationkey AS BIGINT) AS distance FROM nation)""",
)
def treemix_block_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = v.contigs(spark, sf_dir).agg(F.sum("length")).scalar()
    n_sites = v.panel_sites(spark, sf_dir).agg(F.count("*")).scalar()
    distance = (10 * F.col("n_nationkey")).cast("long")
    return v.table(spark, sf_dir, "nation").select(
        distance.alias("distance"), pn.block_size(n_sites, size, distance).alias("k")
    )


# Three genomes per document that differ at few positions
_GENOMES = {
    "plain": "SELECT name, translate(sequence, 'RYMKSW', 'NNNNNN') AS s FROM sequences",
    "columns": """SELECT concat('doc', name) AS contig, unnest(range(1, len(s) + 1)) AS pos,
        unnest(string_split(s, '')) AS a, unnest(string_split(regexp_replace(s, 'GATA', 'GCTA', 'g'), '')) AS b,
        unnest(string_split(regexp_replace(s, 'ATTA', 'AYTA', 'g'), '')) AS c FROM plain""",
    "coded": "SELECT *, "
    + ", ".join(
        f"CASE {name} WHEN 'A' THEN 1 WHEN 'C' THEN 2 WHEN 'G' THEN 4 WHEN 'T' THEN 8 "
        f"WHEN 'Y' THEN 10 END AS set_{name}"
        for name in "abc"
    )
    + " FROM columns",
}


@query(
    "biallelic_sites",
    v.with_views("sequences", extra=_GENOMES)
    + """SELECT contig, pos, a AS ref, concat(a, b, c) AS genotypes FROM coded
        WHERE bit_count(set_a | set_b | set_c) = 2""",
)
def biallelic_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = v.documents_as_sequences(spark, sf_dir).select(
        F.concat(F.lit("doc"), "name").alias("contig"),
        F.translate("sequence", "RYMKSW", "NNNNNN").alias("sequence"),
    )
    width = 3000  # a multiple of the packed width
    genomes = F.array(
        F.col("sequence"),
        F.regexp_replace("sequence", "GATA", "GCTA"),
        F.regexp_replace("sequence", "ATTA", "AYTA"),
    )

    def chunked(rows: DataFrame) -> DataFrame:
        return (
            msa.chunks(rows, width)
            .withColumn("chunk_start", F.col("chunk") * width)
            .withColumnRenamed("bases", "sequence")
            .drop("chunk")
        )

    samples = chunked(plain.select("contig", F.posexplode(genomes).alias("idx", "sequence")))
    sites = pn.biallelic_sites(samples, chunked(plain), n_samples=3)
    return sites.withColumn("pos", F.col("pos").cast("long"))


@query(
    "autosome_filter",
    """SELECT contig, n FROM (SELECT concat('chr', CASE l_suppkey % 13 WHEN 11 THEN 'X' WHEN 12 THEN 'Un'
        ELSE CAST(l_suppkey % 13 AS VARCHAR) END) AS contig, count(*) AS n FROM lineitem GROUP BY ALL)
        WHERE contig NOT IN ('chrX', 'chrUn')""",
)
def autosome_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("l_suppkey") % 13
    contig = F.concat(
        F.lit("chr"), F.when(key == 11, "X").when(key == 12, "Un").otherwise(key.cast("string"))
    )
    rows = v.table(spark, sf_dir, "lineitem").select(contig.alias("contig"))
    return pn.autosome_filter(rows.groupBy("contig").agg(F.count("*").alias("n")))


# Matching of contigs ----------------------------------------------------------------------------

_HEADERS = {
    "headers": """SELECT c_custkey // 25 AS file,
        concat(CASE WHEN c_custkey // 25 % 4 = 1 THEN 'contig' ELSE 'chr' END, c_custkey % 25) AS contig,
        1000 + c_custkey % 25 // 2 + (CASE WHEN c_custkey % 113 = 0 THEN 7 ELSE 0 END) AS length FROM customer""",
    "panel": """SELECT CAST(n_nationkey AS VARCHAR) AS id, CAST(1000 + n_nationkey // 2 AS BIGINT) AS size
        FROM nation""",
    "matches": """SELECT file, id, CASE WHEN count(*) = 1 THEN min(contig)
            WHEN count(*) FILTER (contig = concat('chr', id)) = 1 THEN min(contig) FILTER (contig = concat('chr', id))
            END AS contig, count(*) AS candidates FROM headers JOIN panel ON length = size GROUP BY file, id""",
    "mito": """SELECT concat('chr', n_nationkey) AS contig, CAST(1000 + n_nationkey // 2 AS BIGINT) AS expected,
        CAST(n_nationkey // 2 AS BIGINT) AS padding FROM nation""",
    "hits": """SELECT o_custkey // 25 AS file, concat('chr', o_custkey % 25) AS contig, count(*) AS mapped
        FROM orders GROUP BY ALL""",
    "mito_matches": """SELECT h.file, contig, length, expected, padding, coalesce(mapped, 0) AS hits
        FROM headers h JOIN mito USING (contig) LEFT JOIN hits USING (file, contig)""",
}


def _headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    file, number = F.floor(key / 25), key % 25
    return v.table(spark, sf_dir, "customer").select(
        file.alias("file"),
        F.concat(
            F.when(file % 4 == 1, "contig").otherwise("chr"), number.cast("string")
        ).alias("contig"),
        (1000 + F.floor(number / 2) + F.when(key % 113 == 0, 7).otherwise(0)).alias("length"),
    )


def _panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey")
    return v.table(spark, sf_dir, "nation").select(
        key.cast("string").alias("id"), (1000 + F.floor(key / 2)).alias("size")
    )


def _mito_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey")
    sequences = v.table(spark, sf_dir, "nation").select(
        F.concat(F.lit("chr"), key.cast("string")).alias("name"),
        F.concat(
            F.repeat(F.lit("A"), (1000 + F.floor(key / 2)).cast("int")),
            F.repeat(F.lit("-"), 3),
        ).alias("sequence"),
    )
    hits = (
        v.table(spark, sf_dir, "orders")
        .groupBy(
            F.floor(F.col("o_custkey") / 25).alias("file"),
            F.concat(F.lit("chr"), (F.col("o_custkey") % 25).cast("string")).alias("contig"),
        )
        .agg(F.count("*").alias("mapped"))
    )
    return pn.match_mito_contig(sequences, _headers(spark, sf_dir), hits)


@query(
    "match_contigs",
    v.with_views(extra={k: _HEADERS[k] for k in ("headers", "panel", "matches")})
    + "SELECT file, id, contig, candidates FROM matches",
)
def match_contigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pn.match_contigs(_panel(spark, sf_dir), _headers(spark, sf_dir))


@query(
    "match_mito_contig",
    v.with_views(extra=_HEADERS)
    + "SELECT file, contig, length, expected, padding, hits FROM mito_matches",
)
def match_mito_contig(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mito_matches(spark, sf_dir)


@query(
    "classify_alignments",
    v.with_views(extra=_HEADERS)
    + """SELECT f.file, CASE WHEN NOT coalesce(fits, true) THEN 'invalid'
            WHEN coalesce(found, 0) > 0 AND found < (SELECT count(*) FROM panel) THEN 'invalid'
            WHEN coalesce(found, 0) > 0 AND fits AND n > 0 THEN 'both'
            WHEN coalesce(found, 0) > 0 THEN 'nuclear' WHEN fits AND n > 0 THEN 'mitochondrial'
            ELSE 'invalid' END AS kind
        FROM (SELECT DISTINCT file FROM headers) f
        LEFT JOIN (SELECT file, count(contig) AS found FROM matches GROUP BY file) m USING (file)
        LEFT JOIN (SELECT file, bool_and(length = expected) AS fits, sum(hits) AS n FROM mito_matches
            GROUP BY file) t USING (file)""",
)
def classify_alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers, panel = _headers(spark, sf_dir), _panel(spark, sf_dir)
    nuclear = pn.match_contigs(panel, headers)
    return pn.classify_alignments(headers, nuclear, _mito_matches(spark, sf_dir), panel)


@query(
    "check_contig_sets",
    v.with_views(extra={k: _HEADERS[k] for k in ("headers",)})
    + """SELECT f.file AS sample, concat('chr', n_nationkey) AS contig,
        CASE WHEN h.length IS NULL THEN 'missing' ELSE 'different size' END AS problem
        FROM (SELECT DISTINCT file FROM headers) f CROSS JOIN nation
        LEFT JOIN headers h ON h.file = f.file AND h.contig = concat('chr', n_nationkey)
        WHERE h.length IS NULL OR h.length <> 1000 + n_nationkey // 2""",
)
def check_contig_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    reference = _panel(spark, sf_dir).select(F.concat(F.lit("chr"), "id").alias("contig"), "size")
    samples = _headers(spark, sf_dir).withColumnsRenamed({"file": "sample", "length": "size"})
    return pn.check_contig_sets(reference, samples)


_PLOIDY = {
    "hits": """SELECT o_custkey % 25 AS n, count(*) AS hits FROM orders GROUP BY ALL""",
    "sized": """SELECT CASE n_nationkey WHEN 23 THEN 'X' WHEN 24 THEN 'Y'
            ELSE CAST(n_nationkey + 1 AS VARCHAR) END AS id,
        CAST(100000 + 1000 * n_nationkey AS BIGINT) AS size, CAST(100 * n_nationkey AS BIGINT) AS ns, hits
        FROM nation JOIN hits ON n = n_nationkey""",
}


def _ploidy_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey")
    panel = v.table(spark, sf_dir, "nation").select(
        F.when(key == 23, "X").when(key == 24, "Y").otherwise((key + 1).cast("string")).alias("id"),
        (100000 + 1000 * key).cast("long").alias("size"),
        (100 * key).cast("long").alias("ns"),
        F.concat(F.lit("chr"), key.cast("string")).alias("contig"),
    )
    hits = (
        v.table(spark, sf_dir, "orders")
        .groupBy(
            F.concat(F.lit("chr"), (F.col("o_custkey") % 26).cast("string")).alias("contig"),
            (F.col("o_custkey") % 25).alias("_n"),
        )
        .agg(F.count("*").alias("mapped"))
        .groupBy(F.concat(F.lit("chr"), F.col("_n").cast("string")).alias("contig"))
        .agg(F.sum("mapped").alias("mapped"))
    )
    return pn.contig_hits(hits, panel, panel)


@query(
    "contig_hits",
    v.with_views(extra=_PLOIDY) + "SELECT id, size, ns, hits FROM sized",
)
def contig_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ploidy_hits(spark, sf_dir)


@query(
    "relative_ploidy",
    v.with_views(
        extra=_PLOIDY
        | {
            "rates": """SELECT *, hits / CAST(size - ns AS DOUBLE) AS r, id NOT IN ('X', 'Y') AS autosome FROM sized""",
            "scaled": """SELECT *, 2 * r / (SELECT avg(r) FROM rates WHERE autosome) AS q FROM rates""",
        }
    )
    + """SELECT id, autosome, round(r, 9) AS rel_hits, round(q, 9) AS norm_hits,
        round((SELECT min(q) FROM scaled WHERE autosome), 9) AS female_low,
        round((SELECT max(q) FROM scaled WHERE autosome), 9) AS female_high,
        round((SELECT min(q) FROM scaled WHERE autosome) / 2, 9) AS male_low,
        round((SELECT max(q) FROM scaled WHERE autosome) / 2, 9) AS male_high FROM scaled""",
)
def relative_ploidy(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = pn.relative_ploidy(_ploidy_hits(spark, sf_dir))
    exact = ("id", "autosome")
    return result.select(
        *exact, *(F.round(name, 9).alias(name) for name in result.columns if name not in exact)
    )


# Consensus -----------------------------------------------------------------------------------

_COUNTS = {
    "read_bases": """SELECT contig, unnest(range(pos, pos + m1)) AS pos,
            unnest(string_split(substr(seq, clip + 1, m1), '')) AS base FROM reads WHERE flag & 1796 = 0
        UNION ALL SELECT contig, unnest(range(pos + m1 + del, ref_end)),
            unnest(string_split(substr(seq, clip + m1 + ins + 1, m2), '')) FROM reads WHERE flag & 1796 = 0""",
    "counts": "SELECT contig, pos, "
    + ", ".join(f"count(*) FILTER (base = '{base}') AS {base}" for base in mito.BASES)
    + " FROM read_bases GROUP BY contig, pos",
    "folded": """SELECT contig, CASE WHEN pos >= 9500 THEN pos - 9500 ELSE pos END AS pos,
        CAST(sum(A) AS BIGINT) AS A, CAST(sum(C) AS BIGINT) AS C, CAST(sum(G) AS BIGINT) AS G,
        CAST(sum(T) AS BIGINT) AS T, CAST(sum(N) AS BIGINT) AS N FROM counts GROUP BY 1, 2""",
}


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mito.base_counts(v.alignments(spark, sf_dir))


def _folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mito.fold_padding(_counts(spark, sf_dir), v.contigs(spark, sf_dir), 500)


@query("base_counts", v.with_views("reads", extra=_COUNTS) + "SELECT contig, pos, A, C, G, T, N FROM counts")
def base_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counts(spark, sf_dir)


@query(
    "base_counts_quality",
    v.with_views("reads")
    + """, quality_bases AS (SELECT contig, unnest(range(pos, pos + m1)) AS pos,
            unnest(string_split(substr(seq, clip + 1, m1), '')) AS base,
            unnest(coalesce(quals[clip + 1:clip + m1], list_resize(CAST([] AS INT[]), m1, 40))) AS q
            FROM reads WHERE flag & 1796 = 0
        UNION ALL SELECT contig, unnest(range(pos + m1 + del, ref_end)),
            unnest(string_split(substr(seq, clip + m1 + ins + 1, m2), '')),
            unnest(coalesce(quals[clip + m1 + ins + 1:], list_resize(CAST([] AS INT[]), m2, 40)))
            FROM reads WHERE flag & 1796 = 0)
        SELECT contig, count(*) FILTER (base <> 'N') AS called, count(*) FILTER (base = 'N') AS uncalled
        FROM quality_bases WHERE q >= 20 GROUP BY contig""",
)
def base_counts_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = mito.base_counts(v.alignments(spark, sf_dir), min_base_quality=20)
    return counts.groupBy("contig").agg(
        F.sum(F.col("A") + F.col("C") + F.col("G") + F.col("T")).alias("called"),
        F.sum("N").alias("uncalled"),
    )


@query("fold_padding", v.with_views("reads", extra=_COUNTS) + "SELECT contig, pos, A, C, G, T, N FROM folded")
def fold_padding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _folded(spark, sf_dir)


@query(
    "consensus",
    v.with_views(
        "reads",
        "contigs",
        extra=_COUNTS
        | {
            "called": """SELECT c.contig, s.i, CASE
                WHEN A > greatest(C, G, T) THEN 'A' WHEN C > greatest(A, G, T) THEN 'C'
                WHEN G > greatest(A, C, T) THEN 'G' WHEN T > greatest(A, C, G) THEN 'T' ELSE 'N' END AS base
                FROM contigs c CROSS JOIN range(0, 9500) AS s(i)
                LEFT JOIN folded f ON f.contig = c.contig AND f.pos = s.i"""
        },
    )
    + """SELECT contig, 0 AS chunk, string_agg(base, '' ORDER BY i) AS sequence FROM called GROUP BY contig""",
)
def consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mito.consensus(_folded(spark, sf_dir), v.contigs(spark, sf_dir), 500)


@query(
    "consensus_statistics",
    v.with_views("reads", extra=_COUNTS)
    + """SELECT contig AS sequence_name, CAST(9500 AS BIGINT) AS sequence_len,
        CAST(sum(A + C + G + T) AS BIGINT) AS nucleotides, count(*) FILTER (A + C + G + T > 0) AS covered_sites,
        round_even(100.0::DOUBLE * count(*) FILTER (A + C + G + T > 0) / 9500, 1) AS covered_pct,
        round_even(CAST(sum(A + C + G + T) AS DOUBLE) / 9500, 1) AS mean_coverage FROM folded GROUP BY contig""",
)
def consensus_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mito.consensus_statistics(_folded(spark, sf_dir), v.contigs(spark, sf_dir), 500)


# Genotype tables -------------------------------------------------------------------------------

SAMPLES = [f"s{k}" for k in range(5)]
_GENOTYPES = {
    "genotypes": """SELECT l_partkey AS snp, concat('s', l_suppkey % 5) AS sample,
        CASE WHEN l_orderkey % 23 <> 0 THEN l_linenumber % 3 END AS dosage FROM lineitem""",
    "per_sample": """SELECT snp, sample, coalesce(sum(dosage), 0) AS second, 2 * count(dosage) AS nchrobs
        FROM genotypes GROUP BY ALL""",
    "frequencies": """SELECT snp, sample, CAST(CASE WHEN is_second THEN 2 ELSE 1 END AS INT) AS minor,
        CAST(CASE WHEN is_second THEN second ELSE nchrobs - second END AS BIGINT) AS mac, nchrobs
        FROM (SELECT *, 2 * sum(second) OVER (PARTITION BY snp) <= sum(nchrobs) OVER (PARTITION BY snp) AS is_second
            FROM per_sample)""",
}


def _genotypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("snp"),
        F.concat(F.lit("s"), (F.col("l_suppkey") % 5).cast("string")).alias("sample"),
        F.when(F.col("l_orderkey") % 23 != 0, F.col("l_linenumber") % 3).alias("dosage"),
    )


@query(
    "allele_frequencies",
    v.with_views(extra=_GENOTYPES) + "SELECT snp, sample, minor, mac, nchrobs FROM frequencies",
)
def allele_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pn.allele_frequencies(_genotypes(spark, sf_dir))


@query(
    "treemix_counts",
    v.with_views(extra=_GENOTYPES)
    + "SELECT snp, "
    + ", ".join(
        f"max(concat(mac, ',', nchrobs - mac)) FILTER (sample = '{name}') AS {name}" for name in SAMPLES
    )
    + " FROM frequencies GROUP BY snp",
)
def treemix_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pn.treemix_counts(pn.allele_frequencies(_genotypes(spark, sf_dir)), SAMPLES)


_MATRICES = {
    "covariance": """SELECT vec_id // 64 AS matrix, vec_id % 64 AS "row", i - 1 AS col,
        CAST(embedding[i] AS DOUBLE) AS value, CAST(embedding[i] AS DOUBLE) * 0.5 + vec_id % 7 / 100.0::DOUBLE AS model
        FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)""",
}


def _matrices(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    cells = v.table(spark, sf_dir, "embeddings").select(
        F.floor(F.col("vec_id") / 64).alias("matrix"),
        (F.col("vec_id") % 64).alias("row"),
        (F.col("vec_id") % 7 / 100.0).alias("_shift"),
        F.posexplode("embedding").alias("col", "value"),
    )
    cells = cells.withColumns({"value": F.col("value").cast("double"), "col": F.col("col").cast("long")})
    model = cells.select(
        "matrix", "row", "col", (F.col("value") * 0.5 + F.col("_shift")).alias("value")
    )
    return cells.drop("_shift"), model


@query(
    "treemix_variance",
    v.with_views(extra=_MATRICES)
    + """SELECT matrix, round(1 - var_samp(value - model) / var_samp(value), 6) AS explained
        FROM covariance WHERE "row" < col GROUP BY matrix""",
)
def treemix_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = pn.treemix_variance(*_matrices(spark, sf_dir), ["matrix"])
    return result.select("matrix", F.round("explained", 6).alias("explained"))


@query(
    "treemix_residuals",
    v.with_views(extra=_MATRICES)
    + """SELECT matrix, "row", col, round(value - model, 9) AS residual FROM covariance""",
)
def treemix_residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = pn.treemix_residuals(*_matrices(spark, sf_dir), ["matrix"])
    return result.withColumn("residual", F.round("residual", 9))


@query(
    "mean_standard_error",
    v.with_views(extra=_MATRICES)
    + """SELECT matrix, round(avg(mean), 9) AS mean_se FROM (SELECT matrix, "row", avg(value) AS mean
        FROM covariance GROUP BY ALL) GROUP BY matrix""",
)
def mean_standard_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    covariance, _ = _matrices(spark, sf_dir)
    return pn.mean_standard_error(covariance, ["matrix"]).withColumn(
        "mean_se", F.round("mean_se", 9)
    )


@query(
    "covariance_is_valid",
    v.with_views(extra=_MATRICES)
    + """SELECT matrix, NOT bool_or(matrix % 3 = 1 AND "row" = 5 AND col = 9) AS valid
        FROM covariance GROUP BY matrix""",
)
def covariance_is_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    covariance, _ = _matrices(spark, sf_dir)
    hole = (F.col("matrix") % 3 == 1) & (F.col("row") == 5) & (F.col("col") == 9)
    broken = covariance.withColumn(
        "value", F.when(hole, F.lit(float("nan"))).otherwise(F.col("value"))
    )
    return pn.covariance_is_valid(broken, ["matrix"])


_SCALED = {
    "wide": """SELECT snp, sample, max(dosage) AS d FROM genotypes GROUP BY ALL""",
    "grid": """SELECT snp, sample, avg(d) OVER (PARTITION BY snp) AS mean, d FROM
        (SELECT s.snp, n.sample, w.d FROM (SELECT DISTINCT snp FROM genotypes) s
         CROSS JOIN (SELECT concat('s', i) AS sample FROM range(0, 5) AS r(i)) n
         LEFT JOIN wide w ON w.snp = s.snp AND w.sample = n.sample)""",
    "scaled": """SELECT snp, sample, coalesce(d - mean, 0) / sqrt(mean / 2 * (1 - mean / 2)) AS x FROM grid
        WHERE mean > 0 AND mean < 2""",
}


@query(
    "genotype_covariance",
    v.with_views(extra={"genotypes": _GENOTYPES["genotypes"]} | _SCALED)
    + """SELECT CAST(substr(a.sample, 2) AS INT) AS "row", CAST(substr(b.sample, 2) AS INT) AS col,
        round(sum(a.x * b.x) / count(*), 6) AS value FROM scaled a JOIN scaled b USING (snp)
        GROUP BY a.sample, b.sample""",
)
def genotype_covariance(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = pca.genotype_covariance(_genotypes(spark, sf_dir), SAMPLES)
    return result.withColumn("value", F.round("value", 6))


@query("genotype_pca")
def genotype_pca(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = pca.genotype_pca(_genotypes(spark, sf_dir), SAMPLES)
    return result.select(
        "component", F.round("eigenvalue", 6).alias("eigenvalue"), "sample", F.round("coordinate", 6).alias("coordinate")
    )


_SUPPLIERS = {
    "genotypes": """SELECT l_partkey AS snp, l_suppkey AS sample, l_linenumber % 3 AS dosage FROM lineitem""",
    "wide": """SELECT snp, sample, max(dosage) AS d FROM genotypes GROUP BY ALL""",
    "scaled": """SELECT snp, sample, (d - mean) / sqrt(mean / 2 * (1 - mean / 2)) AS x FROM
        (SELECT *, avg(d) OVER (PARTITION BY snp) AS mean FROM wide) WHERE mean > 0 AND mean < 2""",
}


def _supplier_genotypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier is a sample, so that there are more of them with every scale."""
    return v.table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("snp"),
        F.col("l_suppkey").cast("string").alias("sample"),
        (F.col("l_linenumber") % 3).alias("dosage"),
    )


def _eigen_sql(samples: str, components: int) -> str:
    """A row for each component and sample, all of which solve their equation; norms are one."""
    return f"""SELECT CAST(c AS INT) AS component, sample, true AS solves, true AS unit
        FROM range(1, {components + 1}) AS r(c), ({samples})"""


def _eigen_rows(genotypes: DataFrame, samples: DataFrame, components: int) -> DataFrame:
    """Whether G v = lambda v holds for each sample, G v being summed from the genotypes alone."""
    found = pca.genotype_pca(genotypes, samples, components, 2e-8)
    z = pca.normalised_genotypes(genotypes, samples)
    per_site = z.join(found, "sample").groupBy("snp", "component").agg(
        F.sum(F.col("z") * F.col("coordinate")).alias("w")
    )
    sites = z.agg(F.count_distinct("snp")).scalar()
    product = z.join(per_site, "snp").groupBy("component", "sample").agg(F.sum(F.col("z") * F.col("w")).alias("gv"))
    norms = found.groupBy("component").agg(F.sum(F.col("coordinate") * F.col("coordinate")).alias("norm"))
    gap = F.coalesce("gv", F.lit(0.0)) / sites - F.col("eigenvalue") * F.col("coordinate")
    return (
        found.join(product, ["component", "sample"], "left")
        .join(norms, "component")
        .select(
            "component",
            "sample",
            (F.abs(gap) <= 1e-7 * F.col("eigenvalue")).alias("solves"),
            (F.abs(F.col("norm") - 1) < 1e-9).alias("unit"),
        )
    )


@query(
    "genotype_pca_equations",
    v.with_views(extra=_SUPPLIERS)
    + _eigen_sql("SELECT DISTINCT CAST(sample AS VARCHAR) AS sample FROM genotypes", 3),
)
def genotype_pca_equations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leading components of all suppliers solve G v = lambda v, sample by sample."""
    genotypes = _supplier_genotypes(spark, sf_dir)
    return _eigen_rows(genotypes, genotypes.select("sample").distinct(), 3)


@query(
    "genotype_pca_rebuilt",
    v.with_views(extra={"genotypes": _GENOTYPES["genotypes"]} | _SCALED)
    + """SELECT a.sample AS sample, b.sample AS other, round(sum(a.x * b.x) / count(*), 6) AS value
        FROM scaled a JOIN scaled b USING (snp) GROUP BY a.sample, b.sample""",
)
def genotype_pca_rebuilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of all components together the covariance can be built again, which SQL computes from the rows."""
    found = pca.genotype_pca(_genotypes(spark, sf_dir), SAMPLES, len(SAMPLES))
    other = found.select("component", F.col("sample").alias("other"), F.col("coordinate").alias("_c"))
    value = F.sum(F.col("eigenvalue") * F.col("coordinate") * F.col("_c"))
    both = found.join(other, "component").groupBy("sample", "other")
    return both.agg((F.round(value, 6) + 0.0).alias("value"))


@query(
    "pca_outliers",
    v.with_views(extra=_SUPPLIERS) + "SELECT DISTINCT CAST(sample AS VARCHAR) AS sample FROM genotypes",
)
def pca_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples left after the outlier pass: all but one, which differs from all others at many sites."""
    genotypes = _supplier_genotypes(spark, sf_dir)
    further = genotypes.withColumns({"snp": -F.col("snp"), "dosage": F.lit(0).cast("long")})
    strange = further.select("snp", F.lit("strange").alias("sample"), F.lit(2).cast("long").alias("dosage")).distinct()
    everything = genotypes.withColumn("dosage", F.col("dosage").cast("long")).unionByName(further)
    return pca.without_outliers(everything.unionByName(strange), None, 2.9, 1)


# Admixture -----------------------------------------------------------------------------------

_FRACTIONS = {
    "weights": """SELECT o_custkey % 50 AS run, o_orderkey % 9 AS s, o_orderkey // 9 % 3 AS component,
        sum(CASE WHEN floor(o_totalprice) % 100 = 0 THEN floor(o_totalprice) ELSE 0 END) AS w
        FROM orders GROUP BY ALL""",
    "fractions": """SELECT run, CASE WHEN s = 0 THEN '-' ELSE concat('s', s) END AS sample, component,
        w / (sum(w) OVER (PARTITION BY run, s) + 1) AS fraction FROM weights""",
    "groups": """SELECT concat('s', i) AS sample, concat('G', i % 3) AS "group" FROM range(1, 9) AS r(i)""",
}


def _fractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, price = F.col("o_orderkey"), F.floor("o_totalprice")
    weights = (
        v.table(spark, sf_dir, "orders")
        .groupBy(
            (F.col("o_custkey") % 50).alias("run"),
            (key % 9).alias("s"),
            (F.floor(key / 9) % 3).alias("component"),
        )
        .agg(F.sum(F.when(price % 100 == 0, price).otherwise(0)).cast("double").alias("w"))
    )
    return weights.select(
        "run",
        F.when(F.col("s") == 0, "-")
        .otherwise(F.concat(F.lit("s"), F.col("s").cast("string")))
        .alias("sample"),
        "component",
        (F.col("w") / (F.sum("w").over(Window.partitionBy("run", "s")) + 1)).alias("fraction"),
    )


def _groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        v.table(spark, sf_dir, "orders")
        .select((F.col("o_orderkey") % 9).alias("s"))
        .distinct()
        .where("s > 0")
        .select(
            F.concat(F.lit("s"), F.col("s").cast("string")).alias("sample"),
            F.concat(F.lit("G"), (F.col("s") % 3).cast("string")).alias("group"),
        )
    )


@query(
    "ancestral_groups",
    v.with_views(extra=_FRACTIONS)
    + """SELECT t.run, t.component, t.fraction AS value, coalesce((SELECT string_agg(g, ' / ' ORDER BY g) FROM
        (SELECT DISTINCT "group" AS g FROM fractions f JOIN groups USING (sample)
         WHERE f.run = t.run AND f.component = t.component AND f.fraction >= 0.001)), '') AS groups
        FROM fractions t WHERE sample = '-'""",
)
def ancestral_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad.ancestral_groups(_fractions(spark, sf_dir), _groups(spark, sf_dir), ["run"])


@query(
    "mixed_groups",
    v.with_views(extra=_FRACTIONS)
    + """SELECT run, "group", count(DISTINCT component) AS n_components FROM fractions JOIN groups USING (sample)
        WHERE fraction >= 0.001 GROUP BY run, "group" HAVING count(DISTINCT component) > 1""",
)
def mixed_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad.mixed_groups(_fractions(spark, sf_dir), _groups(spark, sf_dir), ["run"])


_CALLS = {
    "calls": """SELECT run, count(*) FILTER (fraction >= 0.001) AS n_components FROM fractions
        WHERE sample = '-' GROUP BY run"""
}


@query(
    "admixture_calls",
    v.with_views(extra=_FRACTIONS | _CALLS)
    + """SELECT run, n_components, CASE WHEN n_components < 2 THEN 'none' WHEN n_components = 2 THEN 'hybrid'
        ELSE 'complex' END AS call FROM calls""",
)
def admixture_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad.admixture_calls(_fractions(spark, sf_dir), ["run"])


@query(
    "positive_tests",
    v.with_views(extra=_FRACTIONS | _CALLS)
    + """SELECT run % 10 AS sample, count(*) AS n_tests, count(*) FILTER (n_components > 1) AS n_positive
        FROM calls GROUP BY 1""",
)
def positive_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = ad.admixture_calls(_fractions(spark, sf_dir), ["run"])
    return ad.positive_tests(calls.withColumn("sample", F.col("run") % 10), ["sample"])


_SIMULATIONS = {
    "sims": """SELECT 1000 * (user_id % 4 + 1) AS n_reads, 2 + event_id % 2 AS k,
        concat('G', event_id % 3) AS other, event_id // 2 % 2 = 0 AS has_ts,
        event_id % 1000 / 1000.0::DOUBLE AS percentile, value / 1000.0::DOUBLE AS value FROM events""",
    "tests": """SELECT n_nationkey AS test, 500 + n_nationkey * 173 AS n_reads, 2 + n_nationkey % 2 AS k,
        concat('G', n_nationkey % 3) AS other, n_nationkey // 2 % 2 = 0 AS has_ts,
        n_nationkey * 19 % 490 / 1000.0::DOUBLE AS value FROM nation""",
    "sided": """SELECT test, 'lower' AS side, k, other, has_ts, value,
            (SELECT max(n_reads) FROM sims s WHERE s.n_reads <= t.n_reads) AS n_reads FROM tests t
        UNION ALL SELECT test, 'upper', k, other, has_ts, value,
            (SELECT min(n_reads) FROM sims s WHERE s.n_reads >= t.n_reads) FROM tests t""",
    "selected": """SELECT t.test, t.side, CAST(t.n_reads AS BIGINT) AS n_reads, t.value, s.percentile,
        s.value AS sim_value FROM sided t LEFT JOIN sims s ON s.n_reads = t.n_reads AND s.k = t.k
            AND s.other = t.other AND s.has_ts = t.has_ts WHERE t.n_reads IS NOT NULL""",
    "bounds": """SELECT test, side, n_reads, coalesce(max(percentile) FILTER (NOT above), 0.0::DOUBLE) AS lower,
        coalesce(min(percentile) FILTER (NOT below), 1.0::DOUBLE) AS upper FROM (
            SELECT *, bool_or(sim_value > value) OVER (PARTITION BY test, side ORDER BY percentile, sim_value
                    ROWS UNBOUNDED PRECEDING) AS above,
                bool_or(sim_value < value) OVER (PARTITION BY test, side ORDER BY percentile DESC, sim_value DESC
                    ROWS UNBOUNDED PRECEDING) AS below FROM selected) GROUP BY ALL""",
}


def _selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    event, nation = F.col("event_id"), F.col("n_nationkey")

    def swapped(key, other):
        return (
            F.when(key % 5 < 2, "ref").otherwise(other).alias("sample1"),
            F.when(key % 5 < 2, other).otherwise("ref").alias("sample2"),
        )

    simulations = v.table(spark, sf_dir, "events").select(
        (1000 * (F.col("user_id") % 4 + 1)).alias("n_reads"),
        (2 + event % 2).alias("k"),
        *swapped(event, F.concat(F.lit("G"), (event % 3).cast("string"))),
        (F.floor(event / 2) % 2 == 0).alias("has_ts"),
        (event % 1000 / 1000.0).alias("percentile"),
        (F.col("value") / 1000.0).alias("value"),
    )
    tests = v.table(spark, sf_dir, "nation").select(
        nation.alias("test"),
        (500 + nation * 173).cast("long").alias("n_reads"),
        (2 + nation % 2).cast("long").alias("k"),
        *swapped(nation, F.concat(F.lit("G"), (nation % 3).cast("string"))),
        (F.floor(nation / 2) % 2 == 0).alias("has_ts"),
        (nation * 19 % 490 / 1000.0).alias("value"),
    )
    return ad.asof_simulations(tests, simulations)


@query(
    "asof_simulations",
    v.with_views(extra=_SIMULATIONS)
    + """SELECT test, side, n_reads, count(percentile) AS n, min(sim_value) AS low, max(sim_value) AS high
        FROM selected GROUP BY ALL""",
)
def asof_simulations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _selected(spark, sf_dir)
        .groupBy("test", "side", "n_reads")
        .agg(
            F.count("percentile").alias("n"),
            F.min("sim_value").alias("low"),
            F.max("sim_value").alias("high"),
        )
    )


@query(
    "percentile_bounds",
    v.with_views(extra=_SIMULATIONS) + "SELECT test, side, n_reads, lower, upper FROM bounds",
)
def percentile_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad.percentile_bounds(_selected(spark, sf_dir))


@query(
    "percent_range",
    v.with_views(extra=_SIMULATIONS)
    + """SELECT test,
        100 * (1 - greatest(coalesce(l.upper, u.upper), coalesce(u.lower, l.lower))) AS lower_pct,
        100 * (1 - least(coalesce(l.upper, u.upper), coalesce(u.lower, l.lower))) AS upper_pct,
        least(coalesce(l.n_reads, u.n_reads), coalesce(u.n_reads, l.n_reads)) AS min_reads,
        greatest(coalesce(l.n_reads, u.n_reads), coalesce(u.n_reads, l.n_reads)) AS max_reads,
        CASE WHEN l.n_reads IS NULL THEN 'over' WHEN u.n_reads IS NULL THEN 'under' ELSE 'none' END AS estimate
        FROM (SELECT * FROM bounds WHERE side = 'lower') l
        FULL JOIN (SELECT * FROM bounds WHERE side = 'upper') u USING (test)""",
)
def percent_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad.percent_range(ad.percentile_bounds(_selected(spark, sf_dir)))


@query(
    "best_replicate",
    """SELECT o_custkey AS run, arg_max(o_orderkey, -o_totalprice) AS replicate, max(-o_totalprice) AS loglik
        FROM orders GROUP BY o_custkey""",
)
def best_replicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = v.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("run"),
        F.col("o_orderkey").alias("replicate"),
        (-F.col("o_totalprice")).alias("loglik"),
    )
    return ad.best_replicate(rows, ["run"])


@query(
    "tranche_table",
    """WITH tranches AS (SELECT o_custkey AS run, o_orderkey / 1000.0::DOUBLE AS sens,
            CAST(floor(o_totalprice) AS BIGINT) AS n, o_orderkey * 7 % 300 / 100.0::DOUBLE AS titv FROM orders),
        counted AS (SELECT *, round_even((1 - greatest(least(1 - (titv - 0.5) / (2.07 - 0.5), 1.0::DOUBLE),
            0.001::DOUBLE)) * n, 0) AS good FROM tranches),
        shifted AS (SELECT *, n - good AS bad, lead(good, 1, 0) OVER w AS next_good, lead(n - good, 1, 0) OVER w AS next_bad
            FROM counted WINDOW w AS (PARTITION BY run ORDER BY sens DESC))
        SELECT run, sens AS truth_sensitivity, titv AS novel_titv, next_good AS cum_tps, good - next_good AS tranche_tps,
            bad - next_bad AS tranche_fps, next_bad AS cum_fps, next_good + next_bad AS total_novel FROM shifted""",
)
def tranche_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    rows = v.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("run"),
        (key / 1000.0).alias("truth_sensitivity"),
        F.floor("o_totalprice").alias("num_novel"),
        (key * 7 % 300 / 100.0).alias("novel_titv"),
    )
    return ad.tranche_table(rows, 2.07, ["run"])


@query(
    "pc_variance",
    """SELECT o_custkey AS run, o_orderkey AS component,
        round(floor(o_totalprice) / sum(floor(o_totalprice)) OVER (PARTITION BY o_custkey), 3) AS share FROM orders""",
)
def pc_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = v.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("run"),
        F.col("o_orderkey").alias("component"),
        F.floor("o_totalprice").alias("eigenvalue"),
    )
    return ad.pc_variance(rows, ["run"])


# Trees ---------------------------------------------------------------------------------------


def _leaves(key: str, step: str) -> list[str]:
    return [f"concat('L', ({key} + {k} * (1 + {step} % 2)) % 5)" for k in range(5)]


def _newick(key: str, step: str) -> str:
    a, b, c, d, e = _leaves(key, step)
    return f"concat('((', {a}, ',', {b}, '),(', {c}, ',', {d}, '):0.5,', {e}, ':1);')"


def tree_views() -> dict[str, str]:
    a, b, c, d, e = "abcde"
    sets = [[x] for x in "abcde"] + [[a, b], [c, d], [c, d, e], [a, b, e]]
    sets += [[x for x in "abcde" if x != y] for y in "abcde"]
    lists = ", ".join(f"array_to_string(list_sort([{', '.join(it)}]), ',')" for it in sets)
    columns = ", ".join(
        f"{text} AS {name}" for name, text in zip("abcde", _leaves("o_orderkey", "o_custkey"), strict=True)
    )
    return {
        "labelled": f"SELECT o_orderkey AS tree_id, {columns} FROM orders",
        "clades": f"SELECT tree_id, unnest([{lists}]) AS clade FROM labelled",
        "support": "SELECT clade, count(*) AS support FROM clades GROUP BY clade",
    }


def trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS tree_id", f"{_newick('o_orderkey', 'o_custkey')} AS newick"
    )


@query("clade_support", v.with_views(extra=tree_views()) + "SELECT clade, support FROM support")
def clade_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tr.clade_support(trees(spark, sf_dir))


@query(
    "tree_leaves",
    v.with_views(extra=tree_views())
    + """SELECT tree_id, array_to_string(list_sort([a, b, c, d, e]), ',') AS leaves, false AS duplicated
        FROM labelled""",
)
def tree_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tr.tree_leaves(trees(spark, sf_dir))


_MAIN = ", ".join(
    f"{text} AS {name}" for name, text in zip("abcde", _leaves("n_nationkey", "n_regionkey"), strict=True)
)


@query(
    "annotate_support",
    v.with_views(
        extra=tree_views()
        | {
            "main": f"SELECT CAST(n_nationkey AS BIGINT) AS tree_id, {_MAIN} FROM nation",
            "looked_up": """SELECT m.*, coalesce(p.support, 0) AS first, coalesce(q.support, 0) AS second FROM main m
                LEFT JOIN support p ON p.clade = array_to_string(list_sort([a, b]), ',')
                LEFT JOIN support q ON q.clade = array_to_string(list_sort([c, d]), ',')""",
        }
    )
    + """SELECT tree_id, concat('((', a, ',', b, ')', first, ',(', c, ',', d, ')', second, ':0.5,', e, ':1);')
        AS newick FROM looked_up""",
)
def annotate_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    main = v.table(spark, sf_dir, "nation").selectExpr(
        "cast(n_nationkey as bigint) AS tree_id", f"{_newick('n_nationkey', 'n_regionkey')} AS newick"
    )
    return tr.annotate_support(main, trees(spark, sf_dir))


@query("differing_leaves", "SELECT CAST(n_nationkey AS BIGINT) AS tree_id FROM nation WHERE n_nationkey % 3 <> 1")
def differing_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trees with a leaf of another name, or with one of them twice."""
    leaf = "CASE n_nationkey % 3 WHEN 0 THEN 'X' WHEN 1 THEN 'L3' ELSE 'L2' END"
    main = v.table(spark, sf_dir, "nation").selectExpr(
        "cast(n_nationkey as bigint) AS tree_id", f"concat('((L0,L1),(L2,', {leaf}, '):0.5,L4:1);') AS newick"
    )
    return tr.differing_leaves(main, trees(spark, sf_dir))


@query(
    "branch_support",
    v.with_views(extra=tree_views())
    + """SELECT len(string_split(clade, ',')) AS size, support, count(*) AS n FROM support GROUP BY ALL""",
)
def branch_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clades known by their keys, as many as there are of each size and support."""
    keys = tr.clade_keys(trees(spark, sf_dir))
    return keys.groupBy("size", "support").agg(F.count("*").alias("n"))


@query(
    "conflicting_files",
    """SELECT c_nationkey AS sample, count(*) FILTER (c_custkey % 40 IN (1, 3)) AS n_nuclear,
        count(*) FILTER (c_custkey % 40 IN (2, 3)) AS n_mitochondrial FROM customer GROUP BY c_nationkey
        HAVING n_nuclear > 1 OR n_mitochondrial > 1""",
)
def conflicting_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.element_at(
        F.create_map(*(F.lit(it) for it in (1, "nuclear", 2, "mitochondrial", 3, "both"))),
        (F.col("c_custkey") % 40).cast("int"),
    )
    files = v.table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("sample"), F.col("c_custkey").alias("file"), F.coalesce(kind, F.lit("invalid")).alias("kind")
    )
    return pn.conflicting_files(files)
