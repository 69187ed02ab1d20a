"""Operators on panels of variable sites: building, matching and sampling them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.functions import cigar as C
from helixframe.functions import hashing
from helixframe.functions.binding import bound
from helixframe.functions.sequences import (
    autosome_or_sex_name,
    is_autosome,
    is_transition,
    panel_alleles,
)
from helixframe.operators.alignments import exclude_default_flags
from helixframe.operators.msa import (
    PLANE_COLUMNS,
    SET_CODES,
    TWO_BASES,
    ascii_bytes,
    chunks,
    part_of,
    plane,
    set_digits,
)
from helixframe.plans.intervals import overlap_join
from helixframe.plans.session import cut_lineage
from helixframe.plans.skew import skew_join

#: Sites of a chunk whose bases travel together; that many texts of one letter per sample meet in a row.
SITES_PER_ROW = 256
#: Reads of a site that sampling starts with where it has more than four times as many.
FIRST_READS = 256
#: One in so many reads is counted to tell how many a site has.
COUNTED = 64


def reads_at_sites(
    alignments: DataFrame, sites: DataFrame, width: int | None = None
) -> DataFrame:
    """Bases of the reads at the sites of a panel: ``(contig, pos, read_id, base, ...)``.

    ``sites`` holds (contig, pos), 1-based, and further columns, which are kept. Only aligned
    bases other than ``N`` count, of records that pass the default flag filter. ``width`` is the
    bin width of the join, a power of two; long reads want one of the order of their length.
    """
    reads = exclude_default_flags(alignments).where(F.col("cigar").isNotNull())
    blocks = reads.select(
        "read_id", "contig", "seq", F.inline(C.aligned_blocks(F.col("pos"), F.col("cigar")))
    ).select(
        "read_id",
        "contig",
        "ref_start",
        "ref_end",
        F.substring(
            F.col("seq"),
            F.col("query_start") + 1,
            (F.col("ref_end") - F.col("ref_start")).cast("int"),
        ).alias("_bases"),
    )
    points = sites.withColumns({"_from": F.col("pos") - 1, "_to": F.col("pos")})
    base = F.substring(
        F.col("_bases"), (F.col("_from") - F.col("ref_start") + 1).cast("int"), F.lit(1)
    )
    return (
        overlap_join(blocks, points, ("ref_start", "ref_end"), ("_from", "_to"), width=width)
        .withColumn("base", base)
        .where(F.col("base") != "N")
        .drop("_bases", "_from", "_to", "ref_start", "ref_end")
    )


def with_alleles(sites: DataFrame) -> DataFrame:
    """Replace the genotypes of a panel by ``alleles``, the distinct bases as a text.

    Reads are joined to this rather than to a code per sample.
    """
    alleles = F.array_join(F.array_sort(F.array_distinct(panel_alleles(F.col("genotypes")))), "")
    return sites.withColumn("alleles", alleles).drop("genotypes")


def observed_allele_filter(bases: DataFrame) -> DataFrame:
    """Keep bases that occur among the ``alleles`` of the panel."""
    return bases.where(F.col("alleles").contains(F.col("base")))


def exclude_transitions(sites: DataFrame) -> DataFrame:
    """Drop sites whose alleles are exactly A and G or C and T."""
    return sites.where(~is_transition(panel_alleles(F.col("genotypes"))))


def sample_panel_sites(bases: DataFrame, seed: int = 0) -> DataFrame:
    """Choose one random base per site: ``(contig, pos, read_id, base)``.

    ``bases`` holds (contig, pos, read_id, base, alleles).

    Sites are visited by position, each choosing among its reads those that were not used before;
    the site is kept, and its read used up, only if the panel has the base. The random choice is
    the read with the smallest hash of (seed, read, site).

    A site chooses among its first reads by hash unless sites before it used up all of those. So the walk
    starts with about ``FIRST_READS`` of them where a site has many more, and only these are materialised; how
    many a site has is estimated from one in ``COUNTED`` reads. The choices are exact as long as no shortened
    site runs out of reads; if one does, the walk is repeated with eight times as many.
    """
    site = ["contig", "pos"]
    counted = bases.where(F.pmod(F.xxhash64("read_id"), F.lit(COUNTED)) == 0)
    depths = cut_lineage(counted.groupBy(*site).agg((F.count("*") * COUNTED).alias("_depth")))
    wanted = FIRST_READS
    while True:
        # Hashes are hexadecimal digits, so that a share of them is all that is less than some digits
        share = F.hex((F.lit(float(1 << 32)) * wanted / F.col("_depth")).cast("long"))
        upto = cut_lineage(
            depths.where(F.col("_depth") > 4 * wanted).select(*site, F.lower(F.lpad(share, 8, "0")).alias("_upto"))
        )
        settled = _walk_sites(_first_reads(bases, upto, seed))
        if settled is None:
            done = upto.limit(0)
        else:
            done = settled.select(*site)
        if upto.join(done, site, "left_anti").isEmpty():
            break
        wanted *= 8
    if settled is None:
        return bases.select(*site, "read_id", "base")
    return settled.where("choice.allowed").select(*site, "choice.read_id", "choice.base")


def _first_reads(bases: DataFrame, upto: DataFrame, seed: int) -> DataFrame:
    """Every site's choices ``(contig, pos, read_id, choice)``, of the sites in ``upto`` those with hashes below it."""
    site = ["contig", "pos"]
    rank = hashing.digest(seed, F.col("read_id"), F.col("pos"))
    if not upto.isEmpty():
        bases = skew_join(bases, upto, site, "left", salt_by=["read_id"]).where(
            F.col("_upto").isNull() | (rank < F.col("_upto"))
        )
    allowed = F.col("alleles").contains(F.col("base"))
    choice = F.struct(rank.alias("rank"), "read_id", "base", allowed.alias("allowed"))
    return bases.select(*site, "read_id", choice.alias("choice"))


def _walk_sites(reads: DataFrame) -> DataFrame | None:
    """What every site chooses, ``(contig, pos, choice)``, also where the panel lacks the base; None without reads.

    A site depends on earlier ones only through shared reads, and this is resolved in rounds over
    all sites at once. A read is safe at a site if no earlier open site could use it. What a site
    chooses is its first safe read or one before it, so the reads after that are dropped, which
    leaves few; once the first read itself is safe, the site is settled, and a used read leaves
    all other sites. The first open site of a contig is settled in every round, and commonly all
    that share no reads with open ones. Rounds shrink quickly and are cut by checkpoints.
    """
    site = ["contig", "pos"]
    open_reads = cut_lineage(reads)
    settled: list[DataFrame] = []
    while not open_reads.isEmpty():
        first_use = (
            open_reads.where("choice.allowed")
            .groupBy("read_id")
            .agg(F.min("pos").alias("_first_use"))
        )
        # A read covers a bounded number of sites, so that this join is balanced
        known = open_reads.join(first_use, "read_id", "left")
        safe = F.col("_first_use").isNull() | (F.col("_first_use") >= F.col("pos"))
        limits = cut_lineage(known.where(safe).groupBy(*site).agg(F.min("choice").alias("_limit")))
        pruned = cut_lineage(
            skew_join(open_reads, limits, site, "left", salt_by=["read_id"]).where(
                F.col("_limit").isNull() | (F.col("choice") <= F.col("_limit"))
            )
        )
        done = cut_lineage(
            pruned.groupBy(*site)
            .agg(F.min("choice").alias("choice"), F.max("_limit").alias("_limit"))
            .where(F.col("choice") == F.col("_limit"))
            .select(*site, "choice")
        )
        used = done.where("choice.allowed").select("choice.read_id")
        settled.append(done)
        open_reads = cut_lineage(
            pruned.drop("_limit")
            .join(done.select(*site), site, "left_anti")
            .join(used, "read_id", "left_anti")
        )
    return reduce(DataFrame.unionByName, settled) if settled else None


def site_statistics(
    alignments: DataFrame, sites: DataFrame, bases: DataFrame, sampled: DataFrame
) -> DataFrame:
    """Reads on the contigs of the panel, reads at its sites, and sampled sites.

    ``sites`` holds (contig, pos, genotypes), ``sampled`` (contig, pos).
    """
    contigs = sites.select("contig").distinct()
    n_reads = (
        skew_join(exclude_default_flags(alignments), contigs, ["contig"], "left_semi")
        .agg(F.count("*").alias("n_reads"))
    )
    n_used = bases.select("read_id").distinct().agg(F.count("*")).scalar()
    transition = is_transition(panel_alleles(F.col("genotypes")))
    n_sites = (
        sampled.join(sites, ["contig", "pos"])
        .agg(
            F.struct(F.count("*").alias("incl_ts"), F.count_if(~transition).alias("excl_ts"))
        )
        .scalar()
    )
    return n_reads.withColumn("_sites", n_sites).select(
        "n_reads",
        n_used.alias("n_reads_used"),
        F.col("_sites.incl_ts").alias("n_sites_incl_ts"),
        F.col("_sites.excl_ts").alias("n_sites_excl_ts"),
    )


def block_size(n_sites, genome_size, snp_distance):
    """Sites per block such that blocks span at least ``snp_distance`` bases."""
    return F.greatest(F.lit(1), F.ceil(snp_distance / (genome_size / n_sites)).cast("long"))


def biallelic_sites(samples: DataFrame, reference: DataFrame, n_samples: int) -> DataFrame:
    """Panel of the bi-allelic sites of aligned genomes: ``(contig, pos, ref, genotypes)``.

    ``samples`` holds (contig, chunk_start, idx, sequence), ``reference`` the same without idx;
    long contigs are stored in chunks. Columns with a missing base are dropped; the others are
    kept if the bases of all samples are exactly two. ``pos`` is 1-based.

    The sets of bases are combined as planes, and only the planes are shuffled. A missing base counts
    as all four, which makes its column one of more than two. The places that are left come in lists of
    ``SITES_PER_ROW``; what a genome has there is looked up in its chunk and travels as one text per list.
    """
    key = ["contig", "chunk_start"]

    def plain(rows: DataFrame, *columns: str) -> DataFrame:
        codes = F.regexp_replace(F.upper("sequence"), f"[^{SET_CODES}]", "N")
        return rows.select(*key, *columns, ascii_bytes(codes).alias("_bytes"))

    cut = chunks(samples.select(*key, "sequence"), PLANE_COLUMNS)
    sets = (
        cut.groupBy(*key, "chunk")
        .agg(F.bitmap_or_agg(plane(set_digits(F.col("bases"), "F"), "F")).alias("_plane"), F.count("*").alias("_n"))
        .where(F.col("_n") == n_samples)
    )
    two = [it.encode() for it in TWO_BASES]
    places = bound(
        ascii_bytes(F.hex("_plane")),
        lambda digits: F.filter(
            F.sequence(F.lit(0), F.lit(PLANE_COLUMNS - 1)),
            lambda at: F.substring(digits, at + 1, F.lit(1)).isin(*two),
        ),
    )

    def lists(found: Column) -> Column:
        parts = F.sequence(F.lit(0), F.floor((F.size(found) - 1) / SITES_PER_ROW).cast("int"))
        in_chunk = F.transform(
            parts,
            lambda k: F.transform(
                F.slice(found, k * SITES_PER_ROW + 1, F.lit(SITES_PER_ROW)),
                lambda at: at + F.col("chunk") * PLANE_COLUMNS,
            ),
        )
        return F.when(F.size(found) > 0, in_chunk)

    sites = cut_lineage(sets.select(*key, F.explode(bound(places, lists)).alias("_sites")))

    def bases_at(rows: DataFrame) -> DataFrame:
        found = F.transform("_sites", lambda at: part_of(F.col("_bytes"), at + 1, F.lit(1)))
        # Keys have one row per sample and list, and no skew
        return rows.join(sites, key).withColumn("_bases", F.array_join(found, "")).drop("_bytes")

    group = [*key, "_sites"]
    ordered = F.array_sort(F.collect_list(F.struct("idx", "_bases")))
    genotypes = bases_at(plain(samples, "idx")).groupBy(*group).agg(ordered.alias("_samples"))
    ref = bases_at(plain(reference)).withColumnRenamed("_bases", "_ref")

    def genotype(k: Column) -> Column:
        return F.array_join(F.transform("_samples", lambda it: F.substring(it["_bases"], k + 1, F.lit(1))), "")

    rows = F.transform(
        "_sites",
        lambda at, k: F.struct(
            (F.col("chunk_start") + at + 1).alias("pos"),
            F.substring(F.col("_ref"), k + 1, F.lit(1)).alias("ref"),
            genotype(k).alias("genotypes"),
        ),
    )
    return genotypes.join(ref, group).select("contig", F.inline(rows))


def autosome_filter(rows: DataFrame) -> DataFrame:
    return rows.where(is_autosome(F.col("contig")))


def check_contig_sets(reference: DataFrame, samples: DataFrame) -> DataFrame:
    """Reference contigs that a sample lacks or has with another size.

    ``reference`` holds (contig, size), ``samples`` (sample, contig, size). Sizes are compared by a
    join. Which contigs are missing is only asked of the samples that have too few of them.
    """
    wanted = reference.select("contig", F.col("size").alias("expected"))
    matched = samples.join(wanted, "contig", "left")
    wrong = matched.where(F.col("size") != F.col("expected")).select(
        "sample", "contig", F.lit("different size").alias("problem")
    )
    # Without a size a contig counts as missing
    sized = matched.where("expected IS NOT NULL AND size IS NOT NULL")
    present = F.count_if(F.col("expected").isNotNull() & F.col("size").isNotNull())
    total = wanted.agg(F.count("*")).scalar()
    short = matched.groupBy("sample").agg(present.alias("_n")).where(F.col("_n") < total)
    contigs = wanted.agg(F.collect_set("contig")).scalar()
    asked = short.select("sample", F.explode(contigs).alias("contig"))
    missing = asked.join(sized, ["sample", "contig"], "left_anti")
    return wrong.unionByName(missing.withColumn("problem", F.lit("missing")))


def match_contigs(panel: DataFrame, headers: DataFrame) -> DataFrame:
    """Panel contigs in the files with their size: ``(file, id, contig, candidates)``.

    ``panel`` holds (id, size), ``headers`` (file, contig, length). Of several contigs of the
    same size, the one named like the panel's is taken; ``contig`` is null if that fails.
    """
    named = headers.withColumn("_name", autosome_or_sex_name(F.col("contig")))
    same_size = skew_join(
        named.withColumnRenamed("length", "size"), panel.select("id", "size"), ["size"]
    )
    is_named = F.col("_name") == F.col("id")
    return (
        same_size.groupBy("file", "id")
        .agg(
            F.count("*").alias("candidates"),
            F.count_if(is_named).alias("_n_named"),
            F.min("contig").alias("_only"),
            F.min(F.when(is_named, F.col("contig"))).alias("_named"),
        )
        .select(
            "file",
            "id",
            F.when(F.col("candidates") == 1, F.col("_only"))
            .when(F.col("_n_named") == 1, F.col("_named"))
            .alias("contig"),
            "candidates",
        )
    )


def match_mito_contig(mitochondria: DataFrame, headers: DataFrame, hits: DataFrame) -> DataFrame:
    """Mitochondrial contigs of the files: ``(file, contig, length, expected, padding, hits)``.

    ``mitochondria`` holds aligned sequences (name, sequence), padded at the end by the
    difference of the longest and the shortest; ``hits`` holds (file, contig, mapped).
    """
    shortest = mitochondria.agg(F.min(F.length("sequence"))).scalar()
    known = mitochondria.select(
        F.col("name").alias("contig"),
        F.length(F.translate("sequence", "-", "")).cast("long").alias("expected"),
        (F.length("sequence") - shortest).cast("long").alias("padding"),
    )
    return (
        skew_join(headers, known, ["contig"])
        .join(hits, ["file", "contig"], "left")
        .select(
            "file",
            "contig",
            "length",
            "expected",
            "padding",
            F.coalesce("mapped", F.lit(0)).cast("long").alias("hits"),
        )
    )


def classify_alignments(
    headers: DataFrame, nuclear: DataFrame, mitochondrial: DataFrame, panel: DataFrame
) -> DataFrame:
    """Kind of each file: nuclear, mitochondrial, both or invalid.

    ``nuclear`` and ``mitochondrial`` are the results of the two matches. All panel contigs or
    none must be found, and a mitochondrial contig must have the expected length.
    """
    n_panel = panel.agg(F.count("*")).scalar()
    found = nuclear.groupBy("file").agg(F.count("contig").alias("_found"))
    mito = mitochondrial.groupBy("file").agg(
        F.bool_and(F.col("length") == F.col("expected")).alias("_fits"),
        F.sum("hits").alias("_hits"),
    )
    n_found = F.coalesce("_found", F.lit(0))
    has_mito = F.coalesce(F.col("_fits") & (F.col("_hits") > 0), F.lit(False))
    return (
        headers.select("file")
        .distinct()
        .join(found, "file", "left")
        .join(mito, "file", "left")
        .select(
            "file",
            F.when(~F.coalesce("_fits", F.lit(True)), "invalid")
            .when((n_found > 0) & (n_found < n_panel), "invalid")
            .when((n_found > 0) & has_mito, "both")
            .when(n_found > 0, "nuclear")
            .when(has_mito, "mitochondrial")
            .otherwise("invalid")
            .alias("kind"),
        )
    )


def conflicting_files(files: DataFrame) -> DataFrame:
    """Samples with more than one nuclear or more than one mitochondrial file.

    ``files`` holds (sample, file, kind).
    """
    return (
        files.groupBy("sample")
        .agg(
            F.count_if(F.col("kind").isin("nuclear", "both")).alias("n_nuclear"),
            F.count_if(F.col("kind").isin("mitochondrial", "both")).alias("n_mitochondrial"),
        )
        .where((F.col("n_nuclear") > 1) | (F.col("n_mitochondrial") > 1))
    )


def contig_hits(hits: DataFrame, mapping: DataFrame, panel: DataFrame) -> DataFrame:
    """Hits of the panel contigs under their panel names: ``(id, size, ns, hits)``."""
    named = skew_join(hits, mapping.select("contig", "id"), ["contig"])
    return skew_join(named, panel.select("id", "size", "ns"), ["id"]).groupBy(
        "id", "size", "ns"
    ).agg(F.sum("mapped").alias("hits"))


def relative_ploidy(hits: DataFrame) -> DataFrame:
    """Hits per called base, relative to the autosomes, whose mean is 2.

    ``hits`` holds (id, size, ns, hits). The range of the autosomes, and half of it, are what is
    expected of the sex chromosomes of females and males.
    """
    rates = hits.withColumns(
        {
            "rel_hits": F.col("hits") / (F.col("size") - F.col("ns")),
            "autosome": ~F.col("id").isin("X", "Y"),
        }
    )
    mean = rates.agg(F.avg(F.when(F.col("autosome"), F.col("rel_hits")))).scalar()
    scaled = rates.withColumn("norm_hits", 2 * F.col("rel_hits") / mean)
    limits = scaled.where("autosome").agg(
        F.struct(F.min("norm_hits").alias("low"), F.max("norm_hits").alias("high"))
    ).scalar()
    return scaled.withColumn("_limits", limits).select(
        "id",
        "autosome",
        "rel_hits",
        "norm_hits",
        F.col("_limits.low").alias("female_low"),
        F.col("_limits.high").alias("female_high"),
        (F.col("_limits.low") / 2).alias("male_low"),
        (F.col("_limits.high") / 2).alias("male_high"),
    )


# Genotype tables -------------------------------------------------------------------------------


def allele_frequencies(genotypes: DataFrame) -> DataFrame:
    """Minor allele counts per site and sample: ``(snp, sample, minor, mac, nchrobs)``.

    ``genotypes`` holds (snp, sample, dosage), the number of copies of the second of two alleles,
    or null if missing. The minor allele is that with fewer copies in all samples, the second on
    ties.
    """
    counts = genotypes.groupBy("snp", "sample").agg(
        F.coalesce(F.sum("dosage"), F.lit(0)).cast("long").alias("_second"),
        (2 * F.count("dosage")).alias("nchrobs"),
    )
    totals = counts.groupBy("snp").agg(
        (2 * F.sum("_second") <= F.sum("nchrobs")).alias("_is_second")
    )
    return counts.join(totals, "snp").select(
        "snp",
        "sample",
        F.when(F.col("_is_second"), 2).otherwise(1).alias("minor"),
        F.when(F.col("_is_second"), F.col("_second"))
        .otherwise(F.col("nchrobs") - F.col("_second"))
        .alias("mac"),
        "nchrobs",
    )


def treemix_counts(frequencies: DataFrame, samples: list[str]) -> DataFrame:
    """Wide table of ``mac,other`` per site, with the samples sorted by name."""
    return (
        frequencies.withColumn(
            "_counts",
            F.concat_ws(
                ",", F.col("mac").cast("string"), (F.col("nchrobs") - F.col("mac")).cast("string")
            ),
        )
        .groupBy("snp")
        .pivot("sample", sorted(samples))
        .agg(F.first("_counts"))
    )


def treemix_variance(covariance: DataFrame, model: DataFrame, keys: list[str]) -> DataFrame:
    """Share of the variance of a covariance matrix that a model explains.

    Both hold (keys, row, col, value). Pairs above the diagonal are compared.
    """
    both = _paired_matrices(covariance, model, keys).where(F.col("row") < F.col("col"))
    residual = F.col("value") - F.col("model")
    return both.groupBy(*keys).agg(
        (1 - F.var_samp(residual) / F.var_samp("value")).alias("explained")
    )


def treemix_residuals(covariance: DataFrame, model: DataFrame, keys: list[str]) -> DataFrame:
    """Difference of the matrices per pair of samples."""
    return _paired_matrices(covariance, model, keys).select(
        *keys, "row", "col", (F.col("value") - F.col("model")).alias("residual")
    )


def mean_standard_error(errors: DataFrame, keys: list[str]) -> DataFrame:
    """Mean over the rows of a matrix of the mean of each row."""
    per_row = errors.groupBy(*keys, "row").agg(F.avg("value").alias("value"))
    return per_row.groupBy(*keys).agg(F.avg("value").alias("mean_se"))


def _paired_matrices(covariance: DataFrame, model: DataFrame, keys: list[str]) -> DataFrame:
    return covariance.join(
        model.withColumnRenamed("value", "model"), [*keys, "row", "col"], "inner"
    )


def covariance_is_valid(covariance: DataFrame, keys: list[str]) -> DataFrame:
    """Whether a matrix is free of NaN."""
    return covariance.groupBy(*keys).agg(
        (~F.bool_or(F.isnan("value") | F.col("value").isNull())).alias("valid")
    )
