"""Operators on small hand-made inputs and against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from helixframe.functions.cigar import parse_cigar
from helixframe.operators import admixture as ad
from helixframe.operators import alignments as al
from helixframe.operators import coverage as cov
from helixframe.operators import depths as dp
from helixframe.operators import duplicates as du
from helixframe.operators import finalize as fz
from helixframe.operators import intervals as iv
from helixframe.operators import msa
from helixframe.operators import panel as pn
from helixframe.operators import pca
from helixframe.operators import trees as tr
from helixframe.plans import skew

SCHEMA = (
    "read_id long, qname string, flag int, contig string, pos long, mapq int, text string, "
    "mate_contig string, mate_pos long, tlen int, seq string, quals array<int>, "
    "tags map<string,struct<type:string,value:string>>, rg string"
)


def reads(spark, *rows):
    """Records from partial dicts."""
    defaults = {
        "flag": 0, "contig": "chr1", "pos": 0, "mapq": 30, "text": "10M", "mate_contig": None,
        "mate_pos": -1, "tlen": 0, "seq": "A" * 10, "quals": [30] * 10, "tags": {}, "rg": None,
    }
    full = [{"read_id": i, "qname": f"r{i}"} | defaults | row for i, row in enumerate(rows)]
    names = [part.split()[0] for part in SCHEMA.replace("struct<type:string,value:string>", "x").split(", ")]
    df = spark.createDataFrame([tuple(row[name] for name in names) for row in full], SCHEMA)
    return df.withColumn("cigar", parse_cigar(F.col("text"))).drop("text")


@pytest.fixture
def header(spark):
    contigs = spark.createDataFrame([(0, "chr1", 100), (1, "chr2", 50)], "tid int, contig string, length long")
    groups = spark.createDataFrame([("g", "S", "L", "k")], "rg string, sample string, library string, description string")
    return contigs, groups


def test_coverage_leaves_out_empty_na_group(spark, header):
    contigs, groups = header
    rows = cov.coverage_table(reads(spark, {"rg": "g"}, {"rg": "g", "flag": 1024}), contigs, groups).collect()
    assert {row["sample"] for row in rows} == {"S", "*"}
    top = next(r for r in rows if (r["sample"], r["library"], r["contig"]) == ("*", "*", "*"))
    assert (top["size"], top["hits"], top["m"], top["coverage"]) == (150, 1, 10, 10 / 150)
    both = cov.coverage_table(reads(spark, {"rg": "g"}, {"rg": "x"}), contigs, groups).collect()
    assert {row["sample"] for row in both} == {"S", "*", "<NA>"}


def test_coverage_of_regions_counts_bases_inside(spark, header):
    contigs, groups = header
    regions = spark.createDataFrame([("chr1", 5, 12, "x"), ("chr1", 90, 95, "x")], "contig string, start long, end long, name string")
    data = reads(spark, {"rg": "g", "pos": 2, "text": "4M2D4M", "qname": "M_1"}, {"rg": "g", "pos": 40})
    rows = cov.coverage_table(data, contigs, groups, regions).collect()
    row = next(r for r in rows if (r["sample"], r["library"], r["contig"]) == ("S", "L", "x"))
    assert (row["size"], row["hits"], row["collapsed"], row["m"], row["d"]) == (12, 1, 1, 5, 2)


def test_counts_of_regions_equal_those_of_pairs(spark, monkeypatch):
    monkeypatch.setattr(cov, "BIN_WIDTH", 16)
    rng = random.Random(5)
    texts = ("10M", "5M3I", "2I4M", "3M2D4M", "4I", "6M4I", "1M9I1M", "2S3M20N3M", "3M1I4M1D2M")
    rows = [
        {"pos": rng.randrange(90), "text": rng.choice(texts), "rg": rng.choice(["g", "h", None]), "contig": rng.choice(["chr1", "chr2"]),
         "qname": rng.choice(["M_1", "a"]), "flag": rng.choice([0, 65, 129])}
        for _ in range(150)
    ]
    spans = []
    for _ in range(80):
        start = rng.randrange(110)
        name = rng.choice(["x", "y", "z", None])
        spans.append((rng.choice(["chr1", "chr2", "chr3"]), start, start + rng.randrange(25), name))
    regions = spark.createDataFrame(spans, "contig string, start long, end long, name string")
    expected = defaultdict(lambda: [0] * 7)
    for row in rows:
        group = "collapsed" if row["qname"] == "M_1" else {0: "se", 65: "pe_1", 129: "pe_2"}[row["flag"]]
        operations = [(int(num), op) for num, op in re.findall(r"(\d+)([A-Z])", row["text"])]
        end = row["pos"] + sum(num for num, op in operations if op in "MDN")
        for contig, first, last, name in spans:
            if contig != row["contig"] or first >= last or first >= end:
                continue
            at, found = row["pos"], expected[name, row["rg"]]
            found[cov.COUNTERS.index(group)] += row["pos"] < last and row["pos"] < end
            for num, op in operations:
                if op in "MID":
                    found["MID".index(op) + 4] += max(0, min(at + num, last) - max(at, first))
                at += num * (op in "MDN")
    counts = cov.coverage_counts(reads(spark, *rows), regions).collect()
    found = {(row["contig"], row["rg"]): [row[it] for it in cov.COUNTERS] for row in counts}
    assert found == {key: value for key, value in expected.items() if any(value)}
    assert len(found) == len(counts)


def test_regions_of_a_name_that_overlap_make_no_pairs(spark, header):
    contigs, groups = header
    regions = spark.createDataFrame(
        [("chr1", 2, 9, "x")] * 3 + [("chr1", 5, 20, "x"), ("chr1", 0, 4, None)],
        "contig string, start long, end long, name string",
    )
    rows = dp.depth_histogram(reads(spark, {"rg": "g"}, {"rg": "g", "pos": 5}), groups, contigs, regions, width=4).collect()
    counts = {(row["contig"], row["depth"]): row["n_sites"] for row in rows if row["sample"] == row["library"] == "*"}
    assert counts["x", 1] == 3 * 3 + 5 and counts["x", 2] == 4 * 3 + 5 and counts[None, 1] == 4


def test_depths(spark, header):
    contigs, groups = header
    data = reads(spark, {"rg": "g"}, {"rg": "g", "pos": 5}, {"rg": "g", "pos": 5, "contig": "chr2"})
    histogram = dp.depth_histogram(data, groups, contigs, width=4)
    counts = {(r["sample"], r["library"], r["contig"], r["depth"]): r["n_sites"] for r in histogram.collect()}
    assert counts["S", "L", "chr1", 1] == 10 and counts["S", "L", "chr1", 2] == 5
    assert counts["*", "*", "*", 1] == 20
    table = dp.depths_table(data, contigs, groups).collect()
    row = next(r for r in table if (r["sample"], r["library"], r["contig"]) == ("S", "*", "chr1"))
    assert (row["MD_001"], row["MD_002"], row["MD_003"], row["max_depth"]) == ("0.1500", "0.0500", "0.0000", "NA")


def test_orphans_whose_names_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(skew, "fits_broadcast", lambda *_: False)
    data = reads(
        spark,
        {"qname": "a", "flag": 67, "tags": {"XP": ("i", "1")}}, {"qname": "a", "flag": 131, "mapq": 1},
        {"qname": "b", "flag": 67}, {"qname": "b", "flag": 131}, {"qname": None, "flag": 67},
    )
    found = fz.evaluate_alignments(data, fz.FilterOptions(min_mapping_quality=10)).collect()
    assert {row["read_id"] for row in found if row["orphan_reads"]} == {0}
    assert len(found) == 5


def test_reads_in_regions_that_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(skew, "fits_broadcast", lambda *_: False)
    data = reads(spark, {"tags": {"XP": ("i", "1")}}, {"pos": 30})
    regions = spark.createDataFrame([("chr1", 5, 35, 1), ("chr1", 9, 10, 2)], "contig string, start long, end long, region_id long")
    hits = iv.reads_in_regions(data, regions).select("read_id", "region_id").collect()
    assert sorted(map(tuple, hits)) == [(0, 1), (0, 2), (1, 1)]


def test_best_copy_by_cigar_count_then_quality(spark):
    data = reads(
        spark,
        {"text": "10M", "quals": [10] * 10},
        {"text": "10M", "quals": [12] * 10, "tags": {"XP": ("i", "3")}},
        {"text": "4M1I1D5M", "quals": [40] * 10},
        {"pos": 70, "flag": 1024, "tags": {"XP": ("i", "9")}},
        {"flag": 512},
    )
    marked = {r["read_id"]: r for r in du.mark_duplicates_collapsed(data).collect()}
    assert {k: r["flag"] for k, r in marked.items()} == {0: 1024, 1: 0, 2: 1024, 3: 0, 4: 512}
    assert marked[1]["tags"]["XP"]["value"] == "6"
    assert marked[3]["tags"]["XP"]["value"] == "1"


def test_pairs_win_over_singles(spark):
    data = reads(
        spark,
        {"qname": "a", "flag": 65}, {"qname": "a", "flag": 129 + 16, "pos": 50},
        {"qname": "b", "flag": 129 + 16, "pos": 50, "quals": [40] * 10}, {"qname": "b", "flag": 65},
        {"qname": "c", "quals": [60] * 10},
        {"qname": "d", "flag": 16, "pos": 7},
    )
    flags = {r["read_id"]: r["flag"] & 1024 for r in du.mark_duplicates_paired(data).collect()}
    assert flags == {0: 1024, 1: 1024, 2: 0, 3: 0, 4: 1024, 5: 0}


def test_orphans_fail(spark):
    data = reads(
        spark,
        {"qname": "a", "flag": 67}, {"qname": "a", "flag": 131, "mapq": 1},
        {"qname": "b", "flag": 67}, {"qname": "b", "flag": 131},
        {"qname": "c"},
    )
    options = fz.FilterOptions(min_mapping_quality=10)
    result = {r["read_id"]: (r["passes"], r["orphan_reads"]) for r in fz.evaluate_alignments(data, options).collect()}
    assert result == {0: (False, True), 1: (False, False), 2: (True, False), 3: (True, False), 4: (True, False)}
    kept = fz.evaluate_alignments(data, fz.FilterOptions(min_mapping_quality=10, allow_orphan_mates=True))
    assert {r["read_id"] for r in kept.where("passes").collect()} == {0, 2, 3, 4}


@pytest.mark.parametrize("size", [0, 7, 40, 100])
def test_reservoir(spark, size):
    rows = spark.range(40).withColumnRenamed("id", "key")
    kept = {r["key"] for r in al.reservoir_sample(rows, size, "key", seed=3, digits=1).collect()}
    order = sorted(range(40), key=lambda k: hashlib.md5(f"3|{k}".encode()).hexdigest())
    assert kept == set(order[:size])


@pytest.mark.parametrize("size", [-1, 1.5, True])
def test_reservoir_size(spark, size):
    with pytest.raises(ValueError, match="sample size"):
        al.reservoir_sample(spark.range(3), size, "id")


def test_weighted_sample_follows_weights(spark):
    items = spark.createDataFrame([(0, 1), (1, 3), (2, 6)], "item long, weight long")
    draws = spark.range(4000).withColumnRenamed("id", "draw")
    picked = al.weighted_sample(items, draws, "item", "weight", seed=1).groupBy("item").count().collect()
    counts = {row["item"]: row["count"] for row in picked}
    assert sum(counts.values()) == 4000
    assert abs(counts[0] - 400) < 100 and abs(counts[1] - 1200) < 150


def test_merge_and_pad(spark):
    df = spark.createDataFrame(
        [("chr1", 1234, 5678), ("chr1", 5678, 9012), ("chr2", 100, 200), ("chr2", 150, 250)],
        "contig string, start long, end long",
    )
    merged = sorted(map(tuple, iv.merge_regions(df).select("contig", "start", "end").collect()))
    assert merged == [("chr1", 1234, 9012), ("chr2", 100, 250)]
    padded = sorted(map(tuple, iv.pad_regions(df, -60).collect()))
    assert padded == [("chr1", 1294, 5618), ("chr1", 5738, 8952)]


def alignment(spark, *sequences):
    rows = [(1, f"s{i}", "", text) for i, text in enumerate(sequences)]
    return spark.createDataFrame(rows, "msa long, name string, meta string, sequence string")


@pytest.mark.parametrize(
    ("sequences", "expected"),
    [(("N-GC-A", "nNT--C"), ["GCA", "T-C"]), (("nN-", "N--"), []), (("TGA", "CCC"), ["TGA", "CCC"])],
)
def test_msa_reduce(spark, sequences, expected):
    reduced = msa.msa_reduce(alignment(spark, *sequences)).orderBy("name").collect()
    assert [row["sequence"] for row in reduced] == expected


@pytest.mark.parametrize(("reference", "expected"), [("s1", "TnRNnctn-n"), ("s2", "nGaNAcaC-A")])
def test_filter_singletons(spark, reference, expected):
    df = alignment(spark, "TGRNAYWC-A", "TARCGMKTAG", "GGA-ASVCTA")
    out = msa.msa_filter_singletons(df, F.col("name") == "s0", F.col("name") == reference)
    assert {r["name"]: r["sequence"] for r in out.collect()}["s0"] == expected


def test_planes_are_materialised(spark):
    """Their number decides how they are joined, which must not read all sequences again."""
    df = alignment(spark, "TGRNAYWC-A", "TARCGMKTAG", "GGA-ASVCTA")
    for out in (msa.msa_reduce(df), msa.msa_filter_singletons(df, F.col("name") == "s0", F.col("name") != "s0")):
        assert "bitmap_or_agg" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_msa_selection(spark):
    df = alignment(spark, "A", "C")
    names = spark.createDataFrame([("s1",)], "name string")
    assert [r["name"] for r in msa.msa_select(df, names).collect()] == ["s1"]
    assert [r["name"] for r in msa.msa_exclude(df, names).collect()] == ["s0"]
    with pytest.raises(KeyError):
        msa.msa_select(df, spark.createDataFrame([("s7",)], "name string"))


def brute_force_sampling(bases, alleles, seed):
    """Visit the sites in order, as one would on a single machine."""
    by_site = defaultdict(list)
    for contig, pos, read_id, base in bases:
        rank = hashlib.md5(f"{seed}|{read_id}|{pos}".encode()).hexdigest()
        by_site[contig, pos].append((rank, read_id, base))
    used, chosen = set(), set()
    for site in sorted(by_site):
        free = [it for it in by_site[site] if it[1] not in used]
        if free:
            _, read_id, base = min(free)
            if base in alleles[site]:
                used.add(read_id)
                chosen.add((*site, read_id, base))
    return chosen


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize("depth", [1, 8])
def test_sampling_equals_sequential_walk(spark, monkeypatch, depth, broadcast):
    if not broadcast:
        monkeypatch.setattr(skew, "fits_broadcast", lambda *_: False)
    rng = random.Random(depth)
    sites = {("c1", p): rng.choice(["A", "C", "AC"]) for p in range(0, 300, 10)}
    bases = []
    for read_id in range(30 * depth):
        start = 100 if read_id % 3 == 0 else rng.randrange(300)
        bases += [("c1", p, read_id, rng.choice("AC")) for _, p in sites if start <= p < start + 45]
    df = spark.createDataFrame(
        [(*row, sites[row[0], row[1]]) for row in bases],
        "contig string, pos long, read_id long, base string, alleles string",
    )
    sampled = pn.sample_panel_sites(df, seed=4).select("contig", "pos", "read_id", "base").collect()
    assert {tuple(row) for row in sampled} == brute_force_sampling(bases, sites, 4)


@pytest.mark.parametrize("first_reads", [1, 3])
def test_sampling_materialises_the_first_reads_of_a_site(spark, monkeypatch, first_reads):
    """Sites that run out of them are walked again with more; rows that come twice count once."""
    rng = random.Random(first_reads)
    sites = {("c1", p): rng.choice(["A", "C", "AC"]) for p in range(0, 60, 10)}
    bases = []
    for read_id in range(200):
        start = rng.randrange(60)
        bases += [("c1", p, read_id, rng.choice("AC")) for _, p in sites if start <= p < start + 45]
    # Few reads that all sites share are used up
    bases += [("c2", p, read_id, "A") for p in range(5) for read_id in range(900, 906)]
    sites |= {("c2", p): "A" for p in range(5)}
    monkeypatch.setattr(pn, "FIRST_READS", first_reads)
    monkeypatch.setattr(pn, "COUNTED", 1)
    held = []
    monkeypatch.setattr(pn, "cut_lineage", lambda df: held.append((df.columns, df.count())) or df.localCheckpoint())
    df = spark.createDataFrame(
        [(*row, sites[row[0], row[1]]) for row in [*bases, *bases[::7]]],
        "contig string, pos long, read_id long, base string, alleles string",
    )
    sampled = pn.sample_panel_sites(df, seed=4).select("contig", "pos", "read_id", "base").collect()
    assert {tuple(row) for row in sampled} == brute_force_sampling(bases, sites, 4)
    walked = [n for columns, n in held if "choice" in columns and "read_id" in columns]
    assert walked[0] < len(bases) / 2


def test_pca_equals_numpy(spark):
    rng = np.random.default_rng(2)
    dosages = rng.integers(0, 3, size=(200, 6)).astype(float)
    names = [f"s{i}" for i in range(6)]
    rows = [(i, names[j], int(dosages[i, j])) for i in range(200) for j in range(6)]
    df = spark.createDataFrame(rows, "snp long, sample string, dosage int")
    result = pca.genotype_pca(df, names, 3).select("component", "eigenvalue").distinct().collect()
    p = dosages.mean(axis=1) / 2
    keep = (p > 0) & (p < 1)
    x = (dosages[keep] - 2 * p[keep, None]) / np.sqrt(p[keep] * (1 - p[keep]))[:, None]
    expected = np.linalg.eigvalsh(x.T @ x / keep.sum())[::-1][:3]
    assert np.allclose([r["eigenvalue"] for r in sorted(result)], expected)
    assert {row["sample"] for row in pca.without_outliers(df, names).collect()} == set(names)


@pytest.mark.parametrize(("groups", "tolerance"), [(1, 1e-4), (4, 1e-9)])
def test_pca_of_more_samples_than_columns(spark, groups, tolerance):
    """With and without structure; a sample without genotypes lies at 0, and one is far off."""
    rng = np.random.default_rng(groups)
    n, sites = 60, 400
    frequency = rng.uniform(0.2, 0.8, (sites, groups))
    dosages = rng.binomial(2, frequency[:, np.arange(n) % groups]).astype(float)
    rows = [(i, f"s{j:02}", int(dosages[i, j])) for i in range(sites) for j in range(n)]
    df = spark.createDataFrame([*rows, (1, "other", 1)], "snp long, sample string, dosage int")
    names = spark.createDataFrame([(f"s{j:02}",) for j in range(n)] + [("none",)], "sample string")
    found = pca.genotype_pca(df, names, 3, tolerance).toPandas()
    p = dosages.mean(axis=1) / 2
    keep = (p > 0) & (p < 1)
    x = (dosages[keep] - 2 * p[keep, None]) / np.sqrt(p[keep] * (1 - p[keep]))[:, None]
    values, vectors = np.linalg.eigh(x.T @ x / keep.sum())
    for k in range(3):
        own = found[found["component"] == k + 1].sort_values("sample")
        assert np.allclose(own["eigenvalue"], values[-1 - k], rtol=tolerance)
        coordinate = own[own["sample"] != "none"]["coordinate"].to_numpy()
        assert coordinate[np.abs(coordinate).argmax()] > 0
        assert np.allclose(np.abs(coordinate), np.abs(vectors[:, -1 - k]), atol=100 * tolerance)
        assert own[own["sample"] == "none"]["coordinate"].abs().max() < 1e-12


def test_pca_shuffles_no_genotypes_to_multiply(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, f"s{j}", int(rng.integers(0, 3))) for i in range(50) for j in range(30)]
    df = spark.createDataFrame(rows, "snp long, sample string, dosage int")
    plans, cut = [], pca.cut_lineage
    monkeypatch.setattr(pca, "cut_lineage", lambda it: plans.append(it) or cut(it))
    by_broadcast = pca.genotype_pca(df, None, 2, 1e-2).toPandas().sort_values(["component", "sample"])
    products = [it for it in plans if "_q0" in it.columns and "_y0" in it.columns]
    assert products
    for it in products:
        # What lies above the kept genotypes: one shuffle, of what each part sends per sample
        text = it._jdf.queryExecution().sparkPlan().toString()
        planned = it._jdf.queryExecution().executedPlan().toString()
        assert "InMemoryTableScan" in text and "hashpartitioning(snp" not in planned.split("InMemoryRelation")[0]
    monkeypatch.setattr(pca, "BROADCAST_BYTES", 0)
    by_shuffle = pca.genotype_pca(df, None, 2, 1e-2).toPandas().sort_values(["component", "sample"])
    assert np.allclose(by_broadcast["coordinate"], by_shuffle["coordinate"], atol=1e-6), "the way of joining changes no value"


def test_pca_outliers_and_empty_tables(spark):
    rng = np.random.default_rng(9)
    rows = [(i, f"s{j}", int(rng.integers(0, 3))) for i in range(60) for j in range(40)]
    rows += [(1000 + i, f"s{j}", 2 * (j == 7)) for i in range(300) for j in range(40)]
    df = spark.createDataFrame(rows, "snp long, sample string, dosage int")
    left = {row["sample"] for row in pca.without_outliers(df, None, 6.0, 2).collect()}
    assert left == {f"s{j}" for j in range(40)} - {"s7"}
    assert pca.genotype_pca(df.where("false")).count() == 0
    constant = pca.genotype_pca(df.withColumn("dosage", F.lit(2)), None, 2).collect()
    assert len(constant) == 80 and {row["eigenvalue"] for row in constant} == {0.0}


def test_covariance_in_tiles(spark, monkeypatch):
    rng = np.random.default_rng(4)
    names = [f"s{j}" for j in range(7)]
    rows = [(i, name, int(rng.integers(0, 3))) for i in range(50) for name in names]
    df = spark.createDataFrame(rows, "snp long, sample string, dosage int").repartition(3)
    whole = {(r["row"], r["col"]): r["value"] for r in pca.genotype_covariance(df, names).collect()}
    monkeypatch.setattr(pca, "TILE", 3)
    tiled = {(r["row"], r["col"]): r["value"] for r in pca.genotype_covariance(df, names).collect()}
    assert len(whole) == 49 and whole.keys() == tiled.keys()
    assert all(abs(whole[key] - tiled[key]) < 1e-12 for key in whole)


def test_percentiles_of_missing_simulations(spark):
    tests = spark.createDataFrame([(1, "A", "B", 50, 2, True, 0.5)], "test long, sample1 string, sample2 string, n_reads long, k long, has_ts boolean, value double")
    sims = spark.createDataFrame([(100, 2, "B", "A", True, 0.1, 0.4), (100, 2, "A", "B", True, 0.2, 0.6)], "n_reads long, k long, sample1 string, sample2 string, has_ts boolean, percentile double, value double")
    bounds = ad.percentile_bounds(ad.asof_simulations(tests, sims)).collect()
    assert [(r["side"], r["n_reads"], r["lower"], r["upper"]) for r in bounds] == [("upper", 100, 0.1, 0.2)]
    row = ad.percent_range(ad.percentile_bounds(ad.asof_simulations(tests, sims))).first()
    assert (row["estimate"], row["min_reads"]) == ("over", 100)


def test_trees(spark):
    trees = spark.createDataFrame([(1, "((A,B),(C,D));"), (2, "((A:1,B):2,C,D);"), (3, "((A,C),(B,D))x;")], "tree_id long, newick string")
    support = {r["clade"]: r["support"] for r in tr.clade_support(trees).collect()}
    assert support["A,B"] == support["C,D"] == 2 and support["A,C"] == 1 and support["A"] == 3
    main = trees.where("tree_id = 1")
    labelled = tr.annotate_support(main, trees, "{Percentage:.0f}").first()["newick"]
    assert labelled == "((A,B)67,(C,D)67);"
    other = spark.createDataFrame([(9, "((A,B),(C,E));")], "tree_id long, newick string")
    assert [r["tree_id"] for r in tr.differing_leaves(other, trees).collect()] == [9]


def trees_of(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "tree_id long, newick string")


@pytest.mark.parametrize(
    "text", ["(A,B)", "(A,B", "(A,);", "();", "(A B);", "A,B;", "A),(B;", "(A:1:2);", "(A,B);;", "", "((A);"]
)
def test_broken_trees(spark, text):
    with pytest.raises(PySparkException):
        tr.tree_leaves(trees_of(spark, text)).collect()


def test_odd_but_valid_trees(spark):
    found = tr.tree_leaves(trees_of(spark, "A;", "('it''s (x)':1,B);", "(:1,:2)r:0;", " ( A , B ) ; ", None))
    by_id = {r["tree_id"]: (r["leaves"], r["duplicated"]) for r in found.collect()}
    assert by_id == {0: ("A", False), 1: ("'it''s (x)',B", False), 2: (",", True), 3: ("A,B", False)}


def plain_sides(tree):
    """Both sides of all branches of nested tuples."""
    sides, everything = set(), None

    def walk(node):
        own = frozenset([node]) if isinstance(node, str) else frozenset().union(*map(walk, node))
        sides.add(own)
        return own

    everything = walk(tree)
    sides.discard(everything)
    return {it for side in sides for it in (side, everything - side) if it}


def random_tree(rng, names):
    nodes = list(names)
    while len(nodes) > 1:
        rng.shuffle(nodes)
        take = rng.randint(2, min(3, len(nodes)))
        nodes = [tuple(nodes[:take]), *nodes[take:]]
    return nodes[0]


def newick_of(node, rng):
    if isinstance(node, str):
        return node + rng.choice(["", ":0.5"])
    return "(" + rng.choice([",", " , "]).join(newick_of(it, rng) for it in node) + ")" + rng.choice(["", "x", "x:2", ":1"])


@pytest.mark.parametrize("seed", range(3))
def test_support_against_sets(spark, seed):
    rng = random.Random(seed)
    nested = [random_tree(rng, "ABCDEFGH"[: rng.randint(2, 8)]) for _ in range(25)]
    df = trees_of(spark, *(newick_of(it, rng) + ";" for it in nested + nested[:5]))
    expected: dict[str, int] = defaultdict(int)
    for it in nested + nested[:5]:
        for side in plain_sides(it):
            expected[",".join(sorted(side))] += 1
    named = tr.clade_support(df).collect()
    assert {r["clade"]: r["support"] for r in named} == expected and len(named) == len(expected)
    keys = tr.clade_keys(df).collect()
    assert sorted(r["support"] for r in keys) == sorted(expected.values())


def test_labels_of_inner_nodes(spark):
    main = trees_of(spark, "((A,B)old:1,(C,('D x',E):0.5)y)root:3;")
    boots = trees_of(spark, "((A,B),(C,('D x',E)));", "((A,C),(B,('D x',E)));", "((A,B),(C,('D x',E)));")
    text = tr.annotate_support(main, boots, "{Support}/{Fraction:.2f}").first()["newick"]
    assert text == "((A,B)2/0.67:1,(C,('D x',E)3/1.00:0.5)2/0.67):3;"


def test_deep_and_wide_trees(spark):
    """A tree of 5000 levels and one of 10000 leaves; what is made of them is linear."""
    deep = "(" * 5000 + "L0" + "".join(f",L{k})" for k in range(1, 5001)) + ";"
    wide = "(" + ",".join(f"(L{2 * k},L{2 * k + 1})" for k in range(5000)) + ");"
    keys = tr.clade_keys(trees_of(spark, deep)).groupBy("size").count().collect()
    sizes = {r["size"]: r["count"] for r in keys}
    # Clades of k leaves for 2 <= k <= 5000 and their complements, and the leaves
    assert sizes[1] == 5001 and sizes[2500] == 2 and sum(sizes.values()) == 2 * 9999
    assert tr.clade_keys(trees_of(spark, wide)).where("size = 2").count() == 5000
    assert tr.clade_keys(trees_of(spark, wide)).count() == 2 * 15000
    labelled = tr.annotate_support(trees_of(spark, wide), trees_of(spark, wide, wide)).first()["newick"]
    assert labelled == wide.replace("),", ")2,").replace("));", ")2);")


def test_duplicate_report_that_is_not_broadcast(spark, monkeypatch):
    rows = [{"qname": f"q{k % 40 if k % 3 else 0}", "quals": None if k % 3 == 0 else [k % 40] * 10} for k in range(160)]
    rows += [{"qname": "once"}, {"qname": "q0", "seq": ""}, {"qname": "q0", "flag": 4}]
    data = reads(spark, *rows)
    known = spark.createDataFrame([], "rg string, sample string, library string, platform_unit string")
    groups = du.duplicate_read_groups(data)
    expected = sorted(map(str, du.duplicate_report(data, known, groups).collect()))
    assert len(expected) == 160
    monkeypatch.setattr(du, "fits_broadcast", lambda *_: False)
    for share in (3, 1000):
        monkeypatch.setattr(du, "HOT_SHARE", share)
        report = du.duplicate_report(data, known, groups)
        assert sorted(map(str, report.collect())) == expected
    # The sizes of keys come from the groups: records are not counted
    counted = [it for it in report._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Aggregate [" in it]
    assert not any("count(" in it for it in counted)


def test_pca_of_many_products_plans_one_of_them(spark, monkeypatch):
    rng = np.random.default_rng(11)
    rows = [(i, f"s{j}", int(rng.integers(0, 3))) for i in range(300) for j in range(40) if (i * 7 + j) % 5]
    df = spark.createDataFrame(rows, "snp long, sample string, dosage int")
    planned, times = [], pca._Gram.times
    monkeypatch.setattr(pca._Gram, "times", lambda *given: planned.append(given) or times(*given))
    # Blocks end within batches, and a product comes in several pieces
    monkeypatch.setattr(pca, "BLOCK_VALUES", 100)
    monkeypatch.setattr(pca, "BLOCK_SAMPLES", 16)
    in_memory = pca.genotype_pca(df, None, 2, 1e-9).toPandas().sort_values(["component", "sample"])
    assert len(planned) == 1
    dosage = np.full((300, 40), np.nan)
    for i, name, it in rows:
        dosage[i, int(name[1:])] = it
    mean = np.nanmean(dosage, axis=1, keepdims=True)
    x = np.nan_to_num((dosage - mean) / np.sqrt(mean / 2 * (1 - mean / 2)))
    expected = np.linalg.eigvalsh(x.T @ x / 300)[::-1][:2]
    assert np.allclose(in_memory["eigenvalue"].drop_duplicates(), expected, rtol=1e-9)
