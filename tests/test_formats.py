"""Files written and read back."""

from __future__ import annotations

import re

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from helixframe.operators import alignments as al
from helixframe.operators import validate as va
from helixframe.sources import bed, fasta, lines, reports, sam, tables


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_lines_are_numbered_across_splits(spark, small_splits, tmp_path):
    for name in ("a.txt", "b.txt"):
        (tmp_path / name).write_text("".join(f"{name} {i}\n" for i in range(700)))
    numbered = lines.numbered_lines(spark, str(tmp_path), split_bytes=4000)
    assert numbered.select(F.spark_partition_id()).distinct().count() > 2
    rows = numbered.collect()
    assert len(rows) == 1400
    for row in rows:
        assert row["value"] == f"{row['file'].rsplit('/', 1)[1]} {row['line']}"


@pytest.mark.parametrize("extension", ["", ".gz", ".bz2"])
def test_fasta(spark, small_splits, tmp_path, extension):
    import bz2
    import gzip

    opener = {"": open, ".gz": gzip.open, ".bz2": bz2.open}[extension]
    sequences = {f"seq{i}": "ACGTN"[i % 5] * (i * 13 + 1) for i in range(40)}
    with opener(tmp_path / f"in.fasta{extension}", "wt") as handle:
        for name, sequence in sequences.items():
            handle.write(f">{name} some  meta\n")
            handle.writelines(sequence[k : k + 10] + "\n" for k in range(0, len(sequence), 10))
    records = fasta.read_fasta(spark, str(tmp_path / f"in.fasta{extension}"), chunk_lines=3)
    whole = {row["name"]: row for row in fasta.whole_sequences(records).collect()}
    assert {name: row["sequence"] for name, row in whole.items()} == sequences
    assert {row["meta"] for row in whole.values()} == {"some  meta"}
    sizes = {row["name"]: row["size"] for row in fasta.contig_sizes(records).collect()}
    assert sizes == {name: len(sequence) for name, sequence in sequences.items()}


def test_fasta_wrapping(spark):
    df = spark.createDataFrame([("a", "m", "A" * 130), ("b", "", "C")], "name string, meta string, sequence string")
    texts = [row["value"] for row in fasta.format_fasta(df).collect()]
    assert texts == [">a m\n" + "A" * 60 + "\n" + "A" * 60 + "\n" + "A" * 10, ">b\nC"]


@pytest.mark.parametrize("text", ["ACGT\n>a\nAC\n", ">a\n>b\nAC\n", ">\nAC\n"])
def test_broken_fasta(spark, tmp_path, text):
    (tmp_path / "in.fasta").write_text(text)
    with pytest.raises(PySparkException):
        fasta.read_fasta(spark, str(tmp_path / "in.fasta")).collect()


def test_fastq_ends_at_empty_header(spark, tmp_path):
    (tmp_path / "in.fq").write_text("@a x\nACG\n+\n!!!\n@b\nA\n+b\n#\n\n@c\nA\n+\n#\n")
    rows = fasta.read_fastq(spark, str(tmp_path / "in.fq")).orderBy("record").collect()
    assert [(r["name"], r["meta"], r["sequence"], r["qualities"]) for r in rows] == [
        ("a", "x", "ACG", "!!!"),
        ("b", "", "A", "#"),
    ]


@pytest.mark.parametrize(
    "text", ["a\nACG\n+\n!!!\n", "@a\nACG\n-\n!!!\n", "@a\nACG\n+\n!!\n", "@a\nACG\n+\n"]
)
def test_broken_fastq(spark, tmp_path, text):
    (tmp_path / "in.fq").write_text(text)
    with pytest.raises(PySparkException):
        fasta.read_fastq(spark, str(tmp_path / "in.fq")).collect()


@pytest.mark.parametrize(
    ("qualities", "offset"),
    [(["#5"], "33"), (["Zf"], "64"), (["%", "c"], "BOTH"), (["<", "AGI"], "AMBIGUOUS"), ([""], "MISSING")],
)
def test_quality_offset(spark, qualities, offset):
    df = spark.createDataFrame([("f", it) for it in qualities], "file string, qualities string")
    assert va.quality_offset(df).first()["offset"] == offset
    expected = 0 if offset in ("33", "AMBIGUOUS") else 1
    assert va.validate_fastq(df).count() == expected


def test_bed(spark, tmp_path):
    (tmp_path / "in.bed").write_text("# peaks\n\nscaf7\t40\t95\tpeak\t12\nscaf2\t6\t31\tdip\t5\t-\tmore\n")
    rows = bed.read_bed(spark, str(tmp_path / "in.bed"))
    assert sorted(map(tuple, rows.select("contig", "start", "end", "name", "score", "strand").collect())) == [
        ("scaf2", 6, 31, "dip", 5, "-"),
        ("scaf7", 40, 95, "peak", 12, None),
    ]
    assert sorted(row["value"] for row in bed.format_bed(rows).collect()) == [
        "scaf2\t6\t31\tdip\t5\t-",
        "scaf7\t40\t95\tpeak\t12",
    ]


@pytest.mark.parametrize("line", ["scaf2\t7\t7", "scaf2\t-3\t9", "scaf2\t12\t4", "scaf2\t2\tten", "scaf2\t5"])
def test_broken_bed(spark, tmp_path, line):
    (tmp_path / "in.bed").write_text(line + "\n")
    with pytest.raises(PySparkException):
        bed.read_bed(spark, str(tmp_path / "in.bed")).collect()


def test_sam(spark, tmp_path):
    text = (
        "@HD\tVN:1.6\tSO:coordinate\n@SQ\tSN:chr2\tLN:90\n@SQ\tSN:chr1\tLN:50\n"
        "@RG\tID:g1\tSM:s\tLB:l:x\n"
        "r1\t99\tchr1\t8\t30\t2S3M\t=\t20\t17\tACGTA\tIIII!\tRG:Z:g1\tXP:i:3\n"
        "r2\t4\t*\t0\t0\t*\t*\t0\t0\t*\t*\n"
    )
    (tmp_path / "in.sam").write_text(text)
    records, contigs, groups = sam.read_alignments(spark, str(tmp_path / "in.sam"))
    assert [tuple(row) for row in contigs.orderBy("tid").collect()] == [(0, "chr2", 90), (1, "chr1", 50)]
    assert groups.select("rg", "sample", "library").collect()[0] == ("g1", "s", "l:x")
    first, second = records.orderBy("read_id").collect()
    assert (first["contig"], first["pos"], first["mate_contig"], first["mate_pos"]) == ("chr1", 7, "chr1", 19)
    assert first["quals"] == [40, 40, 40, 40, 0] and first["rg"] == "g1"
    assert (second["contig"], second["pos"], second["cigar"], second["seq"]) == (None, -1, None, None)
    written = sam.format_alignments(records.orderBy("read_id")).collect()
    assert [row["value"] for row in written] == text.splitlines()[4:]
    ordered = lines.numbered_lines(spark, str(tmp_path / "in.sam"))
    assert sam.sort_order(ordered).first()["sort_order"] == "coordinate"
    assert al.sort_coordinates(records, contigs).collect()[-1]["qname"] == "r2"


def test_tsv(spark, tmp_path):
    (tmp_path / "good.tsv").write_text("# note\nA\tB\n1\tx\n\n2\ty\n")
    rows = tables.read_tsv(spark, str(tmp_path / "good.tsv")).collect()
    assert [(row["A"], row["B"]) for row in rows] == [("1", "x"), ("2", "y")]
    (tmp_path / "bad.tsv").write_text("A\tB\n1\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        tables.read_tsv(spark, str(tmp_path / "bad.tsv")).collect()


def test_admixture_rows_must_match_samples(spark, tmp_path):
    (tmp_path / "r.Q").write_text("0.1 0.9\n0.5 0.5\n")
    rows = tables.read_admixture_q(spark, str(tmp_path / "r.Q"), ["a"]).collect()
    assert {(r["sample"], r["component"]): r["fraction"] for r in rows} == {
        ("a", 0): 0.1, ("a", 1): 0.9, ("-", 0): 0.5, ("-", 1): 0.5,
    }
    with pytest.raises(PySparkException):
        tables.read_admixture_q(spark, str(tmp_path / "r.Q"), ["a", "b"]).collect()


@pytest.mark.parametrize(
    ("text", "error"),
    [
        (">a\nACGT\nAC\n>b\nA\n", None),
        (">a\r\nACGT\n", "CR"),
        (">a\nAC\n>a\nAC\n", "seen before"),
        (">a\n>b\nAC\n", "follows header"),
        (">a\n\nAC\n", "after header"),
        (">a\nAC\n\nAC\n", "follow blank"),
        (">a\nAC\n\n>b\nAC\n", None),
        (">a\nAC\nACGT\n", "uneven"),
        (">a\nACGT\nAC\nACGT\n", "uneven"),
        (">a\nAZ\n", "letters"),
        ("AC\n", "before any header"),
        (">a\n", "last header"),
        ("\n", "no content"),
        (">\nAC\n", "no name"),
        (">=a\nAC\n", "pattern"),
    ],
)
def test_validate_fasta(spark, tmp_path, text, error):
    (tmp_path / "in.fasta").write_bytes(text.encode())
    found = va.validate_fasta(lines.numbered_lines(spark, str(tmp_path)), width=2).collect()
    assert (not found) if error is None else (error in found[0]["error"])


def test_trees_and_split_outputs(spark, tmp_path):
    (tmp_path / "t.txt").write_text("(A,B);\n\n(A,(B,C));\n")
    rows = tables.read_trees(spark, str(tmp_path / "t.txt")).orderBy("tree_id").collect()
    assert [row["newick"] for row in rows] == ["(A,B);", "(A,(B,C));"]
    df = spark.createDataFrame([(1, "passed"), (2, "failed"), (3, "passed")], "id int, outcome string")
    reports.write_split(df, str(tmp_path / "out"))
    passed = spark.read.parquet(str(tmp_path / "out" / "outcome=passed"))
    assert sorted(row["id"] for row in passed.collect()) == [1, 3]


def test_table_lines_have_separators(spark):
    rows = [("x", "S", lib, c, 10, 1, 1, 0, 0, 0, 5, 0, 0, 0.5) for lib in ("*", "L") for c in ("*", "c1")]
    table = spark.createDataFrame(rows, list(reports.COVERAGE_COLUMNS))
    text = [row["value"].split("\t")[:4] for row in reports.coverage_lines(table).collect()]
    assert text == [
        ["Name", "Sample", "Library", "Contig"],
        ["x", "S", "*", "*"], ["x", "S", "*", "c1"], ["#"],
        ["x", "S", "L", "*"], ["x", "S", "L", "c1"], ["#"], ["#"],
    ]


def test_panel_tables(spark):
    samples = spark.createDataFrame(
        [("a", "G1", "-", "X", "male", "i", "p"), ("b", "G2", "-", "X", "?", "i", "p")],
        ["ID", "Group(2)", "Group(3)", "Species", "Sex", "SampleID", "Publication"],
    )
    groups = tables.parse_panel_groups(samples)
    assert sorted(map(tuple, groups.collect())) == [("a", 2, "G1"), ("b", 2, "G2")]
    assert tables.wrong_group_counts(groups).count() == 0
    parsed = {row["id"]: row["error"] for row in tables.parse_panel_samples(samples).collect()}
    assert parsed == {"a": None, "b": "unknown sex"}
    with pytest.raises(PySparkException):
        tables.valid_or_fail(tables.parse_panel_samples(samples), "id").collect()
    with pytest.raises(ValueError, match="missing columns"):
        tables.parse_panel_contigs(samples)
    with pytest.raises(ValueError, match="Group"):
        tables.parse_panel_groups(samples.withColumnRenamed("Group(2)", "Group(9)"))


def test_fastq_files_that_end_early_shuffle_lines_once(spark):
    texts = ["@a x", "ACG", "+", "!!!", "", "A", "+", "#", "@c", "G", "+", "%"]
    rows = [(f"f{k}", line, "@b" if k % 2 and line == 4 else text) for k in range(6) for line, text in enumerate(texts)]
    lines = spark.createDataFrame(rows, "file string, line long, value string")
    many = fasta.parse_fastq(lines, max_rows=0)
    expected = [(f"f{k}", n, name) for k in range(6) for n, name in enumerate("abc" if k % 2 else "a")]
    assert sorted((r["file"], r["record"], r["name"]) for r in many.collect()) == expected
    assert sorted(many.collect()) == sorted(fasta.parse_fastq(lines).collect())
    # Where lines meet the ends of their files, records are made without another exchange
    plan = fasta.parse_fastq(lines, max_rows=0)._jdf.queryExecution().executedPlan().toString()
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert keys and not any("record" in key for key in keys)


def test_files_numbered_range_by_range(spark):
    rows = [(f"f{k:03}", line, text) for k in range(300) for line, text in enumerate(["@a", "AC", "+", "!J"])]
    lines = spark.createDataFrame(rows, "file string, line long, value string").repartition(5)
    records = fasta.parse_fastq(lines)
    for max_rows in (0, 1000):
        reads = fasta.unmapped_records(records, "g", max_rows=max_rows)
        assert sorted(r["read_id"] for r in reads.collect()) == [k << fasta.FILE_SHIFT for k in range(300)]
    plan = reads._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "row_number" not in plan
