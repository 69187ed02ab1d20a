"""One step beyond what used to be a limit."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException

from helixframe.operators import alignments as al
from helixframe.operators import coverage as cv
from helixframe.operators import duplicates as du
from helixframe.operators import trees as tr
from helixframe.sources import fasta
from helixframe.sources.sam import read_alignments


def sam_text(*names: str, length: int = 1000) -> str:
    header = f"@HD\tVN:1.6\n@SQ\tSN:chrA\tLN:{length}\n@RG\tID:g1\tSM:s1\tLB:l1\n"
    return header + "".join(f"M_{it}\t0\tchrA\t101\t30\t4M\t*\t0\t0\tACGT\tIIII\tRG:Z:g1\n" for it in names)


def test_two_files_with_one_header(spark, tmp_path):
    (tmp_path / "a.sam").write_text(sam_text("q1", "q2", "q3"))
    (tmp_path / "b.sam").write_text(sam_text("q4", "q5", "q6"))
    alignments, contigs, readgroups = read_alignments(spark, str(tmp_path))
    assert alignments.select("read_id").distinct().count() == 6
    assert [tuple(row) for row in contigs.collect()] == [(0, "chrA", 1000)]
    assert readgroups.count() == 1
    assert du.mark_duplicates_collapsed(alignments).count() == 6
    total = cv.coverage_table(alignments, contigs, readgroups).where("contig = 'chrA' AND sample = 's1' AND library = 'l1'")
    assert [(row["hits"], row["size"]) for row in total.collect()] == [(6, 1000)]
    both = al.union_alignments([alignments, alignments])
    assert both.select("read_id").distinct().count() == 12
    assert du.mark_duplicates_collapsed(both).count() == 12


def test_files_that_disagree(spark, tmp_path):
    (tmp_path / "a.sam").write_text(sam_text("q1"))
    (tmp_path / "b.sam").write_text(sam_text("q2", length=999))
    with pytest.raises(PySparkException, match="disagree"):
        read_alignments(spark, str(tmp_path))[1].collect()


def test_small_weights_are_drawn(spark):
    items = spark.createDataFrame([(1, 0.5), (2, 0.5), (3, 2.0)], "item long, weight double")
    draws = spark.range(3000).withColumnRenamed("id", "draw")
    picked = al.weighted_sample(items, draws, "item", "weight", seed=2)
    counts = {row["item"]: row["count"] for row in picked.groupBy("item").count().collect()}
    assert sum(counts.values()) == 3000
    assert abs(counts[1] - 500) < 100 and abs(counts[2] - 500) < 100
    with pytest.raises(ValueError, match="nothing"):
        al.weighted_sample(items.where("false"), draws, "item", "weight")


def test_a_hundred_and_one_contigs(spark):
    contigs = spark.range(101).selectExpr("id AS tid", "concat('c', id) AS contig", "10L AS length")
    assert cv.reference_sizes(contigs).count() == 101
    assert cv.reference_sizes(contigs, max_contigs=100).count() == 1


def test_all_groups_are_reported(spark):
    groups = spark.range(150).selectExpr("id AS first_read", "1L AS n_complex")
    assert du.limit_report(groups).count() == 150
    assert du.limit_report(groups, 7).count() == 7


@pytest.mark.parametrize("chunk_lines", [7, 1 << 14])
def test_long_contig_there_and_back(spark, tmp_path, chunk_lines):
    lines = ["ACGTTGCANC"[k % 10 :] + "GATTACA" * (k % 9) for k in range(20_000 if chunk_lines > 7 else 200)]
    (tmp_path / "in.fasta").write_text(">one long\n" + "\n".join(lines) + "\n>two\nAC\n")
    records = fasta.read_fasta(spark, str(tmp_path / "in.fasta"), chunk_lines)
    assert records.count() > 2
    text = "\n".join(row["value"] for row in fasta.format_fasta(records, 50).collect()).split("\n")
    whole = "".join(lines)
    assert text == [">one long", *(whole[k : k + 50] for k in range(0, len(whole), 50)), ">two", "AC"]


def test_deep_tree(spark):
    depth = 5000
    text = "(" * depth + "x0" + "".join(f",x{k})" for k in range(1, depth + 1)) + ";"
    deep = spark.createDataFrame([(1, text)], "tree_id long, newick string")
    leaves = tr.tree_leaves(deep).first()["leaves"].split(",")
    assert sorted(leaves) == sorted(f"x{k}" for k in range(depth + 1))
    small = spark.createDataFrame([(1, "((a,b),(c,d));"), (2, "((a,b),(d,c));")], "tree_id long, newick string")
    labelled = tr.annotate_support(small, small).orderBy("tree_id").collect()
    assert labelled[0]["newick"] == "((a,b)2,(c,d)2);"
