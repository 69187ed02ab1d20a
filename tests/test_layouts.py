"""Balanced parts of regions, interleaved alignments, and alignments without a position."""

from __future__ import annotations

import random

import pytest
from pyspark.errors import PySparkException

from helixframe.operators import intervals as iv
from helixframe.sources import fasta, phylip


@pytest.mark.parametrize("parts", [1, 7, 64, 20_000])
def test_parts_of_regions(spark, parts):
    draw = random.Random(parts)
    contigs = spark.createDataFrame([("b", 0), ("a", 1)], "contig string, tid int")
    rows = []
    for _ in range(40):
        start = draw.randrange(5000)
        rows.append((draw.choice("abz"), start, start + draw.choice([0, 1, 30, 300])))
    regions = spark.createDataFrame(rows, 'contig string, start long, `end` long')
    bases = [
        (contig, at)
        for contig in "baz"
        for at in sorted({p for c, s, e in rows if c == contig for p in range(s, e)})
    ]
    expected = {base: next_part for next_part, base in _dealt(bases, parts)}
    found = {}
    for row in iv.scatter_regions(regions, parts, contigs, width=64).collect():
        for at in range(row["start"], row["end"]):
            assert (row["contig"], at) not in found
            found[row["contig"], at] = row["part"]
    assert found == expected


def _dealt(bases, parts):
    for part in range(parts):
        low, high = part * len(bases) // parts, (part + 1) * len(bases) // parts
        for base in bases[low:high]:
            yield part, base


def test_parts_must_exist(spark):
    contigs = spark.createDataFrame([("a", 0)], "contig string, tid int")
    none = spark.createDataFrame([], "contig string, start long, `end` long")
    with pytest.raises(ValueError):
        iv.scatter_regions(none, 0, contigs)
    assert iv.scatter_regions(none, 3, contigs).count() == 0


def _phylip(spark, *sequences):
    rows = spark.createDataFrame([(1, *it) for it in sequences], "msa int, name string, sequence string")
    return [row["value"] for row in phylip.phylip_lines(rows).collect()]


def test_phylip_sections(spark):
    long = "ACGTACGTAC" * 11 + "TTT"
    assert _phylip(spark, ("two", long), ("one", long.lower())) == [
        "2 113",
        "",
        "one         " + "  ".join(["acgtacgtac"] * 5),
        "two         " + "  ".join(["ACGTACGTAC"] * 5),
        "",
        "  ".join(["acgtacgtac"] * 6),
        "  ".join(["ACGTACGTAC"] * 6),
        "",
        "ttt",
        "TTT",
    ]


def test_phylip_long_names(spark):
    name = "n" * 45
    assert _phylip(spark, (name, "A" * 31)) == [
        "1 31",
        "",
        "n" * 30 + " " * 6 + "  ".join(["A" * 10] * 3),
        "",
        "A",
    ]


def test_phylip_refuses_other_shapes(spark):
    with pytest.raises(PySparkException, match="length"):
        _phylip(spark, ("a", "AC"), ("b", "A"))
    with pytest.raises(PySparkException, match="unique"):
        _phylip(spark, ("a", "AC"), ("a", "GT"))


def test_unmapped_records(spark):
    texts = ["@r1 x", "AC", "+", "!J", "@r2", "G", "+", "5"]
    rows = [(file, k, text) for file in ("b", "a") for k, text in enumerate(texts)]
    lines = spark.createDataFrame(rows, "file string, line long, value string")
    reads = fasta.unmapped_records(fasta.parse_fastq(lines), "g").orderBy("read_id").collect()
    assert [it["read_id"] for it in reads] == [0, 1, 1 << 40, (1 << 40) + 1]
    assert [(it["qname"], it["flag"], it["pos"], it["quals"], it["rg"]) for it in reads[:2]] == [
        ("r1", 4, -1, [0, 41], "g"),
        ("r2", 4, -1, [20], "g"),
    ]
