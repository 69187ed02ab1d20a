from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from helixframe.functions import cigar as C
from helixframe.functions import flags as fl
from helixframe.functions import sequences as sq


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def cigar(text):
    return C.parse_cigar(F.lit(text))


def test_parse_and_format(spark):
    assert value(spark, C.format_cigar(cigar("2H3S10M2I5M3D4M1S"))) == "2H3S10M2I5M3D4M1S"
    assert value(spark, cigar("*")) is None
    assert value(spark, C.format_cigar(cigar("*"))) == "*"


def test_lengths(spark):
    ops = cigar("2H3S10M2I5M3D4M5N1X1=1P1S")
    assert value(spark, C.reference_length(ops)) == 10 + 5 + 3 + 4 + 5 + 1 + 1
    assert value(spark, C.query_length(ops)) == 3 + 10 + 2 + 5 + 4 + 1 + 1 + 1
    assert value(spark, C.mapped_bases(ops)) == 10 + 5 + 4 + 1 + 1
    assert value(spark, C.clipped_front(ops)) == 5
    assert value(spark, C.clipped_back(ops)) == 1
    assert value(spark, C.unclipped_start(F.lit(100), ops)) == 95


def test_one_search_per_cigar():
    assert str(C.parse_cigar(F.col("text"))).count("regexp_extract_all") == 1


@pytest.mark.parametrize(
    ("text", "front", "back", "soft"),
    [("*", None, None, None), ("", 0, 0, 0), ("5S", 5, 5, 5), ("10M", 0, 0, 0), ("5S10M", 5, 0, 5),
     ("5H3S10M2S", 8, 2, 3), ("3S5H10M2S4H", 8, 6, 3), ("5S2H1S", 8, 8, 6), ("5H10M", 5, 0, 0)],
)
def test_clips_at_the_ends(spark, text, front, back, soft):
    df = spark.createDataFrame([(text,)], "text string").select(C.parse_cigar(F.col("text")).alias("it"))
    ops = F.col("it")
    found = df.select(C.clipped_front(ops), C.clipped_back(ops), C.clipped_front(ops, (4,))).first()
    assert tuple(found) == (front, back, soft)


def test_blocks(spark):
    blocks = value(spark, C.aligned_blocks(F.lit(100), cigar("2H3S10M2I5M3D4M1S")))
    assert [tuple(it) for it in blocks] == [(100, 110, 3), (110, 115, 15), (118, 122, 20)]


def test_padding_consumes_nothing(spark):
    blocks = value(spark, C.aligned_blocks(F.lit(10), cigar("3M2P3M")))
    assert [tuple(it) for it in blocks] == [(10, 13, 0), (13, 16, 3)]


def test_aligned_quality_ignores_soft_clips(spark):
    quals = F.array(*(F.lit(it) for it in (1, 2, 4, 8, 16)))
    assert value(spark, C.aligned_quality(cigar("1S3M1S"), quals)) == 14
    assert value(spark, C.aligned_quality(cigar("1H5M"), quals)) == 31
    assert value(spark, C.aligned_quality(cigar("5M"), F.lit(None).cast("array<int>"))) is None


@pytest.mark.parametrize(
    ("text", "expected"),
    [("ACGT", "TGCA"), ("acgtn", "tgcan"), ("RYKMSWBDVHNX", "YRMKSWVHBDNX"), ("A-z?", "TNNN")],
)
def test_complement(spark, text, expected):
    assert value(spark, sq.complement(F.lit(text))) == expected
    assert value(spark, sq.reverse_complement(F.lit(text))) == expected[::-1]


@pytest.mark.parametrize("code", list(sq.IUPAC))
def test_genotypes_round_trip(spark, code):
    bases = sq.IUPAC[code]
    assert value(spark, sq.decode_genotype(F.lit(code))) == bases
    assert value(spark, sq.encode_genotype(F.lit(",".join(reversed(bases))))) == code


def test_genotype_of_unknown_base(spark):
    with pytest.raises(PySparkException):
        value(spark, sq.encode_genotype(F.lit("AZ")))


def test_split_positions(spark):
    parts = sq.split_positions(F.lit("ABCDEFG"), "112")
    assert value(spark, parts["1"]) == "ABDEG"
    assert value(spark, parts["2"]) == "CF"
    with pytest.raises(ValueError, match="no positions"):
        sq.split_positions(F.lit("A"), "")


@pytest.mark.parametrize(("text", "runs"), [("", 0), ("A", 1), ("AAAA", 1), ("AABBA", 3), ("ABAB", 4)])
def test_complexity(spark, text, runs):
    assert value(spark, sq.complexity(F.lit(text))) == runs


def test_mask(spark):
    assert value(spark, sq.mask_letters(F.lit("ACGTNacgtnRyX-*1"))) == "ACGTNacgtnNNN-*1"


@pytest.mark.parametrize(
    ("name", "expected"),
    [("chr1", "1"), ("22", "22"), ("ChrX", "X"), ("y", "Y"), ("XY", None), ("", None), ("chr", None), ("chrUn", None)],
)
def test_contig_names(spark, name, expected):
    assert value(spark, sq.autosome_or_sex_name(F.lit(name))) == expected


def test_panel_alleles(spark):
    assert value(spark, sq.panel_alleles(F.lit("ARN"))) == ["A", "A", "A", "G"]
    with pytest.raises(PySparkException):
        value(spark, sq.panel_alleles(F.lit("B")))


@pytest.mark.parametrize(
    ("flag", "mate"), [(0, None), (64, None), (65, 1), (129, 2), (193, None), (1, None)]
)
def test_mate_number(spark, flag, mate):
    assert value(spark, fl.mate_number(F.lit(flag))) == mate


def test_transitions(spark):
    assert value(spark, sq.is_transition(F.array(F.lit("C"), F.lit("T"), F.lit("C"))))
    assert not value(spark, sq.is_transition(F.array(F.lit("C"), F.lit("C"))))
    assert not value(spark, sq.is_transition(F.array(F.lit("C"), F.lit("G"))))
