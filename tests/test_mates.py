"""Mate fields taken from the mates."""

from __future__ import annotations

from helixframe.operators.mates import fix_mates
from helixframe.sources import sam

HEADER = "@SQ\tSN:c1\tLN:500\n@SQ\tSN:c2\tLN:500\n"
# name, flag, contig, 1-based position, CIGAR
RECORDS = [
    ("facing", 65 + 2, "c1", 11, "5M"),
    ("facing", 129 + 16, "c1", 31, "4M2D1M"),
    ("away", 65 + 2 + 16, "c1", 11, "5M"),
    ("away", 129 + 2, "c1", 31, "5M"),
    ("apart", 65 + 2, "c1", 11, "5M"),
    ("apart", 129 + 2, "c2", 31, "5M"),
    ("half", 65 + 2, "c2", 7, "5M"),
    ("half", 129 + 4, "*", 0, "*"),
    ("alone", 65 + 2 + 32, "c2", 9, "5M"),
    ("twice", 65, "c2", 1, "5M"),
    ("twice", 65, "c2", 2, "5M"),
    ("twice", 129, "c2", 3, "5M"),
    ("facing", 65 + 256, "c2", 3, "5M"),
    ("single", 0, "c2", 4, "5M"),
]
# flag, contig, pos, mate contig, mate pos, template length, MC, MQ
EXPECTED = [
    (65 + 2 + 32, "c1", 10, "c1", 30, 27, "4M2D1M", "30"),
    (129 + 16, "c1", 30, "c1", 10, -27, "5M", "30"),
    (65 + 16, "c1", 10, "c1", 30, 15, "5M", "30"),
    (129 + 32, "c1", 30, "c1", 10, -15, "5M", "30"),
    (65, "c1", 10, "c2", 30, 0, "5M", "30"),
    (129, "c2", 30, "c1", 10, 0, "5M", "30"),
    (65 + 8, "c2", 6, "c2", 6, 0, None, None),
    (129 + 4, "c2", 6, "c2", 6, 0, "5M", "30"),
    (65 + 8, "c2", 8, None, -1, 0, None, None),
    (65 + 8, "c2", 0, None, -1, 0, None, None),
    (65 + 8, "c2", 1, None, -1, 0, None, None),
    (129 + 8, "c2", 2, None, -1, 0, None, None),
    (65 + 256, "c2", 2, "c1", 399, 77, "9M", None),
    (0, "c2", 3, "c1", 399, 77, "9M", None),
]


def test_fix_mates(spark, tmp_path):
    lines = [
        f"{name}\t{flag}\t{contig}\t{pos}\t30\t{cigar}\tc1\t400\t77\tACGTA\tIIIII\tMC:Z:9M\n"
        for name, flag, contig, pos, cigar in RECORDS
    ]
    for file, part in (("a.sam", lines[:7]), ("b.sam", lines[7:])):
        (tmp_path / file).write_text(HEADER + "".join(part))
    records = sam.read_alignments(spark, str(tmp_path))[0]
    rows = fix_mates(records).orderBy("read_id").collect()
    found = []
    for row in rows:
        tags = {name: tag["value"] for name, tag in row["tags"].items()}
        fields = [row[name] for name in ("flag", "contig", "pos", "mate_contig", "mate_pos", "tlen")]
        found.append((*fields, tags.get("MC"), tags.get("MQ")))
    assert found == EXPECTED
    assert fix_mates(records.limit(0)).count() == 0
    assert fix_mates(records).columns == records.columns
