"""NM and MD tags against a walk over every alignment."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from helixframe.functions import cigar as C
from helixframe.operators.mismatches import set_mismatch_tags

SCHEMA = "read_id long, flag int, contig string, pos long, cigar_text string, seq string, tags map<string,struct<type:string,value:string>>"


def walk(operations, seq, reference, pos):
    """The tags as one would write them base by base."""
    text, run, distance, at = "", 0, 0, 0
    for num, op in operations:
        if op == "D":
            text += f"{run}^{reference[pos : pos + num]}"
            run, distance = 0, distance + num
        elif op == "I":
            distance += num
        elif op == "M":
            for i in range(num):
                if seq[at + i] == reference[pos + i] != "N":
                    run += 1
                else:
                    text += f"{run}{reference[pos + i]}"
                    run, distance = 0, distance + 1
        pos += num if op in "MDN" else 0
        at += num if op in "MIS" else 0
    return str(distance), text + str(run)


@pytest.mark.parametrize("width", [7, 1024])
def test_tags(spark, width):
    draw = random.Random(width)
    contigs = {name: "".join(draw.choices("ACGTN", (9, 9, 9, 9, 1), k=300)) for name in ("a", "b")}
    pieces = []
    for name, whole in contigs.items():
        at = 0
        while at < len(whole):
            end = min(len(whole), at + draw.randrange(1, 60))
            pieces.append((name, at, whole[at:end]))
            at = end
    rows, expected = [], {}
    for read in range(150):
        operations = [(draw.randrange(1, 4), "S"), (draw.randrange(1, 20), "M")]
        for _ in range(draw.randrange(4)):
            operations += [(draw.randrange(1, 9), draw.choice("DIN")), (draw.randrange(1, 20), "M")]
        span = sum(num for num, op in operations if op in "MDN")
        contig, pos = draw.choice("ab"), draw.randrange(300 - span)
        seq, at = "", pos
        for num, op in operations:
            if op == "M":
                seq += "".join(it if draw.random() < 0.8 else draw.choice("ACGTN") for it in contigs[contig][at : at + num])
            elif op in "SI":
                seq += "".join(draw.choices("ACGT", k=num))
            at += num if op in "MDN" else 0
        text = "".join(f"{num}{op}" for num, op in operations)
        rows.append((read, 0, contig, pos, text, seq, {"NM": ("i", "99"), "XX": ("i", "1")}))
        expected[read] = walk(operations, seq, contigs[contig], pos)
    none = (None, None)
    for read, row in enumerate(
        [(4, "a", 3, "*", "ACGT"), (0, "a", 298, "4M", "ACGT"), (0, "c", 1, "4M", "ACGT"), (0, "a", 1, "4M", None)], 500
    ):
        rows.append((read, *row, {"MD": ("Z", "4")}))
        expected[read] = none
    records = spark.createDataFrame(rows, SCHEMA).withColumn("cigar", C.parse_cigar(F.col("cigar_text")))
    reference = spark.createDataFrame(pieces, "contig string, start long, sequence string")
    tagged = set_mismatch_tags(records, reference, width)
    found = {
        row["read_id"]: tuple(row["tags"][name]["value"] if name in row["tags"] else None for name in ("NM", "MD"))
        for row in tagged.collect()
    }
    assert found == expected
    assert all("XX" in row["tags"] for row in tagged.where("read_id < 500").collect())
    assert tagged.columns == records.columns
    assert set_mismatch_tags(records.limit(0), reference).count() == 0


def test_deletion_of_nothing(spark):
    rows = [(1, 0, "a", 0, "3M0D3M", "ACGTAC", {})]
    records = spark.createDataFrame(rows, SCHEMA).withColumn("cigar", C.parse_cigar(F.col("cigar_text")))
    reference = spark.createDataFrame([("a", 0, "ACGTAC")], "contig string, start long, sequence string")
    tags = set_mismatch_tags(records, reference).first()["tags"]
    assert (tags["NM"]["value"], tags["MD"]["value"]) == ("0", "6")
