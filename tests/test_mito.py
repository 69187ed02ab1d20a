"""Consensus of contigs against plain Python."""

from __future__ import annotations

import random

import pytest

from helixframe.operators import mito


def plain_base(row: dict) -> str:
    counts = {base: row[base] for base in "ACGT"}
    top = max(counts.values())
    best = [base for base, n in counts.items() if n == top]
    return best[0] if top > 0 and len(best) == 1 else "N"


def counted(spark, rows):
    return spark.createDataFrame(rows, "contig string, pos long, A long, C long, G long, T long, N long")


@pytest.mark.parametrize("chunk", [1, 7, 1 << 16])
def test_consensus(spark, chunk):
    rng = random.Random(chunk)
    lengths = {"c1": 50, "c2": 7, "c3": 14, "empty": 0, "bare": 20}
    rows = [
        (contig, pos, *(rng.randrange(3) for _ in range(4)), rng.randrange(5))
        for contig, length in lengths.items()
        for pos in range(length)
        if contig != "bare" and rng.random() < 0.4
    ]
    rows.append(("c1", 60, 5, 0, 0, 0, 0))  # beyond the contig
    table = spark.createDataFrame(list(lengths.items()), "contig string, length long")
    for padding in (0, 3):
        found = mito.consensus(counted(spark, rows), table, padding, chunk)
        whole = {r["contig"]: r["sequence"] for r in mito.whole_consensus(found).collect()}
        by_site = {(r[0], r[1]): dict(zip("ACGTN", r[2:], strict=True)) for r in rows}
        expected = {
            contig: "".join(
                plain_base(by_site[contig, pos]) if (contig, pos) in by_site else "N"
                for pos in range(length - padding)
            )
            for contig, length in lengths.items()
            if length > padding
        }
        assert whole == expected


def test_long_contig_with_few_sites(spark):
    """10 Mb and 100 covered sites: rows are chunks and sites, not bases."""
    rng = random.Random(1)
    places = sorted(rng.sample(range(10_000_000), 100))
    counts = counted(spark, [("c", pos, 0, 0, 2, 1, 0) for pos in places])
    lengths = spark.createDataFrame([("c", 10_000_000)], "contig string, length long")
    rows = mito.consensus(counts, lengths)
    assert rows.count() == -(-10_000_000 // mito.CHUNK)
    text = mito.whole_consensus(rows).first()["sequence"]
    assert len(text) == 10_000_000 and [k for k, base in enumerate(text) if base == "G"] == places
    assert set(text) == {"G", "N"}


def test_base_counts_with_qualities(spark):
    reads = spark.createDataFrame(
        [
            (0, "c", 5, [(0, 3)], "ACG", [40, 2, 40]),
            (0, "c", 6, [(0, 2)], "CT", None),
            (4, "c", 5, [(0, 3)], "TTT", [40, 40, 40]),
        ],
        "flag int, contig string, pos long, cigar array<struct<op:int,len:int>>, seq string, quals array<int>",
    )

    def found(minimum):
        return {r["pos"]: {b: r[b] for b in "ACGTN" if r[b]} for r in mito.base_counts(reads, minimum).collect()}

    assert found(0) == {5: {"A": 1}, 6: {"C": 2}, 7: {"G": 1, "T": 1}}
    assert found(20) == {5: {"A": 1}, 6: {"C": 1}, 7: {"G": 1, "T": 1}}
