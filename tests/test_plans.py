"""Building blocks against brute force, with hot keys and without broadcasts."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from helixframe.plans import intervals as iv
from helixframe.plans import skew


@pytest.fixture
def salted(monkeypatch):
    """Let no side count as small."""
    monkeypatch.setattr(skew, "fits_broadcast", lambda *_: False)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, salted, how):
    rng = random.Random(1)
    rows = [(i, None if i % 50 == 0 else "hot" if i % 3 == 0 else f"k{rng.randrange(200)}") for i in range(4000)]
    big = spark.createDataFrame(rows, "id long, key string")
    small = spark.createDataFrame(
        [("hot", 1), ("hot", 2), *((f"k{i}", i) for i in range(0, 200, 2))], "key string, value long"
    )
    expected = sorted(map(str, big.join(small, "key", how).collect()))
    joined = skew.skew_join(big, small, ["key"], how)
    assert sorted(map(str, joined.select(*big.join(small, "key", how).columns).collect())) == expected


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_of_rows_with_maps(spark, salted, how):
    big = spark.range(3000).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("key"),
        F.create_map(F.lit("XP"), F.struct(F.lit("i").alias("type"), F.col("id").alias("value"))).alias("tags"),
        F.struct(F.create_map(F.lit("a"), "id").alias("inner")).alias("nested"),
    )
    small = spark.createDataFrame([("hot", 1), ("k1", 2), ("k1", 3)], "key string, value long")
    joined = skew.skew_join(big, small, ["key"], how)
    names = big.join(small, "key", how).columns
    expected = sorted(map(str, big.join(small, "key", how).collect()))
    assert sorted(map(str, joined.select(*names).collect())) == expected


def test_hot_keys_are_bounded_and_split(spark):
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("key")
    )
    hot = skew.hot_keys(rows, ["key"]).collect()
    assert [row["key"] for row in hot] == ["hot"]
    assert 300 < hot[0]["_salts"] <= skew.HOT_SHARE


def test_broadcast_is_bounded_in_bytes(spark, monkeypatch):
    narrow = spark.range(1000)
    wide = spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("text"), F.array("id").alias("list"))
    assert skew.fits_broadcast(narrow) and skew.fits_broadcast(wide) and not skew.fits_broadcast(narrow, 999)
    monkeypatch.setattr(skew, "BROADCAST_BYTES", 50_000)
    assert skew.fits_broadcast(narrow) and not skew.fits_broadcast(wide)
    assert skew.fits_broadcast(narrow.where("false"))


def random_intervals(n, seed, longest):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        start = 500 if i % 3 == 0 else rng.randrange(2000)
        rows.append((f"c{rng.randrange(2)}", start, start + rng.randrange(longest), i))
    return rows


@pytest.mark.parametrize("width", [None, 4, 4096])
@pytest.mark.parametrize("broadcast", [True, False])
def test_overlap_join(spark, monkeypatch, width, broadcast):
    if not broadcast:
        monkeypatch.setattr(skew, "fits_broadcast", lambda *_: False)
        monkeypatch.setattr(iv, "fits_broadcast", lambda *_: False)
    left, right = random_intervals(200, 1, 60), random_intervals(80, 2, 90)
    a = spark.createDataFrame(left, "contig string, s long, e long, left_id long")
    b = spark.createDataFrame(right, "contig string, start long, end long, right_id long")
    pairs = iv.overlap_join(a, b, ("s", "e"), ("start", "end"), width=width)
    actual = sorted((row["left_id"], row["right_id"]) for row in pairs.collect())
    expected = sorted(
        (x[3], y[3]) for x in left for y in right if x[0] == y[0] and x[1] < y[2] and y[1] < x[2]
        and x[1] < x[2] and y[1] < y[2]
    )
    assert actual == expected


@pytest.mark.parametrize("broadcast", [True, False])
def test_overlap_join_of_all_lengths(spark, monkeypatch, broadcast):
    """Intervals of 1 to 10 million bases on either side; no row is placed in many bins."""
    if not broadcast:
        monkeypatch.setattr(skew, "fits_broadcast", lambda *_: False)
        monkeypatch.setattr(iv, "fits_broadcast", lambda *_: False)
    rng = random.Random(5)

    def rows(n):
        starts = [rng.randrange(10**7) for _ in range(n)]
        return [("c1", it, it + int(10 ** rng.uniform(0, 7)), k) for k, it in enumerate(starts)]

    left, right = rows(150), rows(120)
    a = spark.createDataFrame(left, "contig string, s long, e long, left_id long")
    b = spark.createDataFrame(right, "contig string, start long, end long, right_id long")
    for one, other, names in ((a, b, "left right"), (a, b.where("end - start < 1000"), "left short")):
        pairs = iv.overlap_join(one, other, ("s", "e"), ("start", "end"), width=128).collect()
        kept = [y for y in right if names != "left short" or y[2] - y[1] < 1000]
        expected = sorted((x[3], y[3]) for x in left for y in kept if x[1] < y[2] and y[1] < x[2])
        assert sorted((row["left_id"], row["right_id"]) for row in pairs) == expected
    skip = spark.createDataFrame([("c1", 77, 100_077)], "contig string, s long, e long")
    bits = iv._level_bits(128)
    assert iv._placed(skip, ("s", "e"), bits, 0, "own").count() <= 2
    assert iv._placed(skip, ("s", "e"), bits, len(bits) - 1, "own").count() <= 12


@pytest.mark.parametrize("width", [8, 1024])
def test_depth_runs(spark, width):
    blocks = random_intervals(150, 3, 50)
    df = spark.createDataFrame(
        [(f"s{i % 2}", f"l{i % 3}", c, s, e) for c, s, e, i in blocks],
        "sample string, library string, contig string, ref_start long, ref_end long",
    )
    runs = iv.depth_runs(df, [["sample", "library"], ["sample"], []], width=width).collect()
    actual = Counter()
    for row in runs:
        for pos in range(row["run_start"], row["run_end"]):
            actual[row["sample"], row["library"], row["contig"], pos] += row["depth"]
    expected = Counter()
    for c, s, e, i in blocks:
        for pos in range(s, e):
            for key in ((f"s{i % 2}", f"l{i % 3}"), (f"s{i % 2}", "*"), ("*", "*")):
                expected[(*key, c, pos)] += 1
    assert actual == expected


@pytest.mark.parametrize("width", [4, 64, 1 << 14])
def test_islands(spark, width):
    rows = random_intervals(60, 4, 25) + [("c9", 10, 100, 0), ("c9", 20, 30, 1), ("c9", 100, 110, 2)]
    rows = [row for row in rows if row[1] < row[2]]
    df = spark.createDataFrame(rows, "contig string, start long, end long, id long")
    actual = sorted(map(tuple, iv.islands(df, ["contig"], "start", "end", width).select("contig", "start", "end").collect()))
    merged = []
    for contig, start, end, _ in sorted(rows):
        if merged and merged[-1][0] == contig and start <= merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], end)
        else:
            merged.append([contig, start, end])
    assert actual == [tuple(row) for row in merged]


@pytest.mark.parametrize("width", [2, 16, 1024])
def test_lag_value(spark, width):
    rng = random.Random(5)
    places = sorted(rng.sample(range(500), 80))
    rows = [(f"f{p % 2}", p, rng.randrange(9)) for p in places]
    df = spark.createDataFrame(rows, "file string, at long, value int")
    actual = {row["at"]: row["_previous"] for row in iv.lag_value(df, ["file"], "at", "value", width).collect()}
    last, expected = defaultdict(lambda: None), {}
    for file, at, val in rows:
        expected[at] = last[file]
        last[file] = val
    assert actual == expected


@pytest.mark.parametrize(("value", "power"), [(0.2, 1), (1, 1), (2, 2), (3, 4), (128, 128), (129, 256)])
def test_power_of_two(value, power):
    assert iv.power_of_two(value) == power
