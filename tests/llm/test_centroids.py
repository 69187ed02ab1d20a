"""Progressive search and clustering against plain arithmetic with Python integers."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from helixframe.llm import centroids as module


def plain_clusters(rows: list[tuple], clusters: int, rounds: int) -> list[tuple]:
    """The contract word by word: (vec_id, cluster, distance, cluster_inertia, inertia, digest)."""
    kept = [
        (key, [math.floor(256 * x) for x in vector])
        for key, vector in rows
        if vector is not None
        and len(vector) == 64
        and all(x is not None and math.isfinite(x) for x in vector)
    ]
    order = sorted(kept, key=lambda it: hashlib.sha256(f"2:{it[0]}".encode()).hexdigest())
    places = [vector for _, vector in order[:clusters]]

    def nearest(vector):
        return min((sum((x - y) ** 2 for x, y in zip(vector, c, strict=True)), k) for k, c in enumerate(places))

    for _ in range(rounds):
        members: dict[int, list] = {}
        for _, vector in kept:
            members.setdefault(nearest(vector)[1], []).append(vector)
        for k, own in members.items():
            places[k] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    found = [(key, *reversed(nearest(vector))) for key, vector in kept]
    total = sum(distance for _, _, distance in found)
    own = {k: sum(d for _, j, d in found if j == k) for k in range(len(places))}
    digests = [hashlib.sha256(",".join(map(str, it)).encode()).hexdigest() for it in places]
    return sorted((key, k, d, own[k], total, digests[k]) for key, k, d in found)


def test_transform_keeps_distances():
    rng = np.random.default_rng(1)
    a, b = rng.integers(-(2**20), 2**20, (2, 50, 64))
    squares = (module.transformed(a) - module.transformed(b)) ** 2
    assert (squares.sum(axis=1) == 64 * ((a - b) ** 2).sum(axis=1)).all()
    # The first coefficient is the sum of all components, the second one changes sign once
    assert (module.transformed(a)[:, 0] == a.sum(axis=1)).all()
    assert (module.transformed(a)[:, 1] == a[:, :32].sum(axis=1) - a[:, 32:].sum(axis=1)).all()


@pytest.mark.parametrize("reach", [1, 3, 200])
@pytest.mark.parametrize("kind", [np.int64, object])
def test_search_is_exact_and_ties_go_to_the_smaller(reach, kind):
    rng = np.random.default_rng(reach)
    vectors = rng.integers(-reach, reach + 1, (300, 64))
    places = np.concatenate([vectors[:20], vectors[:5], rng.integers(-reach, reach + 1, (15, 64))])
    plain = ((vectors[:, None] - places[None]) ** 2).sum(axis=2)
    number, distance = module.nearest(
        module.transformed(vectors.astype(kind)), module.transformed(places.astype(kind))
    )
    assert number.tolist() == plain.argmin(axis=1).tolist()
    assert distance.tolist() == plain.min(axis=1).tolist()


def frame(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")


def found(df) -> list[tuple]:
    return sorted(tuple(row) for row in df.collect())


@pytest.mark.parametrize("kind", ["float", "double"])
def test_clusters_are_those_of_plain_arithmetic(spark, kind):
    rng = np.random.default_rng(7)
    rows = [(k, rng.normal(size=64).astype(np.float32).tolist()) for k in range(200)]
    rows += [(k, rows[k][1]) for k in range(20)]  # repeated rows
    rows += [(300 + k, [0.5] * 64) for k in range(30)]  # ties
    df = frame(spark, rows, kind).repartition(5)
    assert found(module.cluster_vectors(df, 12, 3)) == plain_clusters(rows, 12, 3)


def test_odd_vectors(spark):
    good = [0.25] * 64
    rows = [
        (1, good),
        (2, None),
        (3, []),
        (4, good[:63]),
        (5, [*good, 1.0]),
        (6, [*good[:63], None]),
        (7, [*good[:63], math.nan]),
        (8, [*good[:63], math.inf]),
        (9, [-0.001] * 64),
        (9, [-0.001] * 64),
        (10, [1.0e6] * 64),
    ]
    df = frame(spark, rows).selectExpr("*", "'x' AS cluster", "1 AS distance")
    result = found(module.cluster_vectors(df))
    as_floats = [(k, v and [it if it is None else float(np.float32(it)) for it in v]) for k, v in rows]
    assert result == plain_clusters(as_floats, 40, 5)
    assert [row[0] for row in result] == [1, 9, 9, 10]
    assert module.cluster_vectors(df.where("false")).count() == 0
    assert module.cluster_vectors(df.where("vec_id BETWEEN 2 AND 8")).count() == 0
    # A null id comes last, and one long can't hold is null
    odd = frame(spark, [(None, good), (1, [3.0e38] * 64), (2, [-3.0e38] * 64), (3, [3.0e38] * 64)])
    by_id = {row["vec_id"]: row for row in module.cluster_vectors(odd, 2, 2).collect()}
    assert len(by_id) == 4 and by_id[2]["inertia"] is None
    assert by_id[1]["cluster"] == by_id[3]["cluster"] != by_id[2]["cluster"]
