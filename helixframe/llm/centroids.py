"""Centroid clustering by a progressive search over Walsh-Hadamard coefficients.

Vectors become integers, and so does everything computed from them: no result depends on the order
of additions. The transform of 64 components is a matrix of ones and minus ones, so that the squared
distance of two vectors is a 64th of that of their coefficients. Coefficients are ordered coarse to
fine by their sign changes. The search adds up their squared differences block by block: the
centroid that is nearest after the first block is finished, and any centroid whose sum so far is
strictly larger than that distance can't be nearest and is left out of the finer blocks. What
survives is finished over all 64 coefficients; of the nearest ones the smallest number wins.

A round reads the vectors once. Each task adds up the members of every cluster, and what is gathered
per round has one row per task and cluster. The driver holds the centroids only.

Vectors are kept if they have exactly 64 components, none null or non-finite; others, null vectors
among them, have no row in the result. Integers too large for 64-bit arithmetic are computed as Python
integers; a distance or sum beyond a long is null. The first centroids are the kept vectors with the smallest
hashes of their ids; ids that repeat are ordered by their vectors, null ids come last. With fewer kept
vectors than centroids, there are as many centroids as vectors. Repeated rows count repeatedly, an empty
table gives an empty result, and columns besides ``vec_id`` and ``embedding`` are never looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helixframe.llm.common import checkpointed, read
from helixframe.llm.queries import query

DIMENSIONS = 64
SCALE = 256
CLUSTERS = 40
ROUNDS = 5
SEED = 2
#: Ends of the blocks of coefficients, coarse to fine.
BLOCKS = (4, 8, 16, 32, 64)
#: Below this magnitude of components all sums of squares fit into 64 bits.
SAFE = 1 << 24
#: Rows that are searched at once, so that a block of differences stays small.
ROWS_AT_ONCE = 2048


def _sign_changes() -> np.ndarray:
    """The order of the coefficients by the sign changes of their rows of the matrix."""
    rows = np.ones((1, 1), np.int64)
    while len(rows) < DIMENSIONS:
        rows = np.block([[rows, rows], [rows, -rows]])
    return np.argsort((rows[:, 1:] != rows[:, :-1]).sum(axis=1))


_ORDER = _sign_changes()


def transformed(vectors: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients of the rows, coarse to fine; exact for integers of any kind."""
    out = vectors
    width = 1
    while width < DIMENSIONS:
        pairs = out.reshape(len(vectors), DIMENSIONS // (2 * width), 2, width)
        first, second = pairs[:, :, 0], pairs[:, :, 1]
        out = np.stack([first + second, first - second], axis=2).reshape(len(vectors), DIMENSIONS)
        width *= 2
    return out[:, _ORDER]


def _squares(differences: np.ndarray) -> np.ndarray:
    return (differences * differences).sum(axis=-1)


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid of each vector, given their coefficients, and its distance."""
    numbers, distances = [], []
    for at in range(0, len(vectors), ROWS_AT_ONCE):
        rows = vectors[at : at + ROWS_AT_ONCE]
        every = np.arange(len(rows))
        sums = _squares(rows[:, None, : BLOCKS[0]] - centroids[None, :, : BLOCKS[0]])
        likely = sums.argmin(axis=1)
        # What the likely centroid comes to in the end; strictly more than that can't be nearest
        bound = _squares(rows - centroids[likely])[:, None]
        for begin, end in zip(BLOCKS, BLOCKS[1:], strict=False):
            row, centroid = np.nonzero((sums <= bound).astype(bool))
            sums[row, centroid] += _squares(rows[row, begin:end] - centroids[centroid, begin:end])
        best = np.where((sums <= bound).astype(bool), sums, bound + 1).argmin(axis=1)
        numbers.append(best)
        distances.append(sums[every, best] // DIMENSIONS)
    if not numbers:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(numbers), np.concatenate(distances)


def _integer(value: float) -> int:
    return int(value) * SCALE if abs(value) >= 2.0**53 else math.floor(value * SCALE)


def quantised(values: np.ndarray) -> np.ndarray:
    """Components as integers: 64-bit ones, or Python's if one of them is too large."""
    if not len(values) or np.abs(values).max() * SCALE < SAFE:
        return np.floor(values * SCALE).astype(np.int64)
    return np.array([[_integer(value) for value in row] for row in values.tolist()], object)


def kept_vectors(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Places and components of the kept rows of a batch with a column ``embedding``."""
    vectors = batch.column(batch.schema.get_field_index("embedding"))
    sizes = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    places = np.flatnonzero(sizes == DIMENSIONS)
    flat = vectors.take(pa.array(places)).flatten()
    values = flat.cast(pa.float64()).fill_null(math.nan).to_numpy(zero_copy_only=False)
    values = values.reshape(-1, DIMENSIONS)
    finite = np.isfinite(values).all(axis=1)
    return places[finite], values[finite]


def _assigned(
    values: np.ndarray, centroids: list[list[int]]
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of ``values`` with their integers, clusters and distances; exact for any magnitude."""
    wide = np.abs(values).max(axis=1, initial=0.0) * SCALE >= SAFE
    if any(abs(it) >= SAFE for centroid in centroids for it in centroid):
        wide[:] = True
    for kind, chosen in ((np.int64, ~wide), (object, wide)):
        rows = np.flatnonzero(chosen)
        if len(rows):
            integers = quantised(values[rows]).astype(kind)
            targets = transformed(np.array(centroids, kind))
            yield rows, integers, *nearest(transformed(integers), targets)


def first_centroids(vectors: DataFrame, clusters: int, seed: int) -> list[list[int]]:
    """The kept vectors whose ids have the smallest hashes."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.take(pa.array(kept_vectors(batch)[0]))

    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    chosen = (
        vectors.mapInArrow(keep, vectors.schema)
        .orderBy(order.asc_nulls_last(), "embedding")
        .limit(clusters)
        .collect()
    )
    return [[_integer(float(value)) for value in row["embedding"]] for row in chosen]


def cluster_sums(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """Members of each non-empty cluster, and the sum of every component in decimal."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members = [0] * len(centroids)
        sums = np.zeros((len(centroids), DIMENSIONS), object)
        for batch in batches:
            for _, integers, clusters, _ in _assigned(kept_vectors(batch)[1], centroids):
                for cluster in np.unique(clusters).tolist():
                    own = integers[clusters == cluster]
                    members[cluster] += len(own)
                    sums[cluster] += own.sum(axis=0).astype(object)
        found = [k for k, count in enumerate(members) if count]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(found, pa.int32()),
                pa.array([members[k] for k in found], pa.int64()),
                pa.array([list(map(str, sums[k])) for k in found], pa.list_(pa.string())),
            ],
            names=["cluster", "members", "sums"],
        )

    def total(rows: pd.DataFrame) -> pd.DataFrame:
        sums = np.sum([[int(it) for it in row] for row in rows["sums"]], axis=0, dtype=object)
        both = rows.iloc[:1][["cluster"]].assign(members=rows["members"].sum())
        return both.assign(sums=[list(map(str, sums))])

    schema = "cluster int, members long, sums array<string>"
    return vectors.mapInArrow(partial, schema).groupBy("cluster").applyInPandas(total, schema)


def fit_centroids(
    vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED
) -> list[list[int]]:
    """The centroids after so many rounds; there are at most ``clusters``, whatever the input."""
    centroids = first_centroids(vectors, clusters, seed)
    for _ in range(rounds if centroids else 0):
        for row in cluster_sums(vectors, centroids).collect():
            centroids[row["cluster"]] = [int(it) // row["members"] for it in row["sums"]]
    return centroids


def assign_vectors(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """Per kept vector: (vec_id, cluster, distance)."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, values = kept_vectors(batch)
            cluster, distance = np.zeros(len(places), np.int32), np.zeros(len(places), object)
            for rows, _, clusters, distances in _assigned(values, centroids):
                cluster[rows], distance[rows] = clusters, distances
            ids = batch.column(batch.schema.get_field_index("vec_id")).take(pa.array(places))
            small = [it if it < 1 << 63 else None for it in distance.tolist()]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(cluster), pa.array(small, pa.int64())],
                names=["vec_id", "cluster", "distance"],
            )

    schema = T.StructType([vectors.schema["vec_id"]]).add("cluster", "integer").add("distance", "long")
    return vectors.mapInArrow(assign, schema)


def _long(total: float) -> int | None:
    return total if total < 1 << 63 else None


def _digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def cluster_vectors(
    embeddings: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED
) -> DataFrame:
    """Cluster and distance of every kept vector, with the inertia and digest of its cluster."""
    vectors = embeddings.select("vec_id", "embedding")
    centroids = fit_centroids(vectors, clusters, rounds, seed)
    assigned = checkpointed(assign_vectors(vectors, centroids))

    # A row for each cluster at most; a distance that no long holds makes its sums null, too
    own = assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum"),
        F.bool_and(F.col("distance").isNotNull()).alias("known"),
    )
    inertia = {row["cluster"]: int(row["sum"]) if row["known"] else math.inf for row in own.collect()}
    facts = embeddings.sparkSession.createDataFrame(
        [
            (k, _long(inertia[k]), _long(sum(inertia.values())), _digest(centroid))
            for k, centroid in enumerate(centroids)
            if k in inertia
        ],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return assigned.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _sql() -> str:
    """The rounds written out, each one as the nearest centroids and then their new places."""
    parts = [
        f"""kept AS (
    SELECT row_number() OVER () AS row, vec_id,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE len(embedding) = {DIMENSIONS}
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
centroids_0 AS (
    SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id)) - 1 AS c, v
    FROM kept QUALIFY c < {CLUSTERS}
)"""
    ]
    for k in range(ROUNDS + 1):
        parts.append(
            f"""nearest_{k} AS (
    SELECT row, vec_id, any_value(v) AS v, min(d * 64 + c) AS best
    FROM (
        SELECT row, vec_id, kept.v, c, CAST(list_sum(list_transform(list_zip(kept.v, centroids_{k}.v),
               lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d
        FROM kept, centroids_{k}
    )
    GROUP BY row, vec_id
),
assigned_{k} AS (SELECT row, vec_id, v, best % 64 AS c, best // 64 AS d FROM nearest_{k})"""
        )
        if k < ROUNDS:
            parts.append(
                f"""sums_{k} AS (
    SELECT c, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
    FROM (SELECT c, unnest(v) AS x, unnest(range({DIMENSIONS})) AS i FROM assigned_{k})
    GROUP BY c, i
),
moved_{k} AS (
    SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM sums_{k} GROUP BY c
),
centroids_{k + 1} AS (
    SELECT c, coalesce(moved_{k}.v, centroids_{k}.v) AS v FROM centroids_{k} LEFT JOIN moved_{k} USING (c)
)"""
            )
    return f"""
WITH {", ".join(parts)}
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
       CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(centroids_{ROUNDS}.v, ',')) AS centroid_sha256
FROM assigned_{ROUNDS} JOIN centroids_{ROUNDS} USING (c)
"""


@query("op13_centroid_clustering", _sql())
def centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(read(spark, sf_dir, "embeddings"))
