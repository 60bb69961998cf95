"""What the vector operators share: usable vectors, a bounded sample, k-means on it."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# rows that centroids are fitted on: a bound for the driver, whatever the size of the table
SAMPLE_ROWS = 20_000
MOST_CENTROIDS = 4096


def usable(df: DataFrame, vec_id: str, vector: str, keep: dict[str, str] | None = None) -> DataFrame:
    """(id, vector as double[], the columns `keep`) of the rows that can be compared.

    Left out: NULL ids; vectors that are NULL, empty, all zero, or hold NULL or
    non-finite components; and vectors whose length is not the most common one.
    """
    rows = df.select(
        F.col(vec_id).cast("long").alias("id"),
        F.col(vector).cast("array<double>").alias("vector"),
        *[F.col(c).alias(n) for n, c in (keep or {}).items()],
    ).filter(
        "id IS NOT NULL AND forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity')) "
        "AND exists(vector, x -> x <> 0)"
    )
    length = rows.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), "length").first()
    return rows.filter(F.size("vector") == (length["length"] if length else 0))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A list column of equal lengths as a two-dimensional array."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that very small or large numbers survive squaring."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def sample(rows: DataFrame) -> np.ndarray:
    """At most SAMPLE_ROWS vectors, those with the smallest hash of their id, in that order."""
    picked = rows.select("vector", F.xxhash64("id").alias("h"), "id").orderBy("h", "id").limit(SAMPLE_ROWS)
    return matrix(picked.select("vector").toArrow()["vector"])


def k_means(points: np.ndarray, k: int, spherical: bool, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """Centroids of the sample; spherical ones are unit vectors found by largest cosine."""
    k = max(1, min(k, len(points)))
    random = np.random.default_rng(seed)
    centroids = points[np.sort(random.choice(len(points), k, replace=False))]
    for _ in range(rounds):
        near = nearest(points, centroids, spherical)
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, points)
        sizes = np.bincount(near, minlength=k)
        centroids = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centroids)
        if spherical:
            lengths = np.sqrt((centroids * centroids).sum(axis=1, keepdims=True))
            centroids = np.where(lengths > 1e-12, centroids / np.maximum(lengths, 1e-12), points[:1])
    return centroids


def nearest(points: np.ndarray, centroids: np.ndarray, spherical: bool) -> np.ndarray:
    products = points @ centroids.T
    if not spherical:
        products -= 0.5 * (centroids * centroids).sum(axis=1)
    return products.argmax(axis=1)
