"""Centroid clustering with bounds from an n-simplex projection.

A few pivots span a simplex.  The distances of a vector to the pivots are taken
once, and give its apex: its coordinates in the space of the simplex and its
height above that space.  Of two vectors, the distance of the apexes is at most
their true distance; with one of the apexes mirrored below the base it is at
least that.  Both cost a few numbers instead of a whole vector.  A centroid whose
lower bound exceeds the least upper bound, or the distance to the one of the least lower bound, is passed
over, and only the others are compared, exactly, in whole numbers.  Ties go to the smaller number.

Vectors and apexes are written once.  Each round reads them, sums every cluster
within its task and then over the tasks; the driver gets one sum per cluster and
dimension, and no row.

Nulls and edges: rows whose vector is NULL, of another length, or with a NULL or
non-finite entry are left out, and so are entries beyond 10**8 after scaling, as
the square of their distance is no long.  A NULL identifier stays NULL and comes last where first
centroids are chosen; rows that repeat are clustered each, and rows of one
identifier are ordered by their vectors.  With fewer rows than centroids each row
starts one; an empty table gives an empty result.  Other columns aren't read and
may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import lists, small_batches, staged, table
from millrace.llm.vectors import numbers

#: Largest scaled entry: 64 squares of a difference of two of them are a long.
LARGEST = 10**8
#: Bounds are rounded numbers; a centroid is passed over only if it is farther by this part of the scale.
MARGIN = 1e-6
_PAIRS = 1 << 15


@dataclass
class Simplex:
    """Pivots (whole numbers), the inverse of the base's coordinates and the squares of the pivots' distances to the first."""

    pivots: np.ndarray
    inverse: np.ndarray
    squares: np.ndarray

    @classmethod
    def of(cls, points: np.ndarray, most: int) -> Simplex:
        """Take pivots one by one, each the point highest above the space of those before."""
        chosen = [0]
        rest = points.astype(float) - points[0].astype(float)
        heights = (rest**2).sum(1)
        least = 1e-6 * heights.max(initial=0.0)
        while len(chosen) < min(most, len(points)) and heights.max(initial=0.0) > least:
            k = int(heights.argmax())
            chosen.append(k)
            axis = rest[k] / np.sqrt(heights[k])
            rest = rest - np.outer(rest @ axis, axis)
            heights = (rest**2).sum(1)
        pivots = points[chosen]
        away = (pivots[1:] - pivots[0]).astype(float)
        base = np.linalg.cholesky(away @ away.T) if len(away) else np.zeros((0, 0))
        return cls(pivots, np.linalg.inv(base), (away**2).sum(1))

    def apexes(self, x: np.ndarray) -> np.ndarray:
        """Coordinates in the base and the height, from the distances to the pivots alone."""
        squares = np.stack([((x - p) ** 2).sum(1) for p in self.pivots], 1).astype(float) if len(x) else np.zeros((0, len(self.pivots)))
        inside = (squares[:, :1] + self.squares - squares[:, 1:]) / 2 @ self.inverse.T
        height = np.sqrt(np.clip(squares[:, 0] - (inside**2).sum(1), 0, None))
        return np.concatenate([inside, height[:, None]], 1)


def bounds(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the squared distance of each row of ``a`` to each of ``b``."""
    inside = ((a[:, None, :-1] - b[None, :, :-1]) ** 2).sum(2)
    return inside + (a[:, -1:] - b[:, -1]) ** 2, inside + (a[:, -1:] + b[:, -1]) ** 2


def _squares(x: np.ndarray, centroids: np.ndarray, row: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Exact squared distances of some pairs."""
    far = np.empty(len(row), np.int64)
    for k in range(0, len(row), _PAIRS):
        d = x[row[k:k + _PAIRS]] - centroids[number[k:k + _PAIRS]]
        far[k:k + _PAIRS] = np.einsum("ij,ij->i", d, d)
    return far


def nearest(x: np.ndarray, apex: np.ndarray, centroids: np.ndarray, centroid_apex: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid and squared distance of each row, and how many distances were taken for them.

    The centroid of the least lower bound is compared first; its distance, or the least upper bound, is what others must reach.
    """
    low, high = bounds(apex, centroid_apex)
    scale = (apex**2).sum(1) + (centroid_apex**2).sum(1).max()
    each = np.arange(len(x))
    first = low.argmin(1)
    least = np.minimum(high.min(1), _squares(x, centroids, each, first))
    row, number = np.nonzero(low <= (least + MARGIN * (scale + 1))[:, None])
    far = _squares(x, centroids, row, number)
    least = np.minimum.reduceat(far, np.searchsorted(row, each))
    best = np.flatnonzero(far == least[row])  # in order of row, then number
    return number[best[np.searchsorted(row[best], each)]], least, len(row) + len(x)


def _matrix(a: pa.Array, kind) -> np.ndarray:
    return a.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(a), -1)


def _apex_of(simplex: Simplex):
    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def apex(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for x in batches:
            a = simplex.apexes(_matrix(x, np.int64)) if len(x) else np.zeros((0, 1))
            yield lists(a.ravel(), [a.shape[1]] * len(x), pa.float64())

    return apex


def _assigned(centroids: np.ndarray, simplex: Simplex):
    placed = simplex.apexes(centroids)

    @F.arrow_udf("cluster int, distance bigint")
    def assign(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for x, apex in batches:
            number, far = nearest(_matrix(x, np.int64), _matrix(apex, float), centroids, placed)[:2] if len(x) else (np.zeros(0), np.zeros(0))
            yield pa.StructArray.from_arrays([pa.array(number.astype(np.int32)), pa.array(far.astype(np.int64))], ["cluster", "distance"])

    return assign


def _summed(centroids: np.ndarray, simplex: Simplex):
    """Per task one row for each centroid: the sums of its vectors, and how many they are."""
    placed = simplex.apexes(centroids)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(centroids), centroids.shape[1] + 1), np.int64)
        for b in batches:
            if b.num_rows:
                x = _matrix(b.column("x"), np.int64)
                number = nearest(x, _matrix(b.column("apex"), float), centroids, placed)[0]
                order = np.argsort(number, kind="stable")
                found, first = np.unique(number[order], return_index=True)
                total[found] += np.add.reduceat(np.concatenate([x, np.ones((len(x), 1), np.int64)], 1)[order], first)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), lists(total.ravel(), [total.shape[1]] * len(total), pa.int64())], ["cluster", "sums"])

    return sums


def moved(vectors: DataFrame, centroids: np.ndarray, simplex: Simplex) -> np.ndarray:
    """Each centroid's vectors averaged and rounded down; one without vectors stays."""
    parts = vectors.select("x", "apex").mapInArrow(_summed(centroids, simplex), "cluster int, sums array<bigint>")
    sums = parts.select("cluster", F.posexplode("sums").alias("at", "v")).groupBy("cluster", "at").agg(F.sum("v").alias("v")).collect()  # a number per cluster and dimension
    total = np.zeros((len(centroids), centroids.shape[1] + 1), np.int64)
    for r in sums:
        total[r["cluster"], r["at"]] = r["v"]
    n = total[:, -1:]
    return np.where(n > 0, total[:, :-1] // np.maximum(n, 1), centroids)


def first_centroids(kept: DataFrame, k: int, seed: str) -> np.ndarray:
    """The vectors of the ``k`` smallest hashes of identifiers."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    picked = staged(kept.select(order.alias("h"), "x").orderBy(F.col("h").asc_nulls_last(), "x").limit(k), "first-centroids")
    rows = picked.orderBy(F.col("h").asc_nulls_last(), "x").collect()  # k rows
    return np.array([r["x"] for r in rows], np.int64) if rows else np.zeros((0, 0), np.int64)


def clusters(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dimensions: int = 64, scale: int = 256, k: int = 40,
             rounds: int = 5, seed: str = "2", pivots: int = 12) -> tuple[DataFrame, np.ndarray]:
    """(``id``, ``cluster`` and ``distance`` of every usable row, the final centroids)."""
    small_batches(vectors.sparkSession)
    kept = numbers(vectors.where(F.size(vector_col) == dimensions), id_col, vector_col, scale, 0, (LARGEST - 1) / scale)
    centroids = first_centroids(kept, k, seed)
    if not len(centroids):
        return kept.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance")), centroids
    simplex = Simplex.of(centroids, pivots)
    rows = kept.select("id", F.col("x").cast("array<int>").alias("x"))
    rows = staged(rows.withColumn("apex", _apex_of(simplex)("x")), "apexes")
    for _ in range(rounds):
        centroids = moved(rows, centroids, simplex)
    return staged(rows.select("id", _assigned(centroids, simplex)("x", "apex").alias("a")).select("id", "a.*"), "clusters"), centroids


def op12_centroid_simplex(spark, folder):
    rows, centroids = clusters(table(spark, folder, "embeddings"))
    digest = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    sums = {r["cluster"]: r["s"] for r in rows.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # a row per cluster
    facts = spark.createDataFrame([(c, s, sum(sums.values()), digest[c]) for c, s in sums.items()], "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return rows.join(F.broadcast(facts), "cluster").select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
