"""Whitening of embeddings with components from FEAST contour integration.

The fit list is every distinct vector of whole numbers once.  Spark makes it by a
grouping that combines before it shuffles, so a vector that fills a third of the
table is one row of each task, and sums it: first its entries, exactly, then the products
of the centred entries.  The driver gets these sums, whose size is that of the
dimensions squared whatever the rows are, solves for the largest components
(:mod:`millrace.llm.feast`) and sends them out to the rows.  How far the covariance of the
whitened fit list is from the identity is summed from the whitened numbers themselves.

Nulls and edges: rows whose vector is NULL or has a NULL or non-finite entry are
left out, as are entries beyond 10**17 after scaling, so that all are longs.  All
vectors must be of one length: that of most of the distinct ones (of equally many
the longer) counts, and rows of another one are left out.  A direction without
variance has no component, so there are fewer than asked for if the vectors span less, and
none, and so no rows, for an empty table or one vector.  ``deviation`` is NULL where it exceeds a
long.  Rows that repeat give rows each; a NULL identifier stays NULL.  Other columns
aren't read and may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import lists, small_batches, staged, table
from millrace.llm.feast import largest_pairs
from millrace.llm.vectors import numbers

LARGEST = 1e17
_FITS = 1 << 62


@dataclass
class Fit:
    """``n`` distinct vectors, the sums of their entries, and the components: values falling, unit vectors as columns."""

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    axes: np.ndarray

    def __post_init__(self):
        self.middle = [round(s / self.n) if abs(s) < 2**52 else s // self.n for s in self.sums]
        self.rest = np.array([(s - m * self.n) / self.n for s, m in zip(self.sums, self.middle, strict=True)], float)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - np.array(self.middle, np.int64)).astype(float) - self.rest

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.axes / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n * x - S)**2, exact; None where it is no long."""
        if not x.size:
            return [0] * len(x)
        reach = max(abs(int(x.min())), abs(int(x.max()))) * self.n + max(map(abs, self.sums))
        if reach < _FITS:
            away = x * self.n - np.array(self.sums, np.int64)
            if x.shape[1] * int(np.abs(away).max()) ** 2 < _FITS:
                return (away * away).sum(1).tolist()
        exact = [sum((int(v) * self.n - s) ** 2 for v, s in zip(row, self.sums, strict=True)) for row in x.tolist()]
        return [e if e < 2 * _FITS else None for e in exact]


def _matrix(a: pa.Array) -> np.ndarray:
    return a.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(a), -1)


def _products(rows):
    """Per task the rows of the matrix of products that ``rows`` of a batch gives."""
    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for b in batches:
            if b.num_rows:
                y = rows(_matrix(b.column("x")))
                total = total + y.T @ y
        if not isinstance(total, int):
            d = len(total)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(d, dtype=np.int32)), lists(total.ravel(), [d] * d, pa.float64())], ["i", "row"])

    return products


def covariance(fit: DataFrame, n: int, d: int, rows) -> np.ndarray:
    """Covariance of ``rows(x)``, which are centred, over the fit list."""
    parts = fit.select("x").mapInArrow(_products(rows), "i int, row array<double>")
    sums = parts.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v")).collect()  # d x d numbers
    out = np.zeros((d, d))
    for r in sums:
        out[r["i"], r["j"]] = r["v"] / n
    return (out + out.T) / 2


def fitted(distinct: DataFrame, n: int, d: int, components: int) -> Fit:
    """The components of a fit list of ``n`` rows of ``d`` entries."""
    sums = distinct.select(F.posexplode("x").alias("j", "v")).groupBy("j").agg(F.sum(F.col("v").cast("decimal(20,0)")).alias("v")).collect()  # d numbers
    total = [0] * d
    for r in sums:
        total[r["j"]] = int(r["v"])
    fit = Fit(n, total, 0.0, np.zeros(0), np.zeros((d, 0)))
    spread = covariance(distinct, n, d, fit.centred)
    values, axes = largest_pairs(spread, components)
    return Fit(n, total, float(np.trace(spread)), values, axes)


def _placed(fit: Fit):
    @F.arrow_udf("deviation bigint, whitened array<double>")
    def place(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            x = _matrix(batch) if len(batch) else np.zeros((0, len(fit.sums)), np.int64)
            w = fit.whitened(x)
            yield pa.StructArray.from_arrays([pa.array(fit.deviations(x), pa.int64()), lists(w.ravel(), [w.shape[1]] * len(x), pa.float64())], ["deviation", "whitened"])

    return place


def whitened(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 16, scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """A row for each usable row and component, with what all rows share: ``n``, ``explained``, ``eigenvalue`` and ``identity_error``."""
    small_batches(vectors.sparkSession)
    kept = numbers(vectors, id_col, vector_col, scale, shift, LARGEST / scale)
    distinct = staged(kept.select("x").distinct(), "fit-list")
    size = distinct.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()  # a row per length
    n, d = (size["n"], size["d"]) if size else (1, 0)
    distinct = distinct.where(F.size("x") == d)
    fit = fitted(distinct, n, d, components) if d and size else Fit(n, [0] * d, 0.0, np.zeros(0), np.zeros((d, 0)))
    k = len(fit.values)
    error = float(np.abs(covariance(distinct, n, k, fit.whitened) - np.eye(k)).max()) if k else 0.0
    shares = F.array(*[F.struct(F.lit(float(v) / fit.trace).alias("explained"), F.lit(float(v)).alias("eigenvalue")) for v in fit.values]) if k else \
        F.array().cast("array<struct<explained:double,eigenvalue:double>>")
    rows = kept.where(F.size("x") == d).select("id", _placed(fit)("x").alias("p"))
    each = rows.select("id", F.col("p.deviation").alias("deviation"), F.posexplode(F.arrays_zip(F.col("p.whitened").alias("whitened"), shares.alias("share"))).alias("at", "c"))
    return each.select("id", (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation", F.col("c.whitened").alias("whitened"),
                       F.col("c.share.explained").alias("explained"), F.lit(error).alias("identity_error"), F.col("c.share.eigenvalue").alias("eigenvalue"))


def op11_whitening_feast(spark, folder):
    return whitened(table(spark, folder, "embeddings")).withColumnRenamed("id", "vec_id")
