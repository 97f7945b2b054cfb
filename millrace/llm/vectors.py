"""Embedding vectors as whole numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def scaled(vector: Column, scale: int, shift: int = 0) -> Column:
    """``floor(scale * c) + shift`` of each entry, taken as double."""
    return F.transform(vector.cast("array<double>"), lambda c: F.floor(c * F.lit(float(scale))) + F.lit(shift).cast("bigint"))


def usable(vector: Column, largest: float) -> Column:
    """Whether a vector is there and all its entries are finite numbers up to ``largest`` in size."""
    return F.coalesce(vector.isNotNull() & F.forall(vector.cast("array<double>"), lambda c: c.isNotNull() & (F.abs(c) <= largest)), F.lit(False))


def numbers(vectors: DataFrame, id_col: str, vector_col: str, scale: int, shift: int, largest: float) -> DataFrame:
    """``id`` and ``x`` of the usable rows; of the input only the two named columns are read."""
    v = F.col(vector_col)
    return vectors.where(usable(v, largest)).select(F.col(id_col).alias("id"), scaled(v, scale, shift).alias("x"))
