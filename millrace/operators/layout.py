"""Summaries, lookups and wide tables: physical design as explicit jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.relational import clustered_write, reconcile, star_join
from millrace.sources.files import read_csv, unload_csv, unload_json


def build_summary(df: DataFrame, keys, aggs, path: str, files: int | None = None) -> DataFrame:
    """Aggregate once and store it range-sorted on its keys, so a point query reads few row groups."""
    clustered_write(df.groupBy(*keys).agg(*aggs), keys, path, files)
    return df.sparkSession.read.parquet(path)


def answer(summary: DataFrame, predicate: str) -> DataFrame:
    """Rows of a stored summary; the predicate reaches the Parquet scan."""
    return summary.where(predicate)


def denormalise(fact: DataFrame, *dims) -> DataFrame:
    """The fact with its dimension columns in one wide table."""
    return star_join(fact, *dims)


def build_lookup(df: DataFrame, cluster, columns, path: str, files: int | None = None) -> DataFrame:
    """A wide table clustered on ``cluster`` with bloom filters on the lookup columns."""
    clustered_write(df, cluster, path, files, bloom=columns)
    return df.sparkSession.read.parquet(path)


def lookup(df: DataFrame, **values) -> DataFrame:
    """Equality lookup; row groups are skipped by statistics and bloom filters."""
    for c, v in values.items():
        df = df.where(F.col(c) == F.lit(v))
    return df


def round_trip(df: DataFrame, path: str, kind: str = "csv") -> DataFrame:
    """Unload, load and reconcile the row counts of both sides."""
    spark: SparkSession = df.sparkSession
    if kind == "csv":
        unload_csv(df, path)
        loaded = read_csv(spark, path, schema=df.schema, header=True, multi_line=True, null_tokens=("\\N",))
    else:
        unload_json(df, path)
        loaded = spark.read.schema(df.schema).json(path)
    return reconcile({"source": df, "loaded": loaded})
