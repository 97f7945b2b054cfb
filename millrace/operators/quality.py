"""Repair and constraint checks.  A check returns the violating rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def repaired_line(c) -> Column:
    """A CSV line without quoting, stray quotes inside the text kept.

    A quote delimits at either end of the line and next to a comma; only such
    quotes are removed.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(c, r'(?<=^|,)"|"(?=,|$)', "")


def repair_quotes(df: DataFrame, column: str, names) -> DataFrame:
    """Lines with stray quotes split into named columns.

    A comma inside a field shifts the columns after it; the method cannot know.
    """
    line = repaired_line(column)
    return df.select(*[F.split_part(line, F.lit(","), F.lit(i)).alias(n) for i, n in enumerate(names, 1)])


def unique_violations(df: DataFrame, keys) -> DataFrame:
    """Keys that occur more than once; keys with a NULL part are not compared."""
    known = df.dropna(subset=list(keys))
    return known.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def fk_orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose key is set but has no parent."""
    return child.where(F.col(child_key).isNotNull()).join(parent.select(F.col(parent_key).alias("__p")), F.col(child_key) == F.col("__p"), "left_anti")


def fk_referenced(parent: DataFrame, child: DataFrame, parent_key: str, child_key: str) -> DataFrame:
    """Parent rows that may not be deleted because a child refers to them.

    Child keys are made distinct first, which combines before the shuffle, so a
    key with most of the children is one row in the join.
    """
    return parent.join(child.select(F.col(child_key).alias("__c")).distinct(), F.col(parent_key) == F.col("__c"), "left_semi")


def not_null_violations(df: DataFrame, columns) -> DataFrame:
    """Rows with a missing required value and the names of the missing columns."""
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]))
    return df.withColumn("missing", F.concat_ws(",", missing)).where("missing <> ''")


def apply_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    return df.select(*[F.coalesce(F.col(c), F.lit(defaults[c])).alias(c) if c in defaults else F.col(c) for c in df.columns])
