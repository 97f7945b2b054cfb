"""Global order in parallel: row numbers and running totals over a whole table.

Rows are dealt by range and sorted, so that a row's place is that in its range plus
the rows of the ranges before it: one sort of the table, a row per range to
carry over, and no task that sees all rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import work_dir
from millrace.sources.files import save

#: The lower bits of Spark's row identifier: the place in the partition, which the upper ones number.
_PLACE = (1 << 33) - 1


def _dealt(df: DataFrame, order) -> DataFrame:
    """The rows with their range (``__p``) and place in it (``__i``), written once.

    Equal rows are told apart by the order they come in, so a value that fills a
    third of the table is split like any other.  The identifier that Spark numbers rows with holds
    partition and place.
    """
    keys = [F.col(k) if isinstance(k, str) else k for k in order]
    dealt = df.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(*keys, F.col("__tie")).sortWithinPartitions(*keys, F.col("__tie"))
    path = f"{work_dir(df.sparkSession)}/ordered-{uuid.uuid4().hex}"
    rows = save(dealt.withColumn("__at", F.monotonically_increasing_id()).drop("__tie"), path)
    return rows.withColumns({"__p": F.shiftright("__at", 33), "__i": F.col("__at").bitwiseAND(F.lit(_PLACE))}).drop("__at")


def _carried(rows: DataFrame, value: Column) -> DataFrame:
    """Per range the sum of ``value`` over the ranges before it; the window has a row per range."""
    sums = rows.groupBy("__p").agg(F.sum(value).alias("__s"))
    before = F.sum("__s").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1))
    return sums.select(F.col("__p").alias("__q"), before.alias("__before"))


def numbered(df: DataFrame, *order, name: str = "row_number") -> DataFrame:
    """``row_number()`` over the whole table; rows that are equal in ``order`` are numbered in any order."""
    rows = _dealt(df, order)
    out = rows.join(_carried(rows, F.lit(1)), F.col("__p") == F.col("__q"))
    return out.withColumn(name, F.coalesce("__before", F.lit(0)) + F.col("__i") + 1).drop("__p", "__i", "__q", "__before")


def running_total(df: DataFrame, value: str, *order, name: str = "running_total") -> DataFrame:
    """``sum(value)`` from the first row up to each one; like the sum, NULL until there is a value.  Exact for exact types."""
    rows = _dealt(df, order)
    inside = F.sum(value).over(Window.partitionBy("__p").orderBy("__i").rowsBetween(Window.unboundedPreceding, 0))
    out = rows.withColumn("__inside", inside).join(_carried(rows, F.col(value)), F.col("__p") == F.col("__q"))
    total = F.coalesce(F.col("__inside") + F.col("__before"), F.col("__inside"), F.col("__before"))
    return out.withColumn(name, total).drop("__p", "__i", "__q", "__before", "__inside")
