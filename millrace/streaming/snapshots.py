"""Change feeds of tables that are written anew: the difference of two versions.

A table that is merged into, deleted from or updated is a folder of versions.  A
reader keeps the number of the version it has seen; what changed since is one
aggregate over both versions, whatever happened between them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.sources.files import list_files


def _times(df: DataFrame, columns, n) -> DataFrame:
    """Each row as many times as ``n`` says."""
    return df.withColumn("__copy", F.explode(F.array_repeat(F.lit(0), n.cast("int")))).select(*columns)


def difference(old: DataFrame, new: DataFrame, keys) -> DataFrame:
    """The rows that only one of two versions has, with ``action`` (INSERT or DELETE) and ``is_update``.

    A row that is changed comes as a pair of the same key, the row before as DELETE
    and the one after as INSERT, both with ``is_update``.  Versions are compared as bags of whole rows, so a
    key that is not unique loses nothing; copies are counted before they move.
    """
    cols = [F.col(f"`{c}`") for c in new.columns]
    both = old.select(*cols, F.lit(-1).alias("__n")).unionByName(new.select(*cols, F.lit(1).alias("__n")))
    net = both.groupBy(*cols).agg(F.sum("__n").alias("__n")).where("__n <> 0")
    same = Window.partitionBy(*[F.col(f"`{k}`") for k in keys])
    net = net.withColumn("is_update", (F.min("__n").over(same) < 0) & (F.max("__n").over(same) > 0)).withColumn("action", F.when(F.col("__n") > 0, "INSERT").otherwise("DELETE"))
    return _times(net, [*cols, "action", "is_update"], F.abs("__n"))


def replayed(old: DataFrame, feed: DataFrame) -> DataFrame:
    """The version that follows from an earlier one and what changed; a deletion of a row that isn't there is an error."""
    cols = [F.col(f"`{c}`") for c in old.columns]
    moves = old.select(*cols, F.lit(1).alias("__n")).unionByName(feed.select(*cols, F.when(F.col("action") == "INSERT", 1).otherwise(-1).alias("__n")))
    net = moves.groupBy(*cols).agg(F.sum("__n").alias("__n"))
    there = F.when(F.col("__n") < 0, F.raise_error(F.lit("the feed deletes a row that the table does not have")).cast("boolean")).otherwise(F.col("__n") > 0)
    return _times(net.where(there), cols, F.col("__n"))


def write_version(df: DataFrame, root: str, version: int) -> None:
    """A whole version; writing a number again replaces it."""
    df.write.mode("overwrite").parquet(f"{root}/version={version}")


def read_version(spark: SparkSession, root: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{root}/version={version}")


def newest_version(spark: SparkSession, root: str) -> int:
    """The greatest number among the files; an empty version counts."""
    return list_files(spark, root).agg(F.max(F.regexp_extract("path", "/version=([0-9]+)/", 1).cast("int"))).first()[0]


def seen_version(spark: SparkSession, offset: str) -> int | None:
    """The version a reader has seen, from the folder of its offsets."""
    from pyspark.errors import AnalysisException
    try:
        return spark.read.schema("version int").parquet(offset).agg(F.max("version")).first()[0]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def mark_seen(spark: SparkSession, offset: str, version: int) -> None:
    spark.range(1).select(F.lit(version).alias("version")).write.mode("append").parquet(offset)


def consume(spark: SparkSession, root: str, offset: str, keys, apply) -> bool:
    """Hand what changed since the last call to ``apply(feed, version)`` and move the offset; False if nothing did.

    The first call only takes its place.  The offset moves after ``apply`` returns, so a call that
    fails is repeated with the same version, and ``apply`` can write under that number.
    """
    last, now = seen_version(spark, offset), newest_version(spark, root)
    if last is not None and last < now:
        apply(difference(read_version(spark, root, last), read_version(spark, root, now), keys), now)
    if last is None or last < now:
        mark_seen(spark, offset, now)
    return last is not None and last < now
