"""Reading the source tables and giving results plain column types."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import work_dir


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared work folder."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


_schemas: dict[tuple[str, str], T.StructType] = {}


class Source:
    """``s.orders`` is the Parquet table of that name in the folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        path = f"{self.folder}/{name}.parquet"
        known = (self.spark.sparkContext.applicationId, path)
        if known not in _schemas:  # read the footer once per session
            _schemas[known] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_schemas[known]).parquet(path)


def plain(df: DataFrame) -> DataFrame:
    """Decimals as double, whole numbers as bigint, dates and times as text."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        cols.append(c.alias(f.name))
    return df.select(*cols)
