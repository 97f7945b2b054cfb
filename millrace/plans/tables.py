"""Catalogues of star-schema tables: ``t.store_sales`` is a DataFrame."""

from __future__ import annotations

import hashlib
import re
import threading
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from millrace.plans.star import PERIOD_DAYS, PERIOD_SUFFIX, RENAMED_SOURCES, needed_tables, star_sql  # noqa: F401
from millrace.session import work_dir
from millrace.sources.files import state_of

# What facts are views of; only the first is written.
LINES, _SHARED = "order_line", ("sale_line", "sale_amounts", "stock_line")


class Tables:
    """What all catalogues have in common."""

    def stock_near(self, calendar: DataFrame) -> DataFrame:
        """``inventory`` with all its rows on the days (``d_date_sk``) of ``calendar``; others may be left out."""
        return self.inventory


class ParquetTables(Tables):
    """Tables as ``<root>/<name>`` Parquet folders, e.g. a generated TPC-DS data set."""

    def __init__(self, spark: SparkSession, root: str, suffix: str = ""):
        self._spark, self._root, self._suffix = spark, root.rstrip("/"), suffix

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self._spark.read.parquet(f"{self._root}/{name}{self._suffix}")


class CatalogTables(Tables):
    """Tables of a metastore database."""

    def __init__(self, spark: SparkSession, database: str):
        self._spark, self._database = spark, database

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self._spark.table(f"{self._database}.{name}")


class DerivedTables(Tables):
    """The star of ``millrace.plans.star``: dimensions and order lines written as Parquet on first use, facts as views of the lines.

    A query that uses several facts, or one of them often, moves each order line
    once and reads the columns that it needs; the eightfold of the lines that is
    the stock is never moved.  The lines are partitioned by the period of their
    sale, which store sales show, so a join with a filtered calendar prunes
    partitions there.  The tasks of their join write them without a second move,
    each a file per period.
    """

    def __init__(self, spark: SparkSession, source_dir: str):
        self._spark, self._source = spark, source_dir.rstrip("/")
        tag = hashlib.sha1(f"{self._source} {source_state(spark, self._source)}".encode()).hexdigest()[:10]
        self._root = f"{work_dir(spark)}/star-{tag}"
        self._texts = star_sql("spark")
        self._views = {n for n, text in self._texts.items() if set(_SHARED) & set(needed_tables(self._texts, text))} | set(_SHARED)
        self._locks: dict[str, threading.Lock] = {}
        self._schemas: dict[str, StructType] = {}  # of written tables; a known schema saves a footer job per use

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self._view(name) if name in self._views else self._written(name)

    def stock_near(self, calendar: DataFrame) -> DataFrame:
        """Only lines that have stock on the days of ``calendar`` are read and moved."""
        return self._view("inventory_near", calendar=calendar.select("d_date_sk"))

    def _view(self, name: str, **frames: DataFrame) -> DataFrame:
        # lines and frames are CTEs, not views of the session: several stars may be in use
        frames[LINES] = self._written(LINES)
        ctes = [f"{n} as ({self._texts[n]})" for n in needed_tables(self._texts, self._texts[name]) if n in _SHARED]
        return self._sql([*[f"{n} as (select * from {{{n}}})" for n in frames], *ctes], self._texts[name], **frames)

    def stage(self, workers: int = 4) -> None:
        """Write every table now, several at a time."""
        names = [n for n in self._texts if n not in self._views]
        with ThreadPoolExecutor(workers) as pool:
            list(pool.map(self._written, names))

    def _sql(self, ctes: list[str], text: str, **frames: DataFrame) -> DataFrame:
        return self._spark.sql((f"with {', '.join(ctes)} " if ctes else "") + text, **frames)

    def _written(self, name: str) -> DataFrame:
        path = f"{self._root}/{name}"
        with self._locks.setdefault(name, threading.Lock()):
            if name not in self._schemas:
                self._write(name, path)
                self._schemas[name] = self._spark.read.parquet(path).schema
        return self._spark.read.schema(self._schemas[name]).parquet(path)

    def _query(self, name: str) -> DataFrame:
        text = self._texts[name]
        words = set(re.findall(r"\w+", text))
        sources = {src: f"{self._source}/{src}.parquet" for src in ("lineitem", "orders")}
        sources |= {alias: f"{self._source}/{src}.parquet" for alias, src in RENAMED_SOURCES.items()}
        return self._sql([f"{n} as (select * from parquet.`{where}`)" for n, where in sources.items() if n in words], text)

    def _write(self, name: str, path: str) -> None:
        out = self._query(name).write.mode("overwrite")
        (out.partitionBy("sold_period") if name == LINES else out).parquet(path)


_derived: dict[tuple[str, str, str], DerivedTables] = {}


def source_state(spark: SparkSession, source_dir: str) -> str:
    """A mark of the source files the star comes from."""
    names = sorted({"lineitem", "orders", *RENAMED_SOURCES.values()})
    return state_of(spark, [f"{source_dir}/{n}.parquet" for n in names])


def derived_tables(spark: SparkSession, source_dir: str) -> DerivedTables:
    """The star of a folder; written anew once its source files have changed."""
    folder = source_dir.rstrip("/")
    key = (spark.sparkContext.applicationId, folder, source_state(spark, folder))
    if key not in _derived:
        _derived[key] = DerivedTables(spark, source_dir)
    return _derived[key]
