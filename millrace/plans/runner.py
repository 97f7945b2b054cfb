"""Run a set of queries and report the run times: one row per query, then total and geometric mean."""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession

from millrace.operators.relational import run_summary
from millrace.plans.tpcds import QUERIES


def read_parameters(spark: SparkSession, path: str) -> dict[str, dict]:
    """The parameters of one run of the pack from a JSON file: ``{query: {parameter: value}}``; it is as small as the pack."""
    text = spark.read.text(path, wholetext=True).first()[0]
    unknown = (found := json.loads(text)).keys() - QUERIES.keys()
    if unknown:
        raise ValueError(f"no such queries: {sorted(unknown)}")
    return found


def run_pack(spark: SparkSession, tables, names=None, parameters: dict | str | None = None) -> DataFrame:
    """Execute queries of the pack without keeping their rows.

    ``parameters`` maps a name to keyword arguments, or is the path of a JSON file
    that does, one file for each published run.  Only the timings, one row per query, are gathered here.
    """
    parameters = read_parameters(spark, parameters) if isinstance(parameters, str) else parameters
    rows = []
    for name in names or QUERIES:
        spark.catalog.clearCache()
        start = time.perf_counter()
        QUERIES[name](tables, **(parameters or {}).get(name, {})).write.format("noop").mode("overwrite").save()
        rows.append((name, time.perf_counter() - start))
    return spark.createDataFrame(rows, "query string, seconds double")


def summarise(timings: DataFrame) -> DataFrame:
    return run_summary(timings)
