import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as driver  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session", autouse=True)
def importable(spark):
    driver._reachable()


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture(scope="session")
def texts(spark):
    """(doc_id, text) of the smallest table."""
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()}
