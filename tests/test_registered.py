"""Every registered query against its DuckDB text."""

import pytest

import __spark_entry__ as driver
import check

FOLDER = "/root/testdata/sf0.01"
QUERIES, SQL = driver.queries(), driver.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = check.connect(FOLDER)
    yield con
    con.close()


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_duckdb(spark, duck, name):
    verdict, n, _ = check.compare(spark, duck, FOLDER, name, QUERIES[name], SQL.get(name))
    assert n > 0
    assert verdict == ("ok" if name in SQL else "rows-only"), verdict


def test_column_types_are_the_same_on_both_sides(spark, duck):
    kinds = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    for name in ("revenue_share_by_region", "cdc_scd2", "rollup_grouping", "tpcds_q05", "tpcds_q66"):
        want = {r[0]: r[1] for r in duck.execute("describe " + SQL[name]).fetchall()}
        assert {c: kinds[t] for c, t in QUERIES[name](spark, FOLDER).dtypes} == want


def test_entry_has_rows(spark):
    assert driver.entry(spark).limit(1).count() == 1


def test_every_sql_text_has_a_query():
    assert set(SQL) <= set(QUERIES)
