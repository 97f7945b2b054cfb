"""Facts of the derived star are views of the written order lines, and hold the rows that their text gives in DuckDB."""

import os

import duckdb
import pytest

from millrace.plans.star import RENAMED_SOURCES, needed_tables, star_sql
from millrace.plans.tables import derived_tables

FOLDER = "/root/testdata/sf0.001"
FACTS = ["store_sales", "store_returns", "catalog_sales", "catalog_returns", "web_sales", "web_returns", "inventory"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_fact_is_written(spark):
    t = derived_tables(spark, FOLDER)
    for name in FACTS:
        getattr(t, name).limit(1).collect()
    assert "order_line" in os.listdir(t._root) and not {*FACTS, "sale_line", "sale_amounts"} & set(os.listdir(t._root))


def test_sales_need_no_shuffle(spark):
    t = derived_tables(spark, FOLDER)
    assert all("Exchange" not in plan(getattr(t, name)) for name in FACTS if name != "inventory")


def test_stock_is_moved_before_it_is_multiplied(spark):
    text = plan(derived_tables(spark, FOLDER).inventory)
    assert text.count("Exchange") == 1 and text.index("Generate") < text.index("Exchange")


@pytest.mark.parametrize("name", FACTS)
def test_views_hold_the_rows_of_their_text(spark, name):
    texts, con = star_sql("duckdb"), duckdb.connect()
    for table in ("lineitem", "orders"):
        con.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    for alias, table in RENAMED_SOURCES.items():
        con.execute(f"create view {alias} as select * from '{FOLDER}/{table}.parquet'")
    for n in needed_tables(texts, texts[name]):
        con.execute(f"create view {n} as {texts[n]}")
    want = con.execute(texts[name])
    columns = [c[0] for c in want.description]
    rows = sorted(map(repr, want.fetchall()))
    assert sorted(repr(tuple(r)) for r in getattr(derived_tables(spark, FOLDER), name).select(*columns).collect()) == rows and rows


def test_orders_meet_the_stock_of_weeks_of_their_year(spark):
    from millrace.plans.tpcds import QUERIES
    plan = QUERIES["q72"](derived_tables(spark, FOLDER))._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi, (d_week_seq" in plan


def test_a_line_is_moved_once_at_any_size(spark):
    text = plan(derived_tables(spark, FOLDER)._query("order_line"))
    assert "SortMergeJoin" in text and "Broadcast" not in text
    assert text.count("Exchange hashpartitioning(l_orderkey") == 1 and text.count("Exchange hashpartitioning(o_orderkey") == 1 and text.count("Exchange") == 2


@pytest.mark.parametrize("days", ["d_year = 2001 and d_moy in (1, 2)", "d_month_seq between 1190 and 1201", "d_date = date '2000-05-19'", "d_dow = 1 and d_year = 1999", "d_year = 1994"])
def test_stock_of_some_days_is_whole(spark, days):
    t = derived_tables(spark, FOLDER)
    when = t.date_dim.where(days)
    on_days = [df.join(when, df.inv_date_sk == when.d_date_sk, "left_semi") for df in (t.stock_near(when), t.inventory)]
    near, whole = [sorted(map(tuple, df.collect())) for df in on_days]
    assert near == whole


@pytest.mark.parametrize("name", ["q21", "q22", "q37", "q39", "q39b", "q72", "q82"])
def test_only_lines_that_have_stock_on_the_days_are_moved(spark, name):
    from millrace.plans.tpcds import QUERIES
    text = plan(QUERIES[name](derived_tables(spark, FOLDER)))
    stock = text[text.index("collect_set("):]
    moved = stock[stock.index("Exchange"):]
    assert moved.index("LeftSemi") < moved.index("FileScan") and any("dynamicpruning" in line and "explode(sequence" in line for line in moved.splitlines())


@pytest.mark.parametrize("name, joins", [("q75", 3), ("q40", 1)])
def test_returns_of_other_items_are_not_moved(spark, name, joins):
    from millrace.plans.tpcds import QUERIES
    text = plan(QUERIES[name](derived_tables(spark, FOLDER)))
    assert text.count("LeftSemi") == joins


def test_only_returns_of_like_parties_meet_their_sales(spark):
    from millrace.plans.catalog.pack import PARAMETERS
    from millrace.plans.tpcds import QUERIES
    t = derived_tables(spark, FOLDER)
    joins = [line for line in plan(QUERIES["q85"](t, **PARAMETERS["q85"](t))).splitlines() if "Join [" in line]
    assert "wr_order_number" in joins[2] and any("wr_refunded_addr_sk" in line for line in joins[3:])


@pytest.mark.parametrize("name", ["q37", "q82"])
def test_sales_of_other_items_are_not_moved(spark, name):
    from millrace.plans.tpcds import QUERIES
    text = plan(QUERIES[name](derived_tables(spark, FOLDER)))
    last = text[text.rindex("LeftSemi"):]  # the semi join deepest in the branch of sales, next to their lines
    assert text.count("LeftSemi") == 5 and "l_partkey" in last and "i_manufact_id" in last and "Exchange hashpartitioning" not in last
