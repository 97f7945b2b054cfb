"""Steps shared by several queries of the pack."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.semantics import asc, coefficient_of_variation, desc, guarded_ratio, mean, ratio, sd  # noqa: F401
from millrace.plans.tables import PERIOD_DAYS, PERIOD_SUFFIX
from millrace.operators.relational import *  # noqa: F401,F403
from millrace.operators.relational import (exists_any, on, pivot_sum, prefixed, rank_in_hierarchy,  # noqa: F401
                                           ratio_to_report, semi_join, star_join, top_n, union_all)

WEEK = {"sun_sales": "Sunday", "mon_sales": "Monday", "tue_sales": "Tuesday", "wed_sales": "Wednesday",
        "thu_sales": "Thursday", "fri_sales": "Friday", "sat_sales": "Saturday"}

# channel -> (sales table, prefix, customer, address, item, returns table, returns prefix)
CHANNELS = {"store": ("store_sales", "ss"), "catalog": ("catalog_sales", "cs"), "web": ("web_sales", "ws")}
BUYER = {"ss": "ss_customer_sk", "cs": "cs_bill_customer_sk", "ws": "ws_bill_customer_sk"}
BUYER_ADDRESS = {"ss": "ss_addr_sk", "cs": "cs_bill_addr_sk", "ws": "ws_bill_addr_sk"}
RETURNS = {  # sales prefix -> returns table, prefix, sale number, return number, amount
    "ss": ("store_returns", "sr", "ss_ticket_number", "sr_ticket_number", "sr_return_amt"),
    "cs": ("catalog_returns", "cr", "cs_order_number", "cr_order_number", "cr_return_amount"),
    "ws": ("web_returns", "wr", "ws_order_number", "wr_order_number", "wr_return_amt"),
}


def days(t, predicate: str, *columns) -> DataFrame:
    """Calendar rows of a predicate, narrowed to the key and the named columns."""
    return t.date_dim.where(predicate).select("d_date_sk", *columns)


def between_days(start: str, n: int, before: int = 0) -> str:
    return f"d_date between date_sub(date '{start}', {before}) and date_add(date '{start}', {n})"


def period(date_sk: str):
    """The period that a date key lies in: what facts are partitioned by."""
    return F.expr(f"cast({date_sk} div {PERIOD_DAYS} as int)")


def dated(fact: DataFrame, date_column: str, calendar: DataFrame) -> DataFrame:
    """A fact joined with calendar rows.

    A fact that is partitioned by the period of its date joins on that too, so
    Spark reads only the partitions of the calendar rows that a query keeps.
    """
    part = date_column + PERIOD_SUFFIX
    if part not in fact.columns:
        return star_join(fact, (calendar, date_column, "d_date_sk"))
    days_of = calendar.withColumn("d_period", period("d_date_sk"))
    return fact.join(days_of, (F.col(date_column) == F.col("d_date_sk")) & (F.col(part) == F.col("d_period"))).drop(part, "d_period")


def stocked(t, calendar: DataFrame) -> DataFrame:
    """Stock joined with calendar rows."""
    return dated(t.stock_near(calendar), "inv_date_sk", calendar)


def sold(t, prefix: str, predicate: str, *columns) -> DataFrame:
    """Sales of one channel restricted to calendar rows; ``columns`` come from the calendar."""
    table = {p: n for n, p in CHANNELS.values()}[prefix]
    return dated(getattr(t, table), f"{prefix}_sold_date_sk", days(t, predicate, *columns))


def returned(t, prefix: str, predicate: str, *columns) -> DataFrame:
    table = {r[1]: r[0] for r in RETURNS.values()}[prefix]
    return dated(getattr(t, table), f"{prefix}_returned_date_sk", days(t, predicate, *columns))


def with_returns(t, sales: DataFrame, prefix: str, how: str = "left", items: DataFrame | None = None) -> DataFrame:
    """Sales lines with the return of the same number and item.

    Where all sales are of ``items`` (``i_item_sk``), returns of others meet none and are dropped before they are moved.
    """
    table, rp, number, rnumber, _ = RETURNS[prefix]
    backs = getattr(t, table)
    if items is not None:
        backs = semi_join(backs, items.select("i_item_sk"), (f"{rp}_item_sk", "i_item_sk"))
    return sales.join(backs, on((number, rnumber), (f"{prefix}_item_sk", f"{rp}_item_sk")), how)


def sql_list(values) -> str:
    return "(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + ")"


def category_share(t, prefix: str, categories, start: str, limit):
    """Revenue per item and its share of the revenue of its class (q12, q20, q98)."""
    revenue = (
        star_join(sold(t, prefix, between_days(start, 30)),
                  (t.item.where(f"i_category in {sql_list(categories)}"), f"{prefix}_item_sk", "i_item_sk"))
        .groupBy("i_item_id", "i_item_desc", "i_category", "i_class", "i_current_price")
        .agg(F.sum(f"{prefix}_ext_sales_price").alias("itemrevenue"))
    )
    shared = ratio_to_report(revenue, "itemrevenue", ["i_class"], "revenueratio", 100.0)
    return top_n(shared, limit, "i_category", "i_class", "i_item_id", "i_item_desc", "revenueratio")


def demographic_averages(t, prefix: str, cdemo: str, gender, marital, education, year, limit):
    """Average quantity and prices per promoted item for one demographic (q7, q26)."""
    p = prefix
    df = star_join(
        sold(t, p, f"d_year = {year}"),
        (t.customer_demographics.where(f"cd_gender = '{gender}' and cd_marital_status = '{marital}' and cd_education_status = '{education}'"), cdemo, "cd_demo_sk"),
        (t.promotion.where("p_channel_email = 'N' or p_channel_event = 'N'"), f"{p}_promo_sk", "p_promo_sk"),
        (t.item, f"{p}_item_sk", "i_item_sk"),
    )
    out = df.groupBy("i_item_id").agg(*[mean(f"{p}_{c}").alias(f"agg{i}") for i, c in enumerate(
        ("quantity", "list_price", "coupon_amt", "sales_price"), 1)])
    return top_n(out, limit, "i_item_id")


def customer_years(t, prefix: str, first_year: int, measure, agg=F.sum) -> DataFrame:
    """Per customer: the measure of one year and of the year after, side by side."""
    sales = sold(t, prefix, f"d_year in ({first_year}, {first_year + 1})", "d_year")
    return (sales.where(F.col(BUYER[prefix]).isNotNull()).groupBy(F.col(BUYER[prefix]).alias(f"{prefix}_cust"))
            .agg(agg(F.when(F.col("d_year") == first_year, F.expr(measure))).alias(f"{prefix}_first"),
                 agg(F.when(F.col("d_year") == first_year + 1, F.expr(measure))).alias(f"{prefix}_second"))
            .where(f"{prefix}_first > 0 and {prefix}_second is not null"))


def shipped_twice(t, prefix: str, date_column: str, start: str, state: str, outlet, returned_too: bool):
    """Orders of one state that left from several warehouses, with or without returns (q16, q94, q95)."""
    p = prefix
    table = {"cs": "catalog_sales", "ws": "web_sales"}[p]
    rt, rp, number, rnumber, _ = RETURNS[p]
    sales = getattr(t, table)
    if not returned_too:  # the row itself must differ from another row's warehouse
        sales = sales.where(f"{p}_warehouse_sk is not null")
    several = (sales.groupBy(F.col(number).alias("several")).agg(F.min(f"{p}_warehouse_sk").alias("lo"), F.max(f"{p}_warehouse_sk").alias("hi"))
               .where("lo <> hi").select("several"))
    picked = star_join(
        sales,
        (days(t, between_days(start, 60)), date_column, "d_date_sk"),
        (t.customer_address.where(f"ca_state = '{state}'").select("ca_address_sk"), f"{p}_ship_addr_sk", "ca_address_sk"),
        outlet,
        (several, number, "several", "left_semi"),
        (getattr(t, rt).select(rnumber).distinct(), number, rnumber, "left_semi" if returned_too else "left_anti"),
    )
    return picked.agg(F.count_distinct(number).alias("order_count"),
                      F.sum(f"{p}_ext_ship_cost").alias("total_shipping_cost"),
                      F.sum(f"{p}_net_profit").alias("total_net_profit"))


def sale_return_rebuy(t, first: str, back: str, again: str) -> DataFrame:
    """Store sale, its return and a later catalog purchase of the same item (q17, q25, q29)."""
    sales = star_join(t.store_sales, (days(t, first), "ss_sold_date_sk", "d_date_sk")).drop("d_date_sk")
    backs = star_join(t.store_returns, (days(t, back), "sr_returned_date_sk", "d_date_sk")).drop("d_date_sk")
    rebuys = star_join(t.catalog_sales, (days(t, again), "cs_sold_date_sk", "d_date_sk")).drop("d_date_sk")
    chain = (sales.join(backs, on(("ss_customer_sk", "sr_customer_sk"), ("ss_item_sk", "sr_item_sk"), ("ss_ticket_number", "sr_ticket_number")))
             .join(rebuys, on(("sr_customer_sk", "cs_bill_customer_sk"), ("sr_item_sk", "cs_item_sk"))))
    return star_join(chain, (t.store, "ss_store_sk", "s_store_sk"), (t.item, "ss_item_sk", "i_item_sk"))


def channel_totals(t, key: str, items: DataFrame, predicate: str, gmt_offset: int) -> DataFrame:
    """Revenue per item attribute summed over the three channels (q33, q56, q60)."""
    home = t.customer_address.where(f"ca_gmt_offset = {gmt_offset}").select("ca_address_sk")
    wanted = semi_join(t.item, items, (key, "wanted")).select("i_item_sk", key)
    parts = [star_join(sold(t, p, predicate), (home, BUYER_ADDRESS[p], "ca_address_sk"), (wanted, f"{p}_item_sk", "i_item_sk"))
             .select(key, F.col(f"{p}_ext_sales_price").alias("price")) for p in ("ss", "cs", "ws")]
    return union_all(*parts).groupBy(key).agg(F.sum("price").alias("total_sales"))


def neighbours(df: DataFrame, keys, year: int, name_first: str):
    """Months that deviate by more than a tenth from the yearly average, with the month before and after (q47, q57)."""
    from pyspark.sql import Window as W
    yearly = df.withColumn("avg_monthly_sales", (F.sum("sum_sales").over(W.partitionBy(*keys, "d_year")).cast("double")
                                                 / F.count("sum_sales").over(W.partitionBy(*keys, "d_year"))))
    line = W.partitionBy(*keys).orderBy("d_year", "d_moy")
    out = yearly.withColumn("psum", F.lag("sum_sales").over(line)).withColumn("nsum", F.lead("sum_sales").over(line))
    out = out.where(f"d_year = {year} and avg_monthly_sales > 0 and psum is not null and nsum is not null")
    return out.where(F.abs(F.col("sum_sales").cast("double") - F.col("avg_monthly_sales")) / F.col("avg_monthly_sales") > 0.1)


def deviating(df: DataFrame, keys, name: str, positive_only: bool = True) -> DataFrame:
    """Grouped sums that deviate by more than a tenth from the average of their group (q53, q63, q89)."""
    from pyspark.sql import Window as W
    w = W.partitionBy(*keys)
    out = df.withColumn(name, F.sum("sum_sales").over(w).cast("double") / F.count("sum_sales").over(w))
    out = out.where(f"{name} {'> 0' if positive_only else '<> 0'}")
    return out.where(F.abs(F.col("sum_sales").cast("double") - F.col(name)) / F.col(name) > 0.1)


def basket(t, predicate: str, store: str, household: str, *aggs, keep=("ss_ticket_number", "ss_customer_sk"), address=False):
    """Store baskets of some days, stores and households, aggregated per ticket (q34, q46, q68, q73, q79)."""
    dims = [(t.store.where(store), "ss_store_sk", "s_store_sk"),
            (t.household_demographics.where(household), "ss_hdemo_sk", "hd_demo_sk")]
    if address:
        dims.append((t.customer_address, "ss_addr_sk", "ca_address_sk"))
    return star_join(sold(t, "ss", predicate), *dims).groupBy(*keep).agg(*aggs)


def margin_hierarchy(df: DataFrame, keys, value, order, name: str, limit):
    """Rollup over two keys with a rank inside each parent (q36, q70, q86)."""
    level = grouping_level(*keys).alias("lochierarchy")  # noqa: F405
    leaf = F.grouping(keys[1]).alias("leaf")
    rolled = df.rollup(*keys).agg(value.alias(name), level, leaf)
    ranked = rank_in_hierarchy(rolled, "lochierarchy", keys[0], "leaf", order(name), "rank_within_parent").drop("leaf")
    return top_n(ranked, limit, desc("lochierarchy"), F.when(F.col("lochierarchy") == 0, F.col(keys[0])).asc_nulls_last(), "rank_within_parent")
