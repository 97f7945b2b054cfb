"""Queries 26-50 of the pack.  Parameter defaults are fixed values of the published run."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.semantics import asc, coefficient_of_variation, dec_ratio, desc, guarded_ratio, mean, ratio, sd
from millrace.operators.relational import (above_group_avg, exists_any, intersect, lag_buckets, on, pivot_sum, prefixed,
                                           rank_top, semi_join, star_join, top_n, union_all, union_distinct)
from millrace.plans.tpcds import common as c
from millrace.plans.tpcds.part1 import (Q15_ZIPS, _active_customers, _address_bands, _demo_bands, _web_or_catalog)


def q26(t, gender="M", marital="S", education="4 yr Degree", year=1998, limit=100):
    return c.demographic_averages(t, "cs", "cs_bill_cdemo_sk", gender, marital, education, year, limit)


def q27(t, gender="F", marital="U", education="2 yr Degree", year=2000, states=("SD", "OH", "NM", "MI", "TX", "NM"), limit=100):
    """Item and state averages with subtotal rows flagged."""
    demo = t.customer_demographics.where(f"cd_gender = '{gender}' and cd_marital_status = '{marital}' and cd_education_status = '{education}'")
    df = star_join(c.sold(t, "ss", f"d_year = {year}"), (demo.select("cd_demo_sk"), "ss_cdemo_sk", "cd_demo_sk"),
                   (t.store.where(f"s_state in {c.sql_list(states)}").select("s_store_sk", "s_state"), "ss_store_sk", "s_store_sk"),
                   (t.item.select("i_item_sk", "i_item_id"), "ss_item_sk", "i_item_sk"))
    values = ["ss_quantity", "ss_list_price", "ss_coupon_amt", "ss_sales_price"]
    finest = df.groupBy("i_item_id", "s_state").agg(*[F.sum(v).alias(f"s{i}") for i, v in enumerate(values, 1)],
                                                    *[F.count(v).alias(f"n{i}") for i, v in enumerate(values, 1)])
    out = finest.rollup("i_item_id", "s_state").agg(F.grouping("s_state").cast("int").alias("g_state"),
                                                    *[ratio(F.sum(f"s{i}"), F.sum(f"n{i}")).alias(f"agg{i}") for i in range(1, 5)])
    return top_n(out, limit, "i_item_id", "s_state")


# fixed values: quantity band, then lower bounds of list price (+10), coupon (+1000) and wholesale cost (+20)
Q28_BANDS = ((0, 5, 173, 12318, 4), (6, 10, 148, 15913, 54), (11, 15, 114, 10419, 20), (16, 20, 120, 13066, 41), (21, 25, 42, 5802, 8), (26, 30, 22, 281, 48))


def q28(t, bands=Q28_BANDS):
    """List price average, count and distinct count in six quantity bands.

    One scan: each row falls in at most one band, (band, price) is grouped first
    so the distinct count needs no expansion, then the bands go side by side.
    """
    band = F.lit(None).cast("int")
    for i, (lo, hi, price, coupon, cost) in enumerate(bands, 1):
        inside = F.expr(f"ss_quantity between {lo} and {hi} and (ss_list_price between {price} and {price + 10} "
                        f"or ss_coupon_amt between {coupon} and {coupon + 1000} or ss_wholesale_cost between {cost} and {cost + 20})")
        band = F.coalesce(band, F.when(inside, i))
    prices = t.store_sales.where(f"ss_quantity between {bands[0][0]} and {bands[-1][1]}").withColumn("band", band).where("band is not null") \
        .groupBy("band", "ss_list_price").agg(F.count("ss_list_price").alias("n"))
    aggs = []
    for i in range(1, len(bands) + 1):
        here = F.col("band") == i
        n = F.coalesce(F.sum(F.when(here, F.col("n"))), F.lit(0))
        aggs += [ratio(F.sum(F.when(here, F.col("ss_list_price") * F.col("n"))), n).alias(f"b{i}_lp"), n.alias(f"b{i}_cnt"),
                 F.count(F.when(here, F.col("ss_list_price"))).alias(f"b{i}_cntd")]
    return prices.agg(*aggs)


def q29(t, year=2000, month=4, agg=F.sum, limit=100):
    """Quantities through sale, return and re-purchase; ``agg`` chooses the aggregate."""
    df = c.sale_return_rebuy(t, f"d_moy = {month} and d_year = {year}", f"d_moy between {month} and {month + 3} and d_year = {year}",
                             f"d_year between {year} and {year + 2}")
    keys = ["i_item_id", "i_item_desc", "s_store_id", "s_store_name"]
    return top_n(df.groupBy(*keys).agg(agg("ss_quantity").alias("store_sales_quantity"), agg("sr_return_quantity").alias("store_returns_quantity"),
                                       agg("cs_quantity").alias("catalog_sales_quantity")), limit, *keys)


def _returning_customers(t, prefix, amount, year, state):
    totals = star_join(c.returned(t, prefix, f"d_year = {year}"),
                       (t.customer_address.select("ca_address_sk", F.col("ca_state").alias("ctr_state")), f"{prefix}_returning_addr_sk", "ca_address_sk")) \
        .groupBy(F.col(f"{prefix}_returning_customer_sk").alias("ctr_customer_sk"), "ctr_state").agg(F.sum(amount).alias("ctr_total_return"))
    return star_join(above_group_avg(totals, "ctr_state", "ctr_total_return", 1.2), (t.customer, "ctr_customer_sk", "c_customer_sk"),
                     (t.customer_address.where(f"ca_state = '{state}'"), "c_current_addr_sk", "ca_address_sk"))


def q30(t, year=2001, state="MI", limit=100):
    """Customers whose web returns exceed 1.2 times the average of their state."""
    cols = ["c_customer_id", "c_salutation", "c_first_name", "c_last_name", "c_preferred_cust_flag", "c_birth_day", "c_birth_month", "c_birth_year",
            "c_birth_country", "c_login", "c_email_address", "c_last_review_date", "ctr_total_return"]
    return top_n(_returning_customers(t, "wr", "wr_return_amt", year, state).select(*cols), limit, *cols)


def q31(t, year=1999, order="web_q1_q2_increase"):
    """Counties where web sales grew faster than store sales over two quarters.

    The three quarters of a county are pivoted in one aggregate per channel.
    """
    def quarters(p):
        df = star_join(c.sold(t, p, f"d_year = {year} and d_qoy in (1, 2, 3)", "d_qoy"),
                       (t.customer_address.select("ca_address_sk", "ca_county"), c.BUYER_ADDRESS[p], "ca_address_sk"))
        return df.groupBy(F.col("ca_county").alias(f"{p}_county")).agg(
            *[F.sum(F.when(F.col("d_qoy") == q, F.col(f"{p}_ext_sales_price"))).alias(f"{p}{q}") for q in (1, 2, 3)])

    df = quarters("ss").join(quarters("ws"), on(("ss_county", "ws_county")))
    df = df.where((guarded_ratio("ws2", "ws1") > guarded_ratio("ss2", "ss1")) & (guarded_ratio("ws3", "ws2") > guarded_ratio("ss3", "ss2")))
    out = df.select(F.col("ss_county").alias("ca_county"), F.lit(year).cast("bigint").alias("d_year"), ratio("ws2", "ws1").alias("web_q1_q2_increase"),
                    ratio("ss2", "ss1").alias("store_q1_q2_increase"), ratio("ws3", "ws2").alias("web_q2_q3_increase"), ratio("ss3", "ss2").alias("store_q2_q3_increase"))
    return out.orderBy(asc(order), asc("ca_county"))


def _excess_discount(t, p, manufacturer, start):
    """Discounts of one manufacturer above 1.3 times the item's average over 90 days (q32, q92)."""
    mine = star_join(c.sold(t, p, c.between_days(start, 90)), (t.item.where(f"i_manufact_id = {manufacturer}").select("i_item_sk"), f"{p}_item_sk", "i_item_sk"))
    high = above_group_avg(mine.select(f"{p}_item_sk", f"{p}_ext_discount_amt"), f"{p}_item_sk", f"{p}_ext_discount_amt", 1.3)
    return high.agg(F.sum(f"{p}_ext_discount_amt").alias("excess_discount_amount"))


def q32(t, manufacturer=283, start="1999-02-22"):
    return _excess_discount(t, "cs", manufacturer, start)


def q33(t, category="Electronics", year=1999, month=7, gmt_offset=-5, limit=100):
    makers = t.item.where(f"i_category = '{category}'").select(F.col("i_manufact_id").alias("wanted"))
    return top_n(c.channel_totals(t, "i_manufact_id", makers, f"d_year = {year} and d_moy = {month}", gmt_offset), limit, "total_sales")


def q34(t, counties=("Quay County", "Sumner County", "Harper County", "Pipestone County", "Kittitas County", "Surry County", "Wadena County", "Richland County"),
        year=1998, least=15, most=20):
    """Customers with many items on one ticket early or late in the month."""
    lines = c.basket(t, f"(d_dom between 1 and 3 or d_dom between 25 and 28) and d_year between {year} and {year + 2}", f"s_county in {c.sql_list(counties)}",
                     "hd_buy_potential in ('1001-5000', '0-500') and hd_vehicle_count > 0 and hd_dep_count / hd_vehicle_count > 1.2", F.count(F.lit(1)).alias("cnt"))
    cols = ["c_last_name", "c_first_name", "c_salutation", "c_preferred_cust_flag", "ss_ticket_number", "cnt"]
    return star_join(lines.where(f"cnt between {least} and {most}"), (t.customer, "ss_customer_sk", "c_customer_sk")).select(*cols) \
        .orderBy(asc(cols[0]), asc(cols[1]), asc(cols[2]), desc(cols[3]), asc(cols[4]))


def q35(t, year=2000, aggs=("stddev_samp", "max", "sum"), limit=100):
    """Demographic statistics of store customers who also bought on the web or by catalog."""
    when = f"d_year = {year} and d_qoy < 4"
    df = exists_any(_active_customers(t, when), _web_or_catalog(t, when), "c_customer_sk")
    keys = ["ca_state", "cd_gender", "cd_marital_status", "cd_dep_count", "cd_dep_employed_count", "cd_dep_college_count"]
    fns = {"stddev_samp": sd, "max": F.max, "sum": F.sum, "min": F.min, "avg": mean}
    named = [(a if aggs.index(a) == i else f"{a}{i + 1}", fns[a]) for i, a in enumerate(aggs)]  # a repeated aggregate gets its position
    grouped = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt"), *[fn(k).alias(f"{a}_{k[3:]}") for k in keys[3:] for a, fn in named])
    shown = keys[:3]
    for i, k in enumerate(keys[3:], 1):
        shown = shown + [k, F.col("cnt").alias(f"cnt{i}"), *[f"{a}_{k[3:]}" for a, _ in named]]
    return top_n(grouped.select(*shown), limit, *keys)


def q36(t, year=1998, states=("GA", "AL", "LA", "NM", "MN", "NM", "CO", "MI"), limit=100):
    """Gross margin ranked inside the item hierarchy."""
    df = star_join(c.sold(t, "ss", f"d_year = {year}"), (t.store.where(f"s_state in {c.sql_list(states)}").select("s_store_sk"), "ss_store_sk", "s_store_sk"),
                   (t.item.select("i_item_sk", "i_category", "i_class"), "ss_item_sk", "i_item_sk"))
    finest = df.groupBy("i_category", "i_class").agg(F.sum("ss_net_profit").alias("p"), F.sum("ss_ext_sales_price").alias("s"))
    return c.margin_hierarchy(finest, ["i_category", "i_class"], ratio(F.sum("p"), F.sum("s")), asc, "gross_margin", limit)


def _stocked_and_sold(t, sales, item_key, price, start, makers, limit):
    """Items in a price band with stock of 100 to 500 in 60 days and any sale (q37, q82).

    Both existence tests are semi joins, so no item is multiplied by its rows;
    sales of other items are dropped before they are moved.
    """
    when = c.days(t, c.between_days(start, 60))
    stock = semi_join(t.stock_near(when).where("inv_quantity_on_hand between 100 and 500"), when, ("inv_date_sk", "d_date_sk"))
    items = t.item.where(f"i_current_price between {price} and {price + 30} and i_manufact_id in {c.sql_list(makers)}")
    sales = semi_join(sales.select(item_key), items.select(F.col("i_item_sk").alias("wanted")), (item_key, "wanted"))
    out = semi_join(semi_join(items, stock, ("i_item_sk", "inv_item_sk"), many=True), sales, ("i_item_sk", item_key), many=True).select("i_item_id", "i_item_desc", "i_current_price").distinct()
    return top_n(out, limit, "i_item_id")


def q37(t, price=58, start="2001-02-11", makers=(910, 893, 984, 865), limit=100):
    return _stocked_and_sold(t, t.catalog_sales, "cs_item_sk", price, start, makers, limit)


def _buyer_days(t, first_month):
    when = f"d_month_seq between {first_month} and {first_month + 11}"
    return [star_join(c.sold(t, p, when, "d_date"), (t.customer.select("c_customer_sk", "c_last_name", "c_first_name"), c.BUYER[p], "c_customer_sk"))
            .select("c_last_name", "c_first_name", "d_date") for p in ("ss", "cs", "ws")]


def q38(t, first_month=1176):
    """Number of (customer name, day) pairs seen in all three channels."""
    return intersect(*_buyer_days(t, first_month)).agg(F.count(F.lit(1)).alias("cnt"))


def q39(t, year=2001, month=1, least=None):
    """Items whose stock varies strongly in two consecutive months of a warehouse."""
    df = star_join(c.stocked(t, c.days(t, f"d_year = {year} and d_moy in ({month}, {month + 1})", "d_moy")),
                   (t.item.select("i_item_sk"), "inv_item_sk", "i_item_sk"), (t.warehouse.select("w_warehouse_sk", "w_warehouse_name"), "inv_warehouse_sk", "w_warehouse_sk"))
    stats = df.groupBy("w_warehouse_name", "w_warehouse_sk", "i_item_sk", "d_moy").agg(
        mean("inv_quantity_on_hand").alias("mean"), coefficient_of_variation("inv_quantity_on_hand").alias("cov")) \
        .where("cov > 1").drop("w_warehouse_name")
    now, then = stats.where(f"d_moy = {month}"), prefixed(stats.where(f"d_moy = {month + 1}"), "next_")
    if least is not None:
        now = now.where(f"cov > {least}")
    return now.join(then, on(("i_item_sk", "next_i_item_sk"), ("w_warehouse_sk", "next_w_warehouse_sk"))) \
        .select("w_warehouse_sk", "i_item_sk", "d_moy", "mean", "cov", "next_w_warehouse_sk", "next_i_item_sk", "next_d_moy", "next_mean", "next_cov") \
        .orderBy("w_warehouse_sk", "i_item_sk", "d_moy", "mean", "cov", "next_d_moy", "next_mean", "next_cov")


def q39b(t, year=2001, month=1, least=1.5):
    return q39(t, year, month, least)


def q40(t, day="2002-05-08", lo=0.99, hi=1.49, limit=100):
    """Catalog sales net of refunds around a day, per warehouse state and item."""
    items = t.item.where(f"i_current_price between {lo} and {hi}").select("i_item_sk", "i_item_id")
    df = star_join(c.sold(t, "cs", c.between_days(day, 30, 30), "d_date"), (items, "cs_item_sk", "i_item_sk"),
                   (t.warehouse.select("w_warehouse_sk", "w_state"), "cs_warehouse_sk", "w_warehouse_sk"))
    net = F.expr("cs_sales_price - coalesce(cr_refunded_cash, cast(0 as decimal(8,2)))")
    early = F.col("d_date") < F.lit(day).cast("date")
    out = c.with_returns(t, df, "cs", items=items).groupBy("w_state", "i_item_id").agg(
        F.coalesce(F.sum(F.when(early, net)), F.lit(0)).alias("sales_before"), F.coalesce(F.sum(F.when(~early, net)), F.lit(0)).alias("sales_after"))
    return top_n(out, limit, "w_state", "i_item_id")


# fixed values: category, colours, units, sizes
Q41_VARIANTS = (
    ("Women", ("seashell", "indian"), ("Carton", "Dozen"), ("small", "extra large")), ("Women", ("thistle", "green"), ("Box", "Tsp"), ("N/A", "large")),
    ("Men", ("steel", "papaya"), ("Dram", "Bundle"), ("petite", "economy")), ("Men", ("pink", "black"), ("Gross", "Oz"), ("small", "extra large")),
    ("Women", ("lemon", "chocolate"), ("Each", "N/A"), ("small", "extra large")), ("Women", ("purple", "peru"), ("Ounce", "Unknown"), ("N/A", "large")),
    ("Men", ("rosy", "floral"), ("Pound", "Ton"), ("petite", "economy")), ("Men", ("plum", "firebrick"), ("Bunch", "Gram"), ("small", "extra large")))


def q41(t, maker=869, variants=Q41_VARIANTS, limit=100):
    """Products of makers that offer any of the listed variants."""
    any_variant = " or ".join(f"(i_category = '{k}' and i_color in {c.sql_list(co)} and i_units in {c.sql_list(u)} and i_size in {c.sql_list(s)})" for k, co, u, s in variants)
    makers = t.item.where(any_variant).select(F.col("i_manufact").alias("maker"))
    out = semi_join(t.item.where(f"i_manufact_id between {maker} and {maker + 40}"), makers, ("i_manufact", "maker")).select("i_product_name").distinct()
    return top_n(out, limit, "i_product_name")


def _managed_sales(t, manager, month, year, *keys):
    df = star_join(c.sold(t, "ss", f"d_moy = {month} and d_year = {year}", "d_year"), (t.item.where(f"i_manager_id = {manager}"), "ss_item_sk", "i_item_sk"))
    return df.groupBy(*keys).agg(F.sum("ss_ext_sales_price").alias("ext_price"))


def q42(t, manager=1, month=12, year=2001, limit=100):
    out = _managed_sales(t, manager, month, year, "d_year", "i_category_id", "i_category")
    return top_n(out, limit, desc("ext_price"), "d_year", "i_category_id", "i_category")


def q43(t, gmt_offset=-6, year=2000, limit=100):
    """Store sales per weekday."""
    df = star_join(c.sold(t, "ss", f"d_year = {year}", "d_day_name"), (t.store.where(f"s_gmt_offset = {gmt_offset}"), "ss_store_sk", "s_store_sk"))
    return top_n(df.groupBy("s_store_name", "s_store_id").agg(*pivot_sum("d_day_name", c.WEEK, "ss_sales_price")), limit, "s_store_name", "s_store_id", *c.WEEK)


def q44(t, store=112, null_column="ss_hdemo_sk", top=10, limit=100):
    """The ten best and ten worst items of a store, paired by rank."""
    sales = t.store_sales.where(f"ss_store_sk = {store}").select("ss_item_sk", "ss_net_profit", null_column)
    floor = sales.where(f"{null_column} is null").agg((mean("ss_net_profit") * 0.9).alias("floor"))
    items = sales.groupBy("ss_item_sk").agg(mean("ss_net_profit").alias("rank_col")).crossJoin(floor).where("rank_col > floor").drop("floor")
    names = t.item.select("i_item_sk", "i_product_name")
    low = star_join(rank_top(items, "rank_col", top), (names, "ss_item_sk", "i_item_sk")).select("rnk", F.col("i_product_name").alias("best_performing"))
    high = star_join(rank_top(items, "rank_col", top, descending=True), (names, "ss_item_sk", "i_item_sk")).select("rnk", F.col("i_product_name").alias("worst_performing"))
    return top_n(low.join(high, "rnk"), limit, "rnk")


def q45(t, zips=Q15_ZIPS, item_sks=(2, 3, 5, 7, 11, 13, 17, 19, 23, 29), quarter=1, year=1998, by=("ca_zip", "ca_city"), limit=100):
    """Web sales per zip and city where the zip or the item id qualifies."""
    ids = t.item.where(f"i_item_sk in {c.sql_list(item_sks)}").select(F.col("i_item_id").alias("id")).distinct().withColumn("listed", F.lit(True))
    df = star_join(c.sold(t, "ws", f"d_qoy = {quarter} and d_year = {year}"),
                   (t.customer.select("c_customer_sk", "c_current_addr_sk"), "ws_bill_customer_sk", "c_customer_sk"),
                   (t.customer_address.select("ca_address_sk", "ca_zip", *[x for x in by if x != "ca_zip"]), "c_current_addr_sk", "ca_address_sk"),
                   (t.item.select("i_item_sk", "i_item_id"), "ws_item_sk", "i_item_sk"), (ids, "i_item_id", "id", "left"))
    df = df.where(f"substr(ca_zip, 1, 5) in {c.sql_list(zips)} or listed")
    return top_n(df.groupBy(*by).agg(F.sum("ws_sales_price").alias("sum_sales")), limit, *by)


def _away_baskets(t, lines):
    home = t.customer_address.select(F.col("ca_address_sk").alias("home_sk"), F.col("ca_city").alias("home_city"))
    df = star_join(lines, (t.customer, "ss_customer_sk", "c_customer_sk"), (home, "c_current_addr_sk", "home_sk"))
    return df.where("home_city <> ca_city").withColumnRenamed("ca_city", "bought_city").withColumnRenamed("home_city", "ca_city")


def q46(t, deps=4, vehicles=3, year=1999, cities=("Woodland", "Rockville", "Oakdale", "Pleasant Grove", "Springfield"), limit=100):
    """Weekend baskets bought in another city than the buyer's home."""
    lines = c.basket(t, f"d_dow in (6, 0) and d_year between {year} and {year + 2}", f"s_city in {c.sql_list(cities)}",
                     f"hd_dep_count = {deps} or hd_vehicle_count = {vehicles}", F.sum("ss_coupon_amt").alias("amt"), F.sum("ss_net_profit").alias("profit"),
                     keep=("ss_ticket_number", "ss_customer_sk", "ss_addr_sk", "ca_city"), address=True)
    out = _away_baskets(t, lines).select("c_last_name", "c_first_name", "ca_city", "bought_city", "ss_ticket_number", "amt", "profit")
    return top_n(out, limit, "c_last_name", "c_first_name", "ca_city", "bought_city", "ss_ticket_number")


def _around_year(year):
    return f"d_year = {year} or (d_year = {year - 1} and d_moy = 12) or (d_year = {year + 1} and d_moy = 1)"


def q47(t, year=1999, columns=("s_store_name", "s_company_name"), then="sum_sales", limit=100):
    """Monthly brand sales per store that deviate from the yearly average, with both neighbours."""
    keys = ["i_category", "i_brand", "s_store_name", "s_company_name"]
    df = star_join(c.sold(t, "ss", _around_year(year), "d_year", "d_moy"), (t.item, "ss_item_sk", "i_item_sk"), (t.store, "ss_store_sk", "s_store_sk")) \
        .groupBy(*keys, "d_year", "d_moy").agg(F.sum("ss_sales_price").alias("sum_sales"))
    out = c.neighbours(df, keys, year, "")
    gap = asc(F.col("sum_sales").cast("double") - F.col("avg_monthly_sales"))
    return top_n(out.select(*columns, "d_year", "d_moy", "avg_monthly_sales", "sum_sales", "psum", "nsum"), limit, gap, then)


def q48(t, year=2001, demo=(("D", "Secondary", 100, 150), ("W", "2 yr Degree", 50, 100), ("U", "Unknown", 150, 200)),
        address=((("VA", "MI", "FL"), 0, 2000), (("SC", "GA", "MN"), 150, 3000), (("OK", "IA", "TX"), 50, 25000))):
    """Store quantity under OR-ed bands."""
    df = star_join(c.sold(t, "ss", f"d_year = {year}"), (t.store.select("s_store_sk"), "ss_store_sk", "s_store_sk"),
                   (t.customer_demographics, "ss_cdemo_sk", "cd_demo_sk"), (t.customer_address, "ss_addr_sk", "ca_address_sk"))
    return df.where(_demo_bands(demo, "ss_sales_price")).where(_address_bands(address, "ss_net_profit")).agg(F.sum("ss_quantity").alias("sum_quantity"))


def _rank_among(picked, items, value, name):
    """The rank of a few rows among all: one more than the items with a smaller value."""
    values = picked.select(F.col(value).alias("__v")).distinct()
    below = items.select(F.col(value).alias("__x")).join(F.broadcast(values), F.col("__x") < F.col("__v")).groupBy("__v").agg(F.count(F.lit(1)).alias("__n"))
    return picked.join(below, F.col(value) == F.col("__v"), "left").withColumn(name, F.coalesce("__n", F.lit(0)).cast("int") + 1).drop("__v", "__n")


def q49(t, year=2002, month=11, amount=10000, top=10, limit=100):
    """Items with the worst return ratios per channel, by quantity or by money.

    Filtering the returned amount makes the outer join an inner one.  The rows
    with a rank up to ``top`` are found among that many extremes; the other rank
    of these few rows is a count of the items below them.
    """
    parts = []
    for label, p in (("web", "ws"), ("catalog", "cs"), ("store", "ss")):
        _, rp, _, _, ramt = c.RETURNS[p]
        df = c.with_returns(t, c.sold(t, p, f"d_year = {year} and d_moy = {month}"), p, "inner") \
            .where(f"{ramt} > {amount} and {p}_net_profit > 1 and {p}_net_paid > 0 and {p}_quantity > 0")
        items = df.groupBy(F.col(f"{p}_item_sk").alias("item")).agg(
            dec_ratio(F.sum(F.coalesce(f"{rp}_return_quantity", F.lit(0))), F.sum(f"{p}_quantity"), 15, 4).alias("return_ratio"),
            dec_ratio(F.sum(F.coalesce(ramt, F.lit(0).cast("decimal(8,2)"))), F.sum(f"{p}_net_paid"), 15, 4).alias("currency_ratio"))
        worst = union_distinct(*[rank_top(items, v, top).select(*items.columns) for v in ("return_ratio", "currency_ratio")])
        ranked = _rank_among(_rank_among(worst, items, "return_ratio", "return_rank"), items, "currency_ratio", "currency_rank")
        parts.append(ranked.select(F.lit(label).alias("channel"), "item", "return_ratio", "return_rank", "currency_rank"))
    return top_n(union_distinct(*parts), limit, "channel", "return_rank", "currency_rank", "item")


def q50(t, year=1998, month=10, limit=100):
    """How long store goods were kept before their return, per store."""
    keys = ["s_store_name", "s_company_id", "s_street_number", "s_street_name", "s_street_type", "s_suite_number", "s_city", "s_county", "s_state", "s_zip"]
    backs = c.returned(t, "sr", f"d_year = {year} and d_moy = {month}").drop("d_date_sk")
    df = backs.join(t.store_sales, on(("sr_ticket_number", "ss_ticket_number"), ("sr_item_sk", "ss_item_sk"), ("sr_customer_sk", "ss_customer_sk")))
    df = star_join(df, (c.days(t, "true"), "ss_sold_date_sk", "d_date_sk"), (t.store, "ss_store_sk", "s_store_sk"))
    return top_n(df.groupBy(*keys).agg(*lag_buckets("sr_returned_date_sk - ss_sold_date_sk")), limit, *keys)
