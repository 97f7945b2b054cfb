"""Queries 51-75 of the pack.  Parameter defaults are fixed values of the published run."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.semantics import asc, desc, mean, ratio, round_to_int, running_to_here, within_pct
from millrace.operators.relational import (above_group_avg, anti_join, cross_rows, full_join, lag_buckets, on, pivot_sum, prefixed,
                                           rank_in, semi_join, star_join, top_n, union_all, union_distinct)
from millrace.plans.tpcds import common as c
from millrace.plans.tpcds.part1 import _active_customers, _profile_counts
from millrace.plans.tpcds.part2 import _around_year, _away_baskets, _managed_sales


def q51(t, first_month=1176, limit=100):
    """Item days on which cumulative web sales lead cumulative store sales."""
    def cumulative(p, name):
        daily = c.sold(t, p, f"d_month_seq between {first_month} and {first_month + 11}", "d_date").where(f"{p}_item_sk is not null") \
            .groupBy(F.col(f"{p}_item_sk").alias("item_sk"), "d_date").agg(F.sum(f"{p}_sales_price").alias("s"))
        return daily.select("item_sk", "d_date", F.sum("s").over(running_to_here(["item_sk"], ["d_date"])).alias(name))

    both = full_join(cumulative("ws", "web_sales"), cumulative("ss", "store_sales"), ["item_sk", "d_date"])
    line = running_to_here(["item_sk"], ["d_date"])
    out = both.withColumn("web_cumulative", F.max("web_sales").over(line)).withColumn("store_cumulative", F.max("store_sales").over(line))
    return top_n(out.where("web_cumulative > store_cumulative"), limit, "item_sk", "d_date")


def q52(t, manager=1, month=11, year=2002, limit=100):
    out = _managed_sales(t, manager, month, year, "d_year", F.col("i_brand_id").alias("brand_id"), F.col("i_brand").alias("brand"))
    return top_n(out, limit, "d_year", desc("ext_price"), "brand_id")


# fixed values
Q53_KINDS = (
    (("Books", "Children", "Electronics"), ("personal", "portable", "reference", "self-help"),
     ("scholaramalgamalg #14", "scholaramalgamalg #7", "exportiunivamalg #9", "scholaramalgamalg #9")),
    (("Women", "Music", "Men"), ("accessories", "classical", "fragrances", "pants"),
     ("amalgimporto #1", "edu packscholar #1", "exportiimporto #1", "importoamalg #1")))


def _kinds(kinds):
    return " or ".join(f"(i_category in {c.sql_list(a)} and i_class in {c.sql_list(b)} and i_brand in {c.sql_list(d)})" for a, b, d in kinds)


def _kind_deviation(t, first_month, kinds, key, period, name):
    df = star_join(c.sold(t, "ss", f"d_month_seq between {first_month} and {first_month + 11}", period), (t.item.where(_kinds(kinds)), "ss_item_sk", "i_item_sk"),
                   (t.store.select("s_store_sk"), "ss_store_sk", "s_store_sk"))
    sums = df.groupBy(key, period).agg(F.sum("ss_sales_price").alias("sum_sales")).drop(period)
    return c.deviating(sums, [key], name)


def q53(t, first_month=1213, kinds=Q53_KINDS, limit=100):
    out = _kind_deviation(t, first_month, kinds, "i_manufact_id", "d_qoy", "avg_quarterly_sales")
    return top_n(out, limit, "avg_quarterly_sales", "sum_sales", "i_manufact_id")


def q54(t, category="Shoes", item_class="womens", year=2000, month=5, width=50, limit=100):
    """Revenue segments of the local buyers of one item class in the following three months."""
    when = f"d_moy = {month} and d_year = {year}"
    wanted = t.item.where(f"i_category = '{category}' and i_class = '{item_class}'").select("i_item_sk")
    buyers = union_all(*[semi_join(c.sold(t, p, when), wanted, (f"{p}_item_sk", "i_item_sk")).select(F.col(c.BUYER[p]).alias("buyer")) for p in ("cs", "ws")])
    customers = semi_join(t.customer.select("c_customer_sk", "c_current_addr_sk"), buyers, ("c_customer_sk", "buyer"), many=True)
    local = star_join(customers, (t.customer_address.select("ca_address_sk", "ca_county", "ca_state"), "c_current_addr_sk", "ca_address_sk")) \
        .join(t.store.select("s_store_sk", "s_county", "s_state"), on(("ca_county", "s_county"), ("ca_state", "s_state")))
    bounds = t.date_dim.where(when).agg(F.min("d_month_seq").alias("m"))
    period = t.date_dim.select("d_date_sk", "d_month_seq").crossJoin(bounds).where("d_month_seq between m + 1 and m + 3").select("d_date_sk")
    sales = semi_join(t.store_sales, period, ("ss_sold_date_sk", "d_date_sk"))
    revenue = sales.join(local, on(("ss_customer_sk", "c_customer_sk"))).groupBy("c_customer_sk").agg(F.sum("ss_ext_sales_price").alias("revenue"))
    out = revenue.groupBy(round_to_int(F.col("revenue") / width).alias("segment")).agg(F.count(F.lit(1)).alias("num_customers")) \
        .withColumn("segment_base", F.col("segment") * width)
    return top_n(out, limit, "segment", "num_customers")


def q55(t, manager=96, month=12, year=2002, limit=100):
    out = _managed_sales(t, manager, month, year, F.col("i_brand_id").alias("brand_id"), F.col("i_brand").alias("brand"))
    return top_n(out, limit, desc("ext_price"), "brand_id")


def q56(t, colors=("rose", "brown", "drab"), year=2000, month=4, gmt_offset=-5, limit=100):
    ids = t.item.where(f"i_color in {c.sql_list(colors)}").select(F.col("i_item_id").alias("wanted"))
    return top_n(c.channel_totals(t, "i_item_id", ids, f"d_year = {year} and d_moy = {month}", gmt_offset), limit, "total_sales", "i_item_id")


def q57(t, year=2001, columns=("i_brand",), then="nsum", limit=100):
    """As q47, for catalog sales per call center."""
    keys = ["i_category", "i_brand", "cc_name"]
    df = star_join(c.sold(t, "cs", _around_year(year), "d_year", "d_moy"), (t.item, "cs_item_sk", "i_item_sk"), (t.call_center, "cs_call_center_sk", "cc_call_center_sk")) \
        .groupBy(*keys, "d_year", "d_moy").agg(F.sum("cs_sales_price").alias("sum_sales"))
    out = c.neighbours(df, keys, year, "")
    gap = asc(F.col("sum_sales").cast("double") - F.col("avg_monthly_sales"))
    return top_n(out.select(*columns, "d_year", "d_moy", "avg_monthly_sales", "sum_sales", "psum", "nsum"), limit, gap, then)


def _weeks_of(t, dates):
    """Calendar rows of the weeks that contain the given days."""
    weeks = t.date_dim.where(f"d_date in ({', '.join(f'''date '{d}' ''' for d in dates)})").select(F.col("d_week_seq").alias("wk"))
    return semi_join(t.date_dim, weeks, ("d_week_seq", "wk")).select("d_date_sk")


def q58(t, day="1999-04-16", pct=0.1, limit=100):
    """Items whose weekly revenue is about the same in all channels."""
    week = _weeks_of(t, [day])

    def revenue(p):
        df = star_join(semi_join(getattr(t, {"ss": "store_sales", "cs": "catalog_sales", "ws": "web_sales"}[p]), week, (f"{p}_sold_date_sk", "d_date_sk")),
                       (t.item.select("i_item_sk", "i_item_id"), f"{p}_item_sk", "i_item_sk"))
        return df.groupBy(F.col("i_item_id").alias("item_id")).agg(F.sum(f"{p}_ext_sales_price").cast("double").alias(f"{p}_item_rev"))

    df = revenue("ss").join(revenue("cs"), "item_id").join(revenue("ws"), "item_id")
    for a, b in (("ss", "cs"), ("ss", "ws"), ("cs", "ss"), ("cs", "ws"), ("ws", "ss"), ("ws", "cs")):
        df = df.where(within_pct(f"{a}_item_rev", f"{b}_item_rev", pct))
    average = (F.col("ss_item_rev") + F.col("cs_item_rev") + F.col("ws_item_rev")) / 3
    cols = ["item_id"]
    for p in ("ss", "cs", "ws"):
        cols += [f"{p}_item_rev", (F.col(f"{p}_item_rev") / average * 100).alias(f"{p}_dev")]
    return top_n(df.select(*cols, average.alias("average")), limit, "item_id", "ss_item_rev")


def q59(t, first_month=1201, limit=100):
    """Weekly store sales per weekday against the week 52 weeks later."""
    weekly = star_join(t.store_sales.select("ss_sold_date_sk", "ss_store_sk", "ss_sales_price"), (c.days(t, "true", "d_week_seq", "d_day_name"), "ss_sold_date_sk", "d_date_sk")) \
        .groupBy("d_week_seq", "ss_store_sk").agg(*pivot_sum("d_day_name", c.WEEK, "ss_sales_price"))

    def year(first, last):
        n = t.date_dim.where(f"d_month_seq between {first} and {last}").groupBy(F.col("d_week_seq").alias("wk")).agg(F.count(F.lit(1)).alias("n"))
        return star_join(weekly, (n, "d_week_seq", "wk"), (t.store.select("s_store_sk", "s_store_name", "s_store_id"), "ss_store_sk", "s_store_sk"))

    now, then = year(first_month, first_month + 11), prefixed(year(first_month + 12, first_month + 23), "x_")
    pairs = now.join(then, F.expr("s_store_id = x_s_store_id and d_week_seq = x_d_week_seq - 52"))
    times = pairs.withColumn("copy", F.explode(F.sequence(F.lit(1), (F.col("n") * F.col("x_n")).cast("int"))))
    out = times.select(F.col("s_store_name").alias("s_store_name1"), F.col("s_store_id").alias("s_store_id1"), F.col("d_week_seq").alias("d_week_seq1"),
                       *[ratio(k, "x_" + k).alias(k[:3] + "_ratio") for k in c.WEEK])
    return top_n(out, limit, "s_store_name1", "s_store_id1", "d_week_seq1")


def q60(t, category="Jewelry", year=1999, month=9, gmt_offset=-6, limit=100):
    ids = t.item.where(f"i_category = '{category}'").select(F.col("i_item_id").alias("wanted"))
    return top_n(c.channel_totals(t, "i_item_id", ids, f"d_year = {year} and d_moy = {month}", gmt_offset), limit, "i_item_id", "total_sales")


def q61(t, category="Sports", gmt_offset=-6, year=1999, month=11):
    """Share of promoted sales, from one pass: the promotion is an outer join to the same rows."""
    promo = t.promotion.where("p_channel_dmail = 'Y' or p_channel_email = 'Y' or p_channel_tv = 'Y'").select("p_promo_sk")
    df = star_join(c.sold(t, "ss", f"d_year = {year} and d_moy = {month}"), (t.store.where(f"s_gmt_offset = {gmt_offset}").select("s_store_sk"), "ss_store_sk", "s_store_sk"),
                   (t.item.where(f"i_category = '{category}'").select("i_item_sk"), "ss_item_sk", "i_item_sk"),
                   (t.customer.select("c_customer_sk", "c_current_addr_sk"), "ss_customer_sk", "c_customer_sk"),
                   (t.customer_address.where(f"ca_gmt_offset = {gmt_offset}").select("ca_address_sk"), "c_current_addr_sk", "ca_address_sk"),
                   (promo, "ss_promo_sk", "p_promo_sk", "left"))
    out = df.agg(F.sum(F.when(F.col("p_promo_sk").isNotNull(), F.col("ss_ext_sales_price"))).alias("promotions"), F.sum("ss_ext_sales_price").alias("total"))
    return out.withColumn("share", ratio("promotions", "total") * 100)


def _ship_lags(t, p, first_month, outlet, outlet_key, outlet_pk, outlet_name, limit):
    df = star_join(getattr(t, {"ws": "web_sales", "cs": "catalog_sales"}[p]),
                   (c.days(t, f"d_month_seq between {first_month} and {first_month + 11}"), f"{p}_ship_date_sk", "d_date_sk"),
                   (t.warehouse.select("w_warehouse_sk", F.substring("w_warehouse_name", 1, 20).alias("warehouse")), f"{p}_warehouse_sk", "w_warehouse_sk"),
                   (t.ship_mode.select("sm_ship_mode_sk", "sm_type"), f"{p}_ship_mode_sk", "sm_ship_mode_sk"), (outlet.select(outlet_pk, outlet_name), outlet_key, outlet_pk))
    out = df.groupBy("warehouse", "sm_type", outlet_name).agg(*lag_buckets(f"{p}_ship_date_sk - {p}_sold_date_sk"))
    return top_n(out, limit, "warehouse", "sm_type", outlet_name)


def q62(t, first_month=1214, limit=100):
    return _ship_lags(t, "ws", first_month, t.web_site, "ws_web_site_sk", "web_site_sk", "web_name", limit)


def q63(t, first_month=1188, kinds=Q53_KINDS, limit=100):
    out = _kind_deviation(t, first_month, kinds, "i_manager_id", "d_moy", "avg_monthly_sales")
    return top_n(out.select("i_manager_id", "sum_sales", "avg_monthly_sales"), limit, "i_manager_id", "avg_monthly_sales", "sum_sales")


def q64(t, year=1999, colors=("burlywood", "coral", "dark", "puff", "smoke", "peach"), price=22):
    """Returned store sales of catalog-profitable items that recur in the next year at the same store."""
    refunds = c.with_returns(t, t.catalog_sales.select("cs_item_sk", "cs_order_number", "cs_ext_list_price"), "cs", "inner").groupBy(F.col("cs_item_sk").alias("ui_item_sk")) \
        .agg(F.sum("cs_ext_list_price").alias("sale"), F.sum(F.col("cr_refunded_cash") + F.col("cr_reversed_charge") + F.col("cr_store_credit")).alias("refund")) \
        .where("sale > 2 * refund").select("ui_item_sk")
    items = t.item.where(f"i_color in {c.sql_list(colors)} and i_current_price between {price} and {price + 10} and i_current_price between {price + 1} and {price + 15}") \
        .select("i_item_sk", "i_product_name")
    demo = t.customer_demographics.select("cd_demo_sk", "cd_marital_status")
    house = semi_join(t.household_demographics, t.income_band, ("hd_income_band_sk", "ib_income_band_sk")).select("hd_demo_sk")
    address = t.customer_address.select("ca_address_sk", "ca_street_number", "ca_street_name", "ca_city", "ca_zip")
    year_of = t.date_dim.select("d_date_sk", "d_year")
    sales = semi_join(star_join(t.store_sales, (items, "ss_item_sk", "i_item_sk")), refunds, ("ss_item_sk", "ui_item_sk"))
    sales = sales.join(t.store_returns.select("sr_item_sk", "sr_ticket_number"), on(("ss_item_sk", "sr_item_sk"), ("ss_ticket_number", "sr_ticket_number")))
    df = star_join(sales, (c.days(t, f"d_year in ({year}, {year + 1})", F.col("d_year").alias("syear")), "ss_sold_date_sk", "d_date_sk"),
                   (t.store.select("s_store_sk", "s_store_name", "s_zip"), "ss_store_sk", "s_store_sk"),
                   (t.promotion.select("p_promo_sk"), "ss_promo_sk", "p_promo_sk"), (demo, "ss_cdemo_sk", "cd_demo_sk"), (house, "ss_hdemo_sk", "hd_demo_sk"),
                   (prefixed(address, "b_"), "ss_addr_sk", "b_ca_address_sk"), (t.customer, "ss_customer_sk", "c_customer_sk"),
                   (prefixed(demo, "own_"), "c_current_cdemo_sk", "own_cd_demo_sk"), (prefixed(house, "own_"), "c_current_hdemo_sk", "own_hd_demo_sk"),
                   (prefixed(address, "c_"), "c_current_addr_sk", "c_ca_address_sk"), (prefixed(year_of, "fs_"), "c_first_sales_date_sk", "fs_d_date_sk"),
                   (prefixed(year_of, "s2_"), "c_first_shipto_date_sk", "s2_d_date_sk")).where("cd_marital_status <> own_cd_marital_status")
    shown = {"product_name": "i_product_name", "store_name": "s_store_name", "store_zip": "s_zip"}
    for who in ("b", "c"):
        shown |= {f"{who}_{x}": f"{who}_ca_{x}" for x in ("street_number", "street_name", "city", "zip")}
    groups = df.groupBy(F.col("i_item_sk").alias("item_sk"), *[F.col(v).alias(k) for k, v in shown.items()], "syear", "fs_d_year", "s2_d_year") \
        .agg(F.count(F.lit(1)).alias("cnt"), F.sum("ss_wholesale_cost").alias("s1"), F.sum("ss_list_price").alias("s2"), F.sum("ss_coupon_amt").alias("s3"))
    now, then = groups.where(f"syear = {year}"), prefixed(groups.where(f"syear = {year + 1}"), "n_")
    pairs = now.join(then, F.expr("item_sk = n_item_sk and store_name = n_store_name and store_zip = n_store_zip and n_cnt <= cnt"))
    out = pairs.select(*shown, "syear", "cnt", F.col("s1").alias("s11"), F.col("s2").alias("s21"), F.col("s3").alias("s31"), F.col("n_s1").alias("s12"),
                       F.col("n_s2").alias("s22"), F.col("n_s3").alias("s32"), F.col("n_syear").alias("syear_2"), F.col("n_cnt").alias("cnt_2"))
    return out.orderBy(asc("product_name"), asc("store_name"), asc("cnt_2"), asc("s11"), asc("s12"))


def q65(t, first_month=1192, share=0.1, limit=100):
    """Items that earn at most a tenth of the average item revenue of their store."""
    revenue = c.sold(t, "ss", f"d_month_seq between {first_month} and {first_month + 11}").groupBy("ss_store_sk", "ss_item_sk").agg(F.sum("ss_sales_price").alias("revenue"))
    average = revenue.groupBy(F.col("ss_store_sk").alias("avg_store_sk")).agg((mean("revenue") * share).alias("most"))
    low = revenue.join(average, on(("ss_store_sk", "avg_store_sk"))).where(F.col("revenue").cast("double") <= F.col("most"))
    df = star_join(low, (t.store.select("s_store_sk", "s_store_name"), "ss_store_sk", "s_store_sk"), (t.item, "ss_item_sk", "i_item_sk"))
    return top_n(df.select("s_store_name", "i_item_desc", "revenue", "i_current_price", "i_wholesale_cost", "i_brand"), limit, "s_store_name", "i_item_desc")


MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def q66(t, year=1998, time=46866, carriers=("GREAT EASTERN", "UPS"), web_price="ws_ext_sales_price", catalog_price="cs_sales_price", web_net="ws_net_paid", catalog_net="cs_net_paid", limit=100):
    """Monthly sales and net per warehouse and per square foot for two carriers."""
    keys = ["w_warehouse_name", "w_warehouse_sq_ft", "w_city", "w_county", "w_state", "w_country"]
    parts = []
    for p, price, net in (("ws", web_price, web_net), ("cs", catalog_price, catalog_net)):
        df = star_join(c.sold(t, p, f"d_year = {year}", "d_year", "d_moy"), (t.time_dim.where(f"t_time between {time} and {time + 28800}").select("t_time_sk"), f"{p}_sold_time_sk", "t_time_sk"),
                       (t.ship_mode.where(f"sm_carrier in {c.sql_list(carriers)}").select("sm_ship_mode_sk"), f"{p}_ship_mode_sk", "sm_ship_mode_sk"),
                       (t.warehouse, f"{p}_warehouse_sk", "w_warehouse_sk"))
        parts.append(df.select(*keys, F.col("d_year").alias("year"), "d_moy", (F.col(price) * F.col(f"{p}_quantity")).alias("sales"),
                               (F.col(net) * F.col(f"{p}_quantity")).alias("net")))
    zero = F.lit(0).cast("decimal(18,2)")
    monthly = [F.coalesce(F.sum(F.when(F.col("d_moy") == i, F.col(v))), zero).alias(f"{m}_{v}") for v in ("sales", "net") for i, m in enumerate(MONTHS, 1)]
    out = union_all(*parts).groupBy(*keys, "year").agg(*monthly)
    out = out.select(*keys, F.lit(",".join(carriers)).alias("ship_carriers"), "year", *[f"{m}_sales" for m in MONTHS],
                     *[ratio(f"{m}_sales", "w_warehouse_sq_ft").alias(f"{m}_sales_per_sq_foot") for m in MONTHS], *[f"{m}_net" for m in MONTHS])
    return top_n(out, limit, "w_warehouse_name")


def q67(t, first_month=1213, top=100, limit=100):
    """The best hundred combinations per category over an eight-column rollup.

    Detail rows are aggregated to the finest group before the rollup expands
    them, and the rank filter lets Spark drop rows per category before the shuffle.
    """
    keys = ["i_category", "i_class", "i_brand", "i_product_name", "d_year", "d_qoy", "d_moy", "s_store_id"]
    df = star_join(c.sold(t, "ss", f"d_month_seq between {first_month} and {first_month + 11}", "d_year", "d_qoy", "d_moy"),
                   (t.store.select("s_store_sk", "s_store_id"), "ss_store_sk", "s_store_sk"), (t.item, "ss_item_sk", "i_item_sk"))
    finest = df.groupBy(*keys).agg(F.sum(F.coalesce(F.col("ss_sales_price") * F.col("ss_quantity"), F.lit(0).cast("decimal(18,2)"))).alias("v"))
    rolled = finest.rollup(*keys).agg(F.sum("v").alias("sumsales"))
    return top_n(rank_in(rolled, ["i_category"], [desc("sumsales")], "rk", keep=top), limit, *keys, "sumsales", "rk")


def q68(t, deps=3, vehicles=3, year=2000, cities=("Walnut Grove", "Enterprise"), limit=100):
    """Baskets of the first days of a month bought away from home."""
    lines = c.basket(t, f"d_dom between 1 and 2 and d_year between {year} and {year + 2}", f"s_city in {c.sql_list(cities)}",
                     f"hd_dep_count = {deps} or hd_vehicle_count = {vehicles}", F.sum("ss_ext_sales_price").alias("extended_price"), F.sum("ss_ext_list_price").alias("list_price"),
                     F.sum("ss_ext_tax").alias("extended_tax"), keep=("ss_ticket_number", "ss_customer_sk", "ss_addr_sk", "ca_city"), address=True)
    out = _away_baskets(t, lines).select("c_last_name", "c_first_name", "ca_city", "bought_city", "ss_ticket_number", "extended_price", "extended_tax", "list_price")
    return top_n(out, limit, "c_last_name", "ss_ticket_number")


def q69(t, states=("IA", "GA", "MN"), year=2001, month=4, limit=100):
    """Demographics of customers who bought in stores only."""
    when = f"d_year = {year} and d_moy between {month} and {month + 2}"
    df = _active_customers(t, when, states=states)
    df = anti_join(df, c.sold(t, "ws", when), ("c_customer_sk", "ws_bill_customer_sk"), many=True)
    df = anti_join(df, c.sold(t, "cs", when), ("c_customer_sk", "cs_ship_customer_sk"), many=True)
    return _profile_counts(df, [("cd_gender", None), ("cd_marital_status", None), ("cd_education_status", "cnt1"), ("cd_purchase_estimate", "cnt2"), ("cd_credit_rating", "cnt3")], limit)


def q70(t, first_month=1210, top=5, limit=100):
    """Profit ranked inside the state and county hierarchy.

    The published text ranks states inside themselves, so every state passes;
    the semi join is kept for states that sold at all.
    """
    sales = c.sold(t, "ss", f"d_month_seq between {first_month} and {first_month + 11}")
    per_store = star_join(sales.groupBy("ss_store_sk").agg(F.sum("ss_net_profit").alias("p")), (t.store.select("s_store_sk", "s_state", "s_county"), "ss_store_sk", "s_store_sk"))
    states = rank_in(per_store.groupBy(F.col("s_state").alias("st")).agg(F.sum("p").alias("sp")), ["st"], [desc("sp")], "ranking", keep=top).select("st")
    return c.margin_hierarchy(semi_join(per_store, states, ("s_state", "st")), ["s_state", "s_county"], F.sum("p"), desc, "total_sum", limit)


def q71(t, manager=1, month=11, year=2001, meals=("breakfast", "dinner")):
    """Brand revenue by minute around meals in all channels."""
    sales = union_all(*[c.sold(t, p, f"d_moy = {month} and d_year = {year}").select(F.col(f"{p}_ext_sales_price").alias("price"), F.col(f"{p}_item_sk").alias("item"), F.col(f"{p}_sold_time_sk").alias("time"))
                        for p in ("ws", "cs", "ss")])
    df = star_join(sales, (t.item.where(f"i_manager_id = {manager}"), "item", "i_item_sk"), (t.time_dim.where(f"t_meal_time in {c.sql_list(meals)}"), "time", "t_time_sk"))
    return df.groupBy(F.col("i_brand_id").alias("brand_id"), F.col("i_brand").alias("brand"), "t_hour", "t_minute").agg(F.sum("price").alias("ext_price")) \
        .orderBy(desc("ext_price"), asc("brand_id"))


def q72(t, buy_potential=">10000", year=2002, marital="M", limit=100):
    """Catalog orders that exceeded the stock of their week, with and without promotion.

    Stock is brought to (item, week) before the join, so both sides meet on two keys; only weeks
    in which the year has a day can meet an order, and names are looked up behind the join.
    """
    weeks = semi_join(t.date_dim.select("d_date_sk", F.col("d_week_seq").alias("inv_week")), t.date_dim.where(f"d_year = {year}").select("d_week_seq"), ("inv_week", "d_week_seq"))
    stock = star_join(t.stock_near(weeks), (weeks, "inv_date_sk", "d_date_sk")).drop("d_date_sk")
    orders = star_join(c.sold(t, "cs", f"d_year = {year}", "d_week_seq", "d_date"),
                       (t.customer_demographics.where(f"cd_marital_status = '{marital}'").select("cd_demo_sk"), "cs_bill_cdemo_sk", "cd_demo_sk"),
                       (t.household_demographics.where(f"hd_buy_potential = '{buy_potential}'").select("hd_demo_sk"), "cs_bill_hdemo_sk", "hd_demo_sk"),
                       (t.date_dim.select(F.col("d_date_sk").alias("ship_sk"), F.col("d_date").alias("ship_date")), "cs_ship_date_sk", "ship_sk")) \
        .where("ship_date > date_add(d_date, 5)")
    short = orders.join(stock, F.expr("cs_item_sk = inv_item_sk and d_week_seq = inv_week and inv_quantity_on_hand < cs_quantity"))
    df = star_join(short, (t.warehouse.select("w_warehouse_sk", "w_warehouse_name"), "inv_warehouse_sk", "w_warehouse_sk"),
                   (t.item.select("i_item_sk", "i_item_desc"), "cs_item_sk", "i_item_sk"), (t.promotion.select("p_promo_sk"), "cs_promo_sk", "p_promo_sk", "left"))
    df = df.join(t.catalog_returns.select("cr_item_sk", "cr_order_number"), on(("cs_item_sk", "cr_item_sk"), ("cs_order_number", "cr_order_number")), "left")
    out = df.groupBy("i_item_desc", "w_warehouse_name", "d_week_seq").agg(F.sum(F.when(F.col("p_promo_sk").isNull(), 1).otherwise(0)).alias("no_promo"),
                                                                         F.sum(F.when(F.col("p_promo_sk").isNotNull(), 1).otherwise(0)).alias("promo"), F.count(F.lit(1)).alias("total_cnt"))
    return top_n(out, limit, desc("total_cnt"), "i_item_desc", "w_warehouse_name", "d_week_seq")


def q73(t, counties=("Orange County", "San Miguel County", "Williamson County", "Brazos County"), year=1998, least=1, most=5):
    """Customers with a few items per ticket in the first days of a month."""
    lines = c.basket(t, f"d_dom between 1 and 2 and d_year between {year} and {year + 2}", f"s_county in {c.sql_list(counties)}",
                     "hd_buy_potential in ('>10000', '0-500') and hd_vehicle_count > 0 and hd_dep_count / hd_vehicle_count > 1", F.count(F.lit(1)).alias("cnt"))
    cols = ["c_last_name", "c_first_name", "c_salutation", "c_preferred_cust_flag", "ss_ticket_number", "cnt"]
    return star_join(lines.where(f"cnt between {least} and {most}"), (t.customer, "ss_customer_sk", "c_customer_sk")).select(*cols) \
        .orderBy(desc("cnt"), asc("c_last_name"), asc("ss_ticket_number"))


def q74(t, year=2001, agg=F.min, limit=100):
    """Customers whose web spending grew faster than store spending; ``agg`` chooses the yearly measure."""
    ss, ws = [c.customer_years(t, p, year, f"{p}_net_paid", agg) for p in ("ss", "ws")]
    grew = ss.join(ws, on(("ss_cust", "ws_cust"))).where(c.guarded_ratio("ws_second", "ws_first") > c.guarded_ratio("ss_second", "ss_first"))
    out = star_join(grew, (t.customer, "ss_cust", "c_customer_sk")).select(F.col("c_customer_id").alias("customer_id"), F.col("c_first_name").alias("customer_first_name"),
                                                                          F.col("c_last_name").alias("customer_last_name"))
    return top_n(out, limit, "customer_last_name", "customer_first_name", "customer_id")


def q75(t, category="Shoes", year=2000, limit=100):
    """Product kinds whose net quantity fell by more than a tenth from one year to the next."""
    keys = ["i_brand_id", "i_class_id", "i_category_id", "i_manufact_id"]
    zero = F.lit(0)
    items = t.item.where(f"i_category = '{category}'").select("i_item_sk", *keys)
    rows = []
    for p in ("cs", "ss", "ws"):
        _, rp, _, _, ramt = c.RETURNS[p]
        df = star_join(c.sold(t, p, f"d_year in ({year - 1}, {year})", "d_year"), (items, f"{p}_item_sk", "i_item_sk"))
        rows.append(c.with_returns(t, df, p, items=items).select("d_year", *keys, (F.col(f"{p}_quantity") - F.coalesce(f"{rp}_return_quantity", zero)).alias("cnt"),
                                                    (F.col(f"{p}_ext_sales_price") - F.coalesce(ramt, zero.cast("decimal(8,2)"))).alias("amt")))
    detail = union_distinct(*rows)
    wide = detail.groupBy(*keys).agg(*[F.sum(F.when(F.col("d_year") == y, F.col(v))).alias(f"{n}_{v}") for y, n in ((year - 1, "prev"), (year, "curr")) for v in ("cnt", "amt")])
    fell = wide.where("prev_cnt is not null and curr_cnt is not null").where(ratio("curr_cnt", "prev_cnt") < 0.9)
    out = fell.select(F.lit(year - 1).cast("bigint").alias("prev_year"), F.lit(year).cast("bigint").alias("year"), *keys, F.col("prev_cnt").alias("prev_yr_cnt"), F.col("curr_cnt").alias("curr_yr_cnt"),
                      (F.col("curr_cnt") - F.col("prev_cnt")).alias("sales_cnt_diff"), (F.col("curr_amt") - F.col("prev_amt")).alias("sales_amt_diff"))
    return top_n(out, limit, "sales_cnt_diff", "sales_amt_diff")
