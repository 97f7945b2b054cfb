"""Queries 76-99 of the pack.  Parameter defaults are fixed values of the published run."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.semantics import asc, dec_ratio, desc, guarded_ratio, mean, ratio
from millrace.operators.relational import (cross_rows, except_, exists_any, on, prefixed, semi_join, star_join, top_n, union_all)
from millrace.plans.tpcds import common as c
from millrace.plans.tpcds.part1 import _address_bands, _channel_rollup
from millrace.plans.tpcds.part2 import _buyer_days, _excess_discount, _returning_customers, _stocked_and_sold
from millrace.plans.tpcds.part3 import _ship_lags, _weeks_of


def q76(t, nulls=(("store", "ss_hdemo_sk"), ("web", "ws_ship_mode_sk"), ("catalog", "cs_ship_customer_sk")), limit=100):
    """Sales with a missing key, per channel and quarter; the missing key is a parameter."""
    rows = []
    for label, column in nulls:
        table, p = c.CHANNELS[label]
        df = star_join(getattr(t, table).where(f"{column} is null"), (t.item.select("i_item_sk", "i_category"), f"{p}_item_sk", "i_item_sk"),
                       (c.days(t, "true", "d_year", "d_qoy"), f"{p}_sold_date_sk", "d_date_sk"))
        rows.append(df.select(F.lit(label).alias("channel"), F.lit(column).alias("col_name"), "d_year", "d_qoy", "i_category", F.col(f"{p}_ext_sales_price").alias("price")))
    keys = ["channel", "col_name", "d_year", "d_qoy", "i_category"]
    return top_n(union_all(*rows).groupBy(*keys).agg(F.count(F.lit(1)).alias("sales_cnt"), F.sum("price").alias("sales_amt")), limit, *keys)


def q77(t, start="1998-08-21", limit=100):
    """Channel profit including returns over 30 days.

    Catalog sales and returns are paired without a key, as published: each call
    center meets every group of returns.  Sums over those pairs follow from the
    number of groups and their totals, so the returns are one row.
    """
    when = c.between_days(start, 30)
    zero = F.lit(0).cast("decimal(18,2)")

    def sales(p, key, dim=None, pk=None):
        df = c.sold(t, p, when)
        df = semi_join(df, dim, (key, pk)) if dim is not None else df
        return df.groupBy(F.col(key).alias("id")).agg(F.sum(f"{p}_ext_sales_price").alias("sales"), F.sum(f"{p}_net_profit").alias("gain"))

    def backs(p, key, amount, dim=None, pk=None):
        df = c.returned(t, p, when)
        df = semi_join(df, dim, (key, pk)) if dim is not None else df
        return df.groupBy(F.col(key).alias("back_id")).agg(F.sum(amount).alias("returns"), F.sum(f"{p}_net_loss").alias("loss"))

    def row(df, label, returns, loss):
        return df.select(F.lit(label).alias("channel"), "id", "sales", returns.alias("returns"), (F.col("gain") - loss).alias("profit"))

    some = (F.coalesce("returns", zero), F.coalesce("loss", zero))
    store = sales("ss", "ss_store_sk", t.store, "s_store_sk").join(backs("sr", "sr_store_sk", "sr_return_amt", t.store, "s_store_sk"), on(("id", "back_id")), "left")
    totals = backs("cr", "cr_call_center_sk", "cr_return_amount").agg(F.count(F.lit(1)).alias("n"), F.count("loss").alias("n_loss"), F.sum("returns").alias("returns"), F.sum("loss").alias("loss"))
    catalog = cross_rows(sales("cs", "cs_call_center_sk"), totals.where("n > 0")).withColumn("sales", F.col("sales") * F.col("n")).withColumn("gain", F.when(F.col("n_loss") > 0, F.col("gain") * F.col("n_loss")))
    web = sales("ws", "ws_web_page_sk", t.web_page, "wp_web_page_sk").join(backs("wr", "wr_web_page_sk", "wr_return_amt", t.web_page, "wp_web_page_sk"), on(("id", "back_id")), "left")
    rows = union_all(row(store, "store channel", *some), row(catalog, "catalog channel", F.col("returns"), F.col("loss")), row(web, "web channel", *some))
    return top_n(_channel_rollup(rows), limit, "channel", "id")


def q78(t, year=2001, columns=("ss_customer_sk",), limit=100):
    """Store sales against other channels per customer and item, returned lines left out."""
    def kept(p):
        rt, rp, number, rnumber, _ = c.RETURNS[p]
        lines = c.sold(t, p, f"d_year = {year}", "d_year").drop("d_date_sk")
        lines = lines.join(getattr(t, rt).select(rnumber, f"{rp}_item_sk"), on((number, rnumber), (f"{p}_item_sk", f"{rp}_item_sk")), "left_anti")
        return lines.groupBy(F.col("d_year").alias(f"{p}_sold_year"), F.col(f"{p}_item_sk"), F.col(c.BUYER[p]).alias(f"{p}_customer_sk")).agg(
            F.sum(f"{p}_quantity").alias(f"{p}_qty"), F.sum(f"{p}_wholesale_cost").alias(f"{p}_wc"), F.sum(f"{p}_sales_price").alias(f"{p}_sp"))

    ss, ws, cs = kept("ss"), kept("ws"), kept("cs")
    df = ss
    for other, p in ((ws, "ws"), (cs, "cs")):
        df = df.join(other, on(*[(f"ss_{k}", f"{p}_{k}") for k in ("sold_year", "item_sk", "customer_sk")]), "left")
    both = lambda k, z: F.coalesce(F.col(f"ws_{k}"), z) + F.coalesce(F.col(f"cs_{k}"), z)
    money = F.lit(0).cast("decimal(18,2)")
    out = df.where("coalesce(ws_qty, 0) > 0 or coalesce(cs_qty, 0) > 0").select(
        *columns, F.round(ratio("ss_qty", both("qty", F.lit(0))), 2).alias("ratio"), F.col("ss_qty").alias("store_qty"), F.col("ss_wc").alias("store_wholesale_cost"),
        F.col("ss_sp").alias("store_sales_price"), both("qty", F.lit(0)).alias("other_chan_qty"), both("wc", money).alias("other_chan_wholesale_cost"), both("sp", money).alias("other_chan_sales_price"))
    return top_n(out, limit, *columns, desc("store_qty"), desc("store_wholesale_cost"), desc("store_sales_price"), "other_chan_qty", "other_chan_wholesale_cost", "other_chan_sales_price", "ratio")


def q79(t, deps=1, vehicles=3, year=2000, least=200, most=295, limit=100):
    """Monday baskets at stores of a given size."""
    lines = c.basket(t, f"d_dow = 1 and d_year between {year} and {year + 2}", f"s_number_employees between {least} and {most}", f"hd_dep_count = {deps} or hd_vehicle_count > {vehicles}",
                     F.sum("ss_coupon_amt").alias("amt"), F.sum("ss_net_profit").alias("profit"), keep=("ss_ticket_number", "ss_customer_sk", "ss_addr_sk", "s_city"))
    out = star_join(lines, (t.customer, "ss_customer_sk", "c_customer_sk")).select("c_last_name", "c_first_name", F.substring("s_city", 1, 30).alias("city"), "ss_ticket_number", "amt", "profit")
    return top_n(out, limit, "c_last_name", "c_first_name", "city", "profit")


def q80(t, start="2002-08-04", price=50, limit=100):
    """Sales, returns and profit per outlet for dear items promoted outside television."""
    zero = F.lit(0).cast("decimal(8,2)")
    plan = [("store channel", "store", "ss", t.store, "ss_store_sk", "s_store_sk", "s_store_id"),
            ("catalog channel", "catalog_page", "cs", t.catalog_page, "cs_catalog_page_sk", "cp_catalog_page_sk", "cp_catalog_page_id"),
            ("web channel", "web_site", "ws", t.web_site, "ws_web_site_sk", "web_site_sk", "web_site_id")]
    rows = []
    for label, kind, p, outlet, fk, pk, ident in plan:
        _, rp, _, _, ramt = c.RETURNS[p]
        df = star_join(c.sold(t, p, c.between_days(start, 30)), (t.item.where(f"i_current_price > {price}").select("i_item_sk"), f"{p}_item_sk", "i_item_sk"),
                       (t.promotion.where("p_channel_tv = 'N'").select("p_promo_sk"), f"{p}_promo_sk", "p_promo_sk"), (outlet.select(pk, ident), fk, pk))
        rows.append(c.with_returns(t, df, p).groupBy(ident).agg(F.sum(f"{p}_ext_sales_price").alias("sales"), F.sum(F.coalesce(ramt, zero)).alias("returns"),
                                                                F.sum(F.col(f"{p}_net_profit") - F.coalesce(f"{rp}_net_loss", zero)).alias("profit"))
                    .select(F.lit(label).alias("channel"), F.concat(F.lit(kind), ident).alias("id"), "sales", "returns", "profit"))
    return top_n(_channel_rollup(union_all(*rows)), limit, "channel", "id")


def q81(t, year=2000, state="VA", limit=100):
    cols = ["c_customer_id", "c_salutation", "c_first_name", "c_last_name", "ca_street_number", "ca_street_name", "ca_street_type", "ca_suite_number", "ca_city", "ca_county",
            "ca_state", "ca_zip", "ca_country", "ca_gmt_offset", "ca_location_type", "ctr_total_return"]
    return top_n(_returning_customers(t, "cr", "cr_return_amt_inc_tax", year, state).select(*cols), limit, *cols)


def q82(t, price=72, start="1998-01-23", makers=(412, 343, 781, 156), limit=100):
    return _stocked_and_sold(t, t.store_sales, "ss_item_sk", price, start, makers, limit)


def q83(t, dates=("1998-02-20", "1998-09-28", "1998-11-14"), limit=100):
    """Returned quantities per channel in three weeks."""
    days = _weeks_of(t, dates)

    def quantity(p, table):
        df = star_join(semi_join(table, days, (f"{p}_returned_date_sk", "d_date_sk")), (t.item.select("i_item_sk", "i_item_id"), f"{p}_item_sk", "i_item_sk"))
        return df.groupBy(F.col("i_item_id").alias("item_id")).agg(F.sum(f"{p}_return_quantity").alias(f"{p}_item_qty"))

    df = quantity("sr", t.store_returns).join(quantity("cr", t.catalog_returns), "item_id").join(quantity("wr", t.web_returns), "item_id")
    total = F.col("sr_item_qty") + F.col("cr_item_qty") + F.col("wr_item_qty")
    cols = ["item_id"]
    for p in ("sr", "cr", "wr"):
        cols += [f"{p}_item_qty", (ratio(f"{p}_item_qty", total) / 3.0 * 100).alias(f"{p}_dev")]
    return top_n(df.select(*cols, (total / 3.0).alias("average")), limit, "item_id", "sr_item_qty")


def q84(t, city="Shady Grove", income=29438, limit=100):
    """Customers of one city and income band who returned store goods, once per return."""
    bands = t.income_band.where(f"ib_lower_bound >= {income} and ib_upper_bound <= {income + 50000}").select("ib_income_band_sk")
    house = semi_join(t.household_demographics, bands, ("hd_income_band_sk", "ib_income_band_sk")).select("hd_demo_sk")
    df = star_join(t.customer, (t.customer_address.where(f"ca_city = '{city}'").select("ca_address_sk"), "c_current_addr_sk", "ca_address_sk"),
                   (house, "c_current_hdemo_sk", "hd_demo_sk"), (t.customer_demographics.select("cd_demo_sk"), "c_current_cdemo_sk", "cd_demo_sk"))
    df = df.join(t.store_returns.select("sr_cdemo_sk"), on(("cd_demo_sk", "sr_cdemo_sk")))
    name = F.concat(F.coalesce("c_last_name", F.lit("")), F.lit(", "), F.coalesce("c_first_name", F.lit("")))
    return top_n(df.select(F.col("c_customer_id").alias("customer_id"), name.alias("customername")), limit, "customer_id")


def q85(t, year=1998, demo=(("D", "Primary", 100, 150), ("U", "4 yr Degree", 50, 100), ("W", "Advanced Degree", 150, 200)),
        address=((("LA", "CO", "TX"), 100, 200), (("OH", "VA", "MO"), 150, 300), (("FL", "OK", "MS"), 50, 250)), limit=100):
    """Web return averages per reason where both parties share demographics.

    Few returns pass the tests of parties and address, so only those meet their sales.
    """
    lines = c.sold(t, "ws", f"d_year = {year}").select("ws_item_sk", "ws_order_number", "ws_web_page_sk", "ws_quantity", "ws_sales_price", "ws_net_profit")
    kinds = " or ".join(f"(cd_marital_status = '{m}' and cd_education_status = '{e}')" for m, e, _, _ in demo)
    party = t.customer_demographics.where(kinds).select("cd_demo_sk", "cd_marital_status", "cd_education_status")
    states = c.sql_list([s for among, _, _ in address for s in among])
    home = t.customer_address.where(f"ca_country = 'United States' and ca_state in {states}").select("ca_address_sk", "ca_country", "ca_state")
    backs = star_join(t.web_returns, (party, "wr_refunded_cdemo_sk", "cd_demo_sk"), (prefixed(party, "x_"), "wr_returning_cdemo_sk", "x_cd_demo_sk"),
                      (home, "wr_refunded_addr_sk", "ca_address_sk")).where("cd_marital_status = x_cd_marital_status and cd_education_status = x_cd_education_status")
    bands = " or ".join(f"(cd_marital_status = '{m}' and cd_education_status = '{e}' and ws_sales_price between {lo} and {hi})" for m, e, lo, hi in demo)
    df = star_join(lines.join(backs, on(("ws_order_number", "wr_order_number"), ("ws_item_sk", "wr_item_sk"))),
                   (t.web_page.select("wp_web_page_sk"), "ws_web_page_sk", "wp_web_page_sk"), (t.reason, "wr_reason_sk", "r_reason_sk"))
    df = df.where(bands).where(_address_bands(address, "ws_net_profit"))
    out = df.groupBy("r_reason_desc").agg(mean("ws_quantity").alias("avg_quantity"), mean("wr_refunded_cash").alias("avg_refunded_cash"), mean("wr_fee").alias("avg_fee"))
    out = out.select(F.substring("r_reason_desc", 1, 20).alias("reason"), "avg_quantity", "avg_refunded_cash", "avg_fee")
    return top_n(out, limit, "reason", "avg_quantity", "avg_refunded_cash", "avg_fee")


def q86(t, first_month=1205, limit=100):
    """Web net paid ranked inside the item hierarchy."""
    df = star_join(c.sold(t, "ws", f"d_month_seq between {first_month} and {first_month + 11}"), (t.item.select("i_item_sk", "i_category", "i_class"), "ws_item_sk", "i_item_sk"))
    finest = df.groupBy("i_category", "i_class").agg(F.sum("ws_net_paid").alias("p"))
    return c.margin_hierarchy(finest, ["i_category", "i_class"], F.sum("p"), desc, "total_sum", limit)


def q87(t, first_month=1208):
    """Number of (customer name, day) pairs seen in stores but in no other channel."""
    store, catalog, web = _buyer_days(t, first_month)
    return except_(store, catalog, web).agg(F.count(F.lit(1)).alias("cnt"))


def _household_rule(bases=(0, 1, -1)):
    return " or ".join(f"(hd_dep_count = {b} and hd_vehicle_count <= {b + 2})" for b in bases)


def q88(t, store_name="ese", bases=(0, 1, -1)):
    """Eight half-hour traffic counts in one pass."""
    names = ["h8_30_to_9", "h9_to_9_30", "h9_30_to_10", "h10_to_10_30", "h10_30_to_11", "h11_to_11_30", "h11_30_to_12", "h12_to_12_30"]
    slot = F.floor((F.col("t_hour") * 60 + F.col("t_minute")) / 30)
    df = star_join(t.store_sales.select("ss_sold_time_sk", "ss_hdemo_sk", "ss_store_sk"), (t.time_dim.where("t_hour between 8 and 12").select("t_time_sk", slot.alias("slot")), "ss_sold_time_sk", "t_time_sk"),
                   (t.household_demographics.where(_household_rule(bases)).select("hd_demo_sk"), "ss_hdemo_sk", "hd_demo_sk"),
                   (t.store.where(f"s_store_name = '{store_name}'").select("s_store_sk"), "ss_store_sk", "s_store_sk"))
    return df.agg(*[F.count_if(F.col("slot") == 17 + i).alias(n) for i, n in enumerate(names)])


def q89(t, year=2000, kinds=((("Electronics", "Women", "Home"), ("cameras", "maternity", "kids")), (("Sports", "Jewelry", "Shoes"), ("guns", "semi-precious", "athletic"))), limit=100):
    """Monthly class sales per store that deviate from the average of brand and store."""
    rule = " or ".join(f"(i_category in {c.sql_list(a)} and i_class in {c.sql_list(b)})" for a, b in kinds)
    df = star_join(c.sold(t, "ss", f"d_year = {year}", "d_moy"), (t.item.where(rule), "ss_item_sk", "i_item_sk"), (t.store, "ss_store_sk", "s_store_sk")) \
        .groupBy("i_category", "i_class", "i_brand", "s_store_name", "s_company_name", "d_moy").agg(F.sum("ss_sales_price").alias("sum_sales"))
    out = c.deviating(df, ["i_category", "i_brand", "s_store_name", "s_company_name"], "avg_monthly_sales", positive_only=False)
    return top_n(out, limit, asc(F.col("sum_sales").cast("double") - F.col("avg_monthly_sales")), "s_store_name")


def q90(t, am=8, pm=18, deps=9, chars=5000):
    """Morning to evening web sales, both counts in one pass."""
    df = star_join(t.web_sales, (t.time_dim.where(f"t_hour between {am} and {am + 1} or t_hour between {pm} and {pm + 1}").select("t_time_sk", "t_hour"), "ws_sold_time_sk", "t_time_sk"),
                   (t.household_demographics.where(f"hd_dep_count = {deps}").select("hd_demo_sk"), "ws_ship_hdemo_sk", "hd_demo_sk"),
                   (t.web_page.where(f"wp_char_count between {chars} and {chars + 200}").select("wp_web_page_sk"), "ws_web_page_sk", "wp_web_page_sk"))
    counts = df.agg(F.count_if(F.col("t_hour").between(am, am + 1)).alias("amc"), F.count_if(F.col("t_hour").between(pm, pm + 1)).alias("pmc"))
    return counts.select(dec_ratio("amc", "pmc", 15, 4).alias("am_pm_ratio"))


def q91(t, year=2002, month=11, gmt_offset=-6, buy_potential="Unknown%"):
    """Call-center return losses for two demographics."""
    demo = t.customer_demographics.where("(cd_marital_status = 'M' and cd_education_status = 'Unknown') or (cd_marital_status = 'W' and cd_education_status = 'Advanced Degree')") \
        .select("cd_demo_sk", "cd_marital_status", "cd_education_status")
    df = star_join(c.returned(t, "cr", f"d_year = {year} and d_moy = {month}"), (t.call_center, "cr_call_center_sk", "cc_call_center_sk"), (t.customer, "cr_returning_customer_sk", "c_customer_sk"),
                   (demo, "c_current_cdemo_sk", "cd_demo_sk"), (t.household_demographics.where(f"hd_buy_potential like '{buy_potential}'").select("hd_demo_sk"), "c_current_hdemo_sk", "hd_demo_sk"),
                   (t.customer_address.where(f"ca_gmt_offset = {gmt_offset}").select("ca_address_sk"), "c_current_addr_sk", "ca_address_sk"))
    return df.groupBy("cc_call_center_id", "cc_name", "cc_manager", "cd_marital_status", "cd_education_status").agg(F.sum("cr_net_loss").alias("returns_loss")) \
        .select(F.col("cc_call_center_id").alias("call_center"), F.col("cc_name").alias("call_center_name"), F.col("cc_manager").alias("manager"), "returns_loss").orderBy(desc("returns_loss"), asc("call_center"))


def q92(t, manufacturer=939, start="2002-02-16"):
    return _excess_discount(t, "ws", manufacturer, start)


def q93(t, reason="reason 70", limit=100):
    """Customer sales net of goods returned for one reason."""
    backs = star_join(t.store_returns, (t.reason.where(f"r_reason_desc = '{reason}'").select("r_reason_sk"), "sr_reason_sk", "r_reason_sk")).select("sr_item_sk", "sr_ticket_number", "sr_return_quantity")
    df = t.store_sales.join(backs, on(("ss_item_sk", "sr_item_sk"), ("ss_ticket_number", "sr_ticket_number")))
    kept = F.when(F.col("sr_return_quantity").isNotNull(), F.col("ss_quantity") - F.col("sr_return_quantity")).otherwise(F.col("ss_quantity"))
    return top_n(df.groupBy("ss_customer_sk").agg(F.sum(kept * F.col("ss_sales_price")).alias("sumsales")), limit, "sumsales", "ss_customer_sk")


def _web_company(t, company):
    return t.web_site.where(f"web_company_name = '{company}'").select("web_site_sk"), "ws_web_site_sk", "web_site_sk"


def q94(t, start="2002-02-01", state="CA", company="pri"):
    return c.shipped_twice(t, "ws", "ws_ship_date_sk", start, state, _web_company(t, company), False)


def q95(t, start="2002-02-01", state="TN", company="pri"):
    return c.shipped_twice(t, "ws", "ws_ship_date_sk", start, state, _web_company(t, company), True)


def q96(t, hour=8, deps=5, store_name="ese"):
    """Store traffic in one half-hour."""
    df = star_join(t.store_sales.select("ss_sold_time_sk", "ss_hdemo_sk", "ss_store_sk"), (t.time_dim.where(f"t_hour = {hour} and t_minute >= 30").select("t_time_sk"), "ss_sold_time_sk", "t_time_sk"),
                   (t.household_demographics.where(f"hd_dep_count = {deps}").select("hd_demo_sk"), "ss_hdemo_sk", "hd_demo_sk"),
                   (t.store.where(f"s_store_name = '{store_name}'").select("s_store_sk"), "ss_store_sk", "s_store_sk"))
    return df.agg(F.count(F.lit(1)).alias("cnt"))


def q97(t, first_month=1214):
    """Overlap of (customer, item) pairs between store and catalog.

    NULL keys never match in the outer join, so they are counted by the side they
    came from only when the customer is known, as published.
    """
    when = f"d_month_seq between {first_month} and {first_month + 11}"
    pairs = lambda p: c.sold(t, p, when).select(F.col(c.BUYER[p]).alias(f"{p}_cust"), F.col(f"{p}_item_sk").alias(f"{p}_item")).distinct()
    df = pairs("ss").join(pairs("cs"), on(("ss_cust", "cs_cust"), ("ss_item", "cs_item")), "full")
    s, k = F.col("ss_cust").isNotNull(), F.col("cs_cust").isNotNull()
    return df.agg(F.count_if(s & ~k).alias("store_only"), F.count_if(~s & k).alias("catalog_only"), F.count_if(s & k).alias("store_and_catalog"))


def q98(t, categories=("Women", "Electronics", "Shoes"), start="2002-05-27"):
    out = c.category_share(t, "ss", categories, start, None)
    return out.orderBy(*[asc(x) for x in ("i_category", "i_class", "i_item_id", "i_item_desc", "revenueratio")])


def q99(t, first_month=1200, limit=100):
    return _ship_lags(t, "cs", first_month, t.call_center, "cs_call_center_sk", "cc_call_center_sk", "cc_name", limit)
