"""Queries 1-25 of the pack.  Parameter defaults are fixed values of the published run."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.semantics import asc, coefficient_of_variation, desc, guarded_ratio, mean, ratio, sd
from millrace.operators.relational import (above_group_avg, exists_any, grouping_level, intersect, on, pivot_sum,
                                           prefixed, semi_join, star_join, top_n, union_all)
from millrace.plans.tpcds import common as c


def q01(t, year=1999, state="NM", limit=100):
    """Customers whose store returns exceed 1.2 times the average of that store."""
    totals = c.returned(t, "sr", f"d_year = {year}").groupBy("sr_customer_sk", "sr_store_sk") \
        .agg(F.sum("sr_return_amt_inc_tax").alias("total"))
    high = above_group_avg(totals, "sr_store_sk", "total", 1.2)
    df = star_join(high, (t.store.where(f"s_state = '{state}'").select("s_store_sk"), "sr_store_sk", "s_store_sk"),
                   (t.customer.select("c_customer_sk", "c_customer_id"), "sr_customer_sk", "c_customer_sk"))
    return top_n(df.select("c_customer_id"), limit, "c_customer_id")


def q02(t, year=1999):
    """Weekly web and catalog revenue per weekday against the week 53 weeks later."""
    sales = union_all(*[getattr(t, n).select(F.col(f"{p}_sold_date_sk").alias("sk"), F.col(f"{p}_ext_sales_price").alias("price"))
                        for n, p in (("web_sales", "ws"), ("catalog_sales", "cs"))])
    weekly = star_join(sales, (c.days(t, "true", "d_week_seq", "d_day_name"), "sk", "d_date_sk")) \
        .groupBy("d_week_seq").agg(*pivot_sum("d_day_name", c.WEEK, "price"))
    # a week counts once per calendar day of the year it belongs to
    days_in = lambda y: t.date_dim.where(f"d_year = {y}").groupBy(F.col("d_week_seq").alias("wk")).agg(F.count(F.lit(1)).alias("n"))
    first = star_join(weekly, (days_in(year), "d_week_seq", "wk"))
    second = prefixed(star_join(weekly, (days_in(year + 1), "d_week_seq", "wk")), "x_")
    pairs = first.join(second, F.expr("d_week_seq = x_d_week_seq - 53"))
    times = pairs.withColumn("copy", F.explode(F.sequence(F.lit(1), (F.col("n") * F.col("x_n")).cast("int"))))
    return times.select(F.col("d_week_seq").alias("d_week_seq1"),
                        *[F.round(ratio(k, "x_" + k), 2).alias(k[:3] + "_ratio") for k in c.WEEK]).orderBy("d_week_seq1")


def q03(t, manufacturer=540, month=12, measure="ss_ext_discount_amt", limit=100):
    """Brand totals of one manufacturer in one month of every year."""
    df = star_join(c.sold(t, "ss", f"d_moy = {month}", "d_year"),
                   (t.item.where(f"i_manufact_id = {manufacturer}"), "ss_item_sk", "i_item_sk"))
    out = df.groupBy("d_year", F.col("i_brand_id").alias("brand_id"), F.col("i_brand").alias("brand")) \
        .agg(F.sum(measure).alias("sum_agg"))
    return top_n(out, limit, "d_year", desc("sum_agg"), "brand_id")


def q04(t, year=1999, limit=100):
    """Customers whose catalog spending grew faster than store and web spending."""
    measure = "(({0}_ext_list_price - {0}_ext_wholesale_cost - {0}_ext_discount_amt) + {0}_ext_sales_price)"
    ss, cs, ws = [c.customer_years(t, p, year, measure.format(p)) for p in ("ss", "cs", "ws")]
    both = ss.join(cs, on(("ss_cust", "cs_cust"))).join(ws, on(("ss_cust", "ws_cust")))
    grew = both.where((guarded_ratio("cs_second", "cs_first") > guarded_ratio("ss_second", "ss_first"))
                      & (guarded_ratio("cs_second", "cs_first") > guarded_ratio("ws_second", "ws_first")))
    out = star_join(grew, (t.customer, "ss_cust", "c_customer_sk")).select(
        F.col("c_customer_id").alias("customer_id"), F.col("c_first_name").alias("customer_first_name"),
        F.col("c_last_name").alias("customer_last_name"), F.col("c_login").alias("customer_login"))
    return top_n(out, limit, "customer_id")


def q05(t, start="2002-08-09", n_days=14, limit=100):
    """Sales, returns and profit per channel and outlet over two weeks."""
    when = c.between_days(start, n_days)
    zero = F.lit(0).cast("decimal(8,2)")
    labels = ("store channel", "catalog channel", "web channel")
    kinds = ("store", "catalog_page", "web_site")

    def sales(p, outlet):
        return c.sold(t, p, when).select(F.col(outlet).alias("sk"), F.col(f"{p}_ext_sales_price").alias("sales"), zero.alias("returns"),
                                         F.col(f"{p}_net_profit").alias("gain"), zero.alias("loss"))

    def backs(df, p, outlet, amount):
        return df.select(F.col(outlet).alias("sk"), zero.alias("sales"), F.col(amount).alias("returns"), zero.alias("gain"),
                         F.col(f"{p}_net_loss").alias("loss"))

    web_back = c.returned(t, "wr", when).join(
        t.web_sales.select("ws_item_sk", "ws_order_number", "ws_web_site_sk"), on(("wr_item_sk", "ws_item_sk"), ("wr_order_number", "ws_order_number")), "left")
    parts = [
        (sales("ss", "ss_store_sk").unionByName(backs(c.returned(t, "sr", when), "sr", "sr_store_sk", "sr_return_amt")), t.store, "s_store_sk", "s_store_id"),
        (sales("cs", "cs_catalog_page_sk").unionByName(backs(c.returned(t, "cr", when), "cr", "cr_catalog_page_sk", "cr_return_amount")), t.catalog_page, "cp_catalog_page_sk", "cp_catalog_page_id"),
        (sales("ws", "ws_web_site_sk").unionByName(backs(web_back, "wr", "ws_web_site_sk", "wr_return_amt")), t.web_site, "web_site_sk", "web_site_id"),
    ]
    rows = union_all(*[
        star_join(df, (dim.select(sk, ident), "sk", sk)).groupBy(ident)
        .agg(F.sum("sales").alias("sales"), F.sum("returns").alias("returns"), (F.sum("gain") - F.sum("loss")).alias("profit"))
        .select(F.lit(label).alias("channel"), F.concat(F.lit(kind), ident).alias("id"), "sales", "returns", "profit")
        for (df, dim, sk, ident), label, kind in zip(parts, labels, kinds)])
    return top_n(_channel_rollup(rows), limit, "channel", "id")


def _channel_rollup(rows):
    return rows.rollup("channel", "id").agg(*[F.sum(x).alias(x) for x in ("sales", "returns", "profit")])


def q06(t, year=2002, month=7, least=10, limit=100):
    """States with many buyers of items priced 1.2 times above their category."""
    dear = above_group_avg(t.item.select("i_item_sk", "i_category", "i_current_price"), "i_category", "i_current_price", 1.2)
    df = star_join(c.sold(t, "ss", f"d_year = {year} and d_moy = {month}"), (dear, "ss_item_sk", "i_item_sk"),
                   (t.customer.select("c_customer_sk", "c_current_addr_sk"), "ss_customer_sk", "c_customer_sk"),
                   (t.customer_address.select("ca_address_sk", "ca_state"), "c_current_addr_sk", "ca_address_sk"))
    out = df.groupBy(F.col("ca_state").alias("state")).agg(F.count(F.lit(1)).alias("cnt")).where(f"cnt >= {least}")
    return top_n(out, limit, "cnt", "state")


def q07(t, gender="M", marital="M", education="4 yr Degree", year=2001, limit=100):
    return c.demographic_averages(t, "ss", "ss_cdemo_sk", gender, marital, education, year, limit)


def q08(t, zips=None, quarter=1, year=2002, least=10, limit=100):
    """Store profit where the store's zip area holds a listed zip with many preferred customers.

    ``zips`` is a list of five-digit zips or a table with one column of them (the
    published run lists about 400); without one every zip counts as listed.
    """
    addresses = t.customer_address.select("ca_address_sk", F.substring("ca_zip", 1, 5).alias("zip"))
    listed = addresses.select("zip").distinct()
    if isinstance(zips, list | tuple):
        listed = listed.where(F.col("zip").isin([z[:5] for z in zips]))
    elif zips is not None:
        listed = listed.intersect(zips.select(F.substring(zips.columns[0], 1, 5)))
    preferred = star_join(t.customer.where("c_preferred_cust_flag = 'Y'"), (addresses, "c_current_addr_sk", "ca_address_sk")) \
        .groupBy("zip").count().where(f"count > {least}").select("zip")
    areas = listed.intersect(preferred).select(F.substring("zip", 1, 2).alias("area"))
    stores = t.store.select("s_store_sk", "s_store_name", F.substring("s_zip", 1, 2).alias("s_area"))
    # one store row per matching zip: the same store counts once for each zip of its area
    df = star_join(c.sold(t, "ss", f"d_qoy = {quarter} and d_year = {year}"),
                   (stores.join(areas, F.col("s_area") == F.col("area")), "ss_store_sk", "s_store_sk"))
    return top_n(df.groupBy("s_store_name").agg(F.sum("ss_net_profit").alias("net_profit")), limit, "s_store_name")


def q09(t, thresholds=(177560856, 165030289, 357290662, 205197751, 80111186), reason_sk=1, above="ss_ext_discount_amt", below="ss_net_paid_inc_tax"):
    """Five quantity buckets, each choosing one of two averages by its row count; one pass over the fact."""
    aggs, picks = [], []
    for i, limit in enumerate(thresholds):
        inside = F.col("ss_quantity").between(20 * i + 1, 20 * i + 20)
        aggs += [F.count_if(inside).alias(f"n{i}"), mean(F.when(inside, F.col(above))).alias(f"a{i}"),
                 mean(F.when(inside, F.col(below))).alias(f"b{i}")]
        picks.append(F.when(F.col(f"n{i}") > limit, F.col(f"a{i}")).otherwise(F.col(f"b{i}")).alias(f"bucket{i + 1}"))
    return t.reason.where(f"r_reason_sk = {reason_sk}").crossJoin(t.store_sales.agg(*aggs)).select(*picks)


def _active_customers(t, predicate, counties=None, states=None):
    home = t.customer_address.select("ca_address_sk", "ca_county", "ca_state")
    if counties:
        home = home.where(f"ca_county in {c.sql_list(counties)}")
    if states:
        home = home.where(f"ca_state in {c.sql_list(states)}")
    customers = star_join(t.customer.select("c_customer_sk", "c_current_addr_sk", "c_current_cdemo_sk"), (home, "c_current_addr_sk", "ca_address_sk"),
                          (t.customer_demographics, "c_current_cdemo_sk", "cd_demo_sk"))
    return semi_join(customers, c.sold(t, "ss", predicate), ("c_customer_sk", "ss_customer_sk"), many=True)


def _web_or_catalog(t, predicate):
    return [(c.sold(t, "ws", predicate), "ws_bill_customer_sk"), (c.sold(t, "cs", predicate), "cs_ship_customer_sk")]


def _profile_counts(df, columns, limit):
    out = df.groupBy(*[x for x, _ in columns]).agg(F.count(F.lit(1)).alias("cnt"))
    shown = []
    for name, counter in columns:
        shown.append(F.col(name))
        if counter:
            shown.append(F.col("cnt").alias(counter))
    return top_n(out.select(*shown), limit, *[x for x, _ in columns])


def q10(t, counties=("Polk County", "Denton County", "Union County", "Swisher County", "Cherokee County"), year=2002, month=3, limit=100):
    """Demographic counts of store customers who also bought on the web or by catalog."""
    when = f"d_year = {year} and d_moy between {month} and {month + 3}"
    df = exists_any(_active_customers(t, when, counties=counties), _web_or_catalog(t, when), "c_customer_sk")
    return _profile_counts(df, [("cd_gender", None), ("cd_marital_status", None), ("cd_education_status", "cnt1"), ("cd_purchase_estimate", "cnt2"),
                                ("cd_credit_rating", "cnt3"), ("cd_dep_count", "cnt4"), ("cd_dep_employed_count", "cnt5"), ("cd_dep_college_count", "cnt6")], limit)


def q11(t, year=1999, columns=("customer_id", "customer_first_name", "customer_last_name", "customer_login"), limit=100):
    """Customers whose web spending grew faster than their store spending; ``columns`` picks the output."""
    ss, ws = [c.customer_years(t, p, year, f"{p}_ext_list_price - {p}_ext_discount_amt") for p in ("ss", "ws")]
    grew = ss.join(ws, on(("ss_cust", "ws_cust"))).where(guarded_ratio("ws_second", "ws_first", 0.0) > guarded_ratio("ss_second", "ss_first", 0.0))
    named = star_join(grew, (t.customer, "ss_cust", "c_customer_sk"))
    return top_n(named.select(*[F.col("c_" + x.removeprefix("customer_") if x != "customer_id" else "c_customer_id").alias(x) for x in columns]),
                 limit, *columns)


def q12(t, categories=("Shoes", "Children", "Electronics"), start="2002-04-12", limit=100):
    return c.category_share(t, "ws", categories, start, limit)


def _demo_bands(bands, price):
    return " or ".join(f"(cd_marital_status = '{m}' and cd_education_status = '{e}' and {price} between {lo} and {hi}"
                       + (f" and hd_dep_count = {dep[0]}" if dep else "") + ")" for m, e, lo, hi, *dep in bands)


def _address_bands(bands, profit):
    return " or ".join(f"(ca_country = 'United States' and ca_state in {c.sql_list(s)} and {profit} between {lo} and {hi})" for s, lo, hi in bands)


def q13(t, year=2001,
        demo=(("D", "2 yr Degree", 100, 150, 3), ("U", "Primary", 50, 100, 1), ("W", "Secondary", 150, 200, 1)),
        address=((("MI", "MN", "NC"), 100, 200), (("GA", "OH", "MT"), 150, 300), (("MS", "AK", "OK"), 50, 250))):
    """Store averages under OR-ed bands of demographics and addresses."""
    df = star_join(c.sold(t, "ss", f"d_year = {year}"), (t.store.select("s_store_sk"), "ss_store_sk", "s_store_sk"),
                   (t.customer_demographics, "ss_cdemo_sk", "cd_demo_sk"), (t.household_demographics, "ss_hdemo_sk", "hd_demo_sk"),
                   (t.customer_address, "ss_addr_sk", "ca_address_sk"))
    df = df.where(_demo_bands(demo, "ss_sales_price")).where(_address_bands(address, "ss_net_profit"))
    return df.agg(mean("ss_quantity").alias("avg_quantity"), mean("ss_ext_sales_price").alias("avg_ext_sales_price"),
                  mean("ss_ext_wholesale_cost").alias("avg_ext_wholesale_cost"), F.sum("ss_ext_wholesale_cost").alias("sum_ext_wholesale_cost"))


def _cross_items(t, years):
    """Items whose brand, class and category sold in all three channels."""
    kinds = ["i_brand_id", "i_class_id", "i_category_id"]
    sets = [star_join(c.sold(t, p, years), (t.item.select("i_item_sk", *kinds), f"{p}_item_sk", "i_item_sk")).select(*kinds)
            for p in ("ss", "cs", "ws")]
    common = prefixed(intersect(*sets), "x_")
    return t.item.join(common, on(*[(k, "x_" + k) for k in kinds]), "left_semi").select("i_item_sk", *kinds)


def _average_sale(t, years):
    value = union_all(*[c.sold(t, p, years).select((F.col(f"{p}_quantity") * F.col(f"{p}_list_price")).alias("v")) for p in ("ss", "cs", "ws")])
    return value.agg(mean("v").alias("average_sales"))


def _kind_sales(t, p, label, when, items, average):
    df = star_join(c.sold(t, p, when), (items, f"{p}_item_sk", "i_item_sk")) \
        .groupBy("i_brand_id", "i_class_id", "i_category_id") \
        .agg(F.sum(F.col(f"{p}_quantity") * F.col(f"{p}_list_price")).alias("sales"), F.count(F.lit(1)).alias("number_sales"))
    return df.crossJoin(average).where(F.col("sales").cast("double") > F.col("average_sales")).drop("average_sales") \
        .withColumn("channel", F.lit(label))


def q14(t, first_year=1998, month=11, limit=100):
    """Channel totals of cross-channel items above the overall average sale."""
    years = f"d_year between {first_year} and {first_year + 2}"
    items, average = _cross_items(t, years), _average_sale(t, years)
    when = f"d_year = {first_year + 2} and d_moy = {month}"
    rows = union_all(*[_kind_sales(t, p, label, when, items, average) for label, (_, p) in c.CHANNELS.items()])
    keys = ["channel", "i_brand_id", "i_class_id", "i_category_id"]
    out = rows.rollup(*keys).agg(F.sum("sales").alias("sum_sales"), F.sum("number_sales").alias("number_sales"))
    return top_n(out, limit, *keys)


def q14b(t, first_year=1998, month=12, day=28, limit=100):
    """The store side of q14: one week against the same week a year earlier."""
    years = f"d_year between {first_year} and {first_year + 2}"
    items, average = _cross_items(t, years), _average_sale(t, years)

    def week(year):
        days = semi_join(t.date_dim, prefixed(t.date_dim.where(f"d_year = {year} and d_moy = {month} and d_dom = {day}"), "x_"), ("d_week_seq", "x_d_week_seq"))
        sales = semi_join(t.store_sales, days, ("ss_sold_date_sk", "d_date_sk"))
        df = star_join(sales, (items, "ss_item_sk", "i_item_sk")).groupBy("i_brand_id", "i_class_id", "i_category_id") \
            .agg(F.sum(F.col("ss_quantity") * F.col("ss_list_price")).alias("sales"), F.count(F.lit(1)).alias("number_sales"))
        return df.crossJoin(average).where(F.col("sales").cast("double") > F.col("average_sales")) \
            .select(F.lit("store").alias("channel"), F.col("i_brand_id").alias("brand"), F.col("i_class_id").alias("class"),
                    F.col("i_category_id").alias("category"), "sales", "number_sales")

    this, last = prefixed(week(first_year + 1), "ty_"), prefixed(week(first_year), "ly_")
    out = this.join(last, on(*[(f"ty_{k}", f"ly_{k}") for k in ("brand", "class", "category")]))
    return top_n(out, limit, "ty_channel", "ty_brand", "ty_class", "ty_category")


# fixed values
Q15_ZIPS = ("85669", "86197", "88274", "83405", "86475", "85392", "85460", "80348", "81792")


def q15(t, zips=Q15_ZIPS, states=("CA", "WA", "GA"), price=500, quarter=2, year=2000, limit=100):
    """Catalog sales per zip where zip, state or price qualifies."""
    df = star_join(c.sold(t, "cs", f"d_qoy = {quarter} and d_year = {year}"),
                   (t.customer.select("c_customer_sk", "c_current_addr_sk"), "cs_bill_customer_sk", "c_customer_sk"),
                   (t.customer_address.select("ca_address_sk", "ca_zip", "ca_state"), "c_current_addr_sk", "ca_address_sk"))
    df = df.where(f"substr(ca_zip, 1, 5) in {c.sql_list(zips)} or ca_state in {c.sql_list(states)} or cs_sales_price > {price}")
    return top_n(df.groupBy("ca_zip").agg(F.sum("cs_sales_price").alias("sum_sales")), limit, "ca_zip")


def q16(t, start="2000-03-01", state="AL", counties=("Luce County", "Ziebach County", "San Miguel County", "Dauphin County", "Marshall County")):
    centers = t.call_center.where(f"cc_county in {c.sql_list(counties)}").select("cc_call_center_sk")
    return c.shipped_twice(t, "cs", "cs_ship_date_sk", start, state, (centers, "cs_call_center_sk", "cc_call_center_sk"), False)


def q17(t, year=1999, limit=100):
    """Quantity statistics through sale, return and re-purchase."""
    later = f"d_quarter_name in ('{year}Q1', '{year}Q2', '{year}Q3')"
    df = c.sale_return_rebuy(t, f"d_quarter_name = '{year}Q1'", later, later)
    aggs = []
    for col, name in (("ss_quantity", "store_sales"), ("sr_return_quantity", "store_returns"), ("cs_quantity", "catalog_sales")):
        aggs += [F.count(col).alias(f"{name}_quantitycount"), mean(col).alias(f"{name}_quantityave"),
                 sd(col).alias(f"{name}_quantitystdev"), coefficient_of_variation(col).alias(f"{name}_quantitycov")]
    return top_n(df.groupBy("i_item_id", "i_item_desc", "s_state").agg(*aggs), limit, "i_item_id", "i_item_desc", "s_state")


def q18(t, gender="F", education="Secondary", months=(1, 9, 11, 4, 12, 6), year=1998, states=("IL", "WA", "KY", "ND", "VT", "NC", "NJ"), limit=100):
    """Catalog averages per item rolled up over the geography of the buyer."""
    cd1 = t.customer_demographics.where(f"cd_gender = '{gender}' and cd_education_status = '{education}'").select("cd_demo_sk", "cd_dep_count")
    cd2 = t.customer_demographics.select(F.col("cd_demo_sk").alias("cd2_demo_sk"))
    df = star_join(c.sold(t, "cs", f"d_year = {year}"), (cd1, "cs_bill_cdemo_sk", "cd_demo_sk"),
                   (t.customer.where(f"c_birth_month in {c.sql_list(months)}"), "cs_bill_customer_sk", "c_customer_sk"),
                   (cd2, "c_current_cdemo_sk", "cd2_demo_sk"),
                   (t.customer_address.where(f"ca_state in {c.sql_list(states)}"), "c_current_addr_sk", "ca_address_sk"),
                   (t.item.select("i_item_sk", "i_item_id"), "cs_item_sk", "i_item_sk"))
    keys = ["i_item_id", "ca_country", "ca_state", "ca_county"]
    values = ["cs_quantity", "cs_list_price", "cs_coupon_amt", "cs_sales_price", "cs_net_profit", "c_birth_year", "cd_dep_count"]
    finest = df.groupBy(*keys).agg(*[F.sum(F.col(v).cast("decimal(12,2)")).alias(f"s{i}") for i, v in enumerate(values, 1)],
                                   *[F.count(v).alias(f"n{i}") for i, v in enumerate(values, 1)])
    out = finest.rollup(*keys).agg(*[ratio(F.sum(f"s{i}"), F.sum(f"n{i}")).alias(f"agg{i}") for i in range(1, 8)])
    return top_n(out, limit, "ca_country", "ca_state", "ca_county", "i_item_id")


def q19(t, manager=8, month=11, year=1999, limit=100):
    """Brand revenue where the buyer lives in another zip than the store."""
    df = star_join(c.sold(t, "ss", f"d_moy = {month} and d_year = {year}"), (t.item.where(f"i_manager_id = {manager}"), "ss_item_sk", "i_item_sk"),
                   (t.customer.select("c_customer_sk", "c_current_addr_sk"), "ss_customer_sk", "c_customer_sk"),
                   (t.customer_address.select("ca_address_sk", "ca_zip"), "c_current_addr_sk", "ca_address_sk"),
                   (t.store.select("s_store_sk", "s_zip"), "ss_store_sk", "s_store_sk")).where("substr(ca_zip, 1, 5) <> substr(s_zip, 1, 5)")
    out = df.groupBy(F.col("i_brand_id").alias("brand_id"), F.col("i_brand").alias("brand"), "i_manufact_id", "i_manufact") \
        .agg(F.sum("ss_ext_sales_price").alias("ext_price"))
    return top_n(out, limit, desc("ext_price"), "brand", "brand_id", "i_manufact_id", "i_manufact")


def q20(t, categories=("Men", "Electronics", "Music"), start="2001-03-09", limit=100):
    return c.category_share(t, "cs", categories, start, limit)


def q21(t, day="2000-05-19", lo=0.99, hi=1.49, limit=100):
    """Stock of cheap items before and after a day where the ratio stays within 2/3 and 3/2."""
    df = star_join(c.stocked(t, c.days(t, c.between_days(day, 30, 30), "d_date")),
                   (t.item.where(f"i_current_price between {lo} and {hi}").select("i_item_sk", "i_item_id"), "inv_item_sk", "i_item_sk"),
                   (t.warehouse.select("w_warehouse_sk", "w_warehouse_name"), "inv_warehouse_sk", "w_warehouse_sk"))
    early = F.col("d_date") < F.lit(day).cast("date")
    out = df.groupBy("w_warehouse_name", "i_item_id").agg(
        F.sum(F.when(early, F.col("inv_quantity_on_hand")).otherwise(0)).alias("inv_before"),
        F.sum(F.when(~early, F.col("inv_quantity_on_hand")).otherwise(0)).alias("inv_after"))
    return top_n(out.where(guarded_ratio("inv_after", "inv_before").between(2.0 / 3.0, 3.0 / 2.0)), limit, "w_warehouse_name", "i_item_id")


def q22(t, first_month=1190, limit=100):
    """Average stock over the product hierarchy; the rollup runs on per-product sums."""
    keys = ["i_product_name", "i_brand", "i_class", "i_category"]
    df = c.stocked(t, c.days(t, f"d_month_seq between {first_month} and {first_month + 11}"))
    per_item = df.groupBy("inv_item_sk").agg(F.sum("inv_quantity_on_hand").alias("s"), F.count("inv_quantity_on_hand").alias("n"))
    out = star_join(per_item, (t.item.select("i_item_sk", *keys), "inv_item_sk", "i_item_sk")) \
        .rollup(*keys).agg(ratio(F.sum("s"), F.sum("n")).alias("qoh"))
    return top_n(out, limit, "qoh", *keys)


def _frequent_items(t, year, often):
    df = star_join(c.sold(t, "ss", f"d_year between {year} and {year + 3}", "d_date"), (t.item.select("i_item_sk", "i_item_desc"), "ss_item_sk", "i_item_sk"))
    return df.groupBy(F.substring("i_item_desc", 1, 30).alias("itemdesc"), F.col("i_item_sk").alias("item_sk"), "d_date").count() \
        .where(f"count > {often}").select("item_sk")


def _best_customers(t, year, share):
    spent = F.sum(F.col("ss_quantity") * F.col("ss_sales_price"))
    total = t.store_sales.where("ss_customer_sk is not null").groupBy("ss_customer_sk").agg(spent.alias("spent"))
    top = c.sold(t, "ss", f"d_year between {year} and {year + 3}").where("ss_customer_sk is not null") \
        .groupBy("ss_customer_sk").agg(spent.alias("s")).agg(F.max("s").alias("most"))
    known = semi_join(total, t.customer.select("c_customer_sk"), ("ss_customer_sk", "c_customer_sk"))
    return known.crossJoin(top).where(F.col("spent").cast("double") > F.col("most").cast("double") * share).select(F.col("ss_customer_sk").alias("best_sk"))


def _best_sales(t, year, month, often, share):
    items, best = _frequent_items(t, year, often), _best_customers(t, year, share)
    return [(p, semi_join(semi_join(c.sold(t, p, f"d_year = {year} and d_moy = {month}"), items, (f"{p}_item_sk", "item_sk"), many=True),
                          best, (c.BUYER[p], "best_sk"))) for p in ("cs", "ws")]


def q23(t, year=2000, month=2, often=4, share=0.95):
    """Catalog and web revenue of frequently sold items from the best store customers."""
    parts = [df.select((F.col(f"{p}_quantity") * F.col(f"{p}_list_price")).alias("sales")) for p, df in _best_sales(t, year, month, often, share)]
    return union_all(*parts).agg(F.sum("sales").alias("sum_sales"))


def q23b(t, year=2000, month=2, often=4, share=0.95, limit=100):
    parts = [star_join(df, (t.customer, c.BUYER[p], "c_customer_sk")).groupBy("c_last_name", "c_first_name")
             .agg(F.sum(F.col(f"{p}_quantity") * F.col(f"{p}_list_price")).alias("sales")) for p, df in _best_sales(t, year, month, often, share)]
    return top_n(union_all(*parts), limit, "c_last_name", "c_first_name", "sales")


def q24(t, color="cornsilk", market=8):
    """Net paid per customer and store for one colour where it exceeds 5 % of the average group."""
    keys = ["c_last_name", "c_first_name", "s_store_name", "ca_state", "s_state", "i_color", "i_current_price", "i_manager_id", "i_units", "i_size"]
    df = star_join(c.with_returns(t, t.store_sales, "ss", "inner"), (t.store.where(f"s_market_id = {market}"), "ss_store_sk", "s_store_sk"),
                   (t.item, "ss_item_sk", "i_item_sk"), (t.customer, "ss_customer_sk", "c_customer_sk")) \
        .join(t.customer_address, F.expr("c_current_addr_sk = ca_address_sk and s_zip = ca_zip and c_birth_country <> upper(ca_country)"))
    groups = df.groupBy(*keys).agg(F.sum("ss_net_paid_inc_tax").alias("netpaid"))
    average = groups.agg((mean("netpaid") * 0.05).alias("least"))
    out = groups.where(f"i_color = '{color}'").groupBy("c_last_name", "c_first_name", "s_store_name").agg(F.sum("netpaid").alias("paid"))
    return out.crossJoin(average).where(F.col("paid").cast("double") > F.col("least")).drop("least") \
        .orderBy(asc("c_last_name"), asc("c_first_name"), asc("s_store_name"))


def q24b(t, color="lime", market=8):
    return q24(t, color, market)


def q25(t, year=2002, first=4, last=10, limit=100, agg=F.min):
    """Profit and loss through sale, return and re-purchase."""
    later = f"d_moy between {first} and {last} and d_year = {year}"
    df = c.sale_return_rebuy(t, f"d_moy = {first} and d_year = {year}", later, later)
    keys = ["i_item_id", "i_item_desc", "s_store_id", "s_store_name"]
    return top_n(df.groupBy(*keys).agg(agg("ss_net_profit").alias("store_sales_profit"), agg("sr_net_loss").alias("store_returns_loss"),
                                       agg("cs_net_profit").alias("catalog_sales_profit")), limit, *keys)
