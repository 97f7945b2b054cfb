"""Registered queries for joins, aggregates, windows, sets, sorts and scalar functions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions import semantics as m
from millrace.functions.semantics import asc, desc, mean, ratio
from millrace.operators import relational as r
from millrace.operators.relational import on, semi_join, star_join, top_n, union_all
from millrace.plans.catalog.common import Source, plain

QUERIES = {}


def query(fn):
    """Register ``fn(source) -> DataFrame`` under its name."""
    QUERIES[fn.__name__] = lambda spark, folder: plain(fn(Source(spark, folder)))
    return fn


_money = m.money


def _revenue():
    """Discounted price, exact to four digits: cents times percent."""
    units = m.whole_units("l_extendedprice") * (100 - m.whole_units("l_discount"))
    return (units.cast("decimal(14,0)") * F.lit(Decimal("0.0001"))).cast("decimal(16,4)")


def _orders(s, *extra):
    return s.orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"), F.year("o_orderdate").alias("yr"), F.month("o_orderdate").alias("mo"), *extra)


# ---- joins -------------------------------------------------------------------

@query
def revenue_share_by_region(s):
    """Revenue per nation and year and its share of the region's year."""
    rev = star_join(s.lineitem.select("l_orderkey", _revenue().alias("rev")), (_orders(s), "l_orderkey", "o_orderkey"),
                    (s.customer.select("c_custkey", "c_nationkey"), "o_custkey", "c_custkey"), (s.nation, "c_nationkey", "n_nationkey"), (s.region, "n_regionkey", "r_regionkey")) \
        .groupBy("r_name", "n_name", "yr").agg(F.sum("rev").alias("revenue"))
    shared = r.ratio_to_report(rev, "revenue", ["r_name", "yr"], "share_pct", 100.0)
    return top_n(shared, 100, "r_name", "yr", desc("revenue"), "n_name")


@query
def star_brand_by_month(s):
    df = star_join(s.lineitem.select("l_orderkey", "l_partkey", _revenue().alias("rev")), (s.part.where("p_type = 'PROMO'").select("p_partkey", "p_brand"), "l_partkey", "p_partkey"),
                   (_orders(s).where("mo = 11"), "l_orderkey", "o_orderkey"))
    return top_n(df.groupBy("yr", "p_brand").agg(F.sum("rev").alias("revenue")), 100, "yr", desc("revenue"), "p_brand")


@query
def left_join_net(s):
    back = s.lineitem.where("l_returnflag = 'R'").groupBy("l_orderkey").agg(F.sum(_revenue()).alias("returned"))
    df = r.left_join(s.orders, back, ("o_orderkey", "l_orderkey"))
    net = _money("o_totalprice") - F.coalesce("returned", F.lit(0).cast("decimal(12,4)"))
    return df.groupBy("o_orderpriority").agg(F.sum(net).alias("net"), F.count("returned").alias("orders_with_returns"), F.count(F.lit(1)).alias("orders"))


@query
def left_join_made_inner(s):
    """Filtering the nullable side of a left join; Catalyst plans an inner join."""
    df = r.left_join(s.orders, s.lineitem, ("o_orderkey", "l_orderkey")).where("l_quantity > 45")
    return df.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.sum(_money("l_quantity")).alias("quantity"))


def _bought(s, year, name):
    return star_join(s.lineitem.select("l_orderkey", "l_partkey"), (_orders(s).where(f"yr = {year}"), "l_orderkey", "o_orderkey")) \
        .select(F.col("o_custkey").alias("cust"), F.col("l_partkey").alias("part")).distinct().withColumn(name, F.lit(True))


@query
def full_outer_overlap(s):
    """Customer-part pairs of two years by the side they occur on."""
    df = r.full_join(_bought(s, 1996, "early"), _bought(s, 1997, "late"), ["cust", "part"])
    e, l = F.col("early").isNotNull(), F.col("late").isNotNull()
    return df.agg(F.count_if(e & ~l).alias("early_only"), F.count_if(~e & l).alias("late_only"), F.count_if(e & l).alias("both"))


@query
def anti_no_orders(s):
    recent = _orders(s).where("yr >= 2001")
    return r.anti_join(s.customer, recent, ("c_custkey", "o_custkey"), many=True).groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.sum(_money("c_acctbal")).alias("balance"))


@query
def semi_or_exists(s):
    urgent = s.orders.where("o_orderpriority = '1-URGENT' and year(o_orderdate) = 1997")
    large = s.orders.where("o_totalprice > 490000")
    df = r.exists_any(s.customer, [(urgent, "o_custkey"), (large, "o_custkey")], "c_custkey")
    return df.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))


@query
def exists_other_supplier(s):
    """Returned lines of orders that other suppliers also served, where no line is open."""
    df = r.exists_other(s.lineitem, "l_orderkey", "l_suppkey").where("l_returnflag = 'R'")
    df = r.anti_join(df, s.lineitem.where("l_linestatus = 'O'").select(F.col("l_orderkey").alias("open_key")), ("l_orderkey", "open_key"), many=True)
    return df.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("l_orderkey").alias("orders"))


@query
def range_join_hourly(s):
    """Events of a user within two hours after each of their purchases."""
    spans = s.events.where("event_type = 'purchase'").select("event_id", F.col("user_id").alias("buyer"), F.col("ts").alias("from_ts"), (F.col("ts") + F.expr("interval 2 hours")).alias("to_ts"))
    ev = s.events.select(F.col("event_id").alias("e_id"), "user_id", "ts", "event_type")
    df = r.interval_join(ev, spans, ("user_id", "buyer"), "ts", "from_ts", "to_ts")
    return df.groupBy("event_type").agg(F.count(F.lit(1)).alias("pairs"), F.count_distinct("event_id").alias("purchases"), F.count_distinct("e_id").alias("events"))


@query
def shifted_year_compare(s):
    yearly = _orders(s, "o_orderpriority", "o_totalprice").groupBy("o_orderpriority", "yr").agg(F.sum(_money("o_totalprice")).alias("total"))
    df = r.shifted_self_join(yearly, ["o_orderpriority"], "yr", 1)
    return df.select("o_orderpriority", "yr", "total", "total_next", ratio("total_next", "total").alias("growth"))


@query
def or_band_filter(s):
    bands = ("(p_type = 'SMALL' and l_quantity between 1 and 11 and c_mktsegment = 'BUILDING') or (p_type = 'MEDIUM' and l_quantity between 10 and 20 and c_mktsegment = 'MACHINERY')"
             " or (p_type = 'LARGE' and l_quantity between 20 and 30 and c_mktsegment = 'FURNITURE')")
    df = star_join(s.lineitem.where("l_quantity between 1 and 30"), (s.part.select("p_partkey", "p_type"), "l_partkey", "p_partkey"),
                   (s.orders.select("o_orderkey", "o_custkey"), "l_orderkey", "o_orderkey"), (s.customer.select("c_custkey", "c_mktsegment"), "o_custkey", "c_custkey"))
    return df.where(bands).agg(F.sum(_revenue()).alias("revenue"), F.count(F.lit(1)).alias("n"))


@query
def corr_avg_part(s):
    """Lines whose quantity exceeds 1.3 times the average of their part."""
    df = r.above_group_avg(s.lineitem.select("l_partkey", F.col("l_quantity").cast("bigint").alias("q"), "l_extendedprice"), "l_partkey", "q", 1.3)
    return df.agg(F.sum(_money("l_extendedprice")).alias("total"), F.count(F.lit(1)).alias("n"))


@query
def corr_count_or(s):
    """Parts of brands that have at least one part of either kind."""
    kinds = F.expr("(p_type = 'PROMO' and p_size in (1, 2, 3) and p_name like '%ring') or (p_type = 'ECONOMY' and p_size in (48, 49, 50) and p_name like '%widget')")
    brands = r.count_matching(s.part, "p_brand", kinds).where("n_matching > 0").select(F.col("p_brand").alias("b"))
    return top_n(semi_join(s.part.where("p_size between 10 and 40"), brands, ("p_brand", "b")).select("p_name", "p_brand").distinct(), 100, "p_name", "p_brand")


@query
def scalar_bucket_choice(s):
    aggs, picks = [], []
    for i, least in enumerate((1000, 20000, 100, 10 ** 9, 5)):
        inside = F.col("l_quantity").between(10 * i + 1, 10 * i + 10)
        aggs += [F.count_if(inside).alias(f"n{i}"), mean(F.when(inside, _money("l_extendedprice"))).alias(f"a{i}"), mean(F.when(inside, F.col("l_discount").cast("decimal(4,2)"))).alias(f"b{i}")]
        picks.append(F.when(F.col(f"n{i}") > least, F.col(f"a{i}")).otherwise(F.col(f"b{i}")).alias(f"bucket{i + 1}"))
    return s.lineitem.agg(*aggs).select(*picks)


@query
def nested_in_week(s):
    """Orders of the ISO weeks that contain the largest order of each status."""
    o = s.orders.select("o_orderkey", "o_orderstatus", "o_totalprice", F.date_trunc("week", "o_orderdate").alias("wk"))
    top = o.groupBy("o_orderstatus").agg(F.max_by("wk", F.struct("o_totalprice", "o_orderkey")).alias("w")).select("w").distinct()
    return semi_join(o, top, ("wk", "w")).groupBy(F.to_date("wk").alias("week")).agg(F.count(F.lit(1)).alias("n"), F.sum(_money("o_totalprice")).alias("total"))


@query
def nonequi_residual(s):
    """Revenue of lines whose supplier sits in another nation than the customer, shipped within 30 days."""
    df = star_join(s.lineitem, (_orders(s), "l_orderkey", "o_orderkey"), (s.customer.select("c_custkey", "c_nationkey"), "o_custkey", "c_custkey"))
    df = r.residual_join(df, s.supplier.select("s_suppkey", "s_nationkey"), [("l_suppkey", "s_suppkey")], "c_nationkey <> s_nationkey")
    return df.where("to_date(l_shipdate) > day and to_date(l_shipdate) <= date_add(day, 30)").groupBy("c_nationkey").agg(F.sum(_revenue()).alias("revenue"), F.count(F.lit(1)).alias("n"))


@query
def cross_one_row_results(s):
    a = s.orders.where("o_orderpriority = '1-URGENT'").agg(F.count(F.lit(1)).alias("urgent"))
    b = s.orders.where("o_orderpriority = '5-LOW'").agg(F.count(F.lit(1)).alias("low"))
    return r.cross_rows(a, b).select("urgent", "low", m.dec_ratio("urgent", "low", 15, 4).alias("ratio"))


@query
def in_long_list(s):
    """A long list of values as a semi join with a table."""
    wanted = s.lineitem.where("l_quantity = 50 and l_discount >= 0.09").select(F.col("l_partkey").alias("k"))
    return semi_join(s.part, wanted, ("p_partkey", "k"), many=True).groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))


@query
def cte_chain(s):
    """Frequent parts, the largest buyer, and what large buyers spent on frequent parts."""
    frequent = s.lineitem.groupBy("l_partkey").count().where("count > 30").select(F.col("l_partkey").alias("fp"))
    spent = star_join(s.lineitem.select("l_orderkey", "l_partkey", _money("l_extendedprice").alias("v")), (s.orders.select("o_orderkey", "o_custkey"), "l_orderkey", "o_orderkey"))
    totals = spent.groupBy(F.col("o_custkey").alias("buyer")).agg(F.sum("v").alias("t"))
    large = totals.crossJoin(totals.agg(F.max("t").alias("most"))).where(F.col("t").cast("double") > 0.6 * F.col("most").cast("double")).select("buyer")
    df = semi_join(semi_join(spent, frequent, ("l_partkey", "fp")), large, ("o_custkey", "buyer"))
    return df.agg(F.sum("v").alias("total"), F.count(F.lit(1)).alias("n"))


# ---- aggregates ------------------------------------------------------------------

_DAYS = {"sun": "Sunday", "mon": "Monday", "tue": "Tuesday", "wed": "Wednesday", "thu": "Thursday", "fri": "Friday", "sat": "Saturday"}


@query
def pivot_weekday(s):
    df = s.orders.withColumn("day_name", F.date_format("o_orderdate", "EEEE"))
    return df.groupBy("o_orderpriority").agg(*r.pivot_sum("day_name", _DAYS, _money("o_totalprice")))


@query
def lag_buckets(s):
    df = star_join(s.lineitem.select("l_orderkey", "l_returnflag", F.to_date("l_shipdate").alias("ship")), (_orders(s), "l_orderkey", "o_orderkey"))
    return df.groupBy("l_returnflag").agg(*r.lag_buckets(F.datediff("ship", "day")))


@query
def rollup_grouping(s):
    df = star_join(s.orders, (s.customer, "o_custkey", "c_custkey"), (s.nation, "c_nationkey", "n_nationkey"), (s.region, "n_regionkey", "r_regionkey"))
    return r.rollup(df, ["r_name", "n_name"], [F.sum(_money("o_totalprice")).alias("t"), F.count(F.lit(1)).alias("c")],
                    [F.sum("t").alias("total"), F.sum("c").alias("n")], [r.grouping_level("r_name", "n_name").alias("level"), F.grouping("n_name").alias("g_nation")])


@query
def rollup8_top100(s):
    keys = ["p_type", "p_brand", "p_size", "yr", "qtr", "mo", "l_returnflag", "l_linestatus"]
    df = star_join(s.lineitem, (s.part, "l_partkey", "p_partkey"), (_orders(s, F.quarter("o_orderdate").alias("qtr")), "l_orderkey", "o_orderkey")).where("yr = 1998")
    rolled = r.rollup(df, keys, [F.sum(_revenue()).alias("v")], [F.sum("v").alias("sumsales")])
    return top_n(r.rank_in(rolled, ["p_type"], [desc("sumsales")], "rk", keep=100), 100, *keys, "sumsales", "rk")


@query
def count_distinct_multi(s):
    return s.lineitem.groupBy("l_returnflag").agg(F.count_distinct("l_partkey").alias("parts"), F.count_distinct("l_suppkey").alias("suppliers"), F.count_distinct("l_quantity").alias("quantities"), F.count(F.lit(1)).alias("n"))


@query
def stddev_cov(s):
    """Spread of the prices, which have fractions, per part."""
    df = s.lineitem.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"), m.sd("l_extendedprice").alias("stdev"), m.coefficient_of_variation(m.money("l_extendedprice")).alias("cov"))
    return df.where("cov > 0.6 or n = 1")


@query
def having_scalar(s):
    spent = s.orders.groupBy("o_custkey").agg(F.sum(_money("o_totalprice")).alias("total"))
    limit = spent.agg((mean("total") * 1.5).alias("limit"))
    return spent.crossJoin(limit).where(F.col("total").cast("double") > F.col("limit")).select("o_custkey", "total")


@query
def segments_hist(s):
    return s.orders.groupBy(r.segments(_money("o_totalprice"), 50000).alias("segment")).agg(F.count(F.lit(1)).alias("n")).withColumn("segment_base", F.col("segment") * 50000)


@query
def ratio_to_report(s):
    return r.ratio_to_report(s.orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("cnt")), "cnt", name="percent", scale=100.0)


@query
def agg_of_agg(s):
    per = s.lineitem.groupBy("l_suppkey", "l_partkey").agg(F.sum(_revenue()).alias("v"))
    return per.groupBy("l_suppkey").agg(mean("v").alias("avg_revenue"), F.max("v").alias("max_revenue"), F.count(F.lit(1)).alias("parts"))


@query
def geomean(s):
    """Total and geometric mean of event values per type, as for run times."""
    df = s.events.where("value > 0").groupBy("event_type").agg(F.sum(_money("value")).alias("total"), F.round(F.exp(F.avg(F.ln("value"))), 6).alias("geomean"))
    return df


@query
def run_time_summary(s):
    """The run summary over a timing frame: one row per event, its value as seconds."""
    out = r.run_summary(s.events.where("value > 0").select(F.col("value").alias("seconds")))
    return out.select(F.round("total_seconds", 4).alias("total_seconds"), F.round("geomean_seconds", 6).alias("geomean_seconds"))


@query
def distinct_groups(s):
    return s.lineitem.select("l_returnflag", "l_linestatus", F.col("l_discount").cast("decimal(4,2)").alias("discount")).distinct()


@query
def group_by_all(s):
    return s.spark.sql("select o_orderpriority, year(o_orderdate) as yr, count(*) as n from {orders} group by all", orders=s.orders)


@query
def dec_ratio(s):
    df = s.lineitem.groupBy("l_suppkey").agg(F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity").cast("bigint"))).alias("back"), F.sum(F.col("l_quantity").cast("bigint")).alias("sold"))
    return df.select("l_suppkey", F.round(m.dec_ratio("back", "sold", 15, 4), 8).alias("return_ratio"))


@query
def nested_objects(s):
    """Per order an array of line objects, as sorted text."""
    df = r.collect_objects(s.lineitem, ["l_orderkey"], ["l_linenumber", "l_partkey"], "lines")
    return df.select("l_orderkey", F.concat_ws("|", F.transform("lines", lambda x: F.concat(x["l_linenumber"].cast("string"), F.lit(":"), x["l_partkey"].cast("string")))).alias("lines"))


# ---- windows ------------------------------------------------------------------------

@query
def share_of_class(s):
    df = star_join(s.lineitem, (s.part, "l_partkey", "p_partkey")).groupBy("p_type", "p_partkey").agg(F.sum(_revenue()).alias("revenue"))
    return top_n(r.ratio_to_report(df, "revenue", ["p_type"], "share_pct", 100.0), 100, "p_type", desc("revenue"), "p_partkey")


@query
def avg_over_sum_deviation(s):
    df = star_join(s.lineitem, (s.part, "l_partkey", "p_partkey"), (_orders(s, F.quarter("o_orderdate").alias("qtr")), "l_orderkey", "o_orderkey")).where("yr = 1999") \
        .groupBy("p_brand", "qtr").agg(F.sum(_revenue()).alias("sum_sales"))
    w = W.partitionBy("p_brand")
    out = df.withColumn("avg_sales", F.sum("sum_sales").over(w).cast("double") / F.count("sum_sales").over(w))
    return out.where("avg_sales > 0").where(F.abs(F.col("sum_sales").cast("double") - F.col("avg_sales")) / F.col("avg_sales") > 0.1)


@query
def rank_in_rollup(s):
    df = star_join(s.lineitem, (s.part, "l_partkey", "p_partkey")).groupBy("p_type", "p_brand").agg(F.sum(_revenue()).alias("v"))
    rolled = df.rollup("p_type", "p_brand").agg(F.sum("v").alias("total"), r.grouping_level("p_type", "p_brand").alias("level"), F.grouping("p_brand").alias("leaf"))
    return r.rank_in_hierarchy(rolled, "level", "p_type", "leaf", desc("total"), "rank_in_parent").drop("leaf")


@query
def cumulative_overtake(s):
    """Supplier days on which cumulative returned value leads cumulative kept value."""
    df = s.lineitem.select("l_suppkey", F.to_date("l_shipdate").alias("day"), "l_returnflag", _money("l_extendedprice").alias("v")).where("l_returnflag in ('R', 'N')")
    daily = df.groupBy("l_suppkey", "day").agg(F.sum(F.when(F.col("l_returnflag") == "R", F.col("v"))).alias("back"), F.sum(F.when(F.col("l_returnflag") == "N", F.col("v"))).alias("kept"))
    out = daily.withColumn("cum_back", r.running(F.sum, "back", ["l_suppkey"], ["day"])).withColumn("cum_kept", r.running(F.sum, "kept", ["l_suppkey"], ["day"])) \
        .withColumn("peak_back", r.running(F.max, "back", ["l_suppkey"], ["day"]))
    return top_n(out.where("cum_back > cum_kept").select("l_suppkey", "day", "cum_back", "cum_kept", "peak_back"), 100, "l_suppkey", "day")


@query
def best_worst_rank(s):
    avg = s.lineitem.groupBy("l_partkey").agg(mean(_revenue()).alias("v"))
    low = r.rank_top(avg, "v", 10).select("rnk", F.col("l_partkey").alias("worst"))
    high = r.rank_top(avg, "v", 10, descending=True).select("rnk", F.col("l_partkey").alias("best"))
    return low.join(high, "rnk")


@query
def top_n_per_group(s):
    return r.rank_in(s.orders.select("o_orderpriority", "o_orderkey", _money("o_totalprice").alias("price")), ["o_orderpriority"], [desc("price")], "rk", keep=5)


@query
def prev_next_period(s):
    df = _orders(s, "o_orderpriority", "o_totalprice").groupBy("o_orderpriority", "yr", "mo").agg(F.sum(_money("o_totalprice")).alias("total"))
    w = W.partitionBy("o_orderpriority").orderBy("yr", "mo")
    return df.withColumn("prev", F.lag("total").over(w)).withColumn("next", F.lead("total").over(w)).where("yr = 1999")


@query
def qualify_latest(s):
    """The newest event of every user, ties included."""
    return r.qualify(s.events.select("user_id", "event_id", "event_type", "ts"), F.rank().over(W.partitionBy("user_id").orderBy(F.col("ts").desc())), "q = 1").select("user_id", "event_id", "event_type")


@query
def last_over_partition(s):
    """First and last event type of a user beside every purchase, with the whole partition as frame."""
    df = s.events.select("event_id", "user_id", "ts", "event_type")
    out = r.ends_of_partition(df, "user_id", ["ts", "event_id"], "event_type", "first_type", "last_type")
    return out.where("event_type = 'purchase'").drop("ts")


@query
def row_number_global(s):
    """Every line item numbered by its price over the whole table."""
    from millrace.operators.ordered import numbered
    lines = s.lineitem.select("l_orderkey", "l_linenumber", _money("l_extendedprice").alias("price"))
    return numbered(lines, F.col("price").desc(), "l_orderkey", "l_linenumber", name="n")


@query
def running_total_global(s):
    """Turnover up to each order, over the whole table."""
    from millrace.operators.ordered import running_total
    orders = s.orders.select("o_orderkey", _money("o_totalprice").alias("price"), "o_orderdate")
    return running_total(orders, "price", "o_orderdate", "o_orderkey", name="turnover").drop("o_orderdate")


@query
def interval_join_years(s):
    """Orders within spans of very different lengths, from minutes to years, of their customer."""
    k = F.col("c_custkey")
    start = F.expr("timestamp'1995-01-01' + make_interval(0, 0, 0, cast(c_custkey % 1500 as int))")
    spans = s.customer.select("c_custkey", start.alias("a"), (start + F.expr("make_interval(0, 0, 0, 0, 0, cast(pow(12, c_custkey % 6 + 1) as int))")).alias("b"), (k % 6).alias("kind"))
    orders = s.orders.select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("timestamp").alias("at"))
    return r.interval_join(orders, spans, ("o_custkey", "c_custkey"), "at", "a", "b").groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("orders"))


@query
def row_number_orders(s):
    return s.orders.select("o_custkey", "o_orderkey", F.row_number().over(W.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")).alias("n")).where("n <= 2")


@query
def cost_share(s):
    """Order value split over its lines in proportion to quantity."""
    from millrace.operators.analytics import allocate
    lines = star_join(s.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").cast("bigint").alias("q")), (s.orders.select("o_orderkey", "o_totalprice"), "l_orderkey", "o_orderkey"))
    out = allocate(lines, ["l_orderkey"], "q", "o_totalprice", "cost")
    return out.groupBy(F.col("l_linenumber")).agg(F.round(F.sum(F.col("cost").cast("decimal(20,6)")), 2).alias("cost"), F.count(F.lit(1)).alias("n"))


# ---- sorts and sets --------------------------------------------------------------------

@query
def sort_null_order(s):
    """Top rows of a rollup whose subtotal marker NULL sorts last ascending and first descending."""
    df = s.orders.rollup("o_orderpriority", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return top_n(df, 9, desc("o_orderpriority"), asc("o_orderstatus"))


@query
def top_n_orders(s):
    return top_n(s.orders.select("o_orderkey", "o_custkey", "o_totalprice"), 100, desc("o_totalprice"), "o_orderkey")


@query
def union_distinct_channels(s):
    parts = [star_join(s.lineitem.where(f"l_returnflag = '{f}'").select("l_orderkey", "l_suppkey"), (s.orders.select("o_orderkey", "o_custkey"), "l_orderkey", "o_orderkey")).select("o_custkey", "l_suppkey") for f in "RAN"]
    return r.union_distinct(*parts).groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("customers"))


def _buyers(s, flag):
    return star_join(s.lineitem.where(f"l_returnflag = '{flag}'").select("l_orderkey", "l_partkey"), (_orders(s).where("yr in (1996, 1997)"), "l_orderkey", "o_orderkey")).select("o_custkey", "mo")


@query
def intersect_three(s):
    return r.intersect(*[_buyers(s, f) for f in "RAN"]).groupBy("mo").agg(F.count(F.lit(1)).alias("n"))


@query
def except_chain(s):
    return r.except_(*[_buyers(s, f) for f in "RAN"]).groupBy("mo").agg(F.count(F.lit(1)).alias("n"))


@query
def union_all_reagg(s):
    a = s.lineitem.groupBy("l_partkey").agg(F.sum(_revenue()).alias("v"))
    parts = [a.select("l_partkey", "v"), s.lineitem.where("l_returnflag = 'R'").groupBy("l_partkey").agg((-F.sum(_revenue())).alias("v"))]
    return top_n(union_all(*parts).groupBy("l_partkey").agg(F.sum("v").alias("net"), F.count(F.lit(1)).alias("parts")), 100, desc("net"), "l_partkey")


@query
def union_counts(s):
    return r.reconcile({"orders": s.orders, "lineitem": s.lineitem, "orders in lineitem": s.lineitem.select("l_orderkey").distinct()})


@query
def filter_forms(s):
    df = star_join(s.orders, (s.customer, "o_custkey", "c_custkey")).where("o_totalprice between 100000 and 300000 and o_orderpriority in ('1-URGENT', '2-HIGH')") \
        .where("c_name like 'Customer#%1' and c_mktsegment ilike 'b%' and c_acctbal is not null and not (o_orderstatus = 'F')")
    df = df.where(m.guarded_ratio("o_totalprice", "c_acctbal") > 20).where(m.within_pct("o_totalprice", F.lit(200000.0), 0.4))
    return df.select(F.col("o_orderkey").alias("order key"), "c_name", "o_totalprice").withColumnRenamed("order key", "order_key")


@query
def projection_forms(s):
    """Aliases reused in the same projection, dropped columns and a constant."""
    hy = s.customer.alias("hy").join(s.nation.alias("n"), on(("c_nationkey", "n_nationkey"))).select("hy.*", "n.n_name")
    out = hy.drop("c_mktsegment", "c_nationkey").withColumn("half", F.col("c_acctbal") / 2).withColumn("quarter", F.col("half") / 2).withColumn("label", F.concat("c_name", F.lit("/"), "n_name")).withColumn("source", F.lit("crm"))
    return out


# ---- scalar functions --------------------------------------------------------------------

@query
def string_funcs(s):
    c = F.col("c_name")
    return s.customer.select("c_custkey", F.substring(c, 3, 4).alias("sub"), F.left(c, F.lit(3)).alias("l3"), F.right(c, F.lit(4)).alias("r4"), F.length(c).alias("len"), F.upper(c).alias("up"),
                             F.trim(F.concat(F.lit("  "), c, F.lit(" "))).alias("trimmed"), F.replace(c, F.lit("000"), F.lit("-")).alias("repl"), m.split_part(c, "#", 2).alias("part2"),
                             m.split_part(c, "#", 3).alias("part3"), m.strtok(c, "#", 2).alias("tok2"), m.strtok(c, "#", 3).alias("tok3"), F.concat(c, F.lit(":"), F.col("c_mktsegment")).alias("cat"))


@query
def date_funcs(s):
    d = F.to_date("o_orderdate")
    return s.orders.select("o_orderkey", F.date_add(d, 30).alias("plus30"), F.date_sub(d, 30).alias("minus30"), (d + F.expr("interval '60' day")).cast("date").alias("plus60"), F.add_months(d, -1).alias("prev_month"),
                           F.to_date(F.date_trunc("month", "o_orderdate")).alias("month"), F.quarter(d).alias("q"), F.datediff(F.lit("2001-01-01").cast("date"), d).alias("age"),
                           F.expr("timestampdiff(HOUR, o_orderdate, timestamp_ntz'2001-01-01 00:00:00')").alias("hours"),
                           F.substring(F.convert_timezone(F.lit("UTC"), F.lit("Europe/Paris"), F.col("o_orderdate").cast("timestamp_ntz")).cast("string"), 1, 16).alias("paris"))


@query
def math_funcs(s):
    x, y = F.col("l_extendedprice"), F.col("l_quantity")
    return s.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.max(x).alias("x"), F.max(y).alias("y"), F.count(F.lit(1)).alias("n")).select(
        "l_orderkey", "l_linenumber", F.abs(F.col("y") - 25).alias("dist"), F.round(F.col("x"), 0).cast("bigint").alias("rounded"), m.ratio(F.col("y").cast("bigint"), F.lit(7)).alias("frac"),
        m.round_to_int(F.col("x").cast("decimal(12,2)") / 50).alias("seg"), F.round(F.exp(F.ln("y")), 6).alias("expln"), m.ratio("x", F.lit(0)).alias("none"))


@query
def cond_funcs(s):
    p = F.col("o_orderpriority")
    simple = F.when(p == "1-URGENT", 1).when(p == "2-HIGH", 2).otherwise(0)
    empty = F.nullif(F.col("o_orderstatus"), F.lit("O"))
    return s.orders.select("o_orderkey", simple.alias("code"), F.when(F.col("o_totalprice") > 250000, "big").otherwise("small").alias("size"), empty.alias("not_open"), F.coalesce(empty, F.lit("?")).alias("status"),
                           F.ifnull(empty, p).alias("filled"), m.guarded_ratio("o_totalprice", F.col("o_orderkey") - 5).alias("guarded"))


@query
def try_casts(s):
    df = s.customer.select("c_custkey", F.split_part("c_name", F.lit("#"), F.lit(2)).alias("digits"), F.col("c_acctbal").cast("string").alias("balance"), F.concat(F.lit("2024-01-"), (F.col("c_custkey") % 40).cast("string")).alias("day"))
    return df.select("c_custkey", m.try_exact_integer("digits").alias("as_int"), m.try_exact_integer("balance").alias("balance_int"), m.try_to_double("balance").alias("as_double"),
                     m.try_exact_date("day", "yyyy-MM-d").alias("as_date"), F.col("balance").cast("double").cast("decimal(38,2)").alias("as_decimal"))


@query
def regex_lookaround(s):
    """A word that is followed by a given word, replaced and tested over whole texts."""
    return s.documents.select("doc_id", F.md5(F.regexp_replace("text", r"\.(?=\n)", "***")).alias("replaced"), F.col("text").rlike(r"(?i)\bthe (?=an)").alias("found"),
                              F.regexp_replace(F.concat(F.lit("foobarbarfoo"), F.col("doc_id").cast("string")), "bar(?=bar)", "***").alias("stars"))


@query
def strtok_split_table(s):
    """Lines of every document as rows, with position, size and first token."""
    from millrace.operators.semistructured import split_to_rows
    rows = split_to_rows(s.documents.select("doc_id", "text"), "text", "\n", "line", "line_no")
    return rows.groupBy("line_no").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("line")).alias("chars"), F.count(m.strtok("line", " ", 3)).alias("with_third_token"), F.min(m.strtok("line", " ", 1)).alias("least"))
