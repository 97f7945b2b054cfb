"""Forms chosen for large or skewed data, against brute force on small fixtures, and plan checks."""

import json
import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.operators import analytics as an
from millrace.operators import layout
from millrace.operators import relational as r
from millrace.plans.catalog.common import Source
from millrace.plans.tables import derived_tables
from millrace.plans.tpcds import QUERIES
from millrace.streaming import changes as cd

FOLDER = "/root/testdata/sf0.01"


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(5)
    rows = [("hot" if rnd.random() < 0.4 else f"k{rnd.randrange(20)}", rnd.randrange(300), i) for i in range(3000)]
    return spark.createDataFrame(rows, "key string, t bigint, id bigint").cache()


def test_history_equals_one_window_per_key(spark, skewed):
    got = cd.scd2_history(skewed, "key", "t", "id", 25).select("id", "version", "is_latest", "valid_to")
    down = W.partitionBy("key").orderBy(F.col("t").desc())
    score = F.rank().over(down)
    whole = W.partitionBy("key")
    want = skewed.withColumn("score", score).withColumn("top", F.max("score").over(whole)) \
        .select("id", (F.col("top") + 1 - F.col("score")).cast("bigint").alias("version"), (F.col("score") == 1).alias("is_latest"),
                F.lead("t").over(W.partitionBy("key").orderBy("t", "id")).alias("valid_to"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_history_has_one_latest_and_no_overlap(spark):
    df = spark.createDataFrame([("a", t, t) for t in (1, 5, 9)], "key string, t bigint, id bigint")
    rows = cd.scd2_history(df, "key", "t", "id", 2).orderBy("t").collect()
    assert [(x.version, x.valid_to, x.is_latest) for x in rows] == [(1, 5, False), (2, 9, False), (3, None, True)]


def test_latest_keeps_ties(spark):
    df = spark.createDataFrame([("a", 1, "U"), ("a", 2, "U"), ("a", 2, "I"), ("b", 3, "DELETE")], "key string, t bigint, action string")
    assert cd.current_state(df, "key", "t").count() == 2


def test_rank_top_equals_window(spark, skewed):
    for down in (False, True):
        order = F.col("t").desc() if down else F.col("t")
        want = skewed.withColumn("rnk", F.rank().over(W.orderBy(order))).where("rnk <= 10")
        got = r.rank_top(skewed, "t", 10, down)
        assert sorted((x.id, x.rnk) for x in got.collect()) == sorted((x.id, x.rnk) for x in want.collect())


def test_interval_join_equals_nested_loop(spark):
    rnd = random.Random(3)
    ev = [(i, rnd.choice("ab"), rnd.randrange(0, 40000)) for i in range(300)]
    sp = [(i, rnd.choice("ab"), s, s + rnd.randrange(0, 9000)) for i, s in enumerate(rnd.randrange(0, 40000) for _ in range(80))]
    e = spark.createDataFrame(ev, "id int, k string, s bigint").select("id", "k", F.timestamp_seconds("s").alias("ts"))
    s = spark.createDataFrame(sp, "sid int, sk string, a bigint, b bigint").select("sid", "sk", F.timestamp_seconds("a").alias("a"), F.timestamp_seconds("b").alias("b"))
    got = {(x.id, x.sid) for x in r.interval_join(e, s, ("k", "sk"), "ts", "a", "b").collect()}
    assert got == {(i, j) for i, k, t in ev for j, q, a, b in sp if k == q and a <= t <= b}
    half = {(x.id, x.sid) for x in r.interval_join(e, s, ("k", "sk"), "ts", "a", "b", closed=False).collect()}
    assert half == {(i, j) for i, k, t in ev for j, q, a, b in sp if k == q and a <= t < b}


def test_exists_other_equals_pairs(spark, skewed):
    df = skewed.select("key", F.when(F.col("t") % 50 == 0, None).otherwise(F.col("t") % 2).alias("w"), "id").where("key <> 'hot' or t % 2 = 0")
    rows = df.collect()
    want = {x.id for x in rows if x.w is not None and any(y.key == x.key and y.w is not None and y.w != x.w for y in rows)}
    assert {x.id for x in r.exists_other(df, "key", "w").collect()} == want


def test_auc_equals_pairs(spark):
    rnd = random.Random(9)
    rows = [(rnd.randrange(2), round(rnd.random(), 1)) for _ in range(400)]
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    want = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))
    assert an.auc(spark.createDataFrame(rows, "y int, s double"), "y", "s").first()[0] == pytest.approx(want, abs=1e-12)


def test_classifier_skips_bad_rows_and_scores(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice(["a", "b"]), float(rnd.randrange(100)), None) for _ in range(300)]
    df = spark.createDataFrame([(k, x, "yes" if x > 50 else "no") for k, x, _ in rows] + [("a", None, "yes"), ("a", 1.0, None)], "kind string, x double, y string")
    model = an.train_classifier(df, "y", ["kind"], ["x"])
    out = an.predict(model, df.drop("y").dropna())
    assert out.where("(x > 60 and predicted = 'no') or (x < 40 and predicted = 'yes')").count() == 0
    assert an.importance(model, df.dropna()).first().feature == "x"


def test_change_tables_after_apply(spark):
    current = spark.createDataFrame([(1, "2001", "t0"), (2, "2002", "t0")], "id int, year string, s string")
    history = current.withColumn("e", F.lit(None).cast("string"))
    changes = spark.createDataFrame([(1, "2024"), (9, "1999")], "id int, year string")
    h, c = cd.scd2_apply(history, current, changes, "id", "t1", "s", "e")
    assert sorted(map(tuple, c.collect())) == [(1, "2024", "t1"), (2, "2002", "t0")]
    assert sorted(map(tuple, h.collect()), key=str) == [(1, "2001", "t0", "t1"), (1, "2024", "t1", None), (2, "2002", "t0", None)]


def test_state_streams_append_what_a_batch_holds(spark, tmp_path):
    """Late changes, a restart and a retried number; a small batch writes little, whatever was there before."""
    schema = "k int, t bigint, action string, v string"
    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = cd.read_changes(spark, str(tmp_path / "in"), schema)
        cd.run_available(cd.stream_current_state(stream, str(tmp_path / "state"), str(tmp_path / "c1"), "k", "t", ["v"]))
        cd.run_available(cd.stream_scd2(stream, str(tmp_path / "log"), str(tmp_path / "c2")))
    size = lambda folder: sum(f.stat().st_size for f in (tmp_path / folder).rglob("*.parquet"))
    arrive([(k, t, "UPDATE", f"{k}-{t}-" + "x" * 40) for k in range(400) for t in range(10, 15)])
    whole = {f: size(f) for f in ("state", "log")}
    more = [(3, 20, "DELETE", "gone"), (3, 12, "UPDATE", "late"), (5, 14, "UPDATE", "zz"), (7, 1, "INSERT", "first"), (999, 5, "INSERT", "new")]
    arrive(more)
    assert all(size(f) - whole[f] < whole[f] / 4 + 8000 for f in whole)
    state = {r.k: r.v for r in cd.kept_state(spark, str(tmp_path / "state"), spark.createDataFrame([], schema).schema, "k").collect()}
    assert len(state) == 401 and (state[3], state[5], state[999]) == ("gone", "zz", "new") and state[7].startswith("7-14")
    log = spark.read.schema(schema).parquet(str(tmp_path / "in"))
    got = cd.kept_history(spark, str(tmp_path / "log"), log.schema, "k", "t", "v", 4)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, cd.scd2_history(log, "k", "t", "v", 1000).collect()), key=str)
    of_3 = cd.kept_history(spark, str(tmp_path / "log"), log.schema, "k", "t", "v", 4, only="k = 3")
    assert sorted((r.version, r.valid_to or 99) for r in of_3.collect()) == [(1, 11), (2, 12), (4, 12), (4, 13), (5, 14), (6, 20), (7, 99)]
    assert "EqualTo(k,3)" in plan(of_3)
    assert not (tmp_path / "state" / "marker").exists()


def as_run(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_changes_are_read_once(spark, tmp_path):
    path = str(tmp_path / "log")
    spark.range(3000).select((F.col("id") % 50).alias("k"), F.col("id").alias("t"), F.lit("UPDATE").alias("action"), F.col("id").cast("string").alias("v")).write.parquet(path)
    log = spark.read.parquet(path)
    for df in (cd.scd2_history(log, "k", "t", "v", 500), cd.latest(log, "k", "t"), cd.current_state(log, "k", "t")):
        text = as_run(df)
        assert text.count("FileScan parquet") == 1, text


def test_ends_of_partition_equal_whole_frame(spark, skewed):
    w = W.partitionBy("key").orderBy("t", "id").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    want = skewed.select("id", F.first_value("id").over(w), F.last_value("id").over(w))
    got = r.ends_of_partition(skewed, "key", ["t", "id"], "id", "a", "b").select("id", "a", "b")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


# ---- plans --------------------------------------------------------------------

def test_filters_and_columns_reach_the_scan(spark):
    t = derived_tables(spark, FOLDER)
    text = plan(QUERIES["q03"](t))
    assert "i_manufact_id,540" in text.replace(" ", "") and "PushedFilters" in text
    assert "ss_net_profit" not in text.split("== Physical Plan ==")[1]


def test_top_k_does_not_sort_everything(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["q03"](derived_tables(spark, FOLDER)))


def test_rank_filter_limits_groups_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(QUERIES["q67"](derived_tables(spark, FOLDER)))


def test_no_pairing_of_whole_tables(spark):
    t = derived_tables(spark, FOLDER)
    for name in ("q04", "q10", "q16", "q35", "q64", "q69", "q72", "q95"):
        text = plan(QUERIES[name](t)).split("== Physical Plan ==")[1]
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name


def test_outer_join_with_filtered_side_becomes_inner(spark):
    s = Source(spark, FOLDER)
    df = r.left_join(s.orders, s.lineitem, ("o_orderkey", "l_orderkey")).where("l_quantity > 45")
    assert "LeftOuter" not in plan(df).split("== Optimized Logical Plan ==")[1]


def test_lookup_predicate_is_pushed(spark, tmp_path):
    s = Source(spark, FOLDER)
    table = layout.build_lookup(s.orders, ["o_orderdate"], ["o_custkey"], str(tmp_path / "t"), files=4)
    text = plan(layout.lookup(table, o_custkey=7))
    assert "EqualTo(o_custkey,7)" in text


def test_published_variants_run(spark):
    """Aggregates, null columns and output columns that other published runs use."""
    t = derived_tables(spark, FOLDER)
    assert QUERIES["q29"](t, agg=F.max).columns == QUERIES["q29"](t).columns
    assert QUERIES["q74"](t, agg=F.max).limit(1).count() == 1
    assert QUERIES["q44"](t, store=3, null_column="ss_customer_sk").count() > 0
    assert QUERIES["q76"](t, nulls=(("store", "ss_customer_sk"), ("web", "ws_bill_customer_sk"), ("catalog", "cs_bill_customer_sk"))).count() > 0
    assert "customer_birth_country" in QUERIES["q11"](t, columns=("customer_id", "customer_birth_country")).columns
    assert QUERIES["q47"](t, columns=("i_category", "i_brand")).columns[:2] == ["i_category", "i_brand"]
    assert QUERIES["q78"](t, columns=("ss_sold_year",)).count() > 0
    assert QUERIES["q09"](t, above="ss_ext_sales_price").count() == 1
    assert QUERIES["q31"](t, order="store_q2_q3_increase").count() == QUERIES["q31"](t).count()
    assert "stddev_samp3_dep_count" in QUERIES["q35"](t, aggs=("max", "stddev_samp", "stddev_samp")).columns
    assert QUERIES["q45"](t, by=("ca_zip", "ca_state")).columns == ["ca_zip", "ca_state", "sum_sales"]
    assert QUERIES["q47"](t, then="avg_monthly_sales").count() > 0
    assert QUERIES["q66"](t, web_price="ws_sales_price", web_net="ws_net_profit").count() > 0


def test_run_times_are_summarised(spark):
    from millrace.plans.runner import run_pack, summarise

    timings = run_pack(spark, derived_tables(spark, FOLDER), ["q03", "q42"])
    row = summarise(timings).first()
    each = [x.seconds for x in timings.collect()]
    assert len(each) == 2 and row.total_seconds == pytest.approx(sum(each))
    assert row.geomean_seconds == pytest.approx((each[0] * each[1]) ** 0.5)


def test_a_run_takes_its_parameters_from_a_file(spark, tmp_path):
    from millrace.plans.runner import read_parameters, run_pack

    t = derived_tables(spark, FOLDER)
    zips = [r.ca_zip[:5] for r in t.customer_address.where("ca_zip is not null").limit(300).collect()]
    (tmp_path / "run.json").write_text(json.dumps({"q08": {"zips": zips, "least": 0}, "q03": {"limit": 5}}))
    assert run_pack(spark, t, ["q08", "q03"], str(tmp_path / "run.json")).count() == 2
    table = spark.createDataFrame([(z,) for z in zips], "z string")
    found = read_parameters(spark, str(tmp_path / "run.json"))
    assert QUERIES["q08"](t, **found["q08"]).collect() == QUERIES["q08"](t, zips=table, least=0).collect() and QUERIES["q08"](t).columns == ["s_store_name", "net_profit"]
    (tmp_path / "bad.json").write_text('{"q999": {}}')
    with pytest.raises(ValueError):
        read_parameters(spark, str(tmp_path / "bad.json"))


def test_facts_are_pruned_by_the_periods_of_a_calendar(spark):
    from millrace.plans.tables import derived_tables
    from millrace.plans.tpcds import common as c
    t = derived_tables(spark, "/root/testdata/sf0.001")
    df = c.sold(t, "ss", "d_year = 1998 and d_moy = 3").agg(F.count(F.lit(1)).alias("n"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    whole = t.store_sales.join(t.date_dim, F.expr("ss_sold_date_sk = d_date_sk")).where("d_year = 1998 and d_moy = 3").count()
    assert df.first().n == whole > 0


def test_q77_needs_no_product(spark):
    from millrace.plans.tables import derived_tables
    from millrace.plans.tpcds import QUERIES
    plan = QUERIES["q77"](derived_tables(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan


def test_reports_below_walks_down_and_ends_on_loops(spark):
    from millrace.operators import governance as gv
    df = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("d", "a"), ("x", "y")], "employee_id string, reports_to string")
    assert {r.employee for r in gv.reports_below(df, "A").collect()} == {"a", "b", "c", "d"}
    assert gv.reports_below(df, "nobody").count() == 0
