"""Global order without one task, grids of long spans, closure by doubling, the one-pass model."""

import math
import random
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import analytics as an
from millrace.operators import governance as gv
from millrace.operators import relational as r
from millrace.operators.ordered import numbered, running_total


def as_run(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_numbers_and_totals_over_the_whole_table(spark):
    rnd = random.Random(2)
    rows = [(i, rnd.choice([None, 5, 5, 5, rnd.randrange(1000)]), rnd.choice([None, 1, 2, -3])) for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, k int, v int").repartition(7)
    got = numbered(df, "k", "id").collect()
    want = sorted(rows, key=lambda x: (x[1] is not None, x[1] or 0, x[0]))
    assert [(x.id, x.k) for x in sorted(got, key=lambda x: x.row_number)] == [x[:2] for x in want] and sorted(x.row_number for x in got) == list(range(1, 3001))
    total, sums = None, {}
    for i, _, v in want:
        total = total if v is None else (total or 0) + v
        sums[i] = total
    assert {x.id: x.running_total for x in running_total(df, "v", "k", "id").collect()} == sums
    down = numbered(df, F.col("k").desc_nulls_last(), name="n").collect()
    ranks = [x.k for x in sorted(down, key=lambda x: x.n)]
    assert ranks[:-1] == sorted(ranks[:-1], key=lambda k: (k is None, -(k or 0))) or ranks == sorted(ranks, key=lambda k: (k is None, -(k or 0)))
    assert numbered(df.limit(0), "k").count() == 0


def test_one_value_is_split_and_no_task_sees_all(spark):
    df = spark.range(20000).select(F.col("id"), F.lit(1).alias("same"))
    out = numbered(df.repartition(4), "same")
    rows = out.groupBy(F.floor((F.col("row_number") - 1) / 1000).alias("block")).agg(F.count(F.lit(1)).alias("n")).collect()
    assert len(rows) == 20 and all(x.n == 1000 for x in rows)
    text = as_run(running_total(df, "same", "id"))
    for line in text.split("Exchange SinglePartition")[1:]:
        assert "HashAggregate" in line.split("\n")[1] or "HashAggregate" in line.split("\n")[2]  # a row per range


def test_auc_of_skewed_scores_equals_pairs(spark):
    rnd = random.Random(11)
    rows = [(rnd.randrange(2), rnd.choice([0.0, rnd.random() * 1e-9, 1e6])) for _ in range(500)]
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    want = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))
    assert an.auc(spark.createDataFrame(rows, "y int, s double"), "y", "s").first()[0] == pytest.approx(want, abs=1e-12)


def test_a_span_of_any_length_is_put_in_two_cells(spark):
    rnd = random.Random(5)
    ev = [(i, rnd.choice("ab"), rnd.randrange(-10**9, 10**9)) for i in range(400)]
    sp = [(i, rnd.choice("ab"), s, s + rnd.choice([0, 1, 3599, 3600, 3601, 86400, 10**7, 10**8 * 7])) for i, s in enumerate(rnd.choice([x[2] for x in ev]) - rnd.choice([0, 1, 3600]) for _ in range(60))]
    sp += [(90, "a", 10, 5), (91, "a", None, 5), (92, "a", 5, None)]
    e = spark.createDataFrame(ev, "id int, k string, s bigint").select("id", "k", F.timestamp_seconds("s").alias("ts"))
    s = spark.createDataFrame(sp, "sid int, sk string, a bigint, b bigint").select("sid", "sk", F.timestamp_seconds("a").alias("a"), F.timestamp_seconds("b").alias("b"))
    for closed in (True, False):
        got = sorted((x.id, x.sid) for x in r.interval_join(e, s, ("k", "sk"), "ts", "a", "b", closed=closed).collect())
        assert got == sorted((i, j) for i, k, t in ev for j, q, a, b in sp if k == q and a is not None and b is not None and a <= t and (t <= b if closed else t < b))
    years = spark.sql("select 1 as sk, timestamp'1990-01-01' as a, timestamp'2015-01-01' as b")
    one = spark.sql("select 1 as k, timestamp'2000-01-01' as ts")
    out = r.interval_join(one, years, ("k", "sk"), "ts", "a", "b")
    assert out.count() == 1
    generated = [line for line in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Generate explode" in line]
    assert len(generated) == 1 and "sequence" not in generated[0]


def test_closure_doubles(spark, monkeypatch):
    written = []
    keep = gv.save
    monkeypatch.setattr(gv, "save", lambda df, path: written.append(path) or keep(df, path))
    chain = spark.range(1, 1001).select(F.col("id").cast("string").alias("employee_id"), (F.col("id") - 1).cast("string").alias("reports_to"))
    out = gv.reports_closure(chain)
    assert out.count() == 1000 * 1001 // 2 and out.distinct().count() == 1000 * 1001 // 2
    assert len([p for p in written if "/added-" in p]) <= 12
    rnd = random.Random(3)
    edges = [(str(rnd.randrange(25)), str(rnd.randrange(25))) for _ in range(40)] + [("x", None), (None, "y"), ("self", "self")]
    reach = {(a, b) for a, b in edges if a and b}
    while True:
        more = {(a, d) for a, b in reach for c, d in reach if b == c} - reach
        if not more:
            break
        reach |= more
    got = [(x.employee, x.manager) for x in gv.reports_closure(spark.createDataFrame(edges, "employee_id string, reports_to string")).collect()]
    assert sorted(got) == sorted(reach)
    assert gv.reports_closure(spark.createDataFrame([], "employee_id string, reports_to string")).count() == 0


def days(n, f, start=date(2024, 1, 1)):
    return [(start + timedelta(i), f(i)) for i in range(n)]


def test_model_equals_least_squares(spark):
    rnd = random.Random(8)
    rows = [("s", d, 3.0 * i + [10, -4, 7, 0, 2, -9, 5][d.weekday()] + rnd.gauss(0, 2)) for i, (d, _) in enumerate(days(80, lambda i: 0)) if i % 11]
    daily = spark.createDataFrame(rows, "series string, day date, y double")
    until = date(2024, 3, 1)
    train = [x for x in rows if x[1] <= until]
    design = lambda d: [(d - date(1970, 1, 1)).days - 19700.0] + [float(d.weekday() == k) for k in range(7)]
    a, y = np.array([design(d) for _, d, _ in train]), np.array([v for _, _, v in train])
    beta = np.linalg.lstsq(a, y, rcond=None)[0]
    sigma = math.sqrt(((y - a @ beta) ** 2).sum() / (len(train) - 8))
    inverse = np.linalg.inv(a.T @ a)
    got = {x.ts: x for x in an.anomalies(daily, str(until), z=2.0).collect()}
    other = {x.ts: x for x in an.detect(an.fit_daily(daily.where(F.col("day") <= F.lit(until))), daily.where(F.col("day") > F.lit(until)), z=2.0).collect()}
    assert got.keys() == other.keys() == {d for _, d, _ in rows if d > until}
    for d, x in got.items():
        at = np.array(design(d))
        wide = 2.0 * sigma * math.sqrt(1 + at @ inverse @ at)
        for one in (x, other[d]):
            assert one.forecast == pytest.approx(at @ beta, abs=1e-6) and one.upper_bound - one.forecast == pytest.approx(wide, abs=1e-6)
    ordered = [got[d].upper_bound - got[d].lower_bound for d in sorted(got)]
    assert ordered[-1] > ordered[0]


def test_model_of_few_days_and_unseen_weekdays(spark):
    rows = [("few", date(2024, 1, 1), 5.0), ("few", date(2024, 1, 20), 7.0), ("none", date(2024, 1, 20), 1.0)]
    rows += [("mondays", date(2024, 1, 1) + timedelta(7 * i), float(i)) for i in range(2)] + [("mondays", date(2024, 1, 16), 3.0)]
    got = {x.series: x for x in an.anomalies(spark.createDataFrame(rows, "series string, day date, y double"), "2024-01-10").collect()}
    assert got.keys() == {"few", "mondays"} and got["few"].forecast == 5.0 and got["few"].is_anomaly is None
    assert got["mondays"].forecast == pytest.approx(0.5 + (1 / 7) * 11.5)


def test_one_scan_of_the_days(spark, tmp_path):
    spark.range(2000).select(F.col("id").cast("double").alias("value"), F.expr("timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, cast(id % 30 as int))").alias("ts"), (F.col("id") % 3).cast("string").alias("kind")).write.parquet(str(tmp_path / "e"))
    daily = an.daily_totals(spark.read.parquet(str(tmp_path / "e")), "ts", "value", "kind")
    out = an.anomalies(daily, "2024-01-21")
    for df in (out, an.alerts(out, ["2024-01-01", "2024-02-01"])):
        assert as_run(df).count("FileScan parquet") == 1


def test_a_column_of_very_many_values_trains(spark):
    df = spark.range(30000).select(F.concat(F.lit("v"), F.col("id")).alias("many"), (F.col("id") % 100 / 100).alias("x"), F.when(F.col("id") % 100 > 50, "yes").otherwise("no").alias("y"))
    model = an.train_classifier(df, "y", ["many"], ["x"], hashed=64)
    assert not any(getattr(s, "labels", None) and len(s.labels) > 2 for s in model.stages)
    new = spark.createDataFrame([("never seen", 0.95), (None, 0.05)], "many string, x double")
    assert [x.predicted for x in an.predict(model, new).orderBy("x").collect()] == ["no", "yes"]
    assert [x.feature for x in an.importance(model, df).collect()] == ["x", "many"]
