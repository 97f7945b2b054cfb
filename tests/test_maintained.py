"""Change feeds of rewritten tables and summaries kept from lots."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import summaries as sm
from millrace.streaming import snapshots as sn

SCHEMA = "k int, v string, x double"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_difference_and_replay_of_bags(spark):
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", None), (3, "c", 3.0), (3, "c", 3.0), (None, None, None), (5, "e", 5.0)], SCHEMA)
    new = spark.createDataFrame([(1, "a", 1.5), (2, "b", None), (3, "c", 3.0), (None, None, 0.0), (6, "f", 6.0), (6, "f", 6.0)], SCHEMA)
    feed = sn.difference(old, new, ["k"])
    assert rows_of(feed) == sorted([(1, "a", 1.0, "DELETE", True), (1, "a", 1.5, "INSERT", True), (3, "c", 3.0, "DELETE", False), (None, None, None, "DELETE", True), (None, None, 0.0, "INSERT", True),
                                    (5, "e", 5.0, "DELETE", False), (6, "f", 6.0, "INSERT", False), (6, "f", 6.0, "INSERT", False)], key=str)
    assert rows_of(sn.replayed(old, feed)) == rows_of(new)
    assert sn.difference(old, old, ["k"]).count() == 0 and rows_of(sn.replayed(old.limit(0), sn.difference(old.limit(0), new, ["k"]))) == rows_of(new)
    with pytest.raises(Exception, match="does not have"):
        sn.replayed(new, feed).collect()


def test_a_reader_takes_each_change_once(spark, tmp_path):
    root, offset, seen = str(tmp_path / "t"), str(tmp_path / "offset"), []
    table = lambda ids: spark.createDataFrame([(i, str(i), 0.0) for i in ids], SCHEMA)
    take = lambda: sn.consume(spark, root, offset, ["k"], lambda feed, version: seen.append((version, sorted((r.k, r.action) for r in feed.collect()))))
    sn.write_version(table([1, 2]), root, 0)
    assert not take() and not take() and not seen
    sn.write_version(table([2, 3]), root, 1)
    sn.write_version(table([3, 4]), root, 2)
    def fails(feed, version):
        raise RuntimeError("apply failed")
    with pytest.raises(RuntimeError):
        sn.consume(spark, root, offset, ["k"], fails)
    assert take() and not take()
    sn.write_version(table([]), root, 10)
    assert take() and sn.newest_version(spark, root) == 10
    assert seen == [(2, [(1, "DELETE"), (2, "DELETE"), (3, "INSERT"), (4, "INSERT")]), (10, [(3, "DELETE"), (4, "DELETE")])]


WHAT = sm.Measures(("g",), sums=("x",), lows=("x", "d"), highs=("x",), distinct=("d",))


def direct(df):
    return df.groupBy("g").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("x").alias("sum_x"), F.min("x").alias("min_x"), F.min("d").alias("min_d"), F.max("x").alias("max_x"), F.count_distinct("d").alias("n_distinct_d"))


def test_summary_follows_lots_and_deletions(spark, tmp_path):
    rnd = random.Random(4)
    path, base, next_id = str(tmp_path / "s"), {}, 0
    frame = lambda rows: spark.createDataFrame(rows, "id int, g string, x decimal(10,2), d date")
    from datetime import date
    from decimal import Decimal
    for lot in range(5):
        new = {next_id + i: (next_id + i, rnd.choice(["hot", "hot", "a", "b", None, f"g{lot}"]), None if rnd.random() < 0.2 else Decimal(rnd.randrange(-50, 50)), date(2024, 1, rnd.randrange(1, 29))) for i in range(40)}
        next_id += 40
        gone = {i: r for i, r in base.items() if rnd.random() < 0.35 or r[1] == f"g{lot - 1}"}
        base = {i: r for i, r in {**base, **new}.items() if i not in gone}
        changes = frame([*new.values()]).withColumn("action", F.lit("INSERT")).unionByName(frame([*gone.values()]).withColumn("action", F.lit("DELETE")))
        for _ in range(2):  # folded again after a failure
            sm.fold(changes, WHAT, path, lot, frame([*base.values()]))
        assert rows_of(sm.current(spark, WHAT, path)) == rows_of(direct(frame([*base.values()])))
    late = [(9000, "hot", Decimal(999), date(2023, 1, 1)), (9001, "new", None, None)]
    both = frame([*base.values(), *late])
    assert rows_of(sm.current(spark, WHAT, path, frame(late))) == rows_of(direct(both))
    assert rows_of(sm.current(spark, WHAT, path, frame(late), "g = 'hot'")) == rows_of(direct(both.where("g = 'hot'")))
    with pytest.raises(ValueError):
        sm.fold(changes, WHAT, path, 9)
    with pytest.raises(ValueError):
        sm.current(spark, WHAT, path, changes)


def test_only_the_pending_part_of_the_base_is_read(spark, tmp_path):
    base = str(tmp_path / "base")
    rows = spark.range(100).select(F.col("id"), (F.col("id") % 3).cast("string").alias("g"), F.col("id").cast("decimal(10,2)").alias("x"), F.to_date(F.lit("2024-01-01")).alias("d"), (F.col("id") % 5).alias("lot"))
    rows.write.partitionBy("lot").parquet(base)
    read = spark.read.parquet(base)
    for lot in range(4):
        sm.fold(read.where(f"lot = {lot}"), WHAT, str(tmp_path / "s"), lot)
    df = sm.current(spark, WHAT, str(tmp_path / "s"), read.where("lot = 4"), "g = '1'")
    text = df._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in text.splitlines() if "FileScan" in line and f"{base}]" in line]
    assert scans and all("(lot#" in line and "= 4)" in line and "EqualTo(g,1)" in line for line in scans)
    assert rows_of(df) == rows_of(direct(read.where("g = '1'")))
