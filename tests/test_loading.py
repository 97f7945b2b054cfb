"""Loads and unloads that must not lose or guess anything."""

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.functions import semantics as m
from millrace.operators import layout
from millrace.sources import files
from millrace.streaming import changes as cd


def test_old_files_are_loaded(spark, tmp_path):
    """A file that arrives with an old modification time is loaded all the same."""
    source = tmp_path / "in"
    source.mkdir()
    seen = []
    for n, age in (("a", 0), ("b", 400), ("c", 0)):
        path = source / f"{n}.csv"
        path.write_text(f"{len(seen) + 1}\n")
        when = path.stat().st_mtime - age * 86400
        os.utime(path, (when, when))
        cd.copy_into(spark, str(source), str(tmp_path / "out"), str(tmp_path / "checkpoint"), "n int")
        seen.append({r.n for r in spark.read.parquet(str(tmp_path / "out")).collect()})
    assert seen == [{1}, {1, 2}, {1, 2, 3}]


def test_csv_round_trip_of_awkward_text(spark, tmp_path):
    values = ["a\nb", "  pad  ", "", None, 'say "x", twice', "\\", "tab\t", "é,漢"]
    df = spark.createDataFrame(list(enumerate(values)), "k bigint, v string")
    files.unload_csv(df, str(tmp_path / "x"))
    back = files.read_csv(spark, str(tmp_path / "x"), df.schema, header=True, multi_line=True, null_tokens=("\\N",))
    assert {r.k: r.v for r in back.collect()} == dict(enumerate(values))
    assert {r.n_rows for r in layout.round_trip(df, str(tmp_path / "y")).collect()} == {len(values)}


def test_padded_numbers_and_bad_values(spark, tmp_path):
    (tmp_path / "n.csv").write_text(" 12, 1.5\nx,2\n,3 \n")
    read = lambda how: files.read_csv(spark, str(tmp_path / "n.csv"), "a bigint, b double", on_error=how)
    assert {tuple(r) for r in read("null").collect()} == {(12, 1.5), (None, 2.0), (None, 3.0)}
    assert {tuple(r) for r in read("skip").collect()} == {(12, 1.5), (None, 3.0)}
    with pytest.raises(PySparkException, match="does not parse"):
        read("stop").collect()


def test_files_are_bounded_in_bytes(spark, tmp_path):
    df = spark.range(2000).select(F.col("id"), F.repeat(F.lit("x"), 50).alias("t")).coalesce(1)
    for unload in (files.unload_csv, files.unload_json):
        path = str(tmp_path / unload.__name__)
        unload(df, path, compression="none", bytes_per_file=20_000)
        sizes = [f.stat().st_size for f in os.scandir(path) if f.name.startswith("part-")]
        assert len(sizes) > 5 and max(sizes) <= 20_000


def test_repeated_keys_of_a_merge(spark):
    target = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "k int, v string, at int")
    new = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (3, "z", 1)], "k int, v string, at int")
    assert {tuple(r) for r in files.merge_rows(target, new, ["k"], "at").collect()} == {(1, "y", 2), (2, "b", 0), (3, "z", 1)}
    with pytest.raises(PySparkException, match="changed twice"):
        files.merge_rows(target, new, ["k"]).collect()


def test_repeated_keys_of_a_history(spark):
    current = spark.sql("select 1 as k, 'a' as v, date'2024-01-01' as record_start_time")
    history = current.withColumn("record_end_time", F.lit(None).cast("date"))
    new = spark.createDataFrame([(1, "x", 1), (1, "y", 2)], "k int, v string, at int")
    after, now = cd.scd2_apply(history, current, new, "k", "2024-05-01", order="at")
    assert [tuple(r)[:2] for r in now.collect()] == [(1, "y")]
    assert sorted((r.v, r.record_end_time is None) for r in after.collect()) == [("a", False), ("y", True)]


def test_standard_deviation_of_fractions(spark):
    row = spark.createDataFrame([(1.2,), (1.9,), (1.5,)], "x double").agg(m.sd("x").alias("s"), m.coefficient_of_variation(F.col("x").cast("decimal(4,1)")).alias("c")).first()
    assert row.s == 0.351188 and abs(row.c - 0.229036) < 1e-6


def test_new_source_files_change_the_mark(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    first = files.state_of(spark, path)
    assert files.state_of(spark, [path]) == first
    spark.range(2).write.mode("append").parquet(path)
    assert files.state_of(spark, path) != first


def test_uneven_rows_fill_files(spark, tmp_path):
    """One row of 400 KB among 2,000 short ones: files near the bound, none over it, no row lost."""
    wide = F.when(F.col("id") == 700, F.repeat(F.lit('y"'), 200_000)).when(F.col("id") % 500 == 0, F.repeat(F.lit("z"), 9_000)).otherwise(F.repeat(F.lit("x"), 50))
    df = spark.range(2000).select(F.col("id"), wide.alias("t")).coalesce(1)
    for unload in (files.unload_csv, files.unload_json):
        path = str(tmp_path / unload.__name__)
        unload(df, path, compression="none", bytes_per_file=1_000_000)
        sizes = [f.stat().st_size for f in os.scandir(path) if f.name.startswith("part-")]
        assert 2 <= len(sizes) <= 6 and max(sizes) <= 1_000_000
        unload(df, path, compression="none", bytes_per_file=30_000)
        sizes = sorted(f.stat().st_size for f in os.scandir(path) if f.name.startswith("part-"))
        assert sizes[-2] <= 30_000 < sizes[-1] and len(sizes) < 25
        back = files.read_csv(spark, path, df.schema, header=True) if unload is files.unload_csv else spark.read.schema(df.schema).json(path)
        assert back.agg(F.sum("id"), F.sum(F.length("t"))).first() == df.agg(F.sum("id"), F.sum(F.length("t"))).first()
    empty = str(tmp_path / "empty")
    files.unload_csv(df.limit(0), empty, bytes_per_file=100)
    assert files.read_csv(spark, empty, df.schema, header=True).count() == 0


SCHEMA = "n int, x double, t string"
LINES = ['1, 2.5 ,"a ""q"" b"', " 2 ,NULL,plain", "bad,1,t", "4,\\N,", "5,x,t", "6,7", "7,8,t,more", ',,"  "']


def load(spark, tmp_path, mode):
    (tmp_path / "in").mkdir(exist_ok=True)
    (tmp_path / "in" / "a.csv").write_text("\n".join(LINES) + "\n")
    cd.copy_into(spark, str(tmp_path / "in"), str(tmp_path / mode), str(tmp_path / f"c-{mode}"), SCHEMA, on_error=mode, null_tokens=("\\N", "NULL", ""))
    return sorted(map(tuple, cd.loaded(spark, str(tmp_path / mode)).collect()), key=str)


GOOD = [(1, 2.5, 'a "q" b'), (2, None, "plain"), (4, None, None), (None, None, "  ")]


def test_stream_load_leaves_out_or_reports_rows(spark, tmp_path):
    assert load(spark, tmp_path, "skip") == sorted(GOOD, key=str)
    assert load(spark, tmp_path, "report") == sorted(GOOD, key=str)
    bad = cd.rejects(spark, str(tmp_path / "report")).collect()
    assert {(r.row, r.reason) for r in bad} == {('{"n":"bad","x":"1","t":"t"}', "n: bad is no int"), ('{"n":"5","x":"x","t":"t"}', "x: x is no double"), ("6,7", "not the fields of the table"), ("7,8,t,more", "not the fields of the table")}
    assert all(r.file.endswith("in/a.csv") for r in bad)
    (tmp_path / "in" / "b.csv").write_text("9,9,late\nno,0,0\n")
    cd.copy_into(spark, str(tmp_path / "in"), str(tmp_path / "report"), str(tmp_path / "c-report"), SCHEMA, on_error="report", null_tokens=("\\N", "NULL", ""))
    assert cd.loaded(spark, str(tmp_path / "report")).count() == 5 and cd.rejects(spark, str(tmp_path / "report")).count() == 5
    assert (None, 1.0, "t") in load(spark, tmp_path, "null")


def test_stream_load_stops_and_goes_on_when_mended(spark, tmp_path):
    with pytest.raises(Exception, match="does not load"):
        load(spark, tmp_path, "stop")
    (tmp_path / "in" / "a.csv").write_text("1,2,t\n")
    assert not (tmp_path / "stop" / "_spark_metadata" / "0").exists()
    cd.copy_into(spark, str(tmp_path / "in"), str(tmp_path / "stop"), str(tmp_path / "c-again"), SCHEMA)
    assert [tuple(r) for r in cd.loaded(spark, str(tmp_path / "stop")).collect()] == [(1, 2.0, "t")]


def test_reporting_load_with_a_transformation(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("1,2,t\nx,2,t\n")
    cd.copy_into(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "c"), SCHEMA, transform=lambda d: d.select((F.col("n") + 1).alias("m")), on_error="report")
    assert [tuple(r) for r in cd.loaded(spark, str(tmp_path / "out")).collect()] == [(2,)] and cd.rejects(spark, str(tmp_path / "out")).count() == 1
