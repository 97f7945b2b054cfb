"""Summaries kept current from what changed: states of lots that merge, never the whole base.

A lot of new rows, or of changes with an ``action``, is reduced to one state per
key and appended.  An answer merges the states of all lots with one made of the rows that no lot holds yet,
so it reads summaries and the newest rows only.  Sums and counts take deletions as they come; where a deletion hits
the least or greatest value of a key, the state of that key alone is made anew from the base.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


class Measures(NamedTuple):
    """What a summary holds per key: sums (exact types, so that deletions leave no rest), least, greatest and numbers of different values."""

    keys: tuple[str, ...]
    sums: tuple[str, ...] = ()
    lows: tuple[str, ...] = ()
    highs: tuple[str, ...] = ()
    distinct: tuple[str, ...] = ()


def _sign(rows: DataFrame) -> Column:
    return F.when(F.col("action") == "DELETE", -1).otherwise(1) if "action" in rows.columns else F.lit(1)


def totals(rows: DataFrame, m: Measures) -> DataFrame:
    """One state per key of rows or changes, combined before it moves."""
    sign = _sign(rows)
    aggs = [F.sum(sign).alias("n_rows")]
    for c in m.sums:
        aggs += [F.sum(F.when(sign < 0, -F.col(c)).otherwise(F.col(c))).alias(f"sum_{c}"), F.sum(F.when(F.col(c).isNotNull(), sign)).alias(f"n_{c}")]
    aggs += [F.min(F.when(sign > 0, F.col(c))).alias(f"min_{c}") for c in m.lows] + [F.max(F.when(sign > 0, F.col(c))).alias(f"max_{c}") for c in m.highs]
    return rows.groupBy(*m.keys).agg(*aggs)


def values(rows: DataFrame, m: Measures) -> DataFrame:
    """How often each key has each value of the columns whose different values are counted."""
    each = F.inline(F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).cast("string").alias("value")) for c in m.distinct]))
    return rows.select(*m.keys, _sign(rows).alias("sign"), each).where("value is not null").groupBy(*m.keys, "measure", "value").agg(F.sum("sign").alias("n"))


def merged(states: DataFrame, m: Measures) -> DataFrame:
    """One state per key; a state that was made anew replaces those of its key before it."""
    since = F.max(F.when(F.col("whole"), F.col("lot"))).over(Window.partitionBy(*m.keys))
    live = states.withColumn("__since", since).where("__since is null or lot > __since or (lot = __since and whole)")
    aggs = [F.sum("n_rows").alias("n_rows")]
    for c in m.sums:
        aggs += [F.sum(f"sum_{c}").alias(f"sum_{c}"), F.sum(f"n_{c}").alias(f"n_{c}")]
    aggs += [F.min(f"min_{c}").alias(f"min_{c}") for c in m.lows] + [F.max(f"max_{c}").alias(f"max_{c}") for c in m.highs]
    return live.groupBy(*m.keys).agg(*aggs)


def _joined(a: DataFrame, b: DataFrame, m: Measures, how: str) -> DataFrame:
    """Join on the keys, NULL meeting NULL; the keys of ``b`` are called ``__`` and their name."""
    cond = F.lit(True)
    for k in m.keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return a.join(b, cond, how)


def _renamed(df: DataFrame, m: Measures) -> DataFrame:
    return df.withColumnsRenamed({k: f"__{k}" for k in m.keys})


def fold(rows: DataFrame, m: Measures, path: str, lot: int, base: DataFrame | None = None) -> None:
    """Add a lot to the summary; folding a number again replaces it.

    Changes with deletions need ``base``, the table as it is after them, if least or greatest values are kept.
    """
    spark = rows.sparkSession
    state = totals(rows, m).withColumn("whole", F.lit(False))
    if "action" in rows.columns and (m.lows or m.highs):
        if base is None:
            raise ValueError("least and greatest values can't follow deletions without the base")
        hit = _hit_keys(_states(spark, path, lot, state), rows.where("action = 'DELETE'"), m)
        fresh = _joined(hit.select(*[F.col(f"__{k}").alias(k) for k in m.keys]), _renamed(totals(_joined(base, hit, m, "left_semi"), m), m), m, "left")
        fresh = fresh.drop(*[f"__{k}" for k in m.keys]).fillna(0, ["n_rows"]).withColumn("whole", F.lit(True))
        state = _joined(state, hit, m, "left_anti").unionByName(fresh)
    state.write.mode("overwrite").parquet(f"{path}/totals/lot={lot}")
    if m.distinct:
        values(rows, m).write.mode("overwrite").parquet(f"{path}/values/lot={lot}")


def _states(spark: SparkSession, path: str, lot: int, state: DataFrame) -> DataFrame:
    """The states of all lots before one, and its own."""
    own = state.withColumn("lot", F.lit(lot))
    try:
        return spark.read.parquet(f"{path}/totals").where(F.col("lot") < lot).unionByName(own)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return own  # the first lot


def _hit_keys(states: DataFrame, gone: DataFrame, m: Measures) -> DataFrame:
    """Keys that lose a row as low as their least or as high as their greatest value."""
    before = merged(states, m)
    ends = gone.groupBy(*m.keys).agg(*[F.min(c).alias(f"gone_min_{c}") for c in m.lows], *[F.max(c).alias(f"gone_max_{c}") for c in m.highs])
    cond = F.lit(False)
    for c in m.lows:
        cond = cond | (F.col(f"gone_min_{c}") <= F.col(f"min_{c}"))
    for c in m.highs:
        cond = cond | (F.col(f"gone_max_{c}") >= F.col(f"max_{c}"))
    return _joined(before, _renamed(ends, m), m, "inner").where(cond).select(*[F.col(f"__{k}") for k in m.keys])


def current(spark: SparkSession, m: Measures, path: str, pending: DataFrame | None = None, predicate: str | None = None) -> DataFrame:
    """The summary with the rows of ``pending``, which no lot holds yet, put on top.

    ``predicate`` is about keys; it reaches the files of the states and of the pending rows.  Pending rows are
    insertions: fold a lot that deletes.
    """
    if pending is not None and "action" in pending.columns:
        raise ValueError("pending rows are insertions; fold changes first")
    keep = (lambda df: df.where(predicate)) if predicate else (lambda df: df)
    states = keep(spark.read.parquet(f"{path}/totals"))
    if pending is not None:
        states = states.unionByName(totals(keep(pending), m).withColumns({"whole": F.lit(False), "lot": F.lit(2**31 - 1)}))
    out = merged(states, m).where("n_rows > 0")
    out = out.select(*m.keys, "n_rows", *[F.when(F.col(f"n_{c}") > 0, F.col(f"sum_{c}")).alias(f"sum_{c}") for c in m.sums], *[f"min_{c}" for c in m.lows], *[f"max_{c}" for c in m.highs])
    if not m.distinct:
        return out
    kept = keep(spark.read.parquet(f"{path}/values")).drop("lot")
    kept = kept.unionByName(values(keep(pending), m)) if pending is not None else kept
    kept = kept.groupBy(*m.keys, "measure", "value").agg(F.sum("n").alias("n")).where("n > 0")
    counts = kept.groupBy(*m.keys).agg(*[F.count_if(F.col("measure") == c).alias(f"n_distinct_{c}") for c in m.distinct])
    out = _joined(out, _renamed(counts, m), m, "left").drop(*[f"__{k}" for k in m.keys])
    return out.fillna(0, [f"n_distinct_{c}" for c in m.distinct])
