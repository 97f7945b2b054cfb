"""Joins, aggregates, windows, sorts and set operations as DataFrame functions.

No join is hinted: Spark broadcasts a side when its size is below
``spark.sql.autoBroadcastJoinThreshold`` (checked again at run time by adaptive
execution) and sort-merges with skew splitting beyond it.  The only hinted
broadcasts are sides whose row count is bounded by an argument.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.semantics import _col, asc, mean, tie_broken


# ---- joins -----------------------------------------------------------------

def on(*pairs) -> Column:
    """Equality of column pairs: ``on(("a", "b"), ("c", "d"))``."""
    return reduce(lambda x, y: x & y, [F.col(a) == F.col(b) for a, b in pairs])


def star_join(fact: DataFrame, *dims) -> DataFrame:
    """Join ``fact`` to ``(dimension, fact_key, dimension_key[, how])`` in the given order."""
    for dim, fk, pk, *how in dims:
        fact = fact.join(dim, F.col(fk) == F.col(pk), how[0] if how else "inner")
    return fact


def prefixed(df: DataFrame, prefix: str) -> DataFrame:
    """Role-play a table: every column renamed with a prefix."""
    return df.select([F.col(f"`{c}`").alias(prefix + c) for c in df.columns])


def left_join(a, b, *pairs):
    return a.join(b, on(*pairs), "left")


def full_join(a: DataFrame, b: DataFrame, keys) -> DataFrame:
    """Full outer join with the keys coalesced into one column each."""
    return a.join(b, list(keys), "full")


def _once(b, pairs):
    return b.select(*dict.fromkeys(k for _, k in pairs)).distinct()


def semi_join(a, b, *pairs, many: bool = False):
    """Rows of ``a`` with a partner in ``b``.

    ``many`` is for a large ``b`` that repeats its keys: they are made distinct
    map-side first, so a key that owns a third of ``b`` is one row in the join.
    """
    return a.join(_once(b, pairs) if many else b, on(*pairs), "left_semi")


def anti_join(a, b, *pairs, many: bool = False):
    """Rows of ``a`` without a partner in ``b``; ``many`` as for ``semi_join``."""
    return a.join(_once(b, pairs) if many else b, on(*pairs), "left_anti")


def exists_any(a: DataFrame, others, key: str) -> DataFrame:
    """Rows of ``a`` whose ``key`` occurs in at least one of ``(frame, column)``.

    The candidate keys are united and made distinct, so one semi join answers
    the disjunction.
    """
    keys = reduce(DataFrame.union, [o.select(F.col(c).alias("__key")) for o, c in others]).distinct()
    return a.join(keys, F.col(key) == F.col("__key"), "left_semi")


def exists_other(df: DataFrame, key: str, attr: str) -> DataFrame:
    """Rows for which another row has the same ``key`` and a different ``attr``.

    A key qualifies when its smallest and largest ``attr`` differ; that needs
    one aggregate with map-side combining instead of pairing rows in a group.
    Rows with a NULL ``attr`` differ from nothing.
    """
    many = df.groupBy(F.col(key).alias("__key")).agg(F.min(attr).alias("__lo"), F.max(attr).alias("__hi")) \
        .where("__lo <> __hi").select("__key")
    return df.where(F.col(attr).isNotNull()).join(many, F.col(key) == F.col("__key"), "left_semi")


def cross_rows(*frames: DataFrame) -> DataFrame:
    """Put one-row frames (global aggregates) side by side."""
    return reduce(lambda a, b: a.crossJoin(b), frames)


def shifted_self_join(df: DataFrame, keys, shift: str, delta: int, suffix: str = "_next") -> DataFrame:
    """Pair each row with the row of the same ``keys`` whose ``shift`` is ``delta`` larger."""
    later = df.select([F.col(c).alias(c + suffix) for c in df.columns])
    cond = F.col(shift) + delta == F.col(shift + suffix)
    for k in keys:
        cond = cond & (F.col(k) == F.col(k + suffix))
    return df.join(later, cond)


def residual_join(a, b, pairs, residual, how="inner"):
    """Equi join plus a non-equality condition."""
    return a.join(b, on(*pairs) & (F.expr(residual) if isinstance(residual, str) else residual), how)


#: Grids of an interval join: the widest cells are four to this power times the finest, some 30,000 years for an hour.
_GRIDS = 14


def interval_join(events: DataFrame, spans: DataFrame, key, ts: str, start: str, end: str,
                  bucket_seconds: int = 3600, closed: bool = True) -> DataFrame:
    """Each event with every span of the same key that contains it.

    A span goes to the grid whose cells are at least as long as it is, each grid
    four times as wide as the one before, so it is put in two cells at most however long it is.  An
    event is looked up once in every grid that has spans, a few for spans of any lengths.  The join key is
    (key, grid, cell), which spreads a busy key over time.  ``closed`` keeps the end point inside.
    """
    finest = bucket_seconds * 1_000_000
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    width = F.element_at(F.array(*[F.lit(finest * 4**g) for g in range(_GRIDS)]), F.col("__g") + 1)
    cell = lambda at: F.floor((at - F.pmod(at, width)) / width).cast("bigint")
    length = micros(end) - micros(start)
    grid = F.size(F.filter(F.array(*[F.lit(finest * 4**g) for g in range(_GRIDS - 1)]), lambda w: w < length))
    right = spans.where(F.col(start).isNotNull() & F.col(end).isNotNull() & (length >= 0)).withColumn("__g", grid)
    grids = right.select(F.col("__g").alias("__g")).distinct()  # _GRIDS rows at most
    right = right.withColumn("__b2", F.explode(F.array_distinct(F.array(cell(micros(start)), cell(micros(end)))))).withColumnRenamed("__g", "__g2")
    left = events.crossJoin(F.broadcast(grids)).withColumn("__b", cell(micros(ts)))
    keys = [key] if isinstance(key, tuple) else list(key)
    upper = F.col(ts) <= F.col(end) if closed else F.col(ts) < F.col(end)
    cond = on(*keys, ("__g", "__g2"), ("__b", "__b2")) & (F.col(ts) >= F.col(start)) & upper
    return left.join(right, cond).drop("__b", "__b2", "__g", "__g2")


def above_group_avg(df: DataFrame, keys, value: str, factor: float) -> DataFrame:
    """Rows whose value exceeds ``factor`` times the average of their group.

    The average is a separate aggregate joined back, so a hot group is combined
    before it is shuffled and never sits in one window partition.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    avg = df.groupBy([F.col(k).alias("__" + k) for k in keys]).agg((mean(value) * factor).alias("__limit"))
    out = df.join(avg, on(*[(k, "__" + k) for k in keys])).where(F.col(value).cast("double") > F.col("__limit"))
    return out.drop("__limit", *["__" + k for k in keys])


def count_matching(df: DataFrame, key: str, predicate) -> DataFrame:
    """Number of rows per key that satisfy the predicate (zero included)."""
    return df.groupBy(key).agg(F.count_if(predicate).alias("n_matching"))


def entitled(df: DataFrame, mapping: DataFrame, key: str, mapping_key: str, owner: str, account: str) -> DataFrame:
    """Rows whose key the mapping table grants to ``account``."""
    granted = mapping.where(F.col(owner) == account).select(F.col(mapping_key).alias("__key")).distinct()
    return df.join(granted, F.col(key) == F.col("__key"), "left_semi")


# ---- aggregates ------------------------------------------------------------

def pivot_sum(on_col: str, values: dict, value) -> list[Column]:
    """One conditional sum per ``{output name: value of on_col}``."""
    return [F.sum(F.when(F.col(on_col) == v, _col(value))).alias(n) for n, v in values.items()]


def lag_buckets(days, names=("d30", "d60", "d90", "d120", "over")) -> list[Column]:
    """Counts of a day difference in 30-day steps up to 120 and beyond."""
    days = F.expr(days) if isinstance(days, str) else days
    edges = [None, 30, 60, 90, 120, None]
    out = []
    for name, lo, hi in zip(names, edges, edges[1:]):
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (days > lo)
        if hi is not None:
            cond = cond & (days <= hi)
        out.append(F.sum(F.when(cond, 1).otherwise(0)).alias(name))
    return out


def grouping_level(*keys) -> Column:
    return reduce(lambda a, b: a + b, [F.grouping(k) for k in keys])


def rollup(df: DataFrame, keys, aggs, merge, extra=()) -> DataFrame:
    """ROLLUP that first aggregates to the finest group.

    Spark's Expand repeats every input row once per level; feeding it the finest
    groups instead keeps that factor off the detail rows.  ``aggs`` builds the
    finest level, ``merge`` combines it.
    """
    finest = df.groupBy(*keys).agg(*aggs)
    return finest.rollup(*keys).agg(*merge, *extra)


def ratio_to_report(df: DataFrame, value: str, keys=(), name: str = "share", scale: float = 1.0) -> DataFrame:
    """``scale * value / total of value`` over the groups given by ``keys``.

    Totals come from an aggregate joined back, so a group that holds a third of
    the rows is combined map-side rather than gathered in one window partition.
    """
    keys = list(keys)
    total = df.groupBy([F.col(k).alias("__" + k) for k in keys]).agg(F.sum(value).cast("double").alias("__total"))
    if keys:
        cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col("__" + k)) for k in keys])
        joined = df.join(total, cond)
    else:
        joined = df.crossJoin(total)
    share = F.try_divide(F.col(value).cast("double") * scale, F.col("__total"))
    return joined.withColumn(name, share).drop("__total", *["__" + k for k in keys])


def segments(value, width: int) -> Column:
    """Histogram segment number, rounded to the nearest."""
    from millrace.functions.semantics import round_to_int
    return round_to_int(_col(value) / width)


def run_summary(timings: DataFrame, seconds: str = "seconds") -> DataFrame:
    """Total and geometric mean of run times."""
    return timings.agg(F.sum(seconds).alias("total_seconds"),
                       F.exp(F.avg(F.ln(seconds))).alias("geomean_seconds"))


def collect_objects(df: DataFrame, keys, children, name: str) -> DataFrame:
    """Nest the child columns of each group as a sorted array of objects."""
    return df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*children))).alias(name))


# ---- windows ---------------------------------------------------------------

def rank_top(df: DataFrame, value: str, k: int, descending: bool = False, name: str = "rnk") -> DataFrame:
    """Rows whose global ``rank()`` by ``value`` is at most ``k``, ties kept.

    The k extreme rows settle every rank up to k, so the ranking runs over k rows
    and is then joined to the input by value; the input is never sorted whole.
    """
    key = F.col(value).desc() if descending else F.col(value).asc()
    extremes = df.where(F.col(value).isNotNull()).orderBy(key).limit(k).select(F.col(value).alias("__v"))
    ranks = extremes.select("__v", F.rank().over(Window.orderBy(F.col("__v").desc() if descending else F.col("__v"))).alias(name)).distinct()
    return df.join(F.broadcast(ranks), F.col(value) == F.col("__v")).drop("__v")


def rank_in(df: DataFrame, partition, order, name: str = "rnk", keep: int | None = None) -> DataFrame:
    """``rank()`` per partition.  With ``keep`` Spark limits each group before the shuffle."""
    out = df.withColumn(name, F.rank().over(Window.partitionBy(*partition).orderBy(*order)))
    return out if keep is None else out.where(F.col(name) <= keep)


def rank_in_hierarchy(df: DataFrame, level: str, parent: str, leaf_flag: str, order, name: str) -> DataFrame:
    """Rank of rollup rows among the rows of the same level and parent."""
    group = F.when(F.col(leaf_flag) == 0, F.col(parent))
    return df.withColumn(name, F.rank().over(Window.partitionBy(level, group).orderBy(order)))


def running(fn, value, partition, order) -> Column:
    from millrace.functions.semantics import running_to_here
    return fn(value).over(running_to_here(partition, order))


def ends_of_partition(df: DataFrame, partition: str, order, value: str, first: str, last: str) -> DataFrame:
    """First and last value of each partition beside every row.

    The same as ``first_value``/``last_value`` over the whole partition, but the
    two values come from an aggregate joined back, so no partition is buffered.
    ``order`` must be unique within a partition.
    """
    key = F.struct(*order)
    ends = df.groupBy(F.col(partition).alias("__p")).agg(F.min_by(value, key).alias(first), F.max_by(value, key).alias(last))
    return df.join(ends, F.col(partition).eqNullSafe(F.col("__p"))).drop("__p")


def qualify(df: DataFrame, column: Column, predicate: str, name: str = "__q") -> DataFrame:
    """Filter on a window expression; the predicate names it ``q``."""
    return df.withColumn("q", column).where(predicate).drop("q")


# ---- sort, limit, sets -----------------------------------------------------

def top_n(df: DataFrame, n: int | None, *keys) -> DataFrame:
    """``order by .. limit n`` with NULL largest and the remaining columns as tie-breakers."""
    if n is None:
        return df
    return df.orderBy(*tie_broken(df, [asc(k) if isinstance(k, str) else k for k in keys])).limit(n)


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def union_distinct(*frames: DataFrame) -> DataFrame:
    return union_all(*frames).distinct()


def intersect(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.intersect, frames)


def except_(first: DataFrame, *rest: DataFrame) -> DataFrame:
    return reduce(DataFrame.subtract, rest, first)


def reconcile(frames: dict[str, DataFrame]) -> DataFrame:
    """Row count of each named copy."""
    return union_all(*[f.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("location"), "n_rows")
                       for n, f in frames.items()])


def clustered_write(df: DataFrame, columns, path: str, files: int | None = None, bloom=()) -> None:
    """Write range-partitioned and sorted, so row-group statistics prune on ``columns``.

    ``bloom`` columns also get a Parquet bloom filter for point lookups.
    """
    cols = [F.col(c) for c in columns]
    ranged = df.repartitionByRange(files, *cols) if files else df.repartitionByRange(*cols)
    writer = ranged.sortWithinPartitions(*cols).write.mode("overwrite")
    for c in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    writer.parquet(path)
