"""What the operators share: staged intermediates, row keys and text as bytes."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import work_dir


#: Texts that a Python worker gets at a time, in rows and in bytes; Spark's default of 10,000 rows holds several copies of some 30 MB.
BATCH_ROWS, BATCH_BYTES = 2_000, 8 << 20


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: one execution, a short lineage."""
    small_batches(df.sparkSession)
    path = f"{work_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{folder.rstrip('/')}/documents.parquet")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def raw(text: Column) -> Column:
    """The UTF-8 bytes of a text, empty for NULL."""
    return F.coalesce(text, F.lit("")).cast("binary")


def byte_rows(a: pa.Array) -> list[bytes]:
    """The values of a binary Arrow array; bytes of a NULL are empty."""
    return [x or b"" for x in a.to_pylist()]


def lists(flat: np.ndarray, lengths, kind: pa.DataType) -> pa.ListArray:
    """An Arrow list column from its values and the length of each row's list."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, kind))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection, so it adds no collisions)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def free_name(df: DataFrame, wish: str) -> str:
    """A column name that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish = f"_{wish}"
    return wish


def once(value: Column, body) -> Column:
    """``body(value)``, for which the value is computed once however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


#: Lengths of the two levels of sums and of pieces of a text: what grows with the square of a number does so within them.
_LEVEL, _PIECE = 256, 4096


def sums_before(lengths: Column) -> Column:
    """For each number of an array<bigint> the sum of those before it, by blocks, so in time about in proportion."""
    def running(block: Column) -> Column:
        start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<bigint>").alias("out"))
        return F.aggregate(block, start, lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")))

    def joined(all_: Column) -> Column:
        firsts = F.when(F.size(all_) > 0, F.sequence(F.lit(1), F.size(all_), F.lit(_LEVEL))).otherwise(F.array().cast("array<int>"))
        blocks = F.transform(firsts, lambda k: running(F.slice(all_, k, _LEVEL)))
        return once(blocks, lambda b: once(running(F.transform(b, lambda x: x["at"]))["out"], lambda before: F.flatten(F.transform(b, lambda x, i: F.transform(x["out"], lambda v: v + F.get(before, i))))))

    return once(lengths, joined)


def rewritten(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """``row`` and ``text`` of ``rows`` with each span replaced: ``spans`` has row, start, end (code points, end exclusive) and new.

    Spans of a row don't overlap.  Texts are cut into pieces and put together again,
    so a long text with very many spans is spread over tasks and costs what it is long.
    """
    pieces = rows.select("row", F.posexplode(F.regexp_extract_all("text", F.lit(f"(?s).{{1,{_PIECE}}}"), F.lit(0))).alias("c", "piece"))
    first, last = F.floor(F.col("start") / _PIECE).cast("int"), F.floor((F.col("end") - 1) / _PIECE).cast("int")
    cuts = spans.select("row", "start", "end", "new", F.explode(F.sequence(first, last)).alias("c"))
    cut = F.struct(F.greatest(F.col("start") - F.col("c") * _PIECE, F.lit(0)).cast("int").alias("a"), F.least(F.col("end") - F.col("c") * _PIECE, F.lit(_PIECE)).cast("int").alias("b"),
                   F.when(F.col("c") == first, F.col("new")).otherwise("").alias("new"))
    per = cuts.groupBy("row", "c").agg(F.array_sort(F.collect_list(cut)).alias("cuts"))

    def step(acc, x):
        return F.struct(x["b"].alias("at"), F.concat(acc["out"], F.substr(F.col("piece"), acc["at"] + 1, x["a"] - acc["at"]), x["new"]).alias("out"))

    spliced = F.aggregate("cuts", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda acc: F.concat(acc["out"], F.substr(F.col("piece"), acc["at"] + 1)))
    out = pieces.join(per, ["row", "c"], "left").select("row", F.struct("c", F.when(F.col("cuts").isNull(), F.col("piece")).otherwise(spliced).alias("piece")).alias("p"))
    return out.groupBy("row").agg(F.array_join(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["piece"]), "").alias("text"))
