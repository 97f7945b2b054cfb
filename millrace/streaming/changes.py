"""Change logs: current state, type-2 history and summaries, in batch and as streams.

Order is the commit time only.  Late changes are handled by recomputing the keys
they touch, so batch and stream agree on the same files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.semistructured import json_get
from millrace.sources.files import checked_rows, csv_text, newest_per_key


def change_columns(records: DataFrame, column: str = "record_content", fields: dict | None = None) -> DataFrame:
    """Typed columns of a change record ``{transaction: {schema, table, action, ..}}``.

    ``fields`` maps an output column to (name in the record, type); each is taken
    from the record after the change, ``before_<name>`` from the one before.  The
    record is walked once: one typed read of the transaction, then plain fields.
    A value that does not convert is an error, a missing one is NULL.
    """
    fields = fields or {}
    image = ", ".join(f"`{p}`: {t}" for p, t in fields.values())
    images = f", record_before: struct<{image}>, record_after: struct<{image}>" if fields else ""
    kind = f"struct<schema: string, `table`: string, action: string, primaryKey_tokenized: string, committed_at: bigint, dbuser: string{images}>"
    t = records.select(F.variant_get(F.col(column), "$.transaction", kind).alias("t"))
    cols = [F.col("t.schema").alias("source_schema"), F.col("t.table").alias("source_table"), F.col("t.action").alias("action"),
            F.col("t.primaryKey_tokenized").alias("key"), F.col("t.committed_at").alias("committed_at"), F.col("t.dbuser").alias("dbuser")]
    for n, (p, _) in fields.items():
        cols += [F.col(f"t.record_after.{p}").alias(n), F.col(f"t.record_before.{p}").alias(f"before_{n}")]
    return t.select(*cols)


def commit_time(c: str):
    """A commit time in milliseconds as a timestamp."""
    return F.timestamp_millis(F.col(c))


def only_source(changes: DataFrame, schema: str, table: str) -> DataFrame:
    """The changes of one source table out of a multi-table feed."""
    return changes.where((F.col("source_schema") == schema) & (F.col("source_table") == table))


def latest(changes: DataFrame, key: str, order: str) -> DataFrame:
    """The newest change of every key; changes that share the newest time are all kept.

    Changes of one key and time meet first, so a key with very many is spread by
    its times; then each task keeps its newest per key before it passes them on.
    """
    same = changes.groupBy(F.col(key).alias("__k"), F.col(order).alias("__o")).agg(F.collect_list(F.struct(*[F.col(f"`{c}`") for c in changes.columns])).alias("__rows"))
    return same.groupBy("__k").agg(F.max_by("__rows", "__o").alias("__rows")).select(F.inline("__rows"))


def current_state(changes: DataFrame, key: str, order: str, action: str = "action", deleted: str = "DELETE") -> DataFrame:
    """One row per living key: its newest change unless that is a deletion."""
    return latest(changes, key, order).where(F.col(action) != deleted).drop(action)


def scd2_history(changes: DataFrame, key: str, order: str, tie: str, width: int) -> DataFrame:
    """Adds ``version``, ``is_latest``, ``valid_from`` and ``valid_to`` to every change.

    Version counts the changes up to this one, with equal times sharing a version;
    ``valid_to`` is the time of the following change.  The changes of a key in a
    time bucket of ``width`` come together, sorted by time and ``tie``, which is the only time that rows move: one small row per
    bucket meets in the window of a key, and what it finds goes back to the bucket.  So a key
    that owns a third of all changes is split by time; ``width`` is to be such that a key's bucket fits in memory.
    """
    cols = changes.columns
    near = changes.withColumns({"__k": F.col(key), "__o": F.col(order), "__b": F.floor(F.col(order) / width)}).repartition("__k", "__b")
    same = near.groupBy("__k", "__b", "__o").agg(F.sort_array(F.collect_list(F.struct(F.col(tie).alias("t"), F.struct(*[F.col(f"`{c}`") for c in cols]).alias("row")))).alias("same"))
    # of each change: its time, how many of its time are there, itself included, from it on, and of all
    members = F.transform("same", lambda x, i: F.struct(F.col("__o").alias("o"), (F.size("same") - i).alias("left"), F.size("same").alias("n"), x["row"].alias("row")))
    bucket = same.groupBy("__k", "__b").agg(F.sort_array(F.collect_list(F.struct(F.col("__o").alias("o"), members.alias("m")))).alias("m"))
    bucket = bucket.select("__k", "__b", F.flatten(F.transform("m", lambda x: x["m"])).alias("__rows"))
    first = F.element_at("__rows", 1)
    summary = bucket.select(F.col("__k").alias("__sk"), F.col("__b").alias("__sb"), F.size("__rows").alias("__n"), first["o"].alias("__first"), first["n"].alias("__ties"))
    line, whole = Window.partitionBy("__sk").orderBy("__sb"), Window.partitionBy("__sk")
    summary = summary.select("__sk", "__sb", (F.sum("__n").over(line) - F.col("__n")).alias("__before"), F.sum("__n").over(whole).alias("__total"), F.lead("__first").over(line).alias("__following"),
                             F.first("__ties").over(line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("__first_ties"))
    out = bucket.join(summary, F.col("__k").eqNullSafe(F.col("__sk")) & F.col("__b").eqNullSafe(F.col("__sb")))
    out = out.select("__before", "__total", "__following", "__first_ties", F.transform("__rows", lambda x, i: F.struct(
        x["row"].alias("row"), x["o"].alias("o"), (x["left"] + i).alias("upto"), F.get("__rows", i + 1)["o"].alias("next"))).alias("__rows"))
    out = out.select("__before", "__total", "__following", "__first_ties", F.inline("__rows")).withColumn("upto", F.col("__before") + F.col("upto"))
    return out.select("row.*", (F.col("upto") == F.col("__total")).alias("is_latest"), (F.col("upto") - F.col("__first_ties") + 1).alias("version"),
                      F.col("o").alias("valid_from"), F.coalesce("next", "__following").alias("valid_to"))


def position_summary(current: DataFrame, keys, price: str = "price", quantity: str = "quantity") -> DataFrame:
    """Price range, average, shares and value per group of the current state."""
    average = F.round(F.avg(F.col(price).cast("decimal(18,3)")), 2).cast("decimal(38,2)")
    out = current.groupBy(*keys).agg(F.min(price).alias("min_price"), F.max(price).alias("max_price"), average.alias("average_price"),
                                     F.sum(quantity).alias("total_shares"))
    return out.withColumn("total_value_usd", F.round(F.col("total_shares") * F.col("average_price"), 2).cast("decimal(38,2)"))


def scd2_apply(history: DataFrame, current: DataFrame, changes: DataFrame, key: str, ts, start: str = "record_start_time", end: str = "record_end_time",
               order: str | None = None):
    """(new history, new current) after applying changed rows at time ``ts``.

    Current rows are replaced by key; the open history row of a changed key is
    closed and the new version is opened.  Keys that do not exist are ignored, as
    an update of them would be.  A key changed twice takes its newest change by
    ``order``, or fails without one.
    """
    changes = newest_per_key(changes, [key], order)
    changes = changes.drop(order) if order and order not in current.columns else changes
    ts = F.lit(ts).cast(current.schema[start].dataType)
    values = [c for c in changes.columns if c != key]
    new = changes.select(F.col(key).alias("__k"), *[F.col(c).alias("__" + c) for c in values])
    touched = current.join(new, F.col(key) == F.col("__k"), "left")
    hit = F.col("__k").isNotNull()
    now = touched.select(hit.alias("__hit"), *[F.when(hit, F.col("__" + c)).otherwise(F.col(c)).alias(c) if c in values
                                               else F.when(hit, ts).otherwise(F.col(c)).alias(c) if c == start else F.col(c) for c in current.columns])
    opened = now.where("__hit").drop("__hit").withColumn(end, F.lit(None).cast(history.schema[end].dataType))
    closed = history.join(opened.select(F.col(key).alias("__k")), F.col(key) == F.col("__k"), "left") \
        .select(*[F.when(F.col("__k").isNotNull() & F.col(end).isNull(), ts).otherwise(F.col(end)).alias(end) if c == end else F.col(c) for c in history.columns])
    return closed.unionByName(opened), now.drop("__hit")


def landing_counts(df: DataFrame, *by) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"))


# ---- streams ---------------------------------------------------------------

# The file source skips files much older than the newest it has seen; a load must not.
ANY_AGE = {"maxFileAge": "36500d"}


def read_changes(spark: SparkSession, path: str, schema, kind: str = "parquet", **options) -> DataFrame:
    """Rows that arrive in a folder, whatever the age of their file; together with a checkpoint, the rows not yet consumed."""
    reader = spark.readStream.schema(schema)
    for k, v in (ANY_AGE | options).items():
        reader = reader.option(k, v)
    return reader.format(kind).load(path)


def read_json_changes(spark: SparkSession, path: str, column: str = "v", **options) -> DataFrame:
    """JSON lines that arrive in a folder, one semi-structured value per row."""
    reader = spark.readStream.option("singleVariantColumn", column)
    for k, v in (ANY_AGE | options).items():
        reader = reader.option(k, v)
    return reader.schema(f"{column} variant").json(path)


def trigger(lag: str | None) -> dict:
    """Refresh at least every ``lag``; without one, take what is there and stop."""
    return {"processingTime": lag} if lag else {"availableNow": True}


def append_stream(df: DataFrame, path: str, checkpoint: str, lag: str | None = None, partition: str | None = None):
    """Append a stream to a Parquet folder, each input file once."""
    writer = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(**trigger(lag))
    return (writer.partitionBy(partition) if partition else writer).start()


def run_available(query) -> None:
    """Wait for a query that stops by itself; without new files it does nothing."""
    query.awaitTermination()


def arriving_rows(spark: SparkSession, source: str, schema, kind: str = "csv", on_error: str = "stop", **options) -> DataFrame:
    """The rows of files that arrive in a folder, read text first by the rules of ``read_csv``.

    ``options`` are those of :func:`millrace.sources.files.csv_text`.  JSON lines
    become one semi-structured column, named by the schema's only field; a line that is no JSON is a row that
    does not load.  Any other format is typed in itself and read as it is.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if kind == "csv":
        reader = spark.readStream
        for k, v in ANY_AGE.items():
            reader = reader.option(k, v)
        return checked_rows(csv_text(reader, source, schema, **options), schema, on_error)
    if kind == "json":
        name = schema.fields[0].name
        lines = read_changes(spark, source, "value string", "text", **options).select("value", F.col("_metadata.file_path").alias("file"))
        value, bad = F.try_parse_json("value"), F.col("value").isNotNull() & F.try_parse_json("value").isNull()
        if on_error == "stop":
            return lines.select(F.parse_json("value").alias(name))
        if on_error in ("skip", "null"):
            return (lines.where(~bad) if on_error == "skip" else lines).select(value.alias(name))
        reject = F.when(bad, F.struct(F.col("value").alias("row"), "file", F.lit("no JSON").alias("reason")))
        return lines.select(value.alias(name), reject.alias("reject"), bad.cast("int").alias("rejected"))
    return read_changes(spark, source, schema, kind, **options)


def _reporting(kind: str, on_error: str) -> str | None:
    """The column that parts loaded rows from others in the target, if they are reported."""
    return "rejected" if on_error == "report" and kind in ("csv", "json") else None


def loaded(spark: SparkSession, target: str) -> DataFrame:
    """The rows that a load has put into its target."""
    df = spark.read.parquet(target)
    return df.where("rejected = 0").drop("rejected", "reject") if "rejected" in df.columns else df


def rejects(spark: SparkSession, target: str) -> DataFrame:
    """The rows that a reporting load could not put into its target: ``row`` as it stood, ``file`` and ``reason``."""
    return spark.read.parquet(target).where("rejected = 1").select("reject.*")


def copy_into(spark: SparkSession, source: str, target: str, checkpoint: str, schema, kind: str = "csv", transform=None, on_error: str = "stop", **options) -> None:
    """Load every file of a folder once; calling again loads only new files.

    A row that does not load fails its batch, which a later call takes up again
    ("stop"), is left out ("skip"), loses its bad values ("null"), or goes with
    its file and the reason into the same commit as the others ("report"; see :func:`loaded` and :func:`rejects`).
    """
    df = arriving_rows(spark, source, schema, kind, on_error, **options)
    part = _reporting(kind, on_error)
    if transform and part:
        good = transform(df.where("rejected = 0").drop("reject", "rejected"))
        df = good.withColumn("rejected", F.lit(0)).unionByName(df.where("rejected = 1").select("reject", "rejected"), allowMissingColumns=True)
    elif transform:
        df = transform(df)
    run_available(append_stream(df, target, checkpoint, partition=part))


def ingest_stream(spark: SparkSession, source: str, target: str, checkpoint: str, schema, kind: str = "csv", lag: str | None = "1 minute", zone: str = "UTC",
                  on_error: str = "report", **options):
    """Continuous load with an added load time in a zone; rows that do not load are reported unless told otherwise."""
    df = arriving_rows(spark, source, schema, kind, on_error, **options)
    stamped = df.withColumn("insert_ts", F.convert_timezone(F.lit(spark.conf.get("spark.sql.session.timeZone")), F.lit(zone), F.current_timestamp().cast("timestamp_ntz")))
    return append_stream(stamped, target, checkpoint, lag, _reporting(kind, on_error))


# ---- state kept by streams ---------------------------------------------------

#: State of any size on the executors' disks, saved to the checkpoint by changes.
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def _started(writer, spark: SparkSession):
    """Start a query whose state is in the disk-backed store; the session's own setting stays."""
    name, value = STATE_STORE
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        return writer.start()
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


def stream_current_state(changes: DataFrame, path: str, checkpoint: str, key: str, order: str, tie=(), lag: str | None = None):
    """Keep the newest change per key from a change stream, in Spark's state store.

    The state of a key is its newest change, deletions too, so a late change older
    than a deletion is without effect.  A batch appends the states it changed, in a folder of its own number that
    a retry writes over; :func:`kept_state` reads the newest of each key.  Of changes of one time
    the greatest by the columns ``tie`` stays.
    """
    rank = F.struct(*[F.col(c) for c in (order, *tie)])
    newest = changes.groupBy(F.col(key).alias("__k")).agg(F.max_by(F.struct(*changes.columns), rank).alias("row"))

    def append(batch: DataFrame, number: int) -> None:
        batch.select("row.*").write.mode("overwrite").parquet(f"{path}/batch={number}")

    return _started(newest.writeStream.outputMode("update").foreachBatch(append).option("checkpointLocation", checkpoint).trigger(**trigger(lag)), changes.sparkSession)


def kept_state(spark: SparkSession, path: str, schema: T.StructType, key: str) -> DataFrame:
    """The newest state of every key out of what :func:`stream_current_state` has appended, deletions included; combined before it moves."""
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(path)
    return rows.groupBy(F.col(key).alias("__k")).agg(F.max_by(F.struct(*schema.names), "batch").alias("row")).select("row.*")


def stream_scd2(changes: DataFrame, path: str, checkpoint: str, lag: str | None = None):
    """Keep a type-2 history: every version is written once, as it comes.

    What follows from other versions (``valid_to``, the number, which is newest)
    isn't stored but resolved by :func:`kept_history`, so a late change alters nothing that is written and a
    batch costs what it holds.
    """
    return append_stream(changes, path, checkpoint, lag)


def kept_history(spark: SparkSession, path: str, schema: T.StructType, key: str, order: str, tie: str, width: int, only: str | None = None) -> DataFrame:
    """The history out of what :func:`stream_scd2` has appended; ``only`` is a condition on the key, which reaches the files."""
    log = spark.read.schema(schema).parquet(path)
    return scd2_history(log.where(only) if only else log, key, order, tie, width)


# ---- the two-stage weather pipeline -----------------------------------------

def weather_typed(raw: DataFrame, column: str = "v", zone: str = "Europe/Paris") -> DataFrame:
    """Stage 1: typed columns from weather documents, local time, Kelvin."""
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), json_get(column, "time", "timestamp_ntz"))
    paths = {"country": ("city.country", "string"), "city": ("city.name", "string"), "id": ("city.id", "string"), "temp_kel": ("main.temp", "double"),
             "temp_min_kel": ("main.temp_min", "double"), "temp_max_kel": ("main.temp_max", "double"), "conditions": ("weather[0].main", "string"),
             "wind_dir": ("wind.deg", "double"), "wind_speed": ("wind.speed", "double")}
    return raw.select(local.alias("date"), *[json_get(column, p, t).alias(n) for n, (p, t) in paths.items()])


def weather_celsius(typed: DataFrame) -> DataFrame:
    """Stage 2: Kelvin to Celsius."""
    return typed.select(*[(F.col(c) - 273.15).alias(c.replace("_kel", "_cel")) if c.endswith("_kel") else F.col(c) for c in typed.columns])


def weather_pipeline(spark: SparkSession, raw: str, stage: str, final: str, checkpoints: str) -> None:
    """Run both stages over what is new; the second reads what the first wrote."""
    first = weather_typed(read_json_changes(spark, raw))
    run_available(append_stream(first, stage, f"{checkpoints}/stage"))
    run_available(append_stream(weather_celsius(read_changes(spark, stage, first.schema)), final, f"{checkpoints}/final"))
