"""Reading, inferring, loading and unloading files."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.semantics import lenient_cast
from millrace.session import work_dir


def blank_to_null(df: DataFrame, tokens=("",)) -> DataFrame:
    """NULL for every text value that is one of the tokens."""
    return df.select(*[F.when(F.col(f"`{f.name}`").isin(*tokens), None).otherwise(F.col(f"`{f.name}`")).alias(f.name)
                       if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`") for f in df.schema.fields])


#: Columns that text-first reading adds: the whole record where its fields are not those of the schema, and its file.
RECORD, FILE = "__record", "__file"


def csv_text(reader, path, schema: T.StructType, header: bool = False, delimiter: str = ",", quote: str = '"', null_tokens=("", "\\N"),
             pattern: str | None = None, trim: bool = False, multi_line: bool = False) -> DataFrame:
    """The columns of a schema as text, null tokens as NULL, by ``spark.read`` or ``spark.readStream``.

    ``__record`` holds a record that has too few or too many fields, else NULL; ``__file`` is the path of its file.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields] + [T.StructField(RECORD, T.StringType())])
    df = _csv_options(reader, header, delimiter, quote, null_tokens, trim, multi_line).option("columnNameOfCorruptRecord", RECORD).schema(text).csv(path)
    path_of = F.col("_metadata.file_path")
    df = df.where(path_of.rlike(pattern)) if pattern else df
    value = lambda n: F.when(F.col(f"`{n}`").isin(*null_tokens), None).otherwise(F.col(f"`{n}`")) if null_tokens else F.col(f"`{n}`")
    return df.select(*[value(f.name).alias(f.name) for f in schema.fields], RECORD, path_of.alias(FILE))


def _csv_options(reader, header, delimiter, quote, null_tokens, trim, multi_line):
    return reader.option("header", header).option("sep", delimiter).option("quote", quote).option("escape", quote) \
        .option("mode", "PERMISSIVE").option("nullValue", null_tokens[0] if null_tokens else "").option("emptyValue", "").option("multiLine", multi_line) \
        .option("ignoreLeadingWhiteSpace", trim).option("ignoreTrailingWhiteSpace", trim)


def read_csv(spark: SparkSession, path, schema=None, header: bool = False, delimiter: str = ",", quote: str = '"',
             null_tokens=("", "\\N"), pattern: str | None = None, trim: bool = False, multi_line: bool = False, on_error: str = "null") -> DataFrame:
    """CSV files as text or as typed columns.

    Text is read first and the null tokens (any number of them) become NULL
    before the cast, so ``"NULL"`` in a number column is missing, not corrupt.
    Numbers and dates are trimmed before the cast.  A value that doesn't parse
    becomes NULL (``on_error="null"``), fails the load ("stop") or drops its row
    ("skip"); :func:`typed_load` reports the rows.  ``multi_line`` reads quoted
    line breaks and then takes each file as one piece.  Compressed files are
    recognised by suffix and invalid UTF-8 is replaced.  ``pattern`` is a regular
    expression on the path.
    """
    reader = _csv_options(spark.read, header, delimiter, quote, null_tokens, trim, multi_line)
    if schema is not None:
        schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        reader = reader.schema(T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields]))
    df = reader.csv(path)
    if pattern:
        df = df.where(F.col("_metadata.file_path").rlike(pattern))
    if null_tokens:
        df = blank_to_null(df, tuple(null_tokens))
    if schema is None:
        return df
    return typed(df, schema) if on_error == "null" else load_rows(df, schema, on_error)


def _trimmed(name: str, kind: str) -> str:
    return f"`{name}`" if kind == "string" else f"nullif(trim(`{name}`), '')"


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns cast to a schema, NULL where the text does not parse."""
    kinds = [(f.name, f.dataType.simpleString()) for f in schema.fields]
    return df.select(*[F.expr(lenient_cast(_trimmed(n, k), k)).alias(n) for n, k in kinds])


def positional(df: DataFrame, names, types) -> DataFrame:
    """Columns by position (``$1``, ``$2`` ..) cast and named."""
    return df.select(*[F.expr(lenient_cast(f"trim(`{c}`)", t)).alias(n) for c, n, t in zip(df.columns, names, types)])


def by_path(df: DataFrame, pattern: str) -> DataFrame:
    """Rows from files whose path matches a regular expression."""
    return df.where(F.col("_metadata.file_path").rlike(pattern))


def read_json_variant(spark: SparkSession, path, column: str = "v") -> DataFrame:
    """One semi-structured value per JSON line; gzip is recognised by suffix."""
    return spark.read.option("singleVariantColumn", column).json(path)


def gen_rows(spark: SparkSession, n: int, seed: int = 10, length: int = 10) -> DataFrame:
    """``n`` numbered rows with random text, the same for the same seed and partitioning."""
    return spark.range(1, n + 1).select(F.col("id").alias("n"), F.randstr(F.lit(length), F.lit(seed)).alias("r"))


def list_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Path, size and time of the files below a folder; contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length", "modificationTime")


def state_of(spark: SparkSession, path: str | list[str]) -> str:
    """A mark of the files at one or more paths: it changes when one is added, removed or written anew."""
    listed = list_files(spark, path).agg(F.count(F.lit(1)), F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)"))).first()
    return f"{listed[0]}:{listed[1]}"


def peek(spark: SparkSession, path, n: int = 10) -> DataFrame:
    """The first rows of staged delimited files as positional text columns."""
    return spark.read.csv(path).limit(n)


# narrowest first; an exact integer rejects 1.5, a double accepts it
_KINDS = (("bigint", "number(38,0)"), ("double", "double"), ("date", "date"), ("timestamp", "timestamp"))


def infer_csv_schema(df: DataFrame) -> DataFrame:
    """The narrowest type of every text column, from one distributed aggregate.

    One row per column: position, name, rows with a value, inferred type and the
    declared type text.  Every value counts; nothing is sampled.
    """
    aggs = []
    for i, c in enumerate(df.columns):
        text = f"nullif(trim(`{c}`), '')"
        aggs.append(F.expr(f"count({text})").alias(f"n{i}"))
        aggs += [F.expr(f"count({lenient_cast(text, k)})").alias(f"n{i}_{k}") for k, _ in _KINDS]
    counts = df.agg(*aggs)
    rows = []
    for i, c in enumerate(df.columns):
        kind, declared = F.lit("string"), F.lit("string")
        for k, ddl in reversed(_KINDS):
            fits = (F.col(f"n{i}") > 0) & (F.col(f"n{i}_{k}") == F.col(f"n{i}"))
            kind, declared = F.when(fits, k).otherwise(kind), F.when(fits, ddl).otherwise(declared)
        rows.append(F.struct(F.lit(i + 1).cast("bigint").alias("position"), F.lit(c).alias("name"), F.col(f"n{i}").alias("n_values"),
                             kind.alias("type"), declared.alias("declared")))
    return counts.select(F.inline(F.array(*rows)))


def create_table_text(inferred: DataFrame, table: str) -> DataFrame:
    """The inferred schema as one ``create table`` text."""
    line = F.concat(F.lit('"'), F.upper("name"), F.lit('" '), F.col("declared"))
    ordered = F.sort_array(F.collect_list(F.struct("position", line.alias("line"))))  # one entry per column
    body = F.concat_ws(",\n", F.transform(ordered, lambda x: x["line"]))
    return inferred.agg(F.concat(F.lit(f"create or replace table {table}\n(\n"), body, F.lit("\n);")).alias("ddl"))


def _unparsable(schema: T.StructType) -> Column:
    """Whether a row has a value that is present but does not parse."""
    bad = F.lit(False)
    for f in schema.fields:
        text = _trimmed(f.name, f.dataType.simpleString())
        bad = bad | F.expr(f"{text} is not null and ({lenient_cast(text, f.dataType.simpleString())}) is null")
    return bad


def typed_load(df: DataFrame, schema: T.StructType | str) -> tuple[DataFrame, DataFrame]:
    """(loaded rows, rejected rows): a row is rejected when a value is present but does not parse."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    bad = _unparsable(schema)
    return typed(df.where(~bad), schema), df.where(bad)


def load_rows(df: DataFrame, schema: T.StructType | str, on_error: str = "stop") -> DataFrame:
    """Typed rows; a row with a value that does not parse fails the load ("stop") or is left out ("skip")."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if on_error == "skip":
        return typed_load(df, schema)[0]
    if on_error != "stop":
        raise ValueError(f"on_error is 'stop' or 'skip', not {on_error!r}")
    row = F.to_json(F.struct(*[F.col(f"`{f.name}`") for f in schema.fields]))
    checked = df.where(F.when(_unparsable(schema), F.raise_error(F.concat(F.lit("a value does not parse: "), row)).cast("boolean")).otherwise(True))
    return typed(checked, schema)


def reject_reason(schema: T.StructType) -> Column:
    """Why a text row of :func:`csv_text` can't be loaded as the schema says: its fields or the columns that do not parse; NULL if it can."""
    wrong = []
    for f in schema.fields:
        kind = f.dataType.simpleString()
        text = _trimmed(f.name, kind)
        bad = F.expr(f"{text} is not null and ({lenient_cast(text, kind)}) is null")
        wrong.append(F.when(bad, F.concat(F.lit(f"{f.name}: "), F.col(f"`{f.name}`"), F.lit(f" is no {kind}"))))
    return F.when(F.col(RECORD).isNotNull(), F.lit("not the fields of the table")).otherwise(F.nullif(F.concat_ws("; ", *wrong), F.lit("")))


def checked_rows(df: DataFrame, schema: T.StructType, on_error: str) -> DataFrame:
    """Typed rows of :func:`csv_text` under one of the four rules for rows that do not load.

    "null" puts NULL for a value that does not parse, "stop" fails, "skip" leaves
    the row out.  "report" keeps it: ``rejected`` is 1 and ``reject`` holds the row as it stood, its file and the reason.
    """
    if on_error not in ("null", "stop", "skip", "report"):
        raise ValueError(f"on_error is 'null', 'stop', 'skip' or 'report', not {on_error!r}")
    if on_error == "null":
        return typed(df, schema)
    reason = reject_reason(schema)
    row = F.coalesce(F.col(RECORD), F.to_json(F.struct(*[F.col(f"`{f.name}`") for f in schema.fields])))
    if on_error == "stop":
        stop = F.raise_error(F.concat(F.lit("a row does not load, "), reason, F.lit(": "), row, F.lit(" in "), F.col(FILE))).cast("boolean")
        return typed(df.where(F.when(reason.isNotNull(), stop).otherwise(True)), schema)
    if on_error == "skip":
        return typed(df.where(reason.isNull()), schema)
    judged = df.withColumn("reject", F.when(reason.isNotNull(), F.struct(row.alias("row"), F.col(FILE).alias("file"), reason.alias("reason"))))
    kinds = [(f.name, f.dataType.simpleString()) for f in schema.fields]
    good = [F.when(F.col("reject").isNull(), F.expr(lenient_cast(_trimmed(n, k), k))).alias(n) for n, k in kinds]
    return judged.select(*good, "reject", F.col("reject").isNotNull().cast("int").alias("rejected"))


def _csv_bytes(df: DataFrame, null_token: str) -> Column:
    """Bytes of a row as quoted CSV, at most: a quote inside is written twice, and times are longer than their plain text."""
    size = F.lit(1)
    for f in df.schema.fields:
        text = F.col(f"`{f.name}`").cast("string")
        wide = 16 if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)) else 8 if isinstance(f.dataType, (T.FloatType, T.DoubleType, T.DecimalType)) else 0
        size = size + F.coalesce(F.octet_length(text) + F.octet_length(text) - F.octet_length(F.replace(text, F.lit('"'), F.lit(""))), F.lit(len(null_token.encode()))) + 3 + wide
    return size.cast("bigint")


def _json_bytes(df: DataFrame) -> Column:
    return (F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))) + 1).cast("bigint")


def size_classes(df: DataFrame, size: Column, bytes_per_file: int) -> list[tuple[int, int, int]]:
    """(least, most, rows of a file) for rows by size; one aggregate, a row per power of two.

    The first class reaches up to where files of equally many of its rows are still a
    third full; rows beyond, few or far longer, go in classes of a factor of two.
    """
    power = F.ceil(F.log2(size)).cast("int")
    found = df.select(size.alias("s"), power.alias("p")).groupBy("p").agg(F.count(F.lit(1)).alias("n"), F.sum("s").alias("s")).orderBy("p").collect()
    if not found:
        return [(0, 1, 0)]
    rows, held, usual = 0, 0, found[0]["p"]
    for r in found:
        rows, held = rows + r["n"], held + r["s"]
        usual = r["p"] if 3 * held >= rows * 2 ** r["p"] else usual
    out, least = [], 0
    for p in (usual, *(r["p"] for r in found if r["p"] > usual)):
        out.append((least, 2**p, max(1, bytes_per_file // 2**p)))
        least = 2**p
    return out


def _unload(df: DataFrame, path: str, size: Column, overwrite: bool, rows_per_file: int, bytes_per_file: int, write) -> None:
    """``write(writer)`` for all rows, or one size class after the other, so that no file exceeds its bytes unless one row does."""
    mode = "overwrite" if overwrite else "append"
    classes = size_classes(df, size, bytes_per_file) if bytes_per_file else [(0, None, rows_per_file)]
    if len(classes) == 1:
        rows = min(x for x in (classes[0][2], rows_per_file) if x) if classes[0][2] and rows_per_file else classes[0][2]
        write(df.write.mode(mode).option("maxRecordsPerFile", rows))
        return
    cut = classes[0][1]
    long = save(df.where(size > cut), f"{work_dir(df.sparkSession)}/long-rows-{uuid.uuid4().hex}")  # few rows: read again for each class
    for k, (least, most, rows) in enumerate(classes):
        part = df.where(size <= most) if k == 0 else long.where((size > least) & (size <= most))
        write(part.write.mode(mode if k == 0 else "append").option("maxRecordsPerFile", min(rows, rows_per_file) if rows_per_file else rows))


def unload_csv(df: DataFrame, path: str, header: bool = True, overwrite: bool = True, rows_per_file: int = 0, compression: str = "gzip",
               null_token: str = "\\N", bytes_per_file: int = 0) -> None:
    """Write quoted CSV.

    Text keeps its blanks, line breaks and emptiness; only NULL is written as
    ``null_token``.  ``rows_per_file`` and ``bytes_per_file`` (before compression)
    bound one file; rows of very uneven length are written in classes of their size, each in files of
    as many rows as fit.  Read back with ``multi_line=True, null_tokens=(null_token,)``.
    """
    head = sum(len(c.encode()) + 3 for c in df.columns) if header else 0
    _unload(df, path, _csv_bytes(df, null_token), overwrite, rows_per_file, max(1, bytes_per_file - head) if bytes_per_file else 0, lambda w: w.option("header", header).option("quoteAll", True).option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("nullValue", null_token).option("emptyValue", "")
            .option("compression", compression).csv(path))


def unload_json(df: DataFrame, path: str, overwrite: bool = True, rows_per_file: int = 0, compression: str = "gzip", bytes_per_file: int = 0) -> None:
    """Write one JSON document per row, without NULL fields; files are bounded as in :func:`unload_csv`."""
    _unload(df, path, _json_bytes(df), overwrite, rows_per_file, bytes_per_file, lambda w: w.option("compression", compression).json(path))


def empty_like(df: DataFrame) -> DataFrame:
    """The schema of a query without its rows."""
    return df.limit(0)


def save(df: DataFrame, path: str, append: bool = False) -> DataFrame:
    """Write a table and return it as read back."""
    df.write.mode("append" if append else "overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# ---- snapshots: Parquet has no row changes, so each returns the next state ---

def newest_per_key(changes: DataFrame, keys, order: str | None) -> DataFrame:
    """One row per key: the newest by ``order`` (ties by the other columns), or an error on repeated keys without one."""
    keys = list(keys)
    others = [c for c in changes.columns if c not in keys and c != order]
    rank = ([F.col(order)] if order else []) + [F.col(f"`{c}`") for c in others]
    picked = changes.groupBy(*keys).agg(F.max(F.struct(*rank)).alias("__row"), F.count(F.lit(1)).alias("__n")) if rank else changes.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    if order is None:
        picked = picked.where(F.when(F.col("__n") > 1, F.raise_error(F.lit("a key is changed twice; name the column that orders its changes")).cast("boolean")).otherwise(True))
    return picked.select(*[F.col(f"`{c}`") if c in keys else F.col(f"__row.`{c}`").alias(c) for c in changes.columns])


def merge_rows(target: DataFrame, changes: DataFrame, keys, order: str | None = None) -> DataFrame:
    """Upsert by key: rows of ``changes`` replace rows of ``target`` with the same key.

    A key that is changed more than once takes its newest row by ``order``;
    without an order the merge fails, as its result would depend on chance.
    """
    changes = newest_per_key(changes, keys, order)
    return target.join(changes.select(*keys), list(keys), "left_anti").unionByName(changes)


def delete_where(df: DataFrame, predicate: str | Column) -> DataFrame:
    """Rows for which the predicate is not true (NULL keeps the row)."""
    cond = F.expr(predicate) if isinstance(predicate, str) else predicate
    return df.where(~F.coalesce(cond, F.lit(False)))


def update_where(df: DataFrame, predicate: str | Column, values: dict) -> DataFrame:
    """Rows for which the predicate is true get new values."""
    cond = F.expr(predicate) if isinstance(predicate, str) else predicate
    new = {n: (F.expr(v) if isinstance(v, str) else F.lit(v) if not isinstance(v, Column) else v) for n, v in values.items()}
    return df.select(*[F.when(cond, new[c]).otherwise(F.col(c)).cast(df.schema[c].dataType).alias(c) if c in new else F.col(c) for c in df.columns])
