"""Semi-structured values: paths, flattening, nesting and JSON text.

``VARIANT`` cannot be compared, grouped or joined, so every path used as a key is
taken out as a typed column first.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_TYPES = {"number": "bigint", "int": "bigint", "integer": "bigint", "datetime": "timestamp", "float": "double", "varchar": "string"}


def json_path_text(path: str) -> str:
    """``a.b``, ``a[0].b`` and ``a:b:c`` as ``$.``-paths."""
    return "$" + "".join(p if p.startswith("[") else "." + p for p in re.findall(r"\[\d+\]|[^.:\[\]]+", path))


def parse(c, strict: bool = True) -> Column:
    """Text to a semi-structured value; lenient parsing gives NULL on bad text."""
    return (F.parse_json if strict else F.try_parse_json)(F.col(c) if isinstance(c, str) else c)


def json_get(c, path: str, kind: str = "variant") -> Column:
    """Value at a path with a type; NULL when the path is absent or does not convert."""
    v = F.col(c) if isinstance(c, str) else c
    return F.try_variant_get(v, json_path_text(path), _TYPES.get(kind, kind))


def flatten(df: DataFrame, column: str, path: str = "", name: str = "value", with_index: str | None = None, outer: bool = False) -> DataFrame:
    """One row per element of the array at a path, joined with its row.

    The input array is exploded inside its task: no shuffle, no collected groups.
    """
    array = json_get(column, path, "array<variant>") if path else F.col(column).cast("array<variant>")
    cols = [F.col(f"`{c}`") for c in df.columns]
    exploded = (F.posexplode_outer if outer else F.posexplode)(array).alias("__pos", name)
    out = df.select(*cols, exploded)
    return out.withColumnRenamed("__pos", with_index) if with_index else out.drop("__pos")


def row_to_object(df: DataFrame, columns=None, name: str = "object") -> DataFrame:
    """Each row as one JSON object text; NULL fields are left out."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in (columns or df.columns)])).alias(name))


def nest(df: DataFrame, keys, children, name: str) -> DataFrame:
    """Parents with an array of child objects; the array is sorted so it compares."""
    return df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*children))).alias(name))


def rows_to_json(df: DataFrame, columns, n: int, order, where: str | None = None, key: str = "key1") -> DataFrame:
    """The first ``n`` rows by ``order`` as one JSON document ``{key: [row, ..]}``.

    ``n`` bounds what is gathered into the single output row.
    """
    picked = (df.where(where) if where else df).orderBy(*order).limit(n)
    numbered = picked.select(F.row_number().over(Window.orderBy(*order)).alias("n"), F.struct(*columns).alias("row"))
    gathered = numbered.agg(F.transform(F.sort_array(F.collect_list(F.struct("n", "row"))), lambda r: r["row"]).alias(key))
    return gathered.select(F.to_json(F.struct(key), {"ignoreNullFields": "false"}).alias("document"))


def json_to_rows(df: DataFrame, column: str, path: str, schema: dict) -> DataFrame:
    """Rows back from a JSON document that holds an array of objects."""
    items = flatten(df.select(parse(column).alias("__doc")), "__doc", path, "__item")
    return items.select(*[json_get("__item", n, t).alias(n) for n, t in schema.items()])


def struct_to_columns(df: DataFrame, column: str, fields: dict) -> DataFrame:
    """Typed columns from a prediction-like object, other columns kept."""
    rest = [F.col(c) for c in df.columns if c != column]
    return df.select(*rest, *[json_get(column, p, t).alias(n) for n, (p, t) in fields.items()])


def json_key_join(docs: DataFrame, column: str, path: str, table: DataFrame, key: str, kind: str = "bigint") -> DataFrame:
    """Documents with the table rows whose key equals a path of the document."""
    return docs.withColumn("__key", json_get(column, path, kind)).join(table, F.col("__key") == F.col(key)).drop("__key")


def split_to_rows(df: DataFrame, column: str, delimiter: str, name: str = "piece", index: str = "index") -> DataFrame:
    """One row per piece of a delimited text, with its position from 1."""
    pieces = F.posexplode(F.split(F.col(column), re.escape(delimiter))).alias("__p", name)
    return df.select(*[F.col(c) for c in df.columns], pieces).withColumn(index, F.col("__p") + 1).drop("__p")


def to_array(c) -> Column:
    """A value as an array of one; NULL gives an empty array."""
    return F.array_compact(F.array(c))


def array_with(c, value) -> Column:
    """The array with a value added at its end, as text where the kinds differ."""
    c, value = (F.col(x) if isinstance(x, str) else x for x in (c, value))
    return F.array_append(c, value.cast("string"))
