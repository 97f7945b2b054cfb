"""Column helpers that pin down null order, averages, ratios and casts.

The source dialect sorts NULL as the largest value, divides to a fraction and
rounds when a decimal becomes an integer; these helpers say so once.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def asc(c) -> Column:
    return _col(c).asc_nulls_last()


def desc(c) -> Column:
    return _col(c).desc_nulls_first()


def mean(c) -> Column:
    """Average as exact sum / count, so the result does not depend on row order."""
    return F.sum(_col(c)).cast("double") / F.count(_col(c))


def ratio(num, den) -> Column:
    """Fractional division; NULL where the divisor is zero."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))


def guarded_ratio(num, den, otherwise=None) -> Column:
    """``num / den`` only for a positive divisor."""
    num, den = _col(num).cast("double"), _col(den).cast("double")
    return F.when(den > 0, num / den).otherwise(F.lit(otherwise).cast("double"))


def whole_units(c, scale: int = 2) -> Column:
    """A double that holds a decimal of ``scale`` digits, as whole units (cents).

    Casting a double to decimal goes through text for every row; this is one
    multiplication and exact for values below 2**53 units.
    """
    return F.floor(_col(c) * float(10 ** scale) + 0.5)


def money(c) -> Column:
    """A double amount as an exact ``decimal(12,2)``."""
    return (whole_units(c).cast("decimal(14,0)") * F.lit(Decimal("0.01"))).cast("decimal(12,2)")


def dec_ratio(num, den, precision: int, scale: int) -> Column:
    """Ratio of two values first rounded to ``decimal(precision, scale)``."""
    kind = f"decimal({precision},{scale})"
    return ratio(_col(num).cast(kind), _col(den).cast(kind))


def round_to_int(c) -> Column:
    """Cast to integer by rounding half away from zero."""
    return F.round(_col(c), 0).cast("bigint")


def sd(c, digits: int = 6) -> Column:
    """Sample standard deviation, NULL for a single row; rounded, so that the order of rows doesn't show."""
    return F.round(F.stddev_samp(_col(c).cast("double")), digits)


def coefficient_of_variation(c, digits: int = 6) -> Column:
    """Standard deviation over mean, rounded."""
    return F.round(F.try_divide(F.stddev_samp(_col(c).cast("double")), mean(c)), digits)


def sum_if(cond, value) -> Column:
    return F.sum(F.when(cond, _col(value)))


def within_pct(a, b, pct: float) -> Column:
    """``a`` lies within ``pct`` of ``b`` on either side."""
    a, b = _col(a), _col(b)
    return a.between(b * F.lit(1 - pct), b * F.lit(1 + pct))


def strtok(c, delimiter: str, n: int) -> Column:
    """n-th non-empty token, NULL past the end."""
    import re
    parts = F.filter(F.split(_col(c), re.escape(delimiter)), lambda x: x != "")
    return F.try_element_at(parts, F.lit(n))


def split_part(c, delimiter: str, n: int) -> Column:
    """n-th field, the empty string past the end."""
    return F.split_part(_col(c), F.lit(delimiter), F.lit(n))


_INTEGER = "^[+-]?[0-9]+$"
_NUMBER = "^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
_DATE = "^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"


def lenient_cast(text: str, kind: str) -> str:
    """SQL text: ``text`` (SQL for a trimmed string) as ``kind``, NULL where it does not parse.

    A failing numeric ``try_cast`` raises and catches inside the parser for every
    row, some ten microseconds each; the pattern keeps such text away from it.
    """
    if kind in ("bigint", "int", "smallint"):
        return f"case when {text} rlike '{_INTEGER}' then try_cast({text} as {kind}) end"
    if kind in ("double", "float") or kind.startswith("decimal"):
        special = f" or lower({text}) in ('nan', 'infinity', '-infinity')" if kind in ("double", "float") else ""
        return f"case when {text} rlike '{_NUMBER}'{special} then try_cast({text} as {kind}) end"
    if kind == "date":  # a cast alone would drop a time of day
        return f"case when {text} rlike '{_DATE}' then try_cast({text} as date) end"
    return f"try_cast({text} as {kind})"


def try_exact_integer(c: str) -> Column:
    return F.expr(lenient_cast(f"trim(`{c}`)", "bigint"))


def try_exact_date(c: str, fmt: str | None = None) -> Column:
    if fmt:
        return F.try_to_date(F.trim(F.col(c)), fmt)
    return F.expr(lenient_cast(f"trim(`{c}`)", "date"))


def try_to_double(c: str) -> Column:
    return F.expr(lenient_cast(f"trim(`{c}`)", "double"))


def decrypt_text(c, key: Column | str) -> Column:
    """base64 + AES-ECB-PKCS text to plain text; NULL where it does not decrypt."""
    key = F.lit(key) if isinstance(key, str) else key
    return F.try_aes_decrypt(F.unbase64(_col(c)), key.cast("binary"), F.lit("ECB"), F.lit("PKCS")).cast("string")


def whole(*partition):
    """Window over the whole partition, for ``last_value`` and totals."""
    return Window.partitionBy(*partition).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def running_to_here(partition, order):
    return Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)


def tie_broken(df: DataFrame, keys) -> list[Column]:
    """``keys`` followed by every column of ``df``: a total order up to equal rows."""
    return list(keys) + [asc(f"`{c}`") for c in df.columns]
