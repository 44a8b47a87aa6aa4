"""Numeric and truthiness helpers shared by every operator.

All are Column -> Column builders over built-in functions, so they stay inside
whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pround(c, n: int) -> Column:
    """Round a double to ``n`` places, half away from zero on its decimal text.

    Goes through DECIMAL(28,10) so Spark and the SQL oracle agree exactly
    (``CAST(round(CAST(x AS DECIMAL(28,10)), n) AS DOUBLE)``).
    """
    return F.round(col_(c).try_cast("decimal(28,10)"), n).cast("double")


def dbl(c) -> Column:
    """Decimal/number -> double at the arithmetic boundary."""
    return col_(c).cast("double")


def has_text(c) -> Column:
    """Python truthiness of ``str(x).strip()``: not null and not blank."""
    return F.coalesce(F.length(F.trim(col_(c))) > 0, F.lit(False))


def truthy_num(c) -> Column:
    """Python truthiness of a number: not null and not zero."""
    return F.coalesce(col_(c).cast("double") != 0, F.lit(False))


def truthy_bool(c) -> Column:
    return F.coalesce(col_(c).cast("boolean"), F.lit(False))


def count_if(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")


def to_number(c) -> Column:
    """Text -> double: thousands separators removed, anything unparsable -> null."""
    return F.regexp_replace(F.trim(col_(c).cast("string")), ",", "").try_cast("double")


def to_int(c) -> Column:
    """Text -> int via float (truncating); commas are NOT stripped on this path."""
    return F.trim(col_(c).cast("string")).try_cast("double").try_cast("int")
