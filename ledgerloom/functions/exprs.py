"""Column expressions with the engine's rules for missing values, division, equality, symbols and dates.

Missing is NULL and nothing else; NaN becomes NULL when data enter (``nan_to_null``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nan_to_null(x: Column) -> Column:
    return F.when(F.isnan(x), None).otherwise(x)


def divide(a: Column, b: Column) -> Column:
    """IEEE division with NULL for 0/0, under ANSI mode as well."""
    by_zero = F.when(a > 0, F.lit(float("inf"))).when(a < 0, F.lit(float("-inf")))
    return F.when(b == 0, by_zero).otherwise(a / F.when(b != 0, b))


def finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def unequal(local: Column, incoming: Column, rtol: float, atol: float) -> Column:
    """Not equal within tolerance. The relative part follows ``incoming``; two missing values are equal, as are
    equal infinities; a finite and an infinite value never are."""
    near = finite(local) & finite(incoming) & (F.abs(local - incoming) <= F.lit(atol) + F.lit(rtol) * F.abs(incoming))
    return ~(local.eqNullSafe(incoming) | F.coalesce(near, F.lit(False)))


def deviation(local: Column, incoming: Column) -> Column:
    """Relative deviation of two finite values, 0 where both are 0, else NULL."""
    scale = F.greatest(F.abs(local), F.abs(incoming))
    return F.when(finite(local) & finite(incoming), F.when(scale == 0, 0.0).otherwise(F.abs(local - incoming) / F.when(scale != 0, scale)))


def symbol_code(symbol: Column) -> Column:
    """Numeric code of a symbol like 000001.SZ, else NULL. The whole string must match."""
    return F.when(symbol.rlike(r"\A\d{6}\.[A-Za-z]{2}\z"), F.substring(symbol, 1, 6).cast("long"))


def padded(text: Column, width: int = 4) -> Column:
    """Left-padded with zeros; longer strings stay whole."""
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def day_of(text: Column) -> Column:
    """DATE of an 8-digit day, NULL if it is none."""
    digits = text.cast("string")
    return F.when(digits.rlike(r"\A\d{8}\z"), F.try_to_date(digits, "yyyyMMdd"))


def bar_end(date: Column, time: Column) -> Column:
    """End of a one-minute bar from its integer day and HHMM start, as TIMESTAMP_NTZ."""
    text = F.concat(date.cast("string"), padded(time.cast("string")))
    return F.to_timestamp_ntz(text, F.lit("yyyyMMddHHmm")) + F.expr("INTERVAL 1 MINUTE")


def valid_code(text: Column) -> Column:
    """Whole number from 0 to 999999, given as any castable text."""
    number = text.try_cast("double")
    return number.isNotNull() & number.between(0, 999999) & (number == F.round(number))
