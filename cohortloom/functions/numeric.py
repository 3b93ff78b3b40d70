"""Numeric column expressions: rounding, clipping, ratios, scaling, flags."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def round_decimal(value: Column | str, digits: int) -> Column:
    """Half-up rounding of the decimal text of the number (``F.round``)."""
    return F.round(as_column(value), digits)


def round_floor(value: Column | str, digits: int) -> Column:
    """Half-up rounding of the binary value; gives the same digits in any engine.

    NaN and numbers too large to have such digits stay what they are.
    """
    scale = float(10**digits)
    number = as_column(value).cast("double")
    rounded = F.floor(number * F.lit(scale) + F.lit(0.5)) / F.lit(scale)
    return F.when(F.abs(number) < F.lit(2.0**52 / scale), rounded).otherwise(number)


def round_columns(digits: Mapping[str, int], rounding=round_decimal) -> list[Column]:
    """One rounded column per entry, under its own name."""
    return [rounding(F.col(name), places).alias(name) for name, places in digits.items()]


def real_or_null(value: Column | str) -> Column:
    """NaN becomes NULL, so that aggregates and comparisons skip it."""
    number = as_column(value).cast("double")
    return F.when(~F.isnan(number), number)


def finite_or_null(value: Column | str) -> Column:
    """NaN and the infinities become NULL."""
    number = as_column(value).cast("double")
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def clip(value: Column | str, low: float, high: float) -> Column:
    """Limit to ``[low, high]``; NULL and NaN stay what they are."""
    number = as_column(value).cast("double")
    above = (number > F.lit(float(high))) & ~F.isnan(number)
    return F.when(number < F.lit(float(low)), F.lit(float(low))).when(above, F.lit(float(high))).otherwise(number)


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient as double, NULL where the divisor is zero."""
    return F.try_divide(
        as_column(numerator).cast("double"), as_column(denominator).cast("double")
    )


def min_max(value: Column | str, low: float, high: float) -> Column:
    """Position between fixed bounds, not clipped: below 0 or above 1 outside them."""
    if high == low:
        raise ValueError("the two bounds must differ")
    return (as_column(value).cast("double") - F.lit(float(low))) / F.lit(float(high) - float(low))


def min_max_columns(
    bounds: Mapping[str, tuple[float, float]],
    digits: int = 4,
    suffix: str = "_norm",
    rounding=round_decimal,
) -> list[Column]:
    """Scaled copies of several columns, for use in a single ``select``."""
    return [
        rounding(min_max(name, low, high), digits).alias(f"{name}{suffix}")
        for name, (low, high) in bounds.items()
    ]


def threshold_flag(value: Column | str, limit: float) -> Column:
    """1 above the limit, 0 at or below it, NULL for NULL and NaN."""
    return (real_or_null(value) > F.lit(float(limit))).cast("int")
