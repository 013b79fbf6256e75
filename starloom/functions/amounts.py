"""Money arithmetic: exact decimals inside, ratios as doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_decimal(quantity: Column) -> Column:
    return quantity.cast("decimal(10,0)")


def gross(unit_price: Column, quantity: Column) -> Column:
    return unit_price * as_decimal(quantity)


def percent_of(amount: Column, rate: Column) -> Column:
    """``amount * rate / 100`` without leaving decimals: division would lose scale."""
    return amount * rate * F.lit("0.01").cast("decimal(3,2)")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double quotient, NULL where the denominator is zero."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def rounded_ratio(numerator: Column, denominator: Column, digits: int, times: int = 1) -> Column:
    """``times * numerator / denominator`` rounded half up once, as a double; NULL where the denominator is zero.

    Both are whole numbers or decimals of up to six places. They are divided as whole numbers, so a
    quotient that is exactly a tie rounds up, and none does that only comes near one.
    """
    top, bottom = ((c.cast("decimal(25,6)") * 1_000_000).cast("decimal(38,0)") for c in (numerator, denominator))
    bottom = F.nullif(bottom, F.lit(0).cast("decimal(38,0)"))
    scaled = F.abs(top) * F.lit(2 * times * 10**digits).cast("decimal(12,0)") + F.abs(bottom)
    quotient = F.call_function("div", scaled, F.abs(bottom) * 2).cast("double") / float(10**digits)
    return F.when((top < 0) != (bottom < 0), -quotient).otherwise(quotient)


def percentage(numerator: Column, denominator: Column, digits: int = 1) -> Column:
    return rounded_ratio(numerator, denominator, digits, 100)
