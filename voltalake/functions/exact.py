"""Sums of doubles that hardly depend on the order of the rows.

A plain sum of doubles changes in its last digits with the partitioning, and
with it the rounded total. Here each value is split: its DECIMAL(28,6) form is
added exactly, and what that form leaves over is added as a double beside it.
Amounts of up to six decimals leave nothing over. Values without a decimal form
(infinite, not a number, 1e22 and above) are added as doubles whole, so no
digit of any value is left out.

Decimals take their time, so amounts of whole cents are added as integers, which
gives the same total: below ``CENTS_BELOW`` half a unit in a double's last place is
less than half a millionth, and the nearest DECIMAL(28,6) is the one of the cents.
Upper and lower bits are added apart, so that no sum of cents overflows.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT_TYPE = "decimal(28,6)"
TOTAL_TYPE = "decimal(38,6)"
CENTS_BELOW = 1e9
LOW_BITS = 20


def decimal_part(value: Column) -> Column:
    return value.try_cast(EXACT_TYPE)


def double_part(value: Column) -> Column:
    """What the decimal part leaves over: the value itself where it has none."""
    return F.coalesce(value - decimal_part(value).cast("double"), value)


def joined_total(decimals: Column, doubles: Column) -> Column:
    """One double out of the two partial sums; NULL when both are."""
    as_double = decimals.cast("double")
    return F.coalesce(as_double + doubles, as_double, doubles)


def _cents(value: Column) -> tuple[Column, Column]:
    """The value in cents, and whether it has whole ones; NULL has not."""
    cents = F.rint(value * 100)
    whole = (F.abs(value) < CENTS_BELOW) & (cents / 100 == value)
    return cents.try_cast("bigint"), F.coalesce(whole, F.lit(False))


def decimal_total(value: Column) -> Column:
    """Sum of the decimal parts."""
    cents, whole = _cents(value)
    high = F.sum(F.when(whole, F.shiftright(cents, LOW_BITS))).cast("decimal(20,0)")
    low = F.sum(F.when(whole, cents.bitwiseAND((1 << LOW_BITS) - 1))).cast("decimal(20,0)")
    of_cents = (high * F.lit(Decimal(1 << LOW_BITS)) + low) * F.lit(Decimal("0.01"))
    of_cents = of_cents.cast(TOTAL_TYPE)
    others = F.sum(F.when(~whole, decimal_part(value)))
    return F.coalesce((of_cents + others).cast(TOTAL_TYPE), of_cents, others)


def double_total(value: Column) -> Column:
    """Sum of what the decimal parts leave over: nothing by whole cents."""
    _, whole = _cents(value)
    return F.sum(F.when(whole, 0.0).otherwise(double_part(value)))


def exact_sum(value: Column) -> Column:
    return joined_total(decimal_total(value), double_total(value))


def exact_avg(value: Column) -> Column:
    return F.try_divide(exact_sum(value), F.count(value))
