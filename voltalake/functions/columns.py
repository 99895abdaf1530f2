"""Scalar expressions of the cleaning and enrichment steps.

Raw text is typed with the ``try_`` functions, so a value that does not parse
becomes NULL with ANSI mode on, and no row is lost.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from voltalake import schemas as S


def tidy(text: Column) -> Column:
    """Without outer blanks (tabs stay)."""
    return F.trim(text)


def tidy_lower(text: Column) -> Column:
    return F.lower(tidy(text))


def tidy_upper(text: Column) -> Column:
    return F.upper(tidy(text))


def tidy_title(text: Column) -> Column:
    """First letter of each blank-separated word in upper case."""
    return F.initcap(tidy(text))


def number(text: Column) -> Column:
    return text.try_cast("double")


def flag(text: Column) -> Column:
    return text.try_cast("boolean")


def day(text: Column) -> Column:
    """ISO day; any other spelling is NULL."""
    return F.try_to_date(text, S.DAY_FORMAT)


def day_literal(value: str | date) -> Column:
    return F.lit(date.fromisoformat(str(value)))


def days_between(earlier: Column, later: Column) -> Column:
    return F.datediff(later, earlier)


def masked(identifier: Column) -> Column:
    """Mask plus the last characters; a short value shows in full."""
    return F.concat(F.lit(S.MASK), F.right(identifier, F.lit(S.MASK_TAIL)))


def volume_band(kwh: Column) -> Column:
    """Volume class; both ends of the middle class belong to it, NULL has none."""
    return (
        F.when(kwh < S.MEDIUM_FROM_KWH, S.SMALL)
        .when(kwh <= S.MEDIUM_TO_KWH, S.MEDIUM)
        .when(kwh.isNotNull(), S.LARGE)
    )


def rounded(value: Column) -> Column:
    """A double to two decimals as ``round`` has it, which asks for a decimal of each value.

    Where hundredths below a million millions are a thousandth or more from a half, no
    error of the product reaches it, and the nearest whole number is the same.
    """
    hundredths = value * 100
    whole = F.rint(hundredths)
    clear = (F.abs(hundredths) < 1e12) & (F.abs(hundredths - whole) < 0.499)
    # No negative zero.
    return F.when(clear, whole / 100 + 0.0).otherwise(F.round(value, 2))


def share_over(value: Column, base: Column) -> Column:
    """How far ``value`` lies above ``base``, in percent, not rounded."""
    return F.try_divide(value - base, base) * 100


def pct_over(value: Column, base: Column) -> Column:
    """How far ``value`` lies above ``base``, in percent; NULL over a zero base."""
    return F.round(share_over(value, base), 2)
