"""Exact money arithmetic as JVM-side column expressions.

A price is taken at six decimals, as whole millionths (bigint); amounts are summed as
whole numbers and rounded once, half-up, at the end.  Sums are thus independent of the
order of rows, and a ratio's rounding is an exact integer division.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000
_WHOLE = "decimal(38,0)"


def to_cents(amount: Column | str) -> Column:
    """Two-decimal amount → whole cents (bigint)."""
    return F.round(_col(amount) * 100).cast("bigint")


def cents_to_amount(cents: Column | str) -> Column:
    """Whole cents → double amount (``cast(x as double) / 100``)."""
    return _col(cents).cast("double") / 100


def to_micros(amount: Column | str) -> Column:
    """Amount → whole millionths (bigint); more than six decimals are rounded half-up."""
    return F.round(_col(amount) * MICROS).cast("bigint")


def micros_to_amount(micros: Column | str) -> Column:
    """Whole millionths → double amount."""
    return _col(micros).cast("double") / MICROS


def exact_sum(micros: Column | str) -> Column:
    """Sum of bigints as ``decimal(38,0)``: whole units and the rest are summed as bigints on
    their own, so neither a large table nor a slow decimal buffer is a concern."""
    m, unit = _col(micros), F.lit(MICROS).cast("bigint")
    return F.sum(F.call_function("div", m, unit)).cast(_WHOLE) * F.lit(MICROS).cast(_WHOLE) + F.sum(m % unit).cast(_WHOLE)


def rounded_amount(micros: Column | str) -> Column:
    """Summed millionths → amount rounded half-up to cents, as a double."""
    return rounded_ratio(micros, F.lit(1))


def rounded_ratio(micros: Column | str, count: Column | str) -> Column:
    """Summed millionths / count, rounded half-up to cents, as a double."""
    return cents_to_amount(half_up_div(_col(micros).cast(_WHOLE), _col(count).cast(_WHOLE) * (MICROS // 100)))


def half_up_div(num: Column | str, den: Column | str) -> Column:
    """``round(num / den)`` half-up for non-negative whole numbers, exactly: (2n + d) div 2d.

    SQL ``div`` is exact at any size; a decimal quotient would be rounded to a few digits."""
    n, d = _col(num).cast(_WHOLE), _col(den).cast(_WHOLE)
    return F.call_function("div", 2 * n + d, 2 * d).cast("bigint")


def half_up_ratio_amount(cents: Column | str, count: Column | str) -> Column:
    """Average in cents rounded half-up, returned as a two-decimal double amount."""
    return cents_to_amount(half_up_div(cents, count))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
