"""Number parsing, exact money sums and rounded ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_int(text: Column, kind: str = "int") -> Column:
    """Whole number or null; a plain decimal fraction is cut off (``12.0`` is 12)."""
    return F.coalesce(
        text.try_cast(kind),
        F.regexp_replace(text, r"^\s*([+-]?\d+)\.\d*\s*$", "$1").try_cast(kind),
    )


def to_double(text: Column) -> Column:
    """Finite number or null; ``NaN`` and infinities are no amounts."""
    value = text.try_cast("double")
    return F.when(F.abs(value) < F.lit(float("inf")), value)


# Six decimals and up to 18 whole digits; a sum of these has room for 10^10 of the largest.
EXACT = "decimal(24,6)"


def exact(amount: Column) -> Column:
    """Amount as a fixed-point number, whose sums are exact and order-free; null if it does not fit."""
    return amount.try_cast(EXACT)


def misfit(amount: Column) -> Column:
    """Whether an amount is there but too large to be summed exactly."""
    return amount.isNotNull() & exact(amount).isNull()


def money(exact_sum: Column) -> Column:
    return exact_sum.cast("double")


def ratio(part: Column, whole: Column, scale: float = 1.0) -> Column:
    """``scale * part / whole`` as a double; null when ``whole`` is zero or null."""
    return F.try_divide(part.cast("double") * F.lit(scale), whole.cast("double"))


def mean_money(exact_sum: Column, count: Column) -> Column:
    return ratio(money(exact_sum), count)


def display(number: Column, digits: int = 0) -> Column:
    """Grouped thousands as text. For showing only: such text does not sort as a number."""
    return F.format_number(number, digits)
