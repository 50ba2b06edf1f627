"""Amount rules as column expressions. Money stays decimal throughout."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ledgermill.functions import fixed


def amount_band(amount: str) -> Column:
    value = F.col(amount)
    return (
        F.when(value > fixed.HIGH_AMOUNT_OVER, "High")
        .when(value > fixed.MEDIUM_AMOUNT_OVER, "Medium")
        .otherwise("Low")
    )


def tier(spent: Column) -> Column:
    """Unknown spend (no transactions) falls to the lowest tier."""
    return (
        F.when(spent > fixed.PREMIUM_OVER, "Premium")
        .when(spent > fixed.STANDARD_OVER, "Standard")
        .otherwise("Basic")
    )


def segment(has_mortgage: Column, spent: Column) -> Column:
    with_loan = (
        F.when(spent > fixed.MORTGAGE_HIGH_OVER, "High Value Mortgage")
        .when(spent > fixed.MORTGAGE_STANDARD_OVER, "Standard Mortgage")
        .otherwise("Basic Mortgage")
    )
    without_loan = (
        F.when(spent > fixed.NO_MORTGAGE_HIGH_OVER, "High Value Non-Mortgage")
        .when(spent > fixed.NO_MORTGAGE_STANDARD_OVER, "Standard Non-Mortgage")
        .otherwise("Basic Non-Mortgage")
    )
    return F.when(has_mortgage, with_loan).otherwise(without_loan)


# totals beyond this have no exact mean in 38 digits; their mean is NULL
LARGEST_TOTAL = 10**29


def _quotient(units: Column, rows: Column, digits: int) -> Column:
    """``units / rows`` rounded half away from zero, then moved ``digits`` places to the right of the point.

    Both are whole numbers. Remainder and whole quotient are exact whatever the number of rows.
    """
    whole = units.cast("decimal(38,0)")
    by = F.when(rows > 0, rows).cast("decimal(20,0)")
    rest = whole % by
    full = ((whole - rest) / by).cast("decimal(38,0)")
    up = F.when(F.abs(rest) * 2 >= by, F.signum(whole.cast("double")).cast("int")).otherwise(0)
    return ((full + up) / F.lit(10**digits)).cast(f"decimal(38,{digits})")


def mean(total: Column, rows: Column, digits: int = 2) -> Column:
    """``total / rows`` with two or more digits, rounded half away from zero.

    NULL when there are no rows, and for a total of more than ``LARGEST_TOTAL``.
    """
    fits = F.abs(total) <= F.lit(str(LARGEST_TOTAL)).cast("decimal(30,0)")
    cents = F.when(fits, total).try_cast("decimal(38,2)")
    return _quotient(cents * 10**digits, rows, digits)


def percent(part: Column, whole: Column, digits: int) -> Column:
    """``100 * part / whole`` as an exact decimal; NULL when ``whole`` is 0."""
    return _quotient(part.cast("decimal(20,0)") * F.lit(100 * 10**digits), whole, digits)
