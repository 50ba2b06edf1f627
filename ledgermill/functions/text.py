"""Text clean-up rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ledgermill.functions import fixed


def tidy(column: str) -> Column:
    """Upper case without surrounding spaces; tabs and line ends stay."""
    return F.upper(F.trim(column))


def digits_only(column: str) -> Column:
    return F.regexp_replace(column, "[^0-9]", "")


def is_blank(column: str) -> Column:
    """True for empty or space-only text; NULL is not blank."""
    return F.trim(column) == ""


def short_loan_type(column: str) -> Column:
    """Known long names shortened, case-sensitively, before upper-casing."""
    out = F.col(column)
    for long_name, short_name in fixed.LOAN_TYPE_NAMES.items():
        out = F.replace(out, F.lit(long_name), F.lit(short_name))
    return F.upper(F.trim(out))


def snake_purpose(column: str) -> Column:
    """Dashes, spaces and dots become underscores, outer spaces included."""
    return F.upper(F.trim(F.translate(F.col(column), "- .", "___")))


def bare_county(column: str) -> Column:
    return F.upper(F.trim(F.translate(F.col(column), "-_.", "")))
