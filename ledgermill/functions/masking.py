"""Role-dependent views of personal columns.

Masking shapes results; it is no access control where readers can open the files.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ledgermill.functions import fixed


def sees_personal_data(role: str | None) -> Column:
    return F.coalesce(F.upper(F.lit(role).cast("string")) == fixed.STEWARD_ROLE, F.lit(False))


def last_name(column: str, role: str | None) -> Column:
    """A NULL name is hidden too, so that its absence does not show."""
    return F.when(sees_personal_data(role), F.col(column)).otherwise(fixed.HIDDEN_NAME)


def phone(column: str, role: str | None) -> Column:
    """Only the last four characters; NULL stays NULL."""
    hidden = F.concat(F.lit(fixed.HIDDEN_PHONE_PREFIX), F.right(F.col(column), F.lit(4)))
    return F.when(sees_personal_data(role), F.col(column)).otherwise(hidden)
