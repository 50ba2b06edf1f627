"""Dashboard queries. Aggregation stays in Spark; callers collect only the small results."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ledgermill.functions import fixed
from ledgermill.operators.ordering import newest


def _days_before(as_of: dt.date, days: int):
    return F.date_sub(F.lit(as_of).cast("date"), days)


def chosen_transactions(
    transactions: DataFrame,
    as_of: dt.date,
    days_back: int | str = "Last 30 Days",
    types: list[str] = fixed.DEFAULT_TYPES,
) -> DataFrame:
    """All staged transactions of the chosen types and period; no type chosen, no rows.

    The period is a number of days or the name of one of ``fixed.PERIODS``. Staged types are
    upper case, so the choice is compared in upper case too.
    """
    days_back = fixed.PERIODS.get(days_back, days_back)
    return transactions.where(
        (F.col("transaction_date") >= _days_before(as_of, days_back))
        & F.col("transaction_type").isin([t.strip().upper() for t in types])
    ).select(
        "transaction_id",
        "customer_id",
        "transaction_type",
        F.col("transaction_amount").alias("amount"),
        "transaction_date",
        F.col("data_source").alias("description"),
    )


def dashboard_transactions(
    transactions: DataFrame,
    as_of: dt.date,
    days_back: int | str = "Last 30 Days",
    types: list[str] = fixed.DEFAULT_TYPES,
    rows: int = fixed.NEWEST_ROWS,
) -> DataFrame:
    """The newest of the chosen transactions, for a listing."""
    return recent_transactions(chosen_transactions(transactions, as_of, days_back, types), rows)


def volume_by_type(chosen: DataFrame) -> DataFrame:
    """Volume of the whole selection."""
    return chosen.groupBy("transaction_type").agg(F.sum("amount").alias("amount"))


def daily_trends(chosen: DataFrame) -> DataFrame:
    """Volume and transactions of every day of the whole selection."""
    return chosen.groupBy("transaction_date").agg(
        F.sum("amount").alias("amount"), F.count("transaction_id").alias("transaction_count")
    )


def recent_transactions(chosen: DataFrame, rows: int = fixed.RECENT_ROWS) -> DataFrame:
    return newest(chosen, "transaction_date", rows, [F.col("transaction_id").desc()])


def dashboard_summary(
    customer_360: DataFrame, transactions: DataFrame, as_of: dt.date, days_back: int = 30
) -> DataFrame:
    """Customers, active customers, volume and transactions of the last days, as one line.

    Only the days in question are read, and they are summed per customer before the join.
    """
    people = customer_360.groupBy("customer_id").agg(F.count("*").alias("copies"))
    recent = (
        transactions.where(F.col("transaction_date") >= _days_before(as_of, days_back))
        .groupBy("customer_id")
        .agg(
            F.count("transaction_id").alias("n"),
            F.sum("transaction_amount").alias("spent"),
            F.lit(True).alias("active"),
        )
    )
    copies = F.col("copies")
    spent = F.coalesce(F.col("spent"), F.lit(0)).cast("decimal(38,2)") * copies
    return people.join(recent, "customer_id", "left").agg(
        F.count("customer_id").alias("total_customers"),
        F.count(F.when(F.col("active"), F.col("customer_id"))).alias("active_customers_30d"),
        F.sum(spent).cast("decimal(38,2)").alias("total_volume_30d"),
        F.coalesce(F.sum(F.coalesce(F.col("n"), F.lit(0)) * copies), F.lit(0)).alias("total_transactions_30d"),
    )
