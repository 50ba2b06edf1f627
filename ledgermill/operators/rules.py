"""Checks of stored data against the rules by which feeds are produced."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgermill.functions import fixed, money


def type_rules(transactions: DataFrame) -> DataFrame:
    """The fixed table of types; ten rows, so it may be broadcast."""
    return transactions.sparkSession.createDataFrame(
        fixed.TYPE_RULES, "transaction_type string, expected_percent int, lowest int, highest int"
    )


def amount_band_check(transactions: DataFrame) -> DataFrame:
    """Each transaction against the usual amounts of its type."""
    rules = F.broadcast(type_rules(transactions).drop("expected_percent"))
    amount = F.col("transaction_amount")
    verdict = (
        F.when(F.col("lowest").isNull(), "UNKNOWN_TYPE")
        .when(amount.between(F.col("lowest"), F.col("highest")), "IN_RANGE")
        .when(amount.between(fixed.ANOMALY_LOW, fixed.ANOMALY_HIGH), "ANOMALY_BAND")
        .otherwise("OUT_OF_RANGE")
    )
    return transactions.join(rules, "transaction_type", "left").select(
        "transaction_id", "transaction_type", "transaction_amount", verdict.alias("verdict")
    )


def type_mix(transactions: DataFrame) -> DataFrame:
    """Share of each type next to the expected one; expected types appear even if unseen."""
    seen = transactions.groupBy("transaction_type").agg(F.count("*").alias("n"))
    expected = type_rules(transactions).select("transaction_type", "expected_percent")
    both = (
        seen.withColumn("expected_percent", F.lit(None).cast("int"))
        .unionByName(expected.withColumn("n", F.lit(0).cast("bigint")))
        .groupBy("transaction_type")
        .agg(F.sum("n").alias("transaction_count"), F.max("expected_percent").alias("expected_percent"))
    )
    total = seen.agg(F.sum("n").alias("total")).scalar()
    return both.withColumn("actual_percent", money.percent(F.col("transaction_count"), total, 4))


def daily_volume_check(transactions: DataFrame, target: int = fixed.DAILY_TARGET) -> DataFrame:
    """Rows per day against the band for working days or weekends.

    Every day from the first to the last is reported; a day without rows has none. Rows
    without a date are a line of their own, as before.
    """
    low, high = target // 2, target * 2
    weekend_low, weekend_high = int(low * fixed.WEEKEND_FACTOR), int(high * fixed.WEEKEND_FACTOR)
    weekend = F.dayofweek("transaction_date").isin(1, 7)
    per_day = transactions.groupBy("transaction_date").agg(F.count("*").alias("transaction_count"))
    period = per_day.agg(F.min("transaction_date").alias("first"), F.max("transaction_date").alias("last"))
    calendar = period.where("first IS NOT NULL").select(
        F.explode(F.sequence("first", "last")).alias("transaction_date"), F.lit(0).cast("bigint").alias("transaction_count")
    )
    return (
        per_day.unionByName(calendar)
        .groupBy("transaction_date")
        .agg(F.sum("transaction_count").alias("transaction_count"))
        .select(
            "transaction_date",
            "transaction_count",
            weekend.alias("is_weekend"),
            F.when(weekend, weekend_low).otherwise(low).alias("expected_low"),
            F.when(weekend, weekend_high).otherwise(high).alias("expected_high"),
        )
        .withColumn("in_band", F.col("transaction_count").between(F.col("expected_low"), F.col("expected_high")))
    )


def loan_link_check(
    customers: DataFrame,
    offset: int = fixed.LOAN_ID_OFFSET,
    last_with_loan: int = fixed.LAST_CUSTOMER_WITH_LOAN,
) -> DataFrame:
    """Customers whose loan id is not the one their own id implies."""
    implied = F.when(F.col("customer_id") <= last_with_loan, F.col("customer_id") - offset)
    return (
        customers.select("customer_id", "loan_record_id", implied.alias("implied_loan_record_id"))
        .where(~F.col("loan_record_id").eqNullSafe(F.col("implied_loan_record_id")))
    )
