"""Marts: customer 360, segments and transaction summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgermill.functions import money

PERSON = ["customer_id", "first_name", "last_name", "phone_clean", "has_mortgage"]
LOAN = ["loan_amount", "applicant_income", "debt_to_income_ratio", "loan_type", "county"]


def spend_per_customer(transactions: DataFrame) -> DataFrame:
    """One row per customer. Partial sums per customer and month leave each task, not rows."""
    amount = F.col("transaction_amount")
    return transactions.groupBy("customer_id").agg(
        F.count("transaction_id").alias("total_transactions"),
        F.sum(amount).alias("total_spent"),
        F.avg(amount).alias("avg_transaction"),
        F.max("transaction_date").alias("last_transaction_date"),
        F.count_distinct("transaction_month").alias("active_months"),
    )


def customer_profiles(customers: DataFrame, mortgages: DataFrame) -> DataFrame:
    """Distinct customer-with-mortgage profiles and the number of join rows behind each.

    Customers without a loan id cannot match; they skip the join instead of meeting in the
    one partition that NULL keys hash to. Repeated mortgage rows are counted beforehand, so
    they never multiply rows. ``copies`` is what the full join would have repeated.
    """
    loans = (
        mortgages.where(F.col("loan_record_id").isNotNull())
        .groupBy("loan_record_id", *LOAN)
        .agg(F.count("*").alias("loan_copies"))
    )
    linked = customers.where(F.col("loan_record_id").isNotNull()).join(loans, "loan_record_id", "left")
    unlinked = customers.where(F.col("loan_record_id").isNull())
    people = linked.select(*PERSON, *LOAN, "loan_copies").unionByName(
        unlinked.select(*PERSON), allowMissingColumns=True
    )
    return people.groupBy(*PERSON, *LOAN).agg(
        F.sum(F.coalesce("loan_copies", F.lit(1))).alias("copies")
    )


def customer_360(customers: DataFrame, mortgages: DataFrame, transactions: DataFrame) -> DataFrame:
    """Profile, mortgage and spending of every customer, from the three staging views.

    Transactions are summed per customer before the join. The result equals joining first
    and grouping by the profile, also when a customer or mortgage occurs more than once:
    counts and sums scale with the copies, averages, maxima and distinct months do not.
    """
    return with_spend(customer_profiles(customers, mortgages), spend_per_customer(transactions))


def with_spend(profiles: DataFrame, spend: DataFrame) -> DataFrame:
    """Customer 360 of profiles and the spending of each customer."""
    copies = F.col("copies")
    spent = (F.col("total_spent").cast("decimal(38,2)") * copies).cast("decimal(38,2)")
    return profiles.join(spend, "customer_id", "left").select(
        *PERSON,
        *LOAN,
        (F.coalesce("total_transactions", F.lit(0)) * copies).alias("total_transactions"),
        spent.alias("total_spent"),
        "avg_transaction",
        "last_transaction_date",
        F.coalesce("active_months", F.lit(0)).alias("active_months"),
        money.tier(spent).alias("customer_tier"),
    )


def customer_segments(customer_360: DataFrame) -> DataFrame:
    holder = F.col("has_mortgage")
    return (
        customer_360.groupBy(money.segment(holder, F.col("total_spent")).alias("customer_segment"))
        .agg(
            F.count("*").alias("customer_count"),
            F.avg("total_spent").alias("avg_total_spent"),
            F.avg("total_transactions").alias("avg_total_transactions"),
            F.avg("avg_transaction").alias("avg_transaction_size"),
            F.count_if(holder).alias("mortgage_holders"),
        )
        .withColumn(
            "mortgage_percentage",
            money.percent(F.col("mortgage_holders"), F.col("customer_count"), 1),
        )
        .orderBy(F.col("avg_total_spent").desc_nulls_first())
    )


def transaction_summary(transactions: DataFrame) -> DataFrame:
    """Per customer, month, type and source: volume, amounts and rows per amount band."""
    amount = F.col("transaction_amount")
    band = F.col("amount_category")
    return transactions.groupBy(
        "customer_id", "transaction_month", "transaction_type", "data_source"
    ).agg(
        F.count("*").alias("transaction_count"),
        F.sum(amount).alias("total_amount"),
        F.avg(amount).alias("avg_amount"),
        F.min(amount).alias("min_amount"),
        F.max(amount).alias("max_amount"),
        F.count_if(band == "High").alias("high_value_count"),
        F.count_if(band == "Medium").alias("medium_value_count"),
        F.count_if(band == "Low").alias("low_value_count"),
    )
