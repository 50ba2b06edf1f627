"""Staging views: one row in, one row out, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgermill.functions import money, text


def stg_customers(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id",
        text.tidy("first_name").alias("first_name"),
        text.tidy("last_name").alias("last_name"),
        text.digits_only("phone_number").alias("phone_clean"),
        "loan_record_id",
        F.col("loan_record_id").isNotNull().alias("has_mortgage"),
        "created_at",
    )


def stg_transactions(transactions: DataFrame) -> DataFrame:
    return transactions.select(
        "transaction_id",
        "customer_id",
        "transaction_date",
        "transaction_amount",
        text.tidy("transaction_type").alias("transaction_type"),
        "data_source",
        # trunc keeps a DATE, date_trunc would give a timestamp
        F.trunc("transaction_date", "month").alias("transaction_month"),
        money.amount_band("transaction_amount").alias("amount_category"),
        "ingestion_timestamp",
        "created_at",
    )


def stg_mortgages(mortgages: DataFrame) -> DataFrame:
    income = F.col("applicant_income_000s")
    loan = F.col("loan_amount_000s")
    return mortgages.select(
        "loan_record_id",
        "loan_id",
        "week_start_date",
        "week",
        text.tidy("loan_type_name").alias("loan_type"),
        text.tidy("loan_purpose_name").alias("loan_purpose"),
        (income * 1000).alias("applicant_income"),
        (loan * 1000).alias("loan_amount"),
        text.tidy("county_name").alias("county"),
        F.col("mortgageresponse").alias("mortgage_approved"),
        # the name is historical: the value is loan over income
        F.round(loan / F.nullif(income, F.lit(0)), 2).alias("debt_to_income_ratio"),
        "created_at",
    )
