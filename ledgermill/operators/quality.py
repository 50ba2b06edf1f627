"""Data-quality metrics, key tests, load checks and profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ledgermill.functions import money, text


def blank_count(rows: DataFrame, column: str) -> DataFrame:
    return rows.agg(F.count_if(text.is_blank(column)).alias("blank_count"))


def blank_rows(rows: DataFrame, column: str) -> DataFrame:
    """The rows that ``blank_count`` counts."""
    return rows.where(text.is_blank(column))


METRIC_ROWS = {"blank_count": blank_rows}


def metric_scan(rows: DataFrame, metric: str, column: str) -> DataFrame:
    """Rows responsible for a metric's value, by metric name (case and prefix ignored)."""
    return METRIC_ROWS[metric.lower().rsplit(".", 1)[-1]](rows, column)


def repeated_values(rows: DataFrame, column: str) -> DataFrame:
    """Values occurring more than once, with their number; NULLs are not compared."""
    return (
        rows.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n_records"))
        .where("n_records > 1")
    )


def missing_values(rows: DataFrame, column: str) -> DataFrame:
    return rows.where(F.col(column).isNull())


KEY_TESTS = {"unique": repeated_values, "not_null": missing_values}

# model and key column that must be unique and present
TESTED_KEYS = [
    ("stg_customers", "customer_id"),
    ("stg_transactions", "transaction_id"),
    ("customer_360", "customer_id"),
]


def key_test_report(
    models: dict[str, DataFrame], test: str, keys: list[tuple[str, str]] = TESTED_KEYS
) -> DataFrame:
    """One row per tested key: number of failing values or rows, and the verdict."""
    reports = [
        KEY_TESTS[test](models[model], column).agg(
            F.lit(model).alias("model"),
            F.lit(column).alias("column_name"),
            F.lit(test).alias("test"),
            F.count("*").alias("failures"),
        )
        for model, column in keys
    ]
    return reduce(DataFrame.unionByName, reports).withColumn("passed", F.col("failures") == 0)


def raw_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, one line each, labelled with the table's name."""
    counts = [
        rows.agg(F.lit(name).alias("table_name"), F.count("*").alias("record_count"))
        for name, rows in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def customer_mortgage_check(customers: DataFrame, mortgages: DataFrame) -> DataFrame:
    """Distinct customers, linked loans and loans that exist, as one line.

    Loan ids are made distinct on both sides before they meet, so neither a shared loan id
    nor the many customers without one decides the size of a task.
    """
    linked = customers.where(F.col("loan_record_id").isNotNull()).select("loan_record_id").distinct()
    known = mortgages.select("loan_record_id").distinct()
    zero = F.lit(0).cast("bigint")
    parts = [
        customers.agg(
            F.count_distinct("customer_id").alias("a"), zero.alias("b"), zero.alias("c")
        ),
        linked.join(known.withColumn("known", F.lit(1)), "loan_record_id", "left").agg(
            zero.alias("a"), F.count("*").alias("b"), F.count("known").alias("c")
        ),
    ]
    return reduce(DataFrame.unionByName, parts).agg(
        F.lit("Customer-Mortgage Relationship").alias("validation"),
        F.sum("a").alias("total_customers"),
        F.sum("b").alias("customers_with_mortgages"),
        F.sum("c").alias("total_mortgage_records"),
    )


def source_profile(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy("data_source").agg(
        F.count("*").alias("record_count"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.min("transaction_date").alias("earliest_date"),
        F.max("transaction_date").alias("latest_date"),
    )


def load_summary(transactions: DataFrame) -> DataFrame:
    """Rows, amount and anomalies of a load that carries ``is_anomaly``; fine on no rows."""
    totals = transactions.agg(
        F.count("*").alias("total_transactions"),
        F.coalesce(F.sum(F.col("transaction_amount").cast("decimal(28,2)")), F.lit(0)).cast("decimal(38,2)").alias("total_amount"),
        F.count_if("is_anomaly").alias("anomalies"),
    )
    return totals.withColumn(
        "anomaly_percentage",
        F.coalesce(money.percent(F.col("anomalies"), F.col("total_transactions"), 1), F.lit(0)),
    )


def customer_file_profile(customers: DataFrame) -> DataFrame:
    return customers.agg(
        F.count("*").alias("total_customers"),
        F.count("loan_record_id").alias("with_mortgages"),
        F.count_if(F.col("loan_record_id").isNull()).alias("without_mortgages"),
        F.min("customer_id").alias("lowest_customer_id"),
        F.max("customer_id").alias("highest_customer_id"),
    )
