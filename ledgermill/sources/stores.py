"""Writers: JSON lines, the transactions store, the open-format copy, and deletion by day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

STORE_LAYOUT = ["data_source", "ingest_date"]


def write_jsonl(transactions: DataFrame, path: str, data_source: str = "HISTORICAL") -> None:
    """Transactions as JSON lines: monitoring flag left out, source named."""
    (
        transactions.drop("is_anomaly")
        .withColumn("data_source", F.lit(data_source))
        .write.mode("overwrite")
        .json(path)
    )


def write_customers_jsonl(customers: DataFrame, path: str) -> None:
    """Customers as JSON lines; a missing loan id leaves its key out."""
    customers.write.mode("overwrite").option("ignoreNullFields", True).json(path)


def write_lakehouse_copy(customers: DataFrame, path: str, fmt: str = "parquet") -> None:
    """The customer table in an open format; any installed table format may be named."""
    customers.select(
        F.col("customer_id").cast("bigint"),
        F.col("loan_record_id").cast("bigint"),
        F.col("first_name").cast("string"),
        F.col("last_name").cast("string"),
        F.col("phone_number").cast("string"),
        "created_at",
    ).write.format(fmt).mode("overwrite").save(path)


def with_ingest_date(transactions: DataFrame) -> DataFrame:
    return transactions.withColumn("ingest_date", F.to_date("ingestion_timestamp"))


def create_transaction_store(transactions: DataFrame, table: str) -> None:
    """The transactions table, laid out by source and ingest day.

    ``rebalance`` gathers each day's rows into few files, and splits a day that holds a
    large part of all rows over several tasks. Files are sorted by transaction date, so
    that a query for some days skips most of each file. The table is a managed one, so that
    dropping a partition also deletes its files.
    """
    (
        with_ingest_date(transactions)
        .hint("rebalance", *STORE_LAYOUT)
        .sortWithinPartitions(*STORE_LAYOUT, "transaction_date")
        .write.mode("overwrite")
        .partitionBy(*STORE_LAYOUT)
        .saveAsTable(table)
    )


def is_streamed_on(day: dt.date):
    """NULL-safe: a row without ingest time is never deleted."""
    hit = (F.col("data_source") == "STREAMING") & (F.to_date("ingestion_timestamp") == F.lit(day))
    return F.coalesce(hit, F.lit(False))


def without_streaming_day(transactions: DataFrame, day: dt.date) -> DataFrame:
    """What a deletion of one streamed day would leave."""
    return transactions.where(~is_streamed_on(day))


def delete_streaming_rows(spark: SparkSession, table: str, day: dt.date | None = None) -> int:
    """Delete one day (today unless named) of streamed rows; returns how many they were.

    In the store's layout these rows are exactly one partition: it is dropped, no file is
    rewritten, and the count comes from that partition alone.
    """
    day = day or spark.sql("SELECT current_date()").first()[0]
    gone = spark.table(table).where(
        (F.col("data_source") == "STREAMING") & (F.col("ingest_date") == F.lit(day))
    ).count()
    spark.sql(
        f"ALTER TABLE {table} DROP IF EXISTS PARTITION "
        f"(data_source = 'STREAMING', ingest_date = DATE'{day.isoformat()}')"
    )
    return gone
