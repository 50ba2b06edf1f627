"""The model graph: raw tables to staging views to marts, and where each is published."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

from ledgermill.operators import cdc, governance, marts, mortgages, staging


@dataclass(frozen=True)
class Raw:
    """The raw layer as frames."""

    customers: DataFrame
    mortgages: DataFrame
    transactions: DataFrame


def staging_models(raw: Raw, role: str | None = None) -> dict[str, DataFrame]:
    """Staging views as ``role`` sees them.

    The customer table is masked where it is read, so names and phones are already hidden
    when they are cleaned, and stay hidden in every mart built from here.
    """
    return {
        "stg_customers": staging.stg_customers(governance.mask_customers(raw.customers, role)),
        "stg_transactions": staging.stg_transactions(raw.transactions),
        "stg_mortgages": staging.stg_mortgages(raw.mortgages),
    }


def customer_360(stg: dict[str, DataFrame]) -> DataFrame:
    return marts.customer_360(stg["stg_customers"], stg["stg_mortgages"], stg["stg_transactions"])


def mart_models(raw: Raw, stg: dict[str, DataFrame]) -> dict[str, DataFrame]:
    profile = customer_360(stg)
    return {
        "customer_360": profile,
        "customer_segments": marts.customer_segments(profile),
        "transaction_summary": marts.transaction_summary(stg["stg_transactions"]),
        "mortgage_base": mortgages.mortgage_base(raw.mortgages),
    }


CDC_VIEWS = {
    "cdc_parsed": cdc.cdc_parsed,
    "cdc_transactions": cdc.cdc_transactions,
    "cdc_as_transactions": cdc.cdc_as_transactions,
    "cdc_action_summary": cdc.cdc_action_summary,
    "cdc_transaction_types": cdc.cdc_transaction_types,
}


def register_cdc_views(landed: DataFrame) -> None:
    """The CDC views for use from SQL; each is evaluated when it is queried."""
    for name, view in CDC_VIEWS.items():
        view(landed).createOrReplaceTempView(name)


def register_views(
    spark: SparkSession, raw: Raw, landed: DataFrame | None = None, role: str | None = None
) -> None:
    """Everything as temporary views, so that all of it can be queried in SQL.

    ``customer_table`` follows the session variable ``reader_role``; staging and marts show
    what ``role`` may see.
    """
    raw.customers.createOrReplaceTempView("customer_table_unmasked")
    governance.masked_view(spark, "customer_table_unmasked", "customer_table")
    raw.mortgages.createOrReplaceTempView("mortgage_table")
    raw.transactions.createOrReplaceTempView("transactions_table")
    stg = staging_models(raw, role)
    for name, rows in {**stg, **mart_models(raw, stg)}.items():
        rows.createOrReplaceTempView(name)
    if landed is not None:
        landed.createOrReplaceTempView("cdc_streaming_table")
        register_cdc_views(landed)


def schema_for(custom: str | None, default: str) -> str:
    """A layer's own schema, trimmed and in upper case, or else the default one."""
    return default if custom is None else custom.strip().upper()


def publish(
    spark: SparkSession,
    raw: Raw,
    role: str | None = None,
    default_schema: str = "TRANSFORMED",
    mart_schema: str | None = "analytics",
    buckets: int | None = None,
) -> dict[str, str]:
    """Register staging as views and write the marts as tables; returns name to relation.

    The segments are built from the written customer 360, so the large join runs once. With
    ``buckets`` the customer 360 is bucketed by customer, and later joins and groupings by
    customer need not shuffle it. The transaction summary is laid out by month.
    """
    schema = schema_for(mart_schema, default_schema)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")

    published = {}
    stg = staging_models(raw, role)
    for name, rows in stg.items():
        rows.createOrReplaceTempView(name)
        published[name] = name

    def write(name: str, writer: DataFrameWriter) -> None:
        writer.mode("overwrite").saveAsTable(f"{schema}.{name}")
        published[name] = f"{schema}.{name}"

    profile = customer_360(stg)
    if buckets:
        by_customer = profile.repartition(buckets, "customer_id").write.bucketBy(buckets, "customer_id")
        write("customer_360", by_customer.sortBy("customer_id"))
    else:
        write("customer_360", profile.write)
    write("customer_segments", marts.customer_segments(spark.table(published["customer_360"])).write)
    summary = marts.transaction_summary(stg["stg_transactions"]).hint("rebalance", "transaction_month")
    write("transaction_summary", summary.write.partitionBy("transaction_month"))
    write("mortgage_base", mortgages.mortgage_base(raw.mortgages).write)
    return published
