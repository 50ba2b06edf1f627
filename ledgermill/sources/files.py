"""Readers for the raw layer. A file that does not fit its declared shape stops the load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ledgermill import schemas
from ledgermill.functions import envelope as env


def as_text(schema: T.StructType) -> T.StructType:
    """The same fields as text, so that numbers and quoted numbers load alike."""
    return T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])


def cast_to(rows: DataFrame, schema: T.StructType) -> DataFrame:
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def _must_fit(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Stop at a row with a value that does not fit, whichever columns are read, also without ANSI."""
    checks = [
        F.when(
            F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(),
            F.raise_error(F.concat(F.lit(f"{f.name} does not fit: "), F.col(f.name))).cast("boolean"),
        ).otherwise(True)
        for f in schema.fields
    ]
    return rows.where(F.array_min(F.array(*checks)))


def load_mortgages_csv(spark: SparkSession, path: str) -> DataFrame:
    """Comma-separated mortgages: one header line, then ten columns taken by position."""
    raw = (
        spark.read.schema(as_text(schemas.MORTGAGE_FILE))
        .option("header", True)
        .option("enforceSchema", True)
        .option("mode", "FAILFAST")
        .csv(path)
    )
    loaded = cast_to(_must_fit(raw, schemas.MORTGAGE_FILE), schemas.MORTGAGE_FILE)
    return loaded.withColumn("created_at", F.current_timestamp())


def _json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    raw = spark.read.schema(as_text(schema)).option("mode", "FAILFAST").json(path)
    return cast_to(_must_fit(raw, schema), schema)


def load_transactions_json(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines transactions; both timestamps are the time of the load."""
    now = F.current_timestamp()
    return _json_lines(spark, path, schemas.TRANSACTION_FILE).withColumns(
        {"ingestion_timestamp": now, "created_at": now}
    )


def load_customers_json(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines customers; the loan id is absent for customers without a mortgage."""
    loaded = _json_lines(spark, path, schemas.CUSTOMER_FILE)
    return loaded.select(
        "customer_id",
        "loan_record_id",
        "first_name",
        "last_name",
        "phone_number",
        F.current_timestamp().alias("created_at"),
    )


def landed(lines: DataFrame) -> DataFrame:
    """The one-column landing table of all lines (column ``value``) that are JSON.

    A filter on the parsed value would make Spark parse every line twice, once to test it
    and once to keep it. Exploding a one-element array without its NULLs parses once, and
    later filters on the record do not parse again either.
    """
    record = F.array_compact(F.array(F.try_parse_json("value")))
    return lines.select(F.explode(record).alias(env.RECORD))


COMMIT_DATE = "commit_date"


def with_commit_date(records: DataFrame) -> DataFrame:
    """Landed records next to the day they were committed, by which they are stored."""
    committed = env.Envelope(lenient=True).commit_time()
    return records.withColumn(COMMIT_DATE, F.to_date(committed))


def committed_since(records: DataFrame, since: Column) -> DataFrame:
    """Leave out the stored days that lie before ``since``; records without days are all kept.

    A day is added, in case they were stored under another time zone.
    """
    if COMMIT_DATE not in records.columns:
        return records
    return records.where(F.col(COMMIT_DATE) >= F.date_sub(F.to_date(since), 1))


def rejected(lines: DataFrame) -> DataFrame:
    """The lines that are not JSON, kept as text."""
    return lines.where(F.try_parse_json("value").isNull()).select("value")


def load_cdc(spark: SparkSession, path: str) -> DataFrame:
    return landed(spark.read.text(path))
