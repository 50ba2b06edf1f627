"""Mortgage numbering, latest-row selection and the model-ready mortgage table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ledgermill.functions import text
from ledgermill.operators.ordering import with_position


def number_mortgages(loaded: DataFrame) -> DataFrame:
    """Give loaded mortgages the key 1..n in order of loan id (as text) and week start.

    Ties are put in order by the remaining columns, so reruns agree.
    """
    rest = [c for c in loaded.columns if c not in ("loan_id", "week_start_date", "loan_record_id")]
    order = [F.col(c).asc_nulls_last() for c in ["loan_id", "week_start_date", *rest]]
    placed = with_position(loaded.drop("loan_record_id"), order, "loan_record_id")
    ids = (F.col("loan_record_id") + 1).alias("loan_record_id")
    return placed.select(ids, "loan_id", "week_start_date", *rest)


def latest_mortgages(mortgages: DataFrame) -> DataFrame:
    """The newest row per key; rows without a key are dropped.

    Spark keeps only the first row per key in every task before it shuffles, so a key with
    very many rows costs no more than any other.
    """
    rest = [c for c in mortgages.columns if c not in ("loan_record_id", "created_at")]
    newest_first = Window.partitionBy("loan_record_id").orderBy(
        F.col("created_at").desc_nulls_first(), *[F.col(c).asc_nulls_last() for c in rest]
    )
    return (
        mortgages.where(F.col("loan_record_id").isNotNull())
        .withColumn("__rank", F.row_number().over(newest_first))
        .where("__rank = 1")
        .drop("__rank")
    )


def mortgage_base(mortgages: DataFrame) -> DataFrame:
    """Latest mortgages with normalised type, purpose and county."""
    return latest_mortgages(mortgages).select(
        "loan_record_id",
        "loan_id",
        "week_start_date",
        "week",
        "ts",
        text.short_loan_type("loan_type_name").alias("loan_type_name"),
        text.snake_purpose("loan_purpose_name").alias("loan_purpose_name"),
        text.bare_county("county_name").alias("county_name"),
        "applicant_income_000s",
        "loan_amount_000s",
        "mortgageresponse",
        "created_at",
    )
