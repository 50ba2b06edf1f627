"""Masked customers, pseudonymised keys and the access report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgermill.functions import fixed, masking


def mask_customers(customers: DataFrame, role: str | None = None) -> DataFrame:
    """Customers as ``role`` may see them; without a role everything personal is hidden."""
    return customers.withColumns(
        {
            "last_name": masking.last_name("last_name", role),
            "phone_number": masking.phone("phone_number", role),
        }
    )


def masked_view(spark: SparkSession, table: str, view: str, variable: str = "reader_role") -> None:
    """A temporary SQL view of ``table`` that follows the session variable ``variable``.

    ``SET VAR reader_role = 'data_steward'`` changes what later queries of the view show.
    """
    spark.sql(f"DECLARE OR REPLACE VARIABLE {variable} STRING DEFAULT ''")
    steward = f"coalesce(upper({variable}) = '{fixed.STEWARD_ROLE}', false)"
    shown = {
        "last_name": f"if({steward}, last_name, '{fixed.HIDDEN_NAME}')",
        "phone_number": f"if({steward}, phone_number, '{fixed.HIDDEN_PHONE_PREFIX}' || right(phone_number, 4))",
    }
    columns = ", ".join(f"{shown[c]} AS {c}" if c in shown else c for c in spark.table(table).columns)
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {view} AS SELECT {columns} FROM {table}")


def masked_preview(
    customers: DataFrame, role: str | None = None, rows: int = fixed.PREVIEW_ROWS
) -> DataFrame:
    """First customers as shown to ``role``, and whether masking is at work."""
    return (
        mask_customers(customers, role)
        .orderBy("customer_id")
        .limit(rows)
        .select(
            "customer_id",
            "first_name",
            "last_name",
            "phone_number",
            F.lit("Standard").alias("customer_tier"),
            F.coalesce(F.col("last_name") == fixed.HIDDEN_NAME, F.lit(False)).alias("masking_active"),
        )
    )


def pseudonymise(
    rows: DataFrame, column: str, salt: str, key: bytes | None = None
) -> DataFrame:
    """Replace an id by a salted hash; with an AES key also keep an encrypted copy.

    The hash is stable for one salt. The encryption uses a random vector per row, so equal
    ids give different texts.
    """
    plain = F.col(column).cast("string")
    hidden = {f"{column}_tokenized": F.sha2(F.concat(F.lit(salt), plain), 256)}
    if key is not None:
        hidden[f"{column}_encrypted"] = F.base64(F.aes_encrypt(plain, F.lit(key), F.lit("GCM")))
    return rows.withColumns(hidden).drop(column)


def access_audit(access_log: DataFrame) -> DataFrame:
    """Who ran what against which objects: by user, newest query first."""
    return access_log.select(
        "user_name",
        "query_id",
        "query_start_time",
        "direct_objects_accessed",
        "base_objects_accessed",
    ).orderBy("user_name", F.col("query_start_time").desc_nulls_first(), "query_id")
