"""Declared shapes of the raw layer."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)


def _fields(*pairs: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in pairs])


# the mortgage CSV is positional: this order is the file's column order
MORTGAGE_FILE = _fields(
    ("week_start_date", T.DateType()),
    ("week", T.IntegerType()),
    ("loan_id", T.StringType()),
    ("ts", T.StringType()),
    ("loan_type_name", T.StringType()),
    ("loan_purpose_name", T.StringType()),
    ("applicant_income_000s", MONEY),
    ("loan_amount_000s", MONEY),
    ("county_name", T.StringType()),
    ("mortgageresponse", T.IntegerType()),
)

MORTGAGES = T.StructType(
    [T.StructField("loan_record_id", T.LongType(), True)]
    + list(MORTGAGE_FILE.fields)
    + [T.StructField("created_at", T.TimestampType(), True)]
)

CUSTOMER_FILE = _fields(
    ("customer_id", T.LongType()),
    ("first_name", T.StringType()),
    ("last_name", T.StringType()),
    ("phone_number", T.StringType()),
    ("loan_record_id", T.LongType()),
)

CUSTOMERS = _fields(
    ("customer_id", T.LongType()),
    ("loan_record_id", T.LongType()),
    ("first_name", T.StringType()),
    ("last_name", T.StringType()),
    ("phone_number", T.StringType()),
    ("created_at", T.TimestampType()),
)

TRANSACTION_FILE = _fields(
    ("transaction_id", T.LongType()),
    ("customer_id", T.LongType()),
    ("transaction_date", T.DateType()),
    ("transaction_amount", MONEY),
    ("transaction_type", T.StringType()),
    ("data_source", T.StringType()),
)

TRANSACTIONS = T.StructType(
    list(TRANSACTION_FILE.fields)
    + [
        T.StructField("ingestion_timestamp", T.TimestampType(), True),
        T.StructField("created_at", T.TimestampType(), True),
    ]
)

# the live feed carries a generator flag that is counted but never stored
TRANSACTION_FEED = T.StructType(
    list(TRANSACTION_FILE.fields[:5]) + [T.StructField("is_anomaly", T.BooleanType(), True)]
)
