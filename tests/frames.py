"""Small inline tables in the shapes of the raw layer."""

import datetime as dt
import json
from decimal import Decimal

from pyspark.sql import functions as F

from ledgermill import schemas

NOW = dt.datetime(2024, 5, 1, 12, 0)


def money(text):
    return None if text is None else Decimal(text)


def customers(spark, *rows):
    """Rows of id, loan id, first name, last name, phone."""
    return spark.createDataFrame([(*row, NOW) for row in rows], schemas.CUSTOMERS)


def transactions(spark, *rows):
    """Rows of id, customer, date, amount, type, source; ingest time optional."""
    full = []
    for row in rows:
        tid, customer, day, amount, kind, source, *at = row
        day = dt.date.fromisoformat(day) if day else None
        full.append((tid, customer, day, money(amount), kind, source, at[0] if at else NOW, NOW))
    return spark.createDataFrame(full, schemas.TRANSACTIONS)


def mortgage(key, loan_id="1", week="2024-01-01", income="50", loan="200", kind="FHA-insured",
             purpose="Home purchase", county="Kings County", created=NOW):
    return (key, dt.date.fromisoformat(week), 1, loan_id, "t", kind, purpose, money(income), money(loan),
            county, 1, created)


def mortgages(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.MORTGAGES)


def envelope(number, action, key="K1", at=1_700_000_000_000, before=None, after=None, user="u1"):
    return json.dumps(
        {
            "object": "cdc_db_table_commit",
            "transaction": {
                "transaction_id": number, "schema": "S", "table": "T", "action": action,
                "primaryKey_tokenized": key, "dbuser": user, "committed_at": at,
                "record_before": before or {}, "record_after": after or {},
            },
        }
    )


class Raw(float):
    """A float written with the digits given."""

    def __new__(cls, text):
        made = super().__new__(cls, text)
        made.text = text
        return made

    def __repr__(self):
        return self.text


def image(amount, customer=7, kind="dining"):
    return {
        "transaction_id_encrypted": "e", "customer_id": customer, "transaction_type": kind,
        "transaction_date": "2024-05-01", "transaction_amount": None if amount is None else Raw(amount),
        "data_source": "STREAMING",
    }


def landed(spark, *lines):
    from ledgermill.sources import files

    return files.landed(spark.createDataFrame([(line,) for line in lines], "value string"))


def rows(df, *columns):
    """Rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def one(df):
    found = df.collect()
    assert len(found) == 1
    return found[0]


__all__ = [name for name in dir() if not name.startswith("_")] + ["F"]
