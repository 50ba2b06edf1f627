"""Typed access to the parts of a CDC envelope held in one VARIANT column."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

RECORD = "record_content"

# first and last millisecond of the years 1 to 9999
COMMIT_RANGE = (-62_135_596_800_000, 253_402_300_799_999)

# a bare NUMBER has no decimals, so amounts read through it are whole units
WHOLE = "decimal(38,0)"
CENTS = "decimal(10,2)"

# name and type of the fields a before- or after-image may carry
IMAGE_FIELDS = [
    ("transaction_id_encrypted", "string"),
    ("customer_id", "bigint"),
    ("transaction_type", "string"),
    ("transaction_date", "date"),
    ("transaction_amount", CENTS),
    ("data_source", "string"),
]


class Envelope:
    """Columns read from the record. A missing path is NULL.

    A value of another type than asked for is an error, as in a SQL cast; a lenient reader
    gives NULL instead, so that one bad value cannot hold up a live query for good.
    """

    def __init__(self, lenient: bool = False):
        self._lenient = lenient
        self._get = F.try_variant_get if lenient else F.variant_get

    def part(self, path: str, kind: str = "string") -> Column:
        """One path with one type, to be named by the caller.

        The column notes its path as metadata of its own. Otherwise it would take over the
        marks Spark puts on paths read straight from files, and a struct of such columns,
        once written, would be mistaken for a record when it is read again.
        """
        return self._get(RECORD, f"$.{path}", kind).alias(path, metadata={"path": path})

    def commit(self, name: str, kind: str = "string") -> Column:
        return self.part(f"transaction.{name}", kind)

    def after(self, name: str, kind: str = "string") -> Column:
        return self.commit(f"record_after.{name}", kind)

    def before(self, name: str, kind: str = "string") -> Column:
        return self.commit(f"record_before.{name}", kind)

    def action(self) -> Column:
        return self.commit("action")

    def event_id(self) -> Column:
        return self.commit("transaction_id", "bigint")

    def row_key(self) -> Column:
        return self.commit("primaryKey_tokenized")

    def commit_ms(self) -> Column:
        """Commit time in milliseconds; a lenient reader gives NULL outside the years 1 to 9999."""
        stamp = self.commit("committed_at", "bigint")
        return F.when(stamp.between(*COMMIT_RANGE), stamp) if self._lenient else stamp

    def commit_time(self) -> Column:
        """Commit time with its milliseconds."""
        return F.timestamp_millis(self.commit_ms())


def image(read: Callable[[str, str], Column]) -> Column:
    """A whole before- or after-image; an empty one gives a struct of NULLs."""
    return F.struct(*[read(name, kind).alias(name) for name, kind in IMAGE_FIELDS])
