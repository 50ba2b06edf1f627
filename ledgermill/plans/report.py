"""Plain column types at the edge, for comparison with another SQL engine."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T


def plain(rows: DataFrame) -> DataFrame:
    """Decimals as doubles, dates and times as text, arrays as JSON text.

    The amounts are exact until here; the conversion is the last step and the same on both
    sides, so equal decimals give equal doubles.
    """

    def shown(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return column.cast("string").alias(field.name)
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSS").alias(field.name)
        if isinstance(field.dataType, T.ArrayType):
            return F.to_json(column).alias(field.name)
        return column

    return rows.select(*[shown(field) for field in rows.schema.fields])
