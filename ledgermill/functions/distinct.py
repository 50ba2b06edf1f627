"""Exact distinct counts of ids that can be stored and added up: a bitmap for each bucket of ids.

A bucket holds 32,768 following ids, negative ones too, so its bitmap has 4 KiB whatever was counted. Bitmaps of the same
bucket merge by OR; the count is the sum over buckets. NULL ids lie in no bucket and are not counted.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def bucket(ids: str) -> Column:
    return F.bitmap_bucket_number(F.col(ids))


def bitmap(ids: str) -> Column:
    """Aggregate: the ids of one bucket."""
    return F.bitmap_construct_agg(F.bitmap_bit_position(F.col(ids)))


def merged(bitmaps: str) -> Column:
    """Aggregate: bitmaps of one bucket as one."""
    return F.bitmap_or_agg(F.col(bitmaps))


def count(bitmaps: str) -> Column:
    """Aggregate: ids in bitmaps of different buckets."""
    return F.coalesce(F.sum(F.bitmap_count(F.col(bitmaps))), F.lit(0))


def count_per(rows, keys: list[str], ids: str, name: str):
    """Distinct ids per key. What is shuffled is a bitmap for each key and bucket of every task, not the ids."""
    buckets = rows.withColumn("__bucket", bucket(ids)).groupBy(*keys, "__bucket").agg(bitmap(ids).alias("__ids"))
    return buckets.groupBy(*keys).agg(count("__ids").alias(name))
