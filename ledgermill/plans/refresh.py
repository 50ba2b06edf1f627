"""Marts kept up to date by changes instead of being built anew.

A change is a transaction's old image, its new image, or both. Old images count -1, new ones +1; their signed sums are added
to what is stored. Counts and totals need no more. What a sum cannot take back, the lowest and highest amount and the
last day, is looked up in the transactions again, but only for groups that lost a row as extreme as the stored value.

Three tables, each of which replaces only partitions that changes touch (``sources/versioned.py``):
- ``sums``: a row per customer, month, type and source, by month;
- ``spend``: a row per customer and month, by bucket of customers, so that a customer's months lie together;
- ``profiles``: the customer 360, by the same buckets.
A refresh reads the months and buckets of its changes. Customers and loans are taken from the stored profiles: when these
change, ``build`` again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgermill.functions import money
from ledgermill.operators import marts
from ledgermill.session import remove, scratch
from ledgermill.sources import versioned

BUCKETS = 64

GROUP = ["transaction_month", "customer_id", "transaction_type", "data_source"]
_SUMS = (
    "transaction_month date, customer_id bigint, transaction_type string, data_source string, rows bigint, ids bigint, amounts bigint, "
    "total decimal(38,2), high bigint, medium bigint, low bigint, lowest decimal(10,2), highest decimal(10,2), last_day date"
)
_SPEND = "customer_id bigint, transaction_month date, rows bigint, ids bigint, amounts bigint, total decimal(38,2), last_day date, bucket int"
_ADDED = ["rows", "ids", "amounts", "total", "high", "medium", "low"]


def bucket_of(customer: str, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(customer), F.lit(buckets)).cast("int")


def _measures(sign: Column) -> list[Column]:
    amount, band = F.col("transaction_amount"), F.col("amount_category")
    some = lambda there: F.sum(F.when(there, sign).otherwise(0))
    return [
        F.sum(sign).alias("rows"),
        some(F.col("transaction_id").isNotNull()).alias("ids"),
        some(amount.isNotNull()).alias("amounts"),
        F.sum(amount * sign.cast("decimal(1,0)")).cast("decimal(38,2)").alias("total"),
        some(band == "High").alias("high"),
        some(band == "Medium").alias("medium"),
        some(band == "Low").alias("low"),
    ]


def _extremes(prefix: str, among: Column) -> list[Column]:
    amount, day = F.when(among, F.col("transaction_amount")), F.when(among, F.col("transaction_date"))
    return [F.min(amount).alias(f"{prefix}lowest"), F.max(amount).alias(f"{prefix}highest"), F.max(day).alias(f"{prefix}last_day")]


def sums_of(transactions: DataFrame) -> DataFrame:
    """The sums of staged transactions."""
    return transactions.groupBy(*GROUP).agg(*_measures(F.lit(1)), *_extremes("", F.lit(True)))


def signed(changes: DataFrame) -> DataFrame:
    """Staged images with ``sign``. changes: structs ``old`` and ``new`` in the columns of staged transactions, either may be NULL."""
    images = [F.struct(F.lit(s).alias("sign"), F.col(side).alias("image")) for s, side in ((-1, "old"), (1, "new"))]
    return changes.select(F.inline(F.array(*images))).where("image IS NOT NULL").select("sign", "image.*")


def _deltas(images: DataFrame) -> DataFrame:
    sign = F.col("sign")
    return images.groupBy(*GROUP).agg(*_measures(sign), *_extremes("new_", sign > 0), *_extremes("old_", sign < 0))


def _same_group(a: str, b: str) -> Column:
    test = F.lit(True)
    for c in GROUP:
        test = test & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return test


def changed_sums(stored: DataFrame, deltas: DataFrame, transactions: DataFrame) -> DataFrame:
    """All sums of the stored months after the changes. transactions: those months after the changes, staged."""
    zero = lambda c: F.coalesce(c, F.lit(0))
    both = stored.alias("s").join(deltas.alias("d"), _same_group("s", "d"), "full_outer")
    lost = {
        "lowest": F.col("d.old_lowest") <= F.col("s.lowest"),
        "highest": F.col("d.old_highest") >= F.col("s.highest"),
        "last_day": F.col("d.old_last_day") >= F.col("s.last_day"),
    }
    again = F.lit(False)
    for test in lost.values():
        again = again | F.coalesce(test, F.lit(False))
    added = both.select(
        *[F.coalesce(f"s.{c}", f"d.{c}").alias(c) for c in GROUP],
        *[(zero(F.col(f"s.{c}")) + zero(F.col(f"d.{c}"))).cast("decimal(38,2)" if c == "total" else "bigint").alias(c) for c in _ADDED],
        F.least("s.lowest", "d.new_lowest").alias("lowest"),
        F.greatest("s.highest", "d.new_highest").alias("highest"),
        F.greatest("s.last_day", "d.new_last_day").alias("last_day"),
        again.alias("again"),
    ).where("rows <> 0")
    # a sum without amounts is NULL, not 0
    added = added.withColumn("total", F.when(F.col("amounts") != 0, F.col("total")))
    suspects = added.where("again").select(*GROUP)
    found = transactions.alias("t").join(suspects.alias("g"), _same_group("t", "g"), "left_semi").groupBy(*GROUP).agg(*_extremes("true_", F.lit(True)))
    looked_up = added.where("again").alias("a").join(found.alias("f"), _same_group("a", "f"), "left")
    columns = [*GROUP, *_ADDED]
    right = looked_up.select(*[f"a.{c}" for c in columns], *[F.col(f"f.true_{c}").alias(c) for c in lost])
    return added.where("NOT again").select(*columns, *lost).unionByName(right)


def transaction_summary(sums: DataFrame) -> DataFrame:
    """The mart, as ``marts.transaction_summary`` builds it from all transactions."""
    mean = (F.col("total") / F.nullif(F.col("amounts"), F.lit(0))).cast("decimal(14,6)")
    return sums.select(
        *["customer_id", "transaction_month", "transaction_type", "data_source"],
        F.col("rows").alias("transaction_count"),
        F.col("total").cast("decimal(20,2)").alias("total_amount"),
        mean.alias("avg_amount"),
        F.col("lowest").alias("min_amount"),
        F.col("highest").alias("max_amount"),
        F.col("high").alias("high_value_count"),
        F.col("medium").alias("medium_value_count"),
        F.col("low").alias("low_value_count"),
    )


def _monthly(sums: DataFrame, buckets: int) -> DataFrame:
    measures = [F.sum(c).alias(c) for c in ("rows", "ids", "amounts", "total")]
    per_month = sums.groupBy("customer_id", "transaction_month").agg(*measures, F.max("last_day").alias("last_day"))
    return per_month.withColumn("bucket", bucket_of("customer_id", buckets))


def _spent(spend: DataFrame) -> DataFrame:
    """One row per customer, as ``marts.spend_per_customer`` gives it."""
    return spend.groupBy("customer_id").agg(
        F.sum("ids").alias("total_transactions"),
        F.sum("total").alias("total_spent"),
        (F.sum("total") / F.nullif(F.sum("amounts"), F.lit(0))).cast("decimal(14,6)").alias("avg_transaction"),
        F.max("last_day").alias("last_transaction_date"),
        F.count("transaction_month").alias("active_months"),
    )


_PROFILES = (
    "customer_id bigint, first_name string, last_name string, phone_clean string, has_mortgage boolean, loan_amount decimal(15,2), "
    "applicant_income decimal(15,2), debt_to_income_ratio decimal(13,2), loan_type string, county string, copies bigint, bucket int"
)


def build(stg: dict[str, DataFrame], path: str, buckets: int = BUCKETS) -> None:
    """Write all three tables from the staging views."""
    spark = stg["stg_transactions"].sparkSession
    version = 1 + versioned.last_version(spark, f"{path}/profiles")
    sums = sums_of(stg["stg_transactions"])
    profiles = marts.customer_profiles(stg["stg_customers"], stg["stg_mortgages"]).withColumn("bucket", bucket_of("customer_id", buckets))
    _write_all(sums, f"{path}/sums", "transaction_month", version)
    stored = versioned.read(spark, f"{path}/sums", _SUMS, "transaction_month")
    _write_all(_monthly(stored, buckets), f"{path}/spend", "bucket", version)
    _write_all(profiles, f"{path}/profiles", "bucket", version)


def _write_all(rows: DataFrame, path: str, key: str, version: int) -> None:
    spark = rows.sparkSession
    old = [p.rsplit("/", 2)[1].split("=", 1)[1] for p in versioned.partitions(spark, path, key)]
    versioned.replace(rows, path, key, [None if v == versioned.NULL else v for v in old], version)
    versioned.finish(spark, path, version)


def refresh(changes: DataFrame, transactions: DataFrame, path: str, buckets: int = BUCKETS) -> int:
    """Bring the tables up to date; returns the version.

    changes: see ``signed``; an image that stayed the same may be among them. transactions: all staged transactions after
    the changes, of which only months that changes touch are read. If a refresh fails, the same one may be run again: whatever
    it had finished is not applied twice.
    """
    spark = changes.sparkSession
    # every step below reads the changes, which may be a query of any size: they are worked out once
    aside = scratch(spark, "refresh-images")
    signed(changes).write.parquet(aside)
    images = spark.read.parquet(aside)
    sums, spend = f"{path}/sums", f"{path}/spend"
    version = 1 + versioned.last_version(spark, spend)
    if versioned.last_version(spark, sums) < version:
        months = [r[0] for r in images.select("transaction_month").distinct().collect()]  # as many as the calendar has
        stored = versioned.read(spark, sums, _SUMS, "transaction_month", months)
        touched = F.col("transaction_month").isin([m for m in months if m is not None])
        if None in months:
            touched = touched | F.col("transaction_month").isNull()
        fresh = changed_sums(stored, _deltas(images), transactions.where(touched))
        versioned.replace(fresh, sums, "transaction_month", months, version)
        versioned.finish(spark, sums, version)
    keys = images.select("customer_id", "transaction_month").distinct()
    numbers = [r[0] for r in keys.select(bucket_of("customer_id", buckets)).distinct().collect()]
    months = [r[0] for r in keys.select("transaction_month").distinct().collect()]
    same = F.col("a.customer_id").eqNullSafe(F.col("k.customer_id")) & F.col("a.transaction_month").eqNullSafe(F.col("k.transaction_month"))
    stored = versioned.read(spark, spend, _SPEND, "bucket", numbers)
    kept = stored.alias("a").join(keys.alias("k"), same, "left_anti")
    now = _monthly(versioned.read(spark, sums, _SUMS, "transaction_month", months), buckets)
    moved = now.alias("a").join(keys.alias("k"), same, "left_semi").select(*stored.columns)
    versioned.replace(kept.unionByName(moved), spend, "bucket", numbers, version)
    versioned.finish(spark, spend, version)
    for table, key in ((sums, "transaction_month"), (spend, "bucket")):
        versioned.tidy(spark, table, key)
    remove(spark, aside)
    return version


def stored_summary(spark: SparkSession, path: str) -> DataFrame:
    """The transaction summary as of the last refresh."""
    return transaction_summary(versioned.read(spark, f"{path}/sums", _SUMS, "transaction_month"))


def stored_customer_360(spark: SparkSession, path: str, customers: list[int] | None = None, buckets: int = BUCKETS) -> DataFrame:
    """The customer 360 as of the last refresh, of all customers or of some, of whom only the buckets are read.

    Profiles and months of one customer lie in buckets of the same number."""
    numbers = None
    if customers is not None:
        ids = spark.createDataFrame([(c,) for c in customers], "customer_id bigint")
        numbers = [r[0] for r in ids.select(bucket_of("customer_id", buckets)).distinct().collect()]
    profiles = versioned.read(spark, f"{path}/profiles", _PROFILES, "bucket", numbers)
    spend = versioned.read(spark, f"{path}/spend", _SPEND, "bucket", numbers)
    if customers is not None:
        profiles, spend = (x.where(F.col("customer_id").isin(customers)) for x in (profiles, spend))
    return marts.with_spend(profiles.drop("bucket"), _spent(spend))
