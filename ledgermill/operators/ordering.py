"""Total order over a whole table without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgermill.session import remove, scratch

_ROWS_PER_SLOT = 33  # monotonically_increasing_id keeps the row's place in its low 33 bits


def with_position(df: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """Add each row's place (from 0, without gaps) in the order given.

    The rows are numbered as they arrive and written to the shared folder, then range-
    partitioned, sorted, tagged with partition and place, and written again. What remains is
    a running sum over one row per range partition, which is broadcast; its size is the
    number of partitions, whatever the data.

    The arrival number, last in the order, makes copies of one row distinct, so a group of
    copies spreads over partitions as well. It is written before it is used because a second
    evaluation may see the rows in another order; so the input, costly or not, is evaluated
    once although range partitioning reads twice, and a lost executor changes nothing. The
    tags are written because the range bounds are sampled anew by every evaluation. The first
    copy is removed once the second is there.
    """
    spark = df.sparkSession
    arrival, slot = f"__{name}_arrival", f"__{name}_slot"
    keys = [*order, F.col(arrival)]
    arrived, path = scratch(spark, "arrived"), scratch(spark, "position")
    df.withColumn(arrival, F.monotonically_increasing_id()).write.parquet(arrived)
    (
        spark.read.parquet(arrived)
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .drop(arrival)
        .withColumn(slot, F.monotonically_increasing_id())
        .write.parquet(path)
    )
    remove(spark, arrived)
    stored = spark.read.parquet(path)
    part = F.shiftright(slot, _ROWS_PER_SLOT).alias("__part")
    sizes = stored.groupBy(part).agg(F.count("*").alias("__rows"))
    running = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__part", F.coalesce(F.sum("__rows").over(running), F.lit(0)).alias("__start"))
    place = F.col(slot).bitwiseAND(F.lit((1 << _ROWS_PER_SLOT) - 1))
    return (
        stored.withColumn("__part", part)
        .join(F.broadcast(starts), "__part")
        .withColumn(name, F.col("__start") + place)
        .drop("__part", "__start", slot)
    )


def newest(df: DataFrame, day: str, rows: int, tie: list[Column]) -> DataFrame:
    """The ``rows`` newest rows by ``day``, newest first; equal days in the order of ``tie``.

    Rows per day are counted first. Days older than the one in which the count is reached
    cannot contribute, so the second pass reads only what is at least as new. Of that, every
    task keeps its own top rows, groups of about the root of the number of tasks keep theirs,
    and only one top list per group meets in the last task.
    """
    per_day = df.groupBy(day).agg(F.count("*").alias("__n"))
    newer = Window.orderBy(F.col(day).desc()).rowsBetween(Window.unboundedPreceding, -1)
    needed = per_day.where(F.col(day).isNotNull()).select(
        day, F.coalesce(F.sum("__n").over(newer), F.lit(0)).alias("__before")
    )
    oldest = needed.where(F.col("__before") < rows).agg(F.min(day).alias("oldest"))
    order = [F.col(day).desc(), *tie]
    groups = max(1, round(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) ** 0.5))
    in_group = Window.partitionBy("__group").orderBy(*order)
    return (
        df.where(F.col(day) >= oldest.scalar())
        .withColumn("__group", F.pmod(F.spark_partition_id(), F.lit(groups)))
        .withColumn("__rank", F.row_number().over(in_group))
        .where(F.col("__rank") <= rows)
        .drop("__group", "__rank")
        .orderBy(*order)
        .limit(rows)
    )
