"""The live CDC feed: landing, monitoring, running summaries and current state."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgermill.functions import distinct, money
from ledgermill.functions.envelope import IMAGE_FIELDS
from ledgermill.operators import cdc
from ledgermill.sources import files
from ledgermill.streaming import sinks


def land(
    lines: DataFrame, path: str, rejects: str, checkpoint: str, trigger: dict | None = None
) -> list[StreamingQuery]:
    """Append every JSON line to the landing table and every other line to ``rejects``.

    The landing table is stored by commit day, so that monitoring reads recent days only; a
    record whose commit time cannot be one has no day and is kept apart under that. Two queries
    with a checkpoint each, and so two parses: both outputs get each of their lines exactly once.
    """
    return [
        sinks.append(
            files.with_commit_date(files.landed(lines)), path, f"{checkpoint}/landed", trigger, [files.COMMIT_DATE]
        ),
        sinks.append(files.rejected(lines), rejects, f"{checkpoint}/rejects", trigger),
    ]


def high_value(landed: DataFrame) -> DataFrame:
    return cdc.flag_high_value(cdc.cdc_transactions(landed, lenient=True))


def recent_activity(
    landed: DataFrame, lateness: str = "10 minutes", length: str = "1 hour", step: str = "5 minutes"
) -> DataFrame:
    """Events per action in sliding windows; a window appears once no more rows may come.

    Rows later than ``lateness`` are dropped, which bounds the state that is kept.
    """
    amount = F.col("transaction_amount")
    return (
        cdc.cdc_transactions(landed, lenient=True)
        .withWatermark("committed_timestamp", lateness)
        .groupBy(F.window("committed_timestamp", length, step), "cdc_action")
        .agg(
            F.count("*").alias("recent_transactions"),
            money.mean(F.sum(amount), F.count(amount)).alias("avg_amount"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "cdc_action",
            "recent_transactions",
            "avg_amount",
        )
    )


PARTIAL_KEY = ["cdc_action", "transaction_type", "id_bucket"]
PARTIAL_COLUMNS = (
    "cdc_action string, transaction_type string, id_bucket bigint, customers binary, events bigint, amounts bigint, "
    "total decimal(38,0), lowest decimal(38,0), highest decimal(38,0)"
)
VERSION_COLUMNS = (
    "row_key string, committed_ms bigint, event_id bigint, cdc_action string, image struct<"
    + ", ".join(f"{name}: {kind}" for name, kind in IMAGE_FIELDS)
    + ">"
)


def partial_sums(landed: DataFrame) -> DataFrame:
    """What the summaries need of one micro-batch: a row per action, type and bucket of customer ids.

    The ids of a bucket are one bitmap, so the rows are bounded by the range of ids and not by the customers seen.
    """
    amount = F.col("transaction_amount")
    return (
        cdc.cdc_transactions(landed, lenient=True)
        .withColumn("id_bucket", distinct.bucket("customer_id"))
        .groupBy(*PARTIAL_KEY)
        .agg(
            distinct.bitmap("customer_id").alias("customers"),
            F.count("*").alias("events"),
            F.count(amount).alias("amounts"),
            F.sum(amount).alias("total"),
            F.min(amount).alias("lowest"),
            F.max(amount).alias("highest"),
        )
    )


def merge_sums(sums: DataFrame) -> DataFrame:
    """Partial sums of several micro-batches as those of one."""
    return sums.groupBy(*PARTIAL_KEY).agg(
        distinct.merged("customers").alias("customers"),
        F.sum("events").alias("events"),
        F.sum("amounts").alias("amounts"),
        F.sum("total").alias("total"),
        F.min("lowest").alias("lowest"),
        F.max("highest").alias("highest"),
    )


def keep_partial_sums(
    landed: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append each micro-batch's partial sums.

    Exact distinct counts merge like sums when the ids are kept as bitmaps, so what is stored
    grows with the range of ids and not with the events.
    """
    return sinks.each_batch(landed, partial_sums, path, checkpoint, trigger)


def compact_sums(spark: SparkSession, path: str) -> dict[str, int] | None:
    return sinks.compact(sinks.read_log(spark, path, PARTIAL_COLUMNS), path, merge_sums)


def action_summary(spark: SparkSession, path: str) -> DataFrame:
    """Volume per action over all micro-batches so far."""
    buckets = (
        sinks.in_force(sinks.read_log(spark, path, PARTIAL_COLUMNS), path)
        .groupBy("cdc_action", "id_bucket")
        .agg(
            distinct.merged("customers").alias("customers"),
            F.sum("events").alias("events"),
            F.sum("amounts").alias("amounts"),
            F.sum("total").alias("total"),
        )
    )
    return buckets.groupBy("cdc_action").agg(
        F.sum("events").alias("transaction_count"),
        distinct.count("customers").alias("unique_customers"),
        money.mean(F.sum("total"), F.sum("amounts")).alias("avg_amount"),
        F.sum("total").alias("total_amount"),
    )


def type_summary(spark: SparkSession, path: str) -> DataFrame:
    """Insert events per type over all micro-batches so far."""
    return (
        sinks.in_force(sinks.read_log(spark, path, PARTIAL_COLUMNS), path)
        .where(F.col("cdc_action") == "INSERT")
        .groupBy("transaction_type", "cdc_action")
        .agg(
            F.sum("events").alias("count"),
            money.mean(F.sum("total"), F.sum("amounts")).alias("avg_amount"),
            F.min("lowest").alias("min_amount"),
            F.max("highest").alias("max_amount"),
        )
    )


#: lengths of time that sums are kept for, in milliseconds, the shortest first
GRAINS = {"moment": 1, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}
MOMENT_LAYOUT = ("grain", "day")
MOMENT_KEY = ["grain", "day", "start_ms", "cdc_action"]
MOMENT_COLUMNS = "start_ms bigint, cdc_action string, events bigint, amounts bigint, total decimal(38,0), grain string, day date"


def _start(at: Column, grain: str) -> Column:
    """First millisecond of the grain that ``at`` lies in; days are those of UTC."""
    length = F.lit(GRAINS[grain]).cast("bigint")
    return at - F.pmod(at, length)


def _day(at: Column) -> Column:
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(at / GRAINS["day"]).cast("int"))


def moment_sums(landed: DataFrame) -> DataFrame:
    """Events and amounts per action and moment, minute, hour and day of commit, laid out by grain and day."""
    amount, at = F.col("transaction_amount"), F.col("at")
    every = F.explode(F.array(*[F.struct(F.lit(g).alias("grain"), _start(at, g).alias("start_ms")) for g in GRAINS]))
    return (
        cdc.cdc_transactions(landed, lenient=True)
        .where("committed_timestamp IS NOT NULL")
        .select("cdc_action", "transaction_amount", F.unix_millis("committed_timestamp").alias("at"))
        .select("cdc_action", "transaction_amount", _day(at).alias("day"), every.alias("g"))
        .groupBy(F.col("g.grain").alias("grain"), "day", F.col("g.start_ms").alias("start_ms"), "cdc_action")
        .agg(F.count("*").alias("events"), F.count(amount).alias("amounts"), F.sum(amount).alias("total"))
    )


def merge_moments(sums: DataFrame) -> DataFrame:
    return sums.groupBy(*MOMENT_KEY).agg(
        F.sum("events").alias("events"), F.sum("amounts").alias("amounts"), F.sum("total").alias("total")
    )


def keep_moments(landed: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append each micro-batch's sums per length of time, for ``last_hours``. No event is too late to count."""
    return sinks.each_batch(landed, moment_sums, path, checkpoint, trigger, within=MOMENT_LAYOUT)


def compact_moments(spark: SparkSession, path: str, since: dt.datetime | None = None) -> dict[str, int] | None:
    """Fold the finished batches; moments before ``since`` are given up if it is named.

    Lengths of time that begin before it and end after it are given up as well, so that none is kept in part.
    """

    def fold(sums: DataFrame) -> DataFrame:
        kept = sums if since is None else sums.where(F.col("start_ms") >= F.unix_millis(cdc.moment(since)))
        return merge_moments(kept)

    return sinks.compact(sinks.read_log(spark, path, MOMENT_COLUMNS), path, fold, MOMENT_LAYOUT)


def _since(at: Column) -> Column:
    """Rows that together hold all moments from ``at`` on, each once.

    Whole days after its day, whole hours of that day after its hour, and so on; single moments
    are taken from its own minute alone. Grain and day are how the table is laid out, so other
    folders are not opened.
    """
    chosen = F.lit(False)
    names = list(GRAINS)
    for short, long in zip(names, [*names[1:], None], strict=True):
        rows = (F.col("grain") == short) & (F.col("start_ms") >= (at if short == names[0] else _start(at, short) + GRAINS[short]))
        if long:
            rows = rows & (F.col("start_ms") < _start(at, long) + GRAINS[long]) & (F.col("day") == _day(at))
        else:
            rows = rows & (F.col("day") > _day(at))
        chosen = chosen | rows
    return chosen


def last_hours(spark: SparkSession, path: str, as_of: dt.datetime, hours: int = 1) -> DataFrame:
    """Events per action of the last ``hours`` up to now, as ``cdc.cdc_recent_activity`` counts them."""
    since = F.unix_millis(cdc.moment(as_of) - F.make_dt_interval(hours=F.lit(hours)))
    return (
        sinks.in_force(sinks.read_log(spark, path, MOMENT_COLUMNS), path)
        .where(_since(since))
        .groupBy("cdc_action")
        .agg(F.sum("events").alias("recent_transactions"), money.mean(F.sum("total"), F.sum("amounts")).alias("avg_amount"))
    )


def keep_versions(
    landed: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append the last version per key of each micro-batch, deletes included.

    Nothing already written is touched, so a batch costs what it brings; keeping the deletes
    stops an event that arrives late from reviving a deleted row.
    """

    def last_versions(batch: DataFrame) -> DataFrame:
        return cdc.fold(cdc.versions(batch, lenient=True))

    return sinks.each_batch(landed, last_versions, path, checkpoint, trigger)


def compact_versions(spark: SparkSession, path: str) -> dict[str, int] | None:
    return sinks.compact(sinks.read_log(spark, path, VERSION_COLUMNS), path, cdc.fold)


def current_state(spark: SparkSession, path: str) -> DataFrame:
    return cdc.live_rows(cdc.fold(sinks.in_force(sinks.read_log(spark, path, VERSION_COLUMNS), path)))
