"""CDC events: parsed views, summaries, monitoring, current state and continuity.

Every function that takes ``landed`` expects the one-column landing table
(``record_content VARIANT``); only the paths a query names are read from it.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgermill.functions import envelope as env, fixed, money
from ledgermill.operators.ordering import with_position
from ledgermill.sources.files import committed_since


def cdc_parsed(landed: DataFrame, lenient: bool = False) -> DataFrame:
    """The envelope as fifteen columns, raw record included."""
    record = env.Envelope(lenient)
    return landed.select(
        record.part("object").alias("cdc_object_type"),
        record.event_id().alias("transaction_id"),
        record.action().alias("cdc_action"),
        record.commit("schema").alias("source_schema"),
        record.commit("table").alias("source_table"),
        record.commit("dbuser").alias("db_user"),
        record.commit_time().alias("committed_timestamp"),
        record.after("customer_id", "bigint").alias("customer_id"),
        record.after("transaction_type").alias("transaction_type"),
        record.after("transaction_amount", env.WHOLE).alias("transaction_amount"),
        record.after("transaction_date", "date").alias("transaction_date"),
        record.after("data_source").alias("data_source"),
        record.row_key().alias("primary_key_tokenized"),
        record.after("transaction_id_encrypted").alias("transaction_id_encrypted"),
        F.col(env.RECORD).alias("raw_json"),
    )


def cdc_transactions(landed: DataFrame, lenient: bool = False) -> DataFrame:
    """The eight columns most queries need, of events that name an action."""
    return (
        cdc_parsed(landed, lenient)
        .where(F.col("cdc_action").isNotNull())
        .select(
            "transaction_id",
            "cdc_action",
            "customer_id",
            "transaction_type",
            "transaction_amount",
            "transaction_date",
            "db_user",
            "committed_timestamp",
        )
    )


def cdc_as_transactions(landed: DataFrame) -> DataFrame:
    """Insert events in the shape of the transactions table; amounts keep their cents."""
    record = env.Envelope()
    committed = record.commit_time()
    return landed.where(record.action() == "INSERT").select(
        record.event_id().alias("transaction_id"),
        record.after("customer_id", "bigint").alias("customer_id"),
        record.after("transaction_date", "date").alias("transaction_date"),
        record.after("transaction_amount", env.CENTS).alias("transaction_amount"),
        record.after("transaction_type").alias("transaction_type"),
        record.after("data_source").alias("data_source"),
        committed.alias("ingestion_timestamp"),
        committed.alias("created_at"),
    )


def _mean_amount() -> Column:
    amount = F.col("transaction_amount")
    return money.mean(F.sum(amount), F.count(amount))


def cdc_action_summary(landed: DataFrame) -> DataFrame:
    """Volume per action. Deletes count as events but bring no customer and no amount."""
    amount = F.col("transaction_amount")
    return (
        cdc_transactions(landed)
        .groupBy("cdc_action")
        .agg(
            F.count("*").alias("transaction_count"),
            F.count_distinct("customer_id").alias("unique_customers"),
            _mean_amount().alias("avg_amount"),
            F.sum(amount).alias("total_amount"),
        )
        .orderBy(F.col("transaction_count").desc(), "cdc_action")
    )


def cdc_transaction_types(landed: DataFrame) -> DataFrame:
    """Insert events per transaction type, most frequent first."""
    amount = F.col("transaction_amount")
    return (
        cdc_transactions(landed)
        .where(F.col("cdc_action") == "INSERT")
        .groupBy("transaction_type", "cdc_action")
        .agg(
            F.count("*").alias("count"),
            _mean_amount().alias("avg_amount"),
            F.min(amount).alias("min_amount"),
            F.max(amount).alias("max_amount"),
        )
        .orderBy(F.col("count").desc(), "transaction_type")
    )


def cdc_top_types(landed: DataFrame, rows: int = 5) -> DataFrame:
    return cdc_transaction_types(landed).limit(rows)


def cdc_total(landed: DataFrame) -> DataFrame:
    return landed.agg(F.count("*").alias("total_cdc_records"))


def cdc_latest_rows(landed: DataFrame, rows: int = 10) -> DataFrame:
    """The events with the highest numbers; commit time settles equal numbers."""
    return (
        cdc_transactions(landed)
        .orderBy(F.col("transaction_id").desc(), F.col("committed_timestamp").desc(), "cdc_action")
        .limit(rows)
    )


def cdc_latest_inserts(landed: DataFrame, rows: int = 10) -> DataFrame:
    return (
        cdc_as_transactions(landed)
        .orderBy(F.col("transaction_id").desc(), F.col("created_at").desc(), "customer_id")
        .limit(rows)
    )


def moment(at: dt.datetime) -> Column:
    """A time without zone is one of the session's zone, not of the machine's."""
    return F.lit(at) if at.tzinfo else F.lit(at.isoformat(sep=" ")).cast("timestamp")


def cdc_recent_activity(landed: DataFrame, as_of: dt.datetime, hours: int = 1) -> DataFrame:
    """Events per action committed in the last ``hours`` before ``as_of`` (or after it).

    Of a landing table stored by commit day only the days in question are read.
    """
    since = moment(as_of) - F.make_dt_interval(hours=F.lit(hours))
    return (
        cdc_transactions(committed_since(landed, since))
        .where(F.col("committed_timestamp") >= since)
        .groupBy("cdc_action")
        .agg(F.count("*").alias("recent_transactions"), _mean_amount().alias("avg_amount"))
        .orderBy(F.col("recent_transactions").desc(), "cdc_action")
    )


def flag_high_value(events: DataFrame) -> DataFrame:
    """Events above the limit, any action; also the stateless step of the live query."""
    return events.where(F.col("transaction_amount") > fixed.HIGH_VALUE_OVER).select(
        "transaction_id",
        "customer_id",
        "transaction_type",
        "transaction_amount",
        "committed_timestamp",
        F.lit("HIGH_VALUE").alias("anomaly_type"),
    )


def high_value_cdc(landed: DataFrame) -> DataFrame:
    return flag_high_value(cdc_transactions(landed)).orderBy(
        F.col("transaction_amount").desc(), "transaction_id"
    )


def method_comparison(landed: DataFrame, transactions: DataFrame) -> DataFrame:
    """Insert events next to directly written rows, per data source."""

    def per_source(rows: DataFrame, method: str) -> DataFrame:
        counts = rows.groupBy("data_source").agg(F.count("*").alias("count"))
        return counts.select(F.lit(method).alias("method"), "count", "data_source")

    return (
        per_source(cdc_as_transactions(landed), "CDC_STREAM")
        .unionByName(per_source(transactions, "DIRECT_INSERT"))
        .orderBy("method", F.col("data_source").asc_nulls_last())
    )


def versions(landed: DataFrame, lenient: bool = False) -> DataFrame:
    """Row key, version and after-image of every event that names a key and an action."""
    record = env.Envelope(lenient)
    return landed.select(
        record.row_key().alias("row_key"),
        record.commit_ms().alias("committed_ms"),
        record.event_id().alias("event_id"),
        record.action().alias("cdc_action"),
        env.image(record.after).alias("image"),
    ).where("row_key IS NOT NULL AND cdc_action IS NOT NULL")


def fold(changes: DataFrame) -> DataFrame:
    """The last version of every key, deletes included.

    The event number restarts with every producer run, so it only settles one millisecond.
    Each task keeps one row per key before anything is shuffled.
    """
    version = ["committed_ms", "event_id", "cdc_action"]
    newest_first = Window.partitionBy("row_key").orderBy(*[F.col(c).desc_nulls_last() for c in version])
    last = changes.withColumn("__nth", F.row_number().over(newest_first)).where("__nth = 1")
    return last.select("row_key", *version, "image")


def live_rows(folded: DataFrame) -> DataFrame:
    """Rows that still exist, with the fields of their last image."""
    return folded.where(F.col("cdc_action") != "DELETE").select(
        "row_key",
        "image.*",
        F.col("event_id").alias("last_event_id"),
        F.timestamp_millis("committed_ms").alias("last_committed"),
    )


def cdc_current_state(landed: DataFrame) -> DataFrame:
    """Inserts, updates and deletes applied: one row per key that still exists."""
    return live_rows(fold(versions(landed)))


ROWS_PER_BLOCK = 20_000


def cdc_continuity(landed: DataFrame, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Events whose before-image is not the after-image of the key's previous event.

    All events are put in one order (key, commit time, number) and cut into equal blocks;
    the last event of a block is handed to the next block as well. So each block holds what
    its events need, and a key with a third of all events is many blocks, not one task. Images
    are compared by 128 bits, so what is sorted and moved is narrow, whatever they hold.
    """
    record = env.Envelope()
    images = landed.select(
        record.row_key().alias("row_key"),
        record.commit_ms().alias("committed_ms"),
        record.event_id().alias("event_id"),
        record.action().alias("cdc_action"),
        env.image(record.before).alias("found"),
        env.image(record.after).alias("after"),
    ).where(F.col("row_key").isNotNull())
    amounts = [F.col(f"{side}.transaction_amount").alias(f"{side}_amount") for side in ("found", "after")]
    nothing = reduce(and_, [F.col(f"found.{f}").isNull() for f, _ in env.IMAGE_FIELDS])
    digests = [x for side in ("found", "after") for x in _digest(side)]
    events = images.select("row_key", "committed_ms", "event_id", "cdc_action", *digests, *amounts, nothing.alias("found_nothing"))
    order = [F.col(c).asc() for c in ("row_key", "committed_ms", "event_id", "cdc_action")]
    placed = with_position(events, order, "place").withColumn(
        "block", F.floor(F.col("place") / rows_per_block)
    )
    shown = ["row_key", "after_1", "after_2", "after_amount"]
    handed_on = placed.where(F.col("place") % rows_per_block == rows_per_block - 1).select(
        "place", *shown, (F.col("block") + 1).alias("block"), F.lit(True).alias("handed_on")
    )
    in_block = Window.partitionBy("block").orderBy("place")
    previous = lambda column: F.col(f"previous.{column}")
    same_key = F.coalesce(previous("row_key") == F.col("row_key"), F.lit(False))
    equal = (previous("after_1") == F.col("found_1")) & (previous("after_2") == F.col("found_2"))
    return (
        placed.withColumn("handed_on", F.lit(False))
        .unionByName(handed_on, allowMissingColumns=True)
        .withColumn("previous", F.lag(F.struct(*shown)).over(in_block))
        .where(~F.col("handed_on"))
        .withColumn("has_previous", same_key)
        .where(F.when(F.col("has_previous"), ~equal).otherwise(~F.col("found_nothing")))
        .select(
            "row_key",
            "event_id",
            "cdc_action",
            F.timestamp_millis("committed_ms").alias("committed_timestamp"),
            F.when(F.col("has_previous"), previous("after_amount")).alias("expected_amount"),
            F.col("found_amount"),
            "has_previous",
        )
    )


def _digest(side: str) -> list[Column]:
    """128 bits of an image. Hashes pass over NULLs, so each field goes in with whether it is NULL."""
    fields = [x for f, _ in env.IMAGE_FIELDS for x in (F.col(f"{side}.{f}").isNull(), F.col(f"{side}.{f}"))]
    return [F.xxhash64(F.lit(n), *fields).alias(f"{side}_{n}") for n in (1, 2)]
