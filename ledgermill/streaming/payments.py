"""The live transaction feed: JSON lines in, the transactions store and running counters out."""

from __future__ import annotations

import datetime as dt
import threading
import uuid
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgermill import schemas
from ledgermill.functions import money
from ledgermill.sources.files import as_text
from ledgermill.sources.stores import STORE_LAYOUT, with_ingest_date
from ledgermill.streaming import sinks


def feed(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Lines of the files that arrive in ``folder``."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(folder)


def read_lines(lines: DataFrame) -> DataFrame:
    """Typed feed rows and ``sent``: whether the row has all that the table requires.

    Works on a stream and on a batch; a bad line is marked, it does not stop the feed.
    """
    shape = schemas.TRANSACTION_FEED
    parsed = lines.select(F.from_json("value", as_text(shape)).alias("row"))
    typed = parsed.select(*[F.col(f"row.{f.name}").try_cast(f.dataType).alias(f.name) for f in shape.fields])
    needed = [F.col(f.name).isNotNull() for f in shape.fields if f.name != "is_anomaly"]
    return typed.withColumn("sent", reduce(and_, needed))


def stored_rows(lines: DataFrame) -> DataFrame:
    """Good rows as they are stored: source named, both timestamps the time of arrival."""
    return as_stored(read_lines(lines))


def as_stored(typed: DataFrame) -> DataFrame:
    now = F.current_timestamp()
    return (
        typed.where("sent")
        .drop("sent", "is_anomaly")
        .withColumns({"data_source": F.lit("STREAMING"), "ingestion_timestamp": now, "created_at": now})
    )


def append_transactions(
    lines: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    rows = with_ingest_date(stored_rows(lines))
    return sinks.append(rows, path, checkpoint, trigger, STORE_LAYOUT)


DELETED_COLUMNS = "day date, file string, deletion string"


def _deleted_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DELETED_COLUMNS).parquet(f"{path}-deleted")


def open_store(spark: SparkSession, path: str) -> None:
    """Prepare the list of deleted files beside a live store; an existing one is kept."""
    spark.createDataFrame([], DELETED_COLUMNS).write.mode("append").parquet(f"{path}-deleted")


def _with_file(spark: SparkSession, path: str) -> DataFrame:
    """Committed rows, as the live query's own log lists their files."""
    return spark.read.parquet(path).withColumn("__file", F.col("_metadata.file_path"))


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """The live rows that have not been deleted."""
    rows = _with_file(spark, path)
    deleted = _deleted_files(spark, path).select(F.col("day").alias("ingest_date"), F.col("file").alias("__file")).distinct()
    return rows.join(deleted, ["ingest_date", "__file"], "left_anti").drop("__file").select(*spark.read.parquet(path).columns)


def delete_day(spark: SparkSession, path: str, day: dt.date | None = None) -> int:
    """Delete what has been streamed on one day (today unless named); returns the row count.

    The store belongs to the live query, whose own log lists its files, so no file is
    touched: the day's committed files are written down, and readers leave them out. A
    micro-batch that commits later, also one that is under way, brings files of its own; its
    rows stay, as after any DELETE. The count is that of the files written down.
    """
    day = day or spark.sql("SELECT current_date()").first()[0]
    deletion = uuid.uuid4().hex
    rows = _with_file(spark, path).where(F.col("ingest_date") == F.lit(day))
    known = _deleted_files(spark, path).select("day", "file")
    files = rows.select(F.col("ingest_date").alias("day"), F.col("__file").alias("file")).distinct().join(known, ["day", "file"], "left_anti")
    files.withColumn("deletion", F.lit(deletion)).write.mode("append").parquet(f"{path}-deleted")
    own = _deleted_files(spark, path).where(F.col("deletion") == deletion).select(F.col("file").alias("__file"))
    return rows.join(own, "__file", "left_semi").count()


def counters(lines: DataFrame) -> DataFrame:
    """Running totals of the feed; on a stream one row of state, summed task by task."""
    return read_lines(lines).agg(
        F.count("*").alias("total_transactions"),
        F.count_if("sent").alias("successful_sends"),
        F.count_if(~F.col("sent")).alias("failed_sends"),
        F.count_if(F.coalesce("is_anomaly", F.lit(False))).alias("anomalies"),
    )


def with_rates(totals: DataFrame) -> DataFrame:
    """Success and anomaly percentages; zero rows count as one, so nothing divides by zero."""
    rows = F.greatest(F.col("total_transactions"), F.lit(1))
    return totals.withColumns(
        {
            "success_percentage": money.percent(F.col("successful_sends"), rows, 1),
            "anomaly_percentage": money.percent(F.col("anomalies"), rows, 1),
        }
    )


def keep_counters(
    lines: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Write the running totals after every micro-batch, in place of those of two batches before.

    Of each query two partitions remain, so a reader that has listed one still finds it.
    """
    return sinks.each_batch(
        counters(lines), with_rates, path, checkpoint, trigger, output_mode="complete", level="totals", kept=2
    )


def latest_counters(spark: SparkSession, path: str) -> DataFrame:
    """The totals after the last micro-batch; of several queries that wrote here, those of all together."""
    kept = spark.read.parquet(path)
    last = kept.groupBy("query").agg(F.max("batch").alias("batch"))
    names = ["total_transactions", "successful_sends", "failed_sends", "anomalies"]
    totals = kept.join(last, ["query", "batch"]).agg(*[F.sum(c).alias(c) for c in names])
    return with_rates(totals.where("total_transactions IS NOT NULL"))


COUNTED = ["total_transactions", "successful_sends", "failed_sends", "anomalies"]
_COUNTED_COLUMNS = ", ".join(f"{c} bigint" for c in COUNTED) + ", query string, batch bigint"


def append_counted(
    lines: DataFrame, path: str, counts: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Store the good rows and count all, in the same pass: the counts are observed while the rows are written.

    Rows and counts are partitions named by query and batch, so a batch that is run again after a failure replaces
    both and nothing counts twice.
    """
    known, started = [], threading.Event()

    def keep(batch: DataFrame, number: int) -> None:
        started.wait()
        spark = batch.sparkSession
        place = {"query": F.lit(known[0]), "batch": F.lit(number).cast("bigint")}
        seen = Observation("feed")
        typed = read_lines(batch).observe(
            seen,
            F.count(F.lit(1)).alias("total_transactions"),
            F.count_if("sent").alias("successful_sends"),
            F.count_if(~F.col("sent")).alias("failed_sends"),
            F.count_if(F.coalesce("is_anomaly", F.lit(False))).alias("anomalies"),
        )
        sinks.write_batch(as_stored(typed).withColumns(place), path, "query", "batch")
        row = spark.createDataFrame([tuple(seen.get[c] for c in COUNTED)], ", ".join(f"{c} bigint" for c in COUNTED))
        sinks.write_batch(row.coalesce(1).withColumns(place), counts, "query", "batch")

    query = lines.writeStream.option("checkpointLocation", checkpoint).foreachBatch(keep).trigger(**(trigger or sinks.ONCE)).start()
    known.append(query.id)
    started.set()
    return query


def counted(spark: SparkSession, counts: str) -> DataFrame:
    """Totals and rates of all micro-batches so far."""
    kept = spark.read.schema(_COUNTED_COLUMNS).parquet(counts)
    return with_rates(kept.agg(*[F.sum(c).alias(c) for c in COUNTED]).where("total_transactions IS NOT NULL"))
