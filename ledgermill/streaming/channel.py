"""A feed channel with offset tokens: every row carries its place in its channel, so nothing is stored twice.

A producer numbers the rows of its channel 1, 2, 3, ... and sends lines ``{"channel": ..., "offset": ..., "record": {...}}``. After a
restart it asks ``committed_offset`` and goes on from there; what it sends again, however much and in whatever order,
adds no row.

Stored rows are ``rows/query=<id>/batch=<n>/block=<offset div BLOCK>``. Beside them each micro-batch writes its ledger, a
row per channel: ``upto`` is the last offset before which none is missing, and ``highest`` the largest seen. Offsets up
to ``upto`` are known to be stored, so a row sent again is told by its number alone; only rows beyond it are compared
with stored ones, and only with the blocks from ``upto`` on. A batch that is run again does not count what it wrote
itself. One live query at a time writes to a table.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgermill.functions import envelope as env
from ledgermill.streaming import sinks

#: offsets in one stored block
BLOCK = 100_000

LEDGER_COLUMNS = "channel string, upto bigint, highest bigint"
ROW_COLUMNS = f"channel string, offset bigint, {env.RECORD} variant, query string, batch bigint, block bigint"
_LEDGER_LAYOUT, _ROW_LAYOUT = ("query", "batch"), ("query", "batch", "block")


def read_lines(lines: DataFrame) -> DataFrame:
    """channel, offset, record and ``good``: whether a line is JSON with a channel, an offset of 1 or more, and a record."""
    parsed = lines.select("value", F.try_parse_json("value").alias("line"))
    read = lambda path, kind: F.try_variant_get("line", f"$.{path}", kind)
    rows = parsed.select("value", read("channel", "string").alias("channel"), read("offset", "bigint").alias("offset"), F.variant_get("line", "$.record", "variant").alias(env.RECORD))
    good = F.col("channel").isNotNull() & (F.col("offset") >= 1) & F.col(env.RECORD).isNotNull()
    return rows.withColumn("good", F.coalesce(good, F.lit(False)))


def with_offsets(lines: DataFrame, channel: str, start: int = 1) -> DataFrame:
    """What a producer sends of numbered envelopes (columns ``number`` from 0 and ``value``)."""
    return lines.select(
        F.concat(
            F.lit(f'{{"channel":"{channel}","offset":'), (F.col("number") + start).cast("string"), F.lit(',"record":'), F.col("value"), F.lit("}")
        ).alias("value")
    )


def _others(rows: DataFrame, query: str, batch: int) -> DataFrame:
    return rows.where(~((F.col("query") == query) & (F.col("batch") == batch)))


def _rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ROW_COLUMNS).parquet(f"{path}/rows")


def _ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{LEDGER_COLUMNS}, query string, batch bigint").parquet(f"{path}/ledger")


def create(spark: SparkSession, path: str) -> None:
    """An empty channel table; an existing one is kept."""
    spark.createDataFrame([], ROW_COLUMNS).write.mode("append").partitionBy(*_ROW_LAYOUT).parquet(f"{path}/rows")
    spark.createDataFrame([], f"{LEDGER_COLUMNS}, query string, batch bigint").write.mode("append").partitionBy(*_LEDGER_LAYOUT).parquet(f"{path}/ledger")


def _last(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("channel").agg(F.max("upto").alias("upto"), F.max("highest").alias("highest"))


def new_rows(batch: DataFrame, stored: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows of a micro-batch that are not stored yet, each offset once. stored, ledger: those of all other batches."""
    known = _last(ledger)
    fresh = batch.join(known, "channel", "left").where(F.col("offset") > F.coalesce("upto", F.lit(0))).drop("upto", "highest")
    one = fresh.dropDuplicates(["channel", "offset"])
    first = known.agg(F.min(F.floor((F.col("upto") + 1) / BLOCK))).scalar()
    beyond = stored.where(F.col("block") >= F.coalesce(first, F.lit(0))).select("channel", "offset")
    return one.join(beyond, ["channel", "offset"], "left_anti")


def contiguous(offsets: DataFrame, known: DataFrame) -> DataFrame:
    """channel, upto, highest after more offsets are stored. offsets: channel, offset, each once; known: the ledger so far.

    Offsets are counted per block first, so what meets in one place for a channel is a row per block; single offsets are put in order
    only in each channel's first block that is not full.
    """
    start = F.coalesce("upto", F.lit(0))
    beyond = offsets.join(known.select("channel", "upto"), "channel", "left").where(F.col("offset") > start)
    beyond = beyond.select("channel", "offset", start.alias("upto"), F.floor(F.col("offset") / BLOCK).alias("block"))
    blocks = beyond.groupBy("channel", "upto", "block").agg(F.count("*").alias("n"), F.max("offset").alias("top"))
    # what a block would hold if nothing of it were missing
    low = F.greatest(F.col("block") * BLOCK, F.col("upto") + 1)
    full = F.col("n") == (F.col("block") + 1) * BLOCK - low
    by_block = Window.partitionBy("channel").orderBy("block")
    first = F.floor((F.col("upto") + 1) / BLOCK)
    in_row = F.col("block") - first == F.row_number().over(by_block) - 1
    gaps = F.count_if(~full).over(by_block.rowsBetween(Window.unboundedPreceding, -1))
    reached = blocks.select("*", full.alias("full"), in_row.alias("in_row"), gaps.alias("gaps")).where("in_row AND gaps = 0")
    whole = reached.where("full").select("channel", ((F.col("block") + 1) * BLOCK - 1).alias("upto"))
    part = reached.where("NOT full").select("channel", "block")
    by_offset = Window.partitionBy("channel").orderBy("offset")
    inside = beyond.join(part, ["channel", "block"]).withColumn("nth", F.row_number().over(by_offset) - 1)
    begin = F.greatest(F.col("block") * BLOCK, F.col("upto") + 1)
    ends = inside.where(F.col("offset") == begin + F.col("nth")).select("channel", F.col("offset").alias("upto"))
    tops = blocks.select("channel", F.lit(0).cast("bigint").alias("upto"), F.col("top").alias("highest"))
    zero = F.lit(0).cast("bigint").alias("highest")
    every = known.select("channel", "upto", "highest").unionByName(tops)
    every = every.unionByName(whole.select("channel", "upto", zero)).unionByName(ends.select("channel", "upto", zero))
    return _last(every)


def keep_channel(lines: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Store the good rows of every micro-batch that are not stored yet, and the ledger after it."""
    known, started = [], threading.Event()

    def keep(batch: DataFrame, number: int) -> None:
        started.wait()
        spark = batch.sparkSession
        place = {"query": F.lit(known[0]), "batch": F.lit(number).cast("bigint")}
        stored, ledger = _others(_rows(spark, path), known[0], number), _others(_ledger(spark, path), known[0], number)
        sent = read_lines(batch).where("good").select("channel", "offset", env.RECORD)
        fresh = new_rows(sent, stored, ledger).withColumns({**place, "block": F.floor(F.col("offset") / BLOCK)})
        sinks.write_batch(fresh.hint("rebalance", "block"), f"{path}/rows", *_ROW_LAYOUT)
        last = _last(ledger)
        # of what is stored only the blocks that the ledger leaves open count
        first = last.agg(F.min(F.floor((F.col("upto") + 1) / BLOCK))).scalar()
        offsets = _rows(spark, path).where(F.col("block") >= F.coalesce(first, F.lit(0))).select("channel", "offset")
        sinks.write_batch(contiguous(offsets, last).withColumns(place), f"{path}/ledger", *_LEDGER_LAYOUT)

    query = lines.writeStream.option("checkpointLocation", checkpoint).foreachBatch(keep).trigger(**(trigger or sinks.ONCE)).start()
    known.append(query.id)
    started.set()
    return query


def committed_offsets(spark: SparkSession, path: str) -> DataFrame:
    """Per channel the offset up to which every row is stored, and the highest stored."""
    return _last(_ledger(spark, path)).withColumnRenamed("upto", "committed_offset").withColumnRenamed("highest", "highest_offset")


def committed_offset(spark: SparkSession, path: str, channel: str) -> int:
    """The offset a producer goes on from (0: nothing stored yet)."""
    found = committed_offsets(spark, path).where(F.col("channel") == channel).first()
    return found.committed_offset if found else 0


def landed(spark: SparkSession, path: str) -> DataFrame:
    """The stored records as a landing table, with channel and offset."""
    return _rows(spark, path).select("channel", "offset", env.RECORD)
