"""Starting live queries: append to files, or hand each micro-batch to a partitioned table."""

from __future__ import annotations

import threading
import urllib.parse
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgermill.session import folders, make_folder, remove

# read what is there, then stop; pass {"processingTime": "10 seconds"} to keep running
ONCE = {"availableNow": True}


def append(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    partition_by: Iterable[str] = (),
) -> StreamingQuery:
    """Append to parquet files. The checkpoint makes every input row arrive exactly once."""
    writer = (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.trigger(**(trigger or ONCE)).start()


LAYOUT = ("level", "query", "batch")
#: marks of finished snapshots; Spark's readers pass over folders named like this
DONE = "_done"


def write_batch(rows: DataFrame, path: str, *layout: str) -> None:
    """Write rows to their partitions, replacing only those; a repeated write changes nothing."""
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*layout)
        .parquet(path)
    )


def _place(level: str, query: str, batch: int) -> dict:
    return {"level": F.lit(level), "query": F.lit(query), "batch": F.lit(batch).cast("bigint")}


def each_batch(
    rows: DataFrame,
    condense: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    output_mode: str = "append",
    level: str = "changes",
    kept: int | None = None,
    within: tuple[str, ...] = (),
) -> StreamingQuery:
    """Condense every micro-batch and keep it as its own partition of the table at ``path``.

    The query's id, which lives in its checkpoint, and the batch number name the partition. A
    batch that is run again after a failure replaces its own rows; a query that starts anew
    with another checkpoint adds to what is there and replaces nothing. With ``kept``, only
    that many of the query's last batches remain. ``within`` names columns by which a batch's
    partition is divided further.
    """
    known, started = [], threading.Event()

    def keep(batch: DataFrame, number: int) -> None:
        started.wait()
        write_batch(condense(batch).withColumns(_place(level, known[0], number)), path, *LAYOUT, *within)
        if kept and number >= kept:
            remove(batch.sparkSession, f"{path}/level={level}/query={known[0]}/batch={number - kept}")

    query = (
        rows.writeStream.outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(keep)
        .trigger(**(trigger or ONCE))
        .start()
    )
    known.append(query.id)
    started.set()
    return query


def unescaped(name: str) -> str:
    """A partition's value as its folder's name shows it."""
    return urllib.parse.unquote(name)


def read_log(spark: SparkSession, path: str, columns: str) -> DataFrame:
    """All partitions kept at ``path``; no rows yet is fine."""
    return spark.read.schema(f"{columns}, level string, query string, batch bigint").parquet(path)


def _partitions(log: DataFrame, path: str, level: str) -> list[tuple[str, int]]:
    """(query, batch) of the partitions of one level, from the names of their folders."""
    spark = log.sparkSession
    queries = [x for x in folders(spark, f"{path}/level={level}") if x.startswith("query=")]
    return [
        (unescaped(query.removeprefix("query=")), int(batch.removeprefix("batch=")))
        for query in queries
        for batch in folders(spark, f"{path}/level={level}/{query}")
        if batch.startswith("batch=")
    ]


def _finished_snapshots(log: DataFrame, path: str) -> list[tuple[str, int]]:
    """Snapshots that were written to the end. One of several folders does not appear at one moment, its mark does."""
    done = folders(log.sparkSession, f"{path}/{DONE}")
    found = _partitions(log, path, "snapshot")
    return [(covers, number) for covers, number in found if f"batch={number}" in done] if DONE in folders(log.sparkSession, path) else found


def _last_snapshot(log: DataFrame, path: str) -> tuple[int, dict[str, int]]:
    """Number of the last snapshot (-1: none) and the last batch of each query that it covers.

    What a snapshot covers is part of its partition's name.
    """
    covers, number = max(_finished_snapshots(log, path), key=lambda x: x[1], default=("", -1))
    return number, {q: int(n) for q, n in (x.split("~") for x in covers.split(",") if x)}


def _changes_after(covered: dict[str, int]) -> Column:
    """Batches of a query that the snapshot does not hold; there are as many terms as queries ever wrote."""
    later = F.col("level") == "changes"
    for query, batch in covered.items():
        later = later & ((F.col("query") != query) | (F.col("batch") > batch))
    return later


def in_force(log: DataFrame, path: str) -> DataFrame:
    """The last snapshot and the changes after it; other partitions are not read."""
    number, covered = _last_snapshot(log, path)
    snapshot = (F.col("level") == "snapshot") & (F.col("batch") == number)
    return log.where(snapshot | _changes_after(covered)).drop(*LAYOUT)


def compact(
    log: DataFrame, path: str, condense: Callable[[DataFrame], DataFrame], within: tuple[str, ...] = ()
) -> dict[str, int] | None:
    """Condense all finished batches into one snapshot, which later reads start from.

    Returns the last batch of each query that it covers, if any. A query starts a batch only
    when the one before is committed, so all but its newest are finished and fully listed; the
    newest stays as it is. May run beside the stream. What the snapshot before this one covered
    is deleted: readers that started from older files have had the time between two
    compactions, so the number of folders stays that of the batches of two such intervals.
    """
    spark = log.sparkSession
    number, covered = _last_snapshot(log, path)
    changes = _partitions(log, path, "changes")
    newest: dict[str, int] = {}
    for query, batch in changes:
        newest[query] = max(batch, newest.get(query, batch))
    finished = dict(covered)
    for query, batch in changes:
        if batch < newest[query]:
            finished[query] = max(batch, finished.get(query, -1))
    if finished == covered:
        return covered or None
    done = (F.col("level") == "snapshot") & (F.col("batch") == number)
    for query, last in finished.items():
        done = done | ((F.col("level") == "changes") & (F.col("query") == query) & (F.col("batch") > covered.get(query, -1)) & (F.col("batch") <= last))
    name = ",".join(f"{q}~{n}" for q, n in sorted(finished.items()))
    make_folder(spark, f"{path}/{DONE}")
    for old, batch in _partitions(log, path, "snapshot"):
        if batch > number:  # begun and not finished
            remove(spark, f"{path}/level=snapshot/query={old}/batch={batch}")
    write_batch(condense(log.where(done).drop(*LAYOUT)).withColumns(_place("snapshot", name, number + 1)), path, *LAYOUT, *within)
    make_folder(spark, f"{path}/{DONE}/batch={number + 1}")
    for query, batch in changes:
        if batch <= covered.get(query, -1):
            remove(spark, f"{path}/level=changes/query={query}/batch={batch}")
    for old, batch in _partitions(log, path, "snapshot"):
        if batch < number:
            remove(spark, f"{path}/level=snapshot/query={old}")
            remove(spark, f"{path}/{DONE}/batch={batch}")
    return finished


def rows_read(query: StreamingQuery) -> int:
    return sum(progress.numInputRows for progress in query.recentProgress)
