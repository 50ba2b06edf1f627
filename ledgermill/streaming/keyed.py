"""A live table of current rows by key: hash buckets, and levels of runs that are merged as they become many.

A micro-batch is one run, ``run=<name>/bucket=<number>``, with the last version of each of its keys. A key lies in the same
bucket of every run, so a lookup opens one bucket of each run and nothing else. When a level has FAN runs, these are
merged into one run of the next level; a row is therefore rewritten once per level, about the logarithm of the number of
batches, and the number of runs that a read opens stays below FAN for each level.

What counts is written beside the rows:
- ``_batches/query=<id>/batch=<n>`` marks a micro-batch that is stored whole. A batch that is run again replaces its run.
- ``_state/<n>`` names the merged runs in force and the last batch of each query that they hold. It appears at one moment.
Readers start from the last state and add the marked batches after it. One process at a time merges; any number of live
queries may write, and readers never wait.

Versions are ordered by commit time, then event number, then action, as in ``cdc.fold``. Deletes are kept as versions, so a
late update does not revive a row; ``merge`` forgets deletes older than it is told to.
"""

from __future__ import annotations

import datetime as dt
import json
import threading
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgermill.operators import cdc
from ledgermill.session import folders, make_folder, remove
from ledgermill.streaming import sinks
from ledgermill.streaming.changes import VERSION_COLUMNS

BUCKETS = 64
FAN = 4

_COLUMNS = f"{VERSION_COLUMNS}, run string, bucket int"


def create(spark: SparkSession, path: str, buckets: int = BUCKETS) -> None:
    """Fix the number of buckets. A table keeps what it was created with."""
    if not folders(spark, f"{path}/_buckets"):
        make_folder(spark, f"{path}/_buckets/{buckets}")


def _buckets(spark: SparkSession, path: str) -> int:
    found = folders(spark, f"{path}/_buckets")
    if len(found) != 1:
        raise ValueError(f"no keyed table at {path}: create it first")
    return int(found[0])


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _write(versions: DataFrame, path: str, run: str, buckets: int) -> None:
    """One run, a file for each bucket; an older try of the same run is replaced."""
    spark = versions.sparkSession
    remove(spark, f"{path}/run={run}")
    make_folder(spark, f"{path}/run={run}")
    placed = versions.withColumn("bucket", bucket_of(F.col("row_key"), buckets))
    placed.repartition(buckets, "bucket").sortWithinPartitions("bucket", "row_key").write.mode("append").partitionBy("bucket").parquet(f"{path}/run={run}")


def _state(spark: SparkSession, path: str) -> dict:
    """The last state: number, merged runs as {level: [names]}, last batch held of each query, runs that the next merge removes."""
    numbers = [int(x) for x in folders(spark, f"{path}/_state") if x.isdigit()]
    if not numbers:
        return {"number": 0, "levels": {}, "held": {}, "gone": []}
    return json.loads(spark.read.text(f"{path}/_state/{max(numbers)}", wholetext=True).first()[0])


def _store_state(spark: SparkSession, path: str, state: dict) -> None:
    """Written aside, then renamed, so that readers see all of it or nothing."""
    aside, place = f"{path}/_aside/{uuid.uuid4().hex}", f"{path}/_state/{state['number']}"
    spark.createDataFrame([(json.dumps(state),)], "value string").coalesce(1).write.text(aside)
    make_folder(spark, f"{path}/_state")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    store = hadoop(aside).getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.rename(hadoop(aside), hadoop(place)):
        raise OSError(f"{place} exists: another merge has run")


def _batches(spark: SparkSession, path: str, held: dict[str, int]) -> list[tuple[str, int]]:
    """(query, batch) of the micro-batches that are stored whole and not merged yet, oldest first."""
    found = []
    for query in folders(spark, f"{path}/_batches"):
        name = query.removeprefix("query=")
        numbers = (int(x.removeprefix("batch=")) for x in folders(spark, f"{path}/_batches/{query}"))
        found += [(name, n) for n in numbers if n > held.get(name, -1)]
    return sorted(found, key=lambda x: (x[1], x[0]))


def _run(query: str, batch: int) -> str:
    return f"{query}-{batch}"


def keep_rows(landed: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Store each micro-batch's last version per key as a run."""
    spark = landed.sparkSession
    buckets = _buckets(spark, path)
    known, started = [], threading.Event()

    def keep(batch: DataFrame, number: int) -> None:
        started.wait()
        own = batch.sparkSession
        if number <= _state(own, path)["held"].get(known[0], -1):
            return  # merged before the failure that made it run again
        _write(cdc.fold(cdc.versions(batch, lenient=True)), path, _run(known[0], number), buckets)
        make_folder(own, f"{path}/_batches/query={known[0]}/batch={number}")

    query = landed.writeStream.option("checkpointLocation", checkpoint).foreachBatch(keep).trigger(**(trigger or sinks.ONCE)).start()
    known.append(query.id)
    started.set()
    return query


def runs_in_force(spark: SparkSession, path: str) -> list[str]:
    state = _state(spark, path)
    merged = [run for level in state["levels"].values() for run in level]
    return merged + [_run(q, n) for q, n in _batches(spark, path, state["held"])]


def _read(spark: SparkSession, path: str, runs: list[str]) -> DataFrame:
    reader = spark.read.schema(_COLUMNS).option("basePath", path)
    return reader.parquet(*[f"{path}/run={run}" for run in runs]) if runs else spark.createDataFrame([], _COLUMNS)


def stored_versions(spark: SparkSession, path: str, keys: list[str] | None = None) -> DataFrame:
    """Versions in force, of all keys or of those given: only the buckets of these are opened."""
    rows = _read(spark, path, runs_in_force(spark, path))
    if keys is not None:
        buckets = _buckets(spark, path)
        places = spark.createDataFrame([(k,) for k in keys], "k string").select(bucket_of(F.col("k"), buckets)).distinct().collect()
        rows = rows.where(F.col("bucket").isin([p[0] for p in places]) & F.col("row_key").isin(keys))
    return rows.drop("run", "bucket")


def rows(spark: SparkSession, path: str, keys: list[str] | None = None) -> DataFrame:
    """The rows that exist now, as ``cdc.cdc_current_state`` gives them; with ``keys``, theirs."""
    return cdc.live_rows(cdc.fold(stored_versions(spark, path, keys)))


def _clean(spark: SparkSession, path: str, state: dict) -> None:
    """Remove what the last state replaced: runs, and marks of batches that it holds."""
    for run in state["gone"]:
        remove(spark, f"{path}/run={run}")
    for query in folders(spark, f"{path}/_batches"):
        for batch in folders(spark, f"{path}/_batches/{query}"):
            if int(batch.removeprefix("batch=")) <= state["held"].get(query.removeprefix("query="), -1):
                remove(spark, f"{path}/_batches/{query}/{batch}")


def merge(
    spark: SparkSession, path: str, fan: int = FAN, everything: bool = False, forget: dt.datetime | None = None
) -> list[str]:
    """Merge the runs of every level that has ``fan`` of them, two at least; returns the names of the runs written.

    With ``everything``, all runs become one. With ``forget``, a merge that takes in the oldest run leaves out rows deleted
    before that time: an update of such a row that is still to come would then be taken for a new row. Runs replaced by the
    merge before this one are removed, so readers that started from them have had the time between two merges.
    """
    if fan < 2:
        raise ValueError("a merge takes two runs at least")
    state = _state(spark, path)
    _clean(spark, path, state)
    batches = _batches(spark, path, state["held"])
    levels = {int(k): v for k, v in state["levels"].items() if v}
    held = dict(state["held"])
    for query, number in batches:
        held[query] = max(number, held.get(query, -1))
    buckets, gone, written = _buckets(spark, path), [], []

    def merged(runs: list[str], level: int, oldest: bool) -> str:
        versions = cdc.fold(_read(spark, path, runs).drop("run", "bucket"))
        if oldest and forget is not None:
            old = F.col("committed_ms") < F.unix_millis(cdc.moment(forget))
            versions = versions.where(~((F.col("cdc_action") == "DELETE") & F.coalesce(old, F.lit(True))))
        run = f"{level}-{uuid.uuid4().hex}"
        _write(versions, path, run, buckets)
        gone.extend(runs)
        written.append(run)
        return run

    due = [_run(q, n) for q, n in batches]
    if everything:
        due += [run for runs in levels.values() for run in runs]
        if due:
            top = max([1, *levels])
            levels = {top: [merged(due, top, True)]}
    else:
        level = 0
        while len(due) >= fan:
            level += 1
            run = merged(due, level, not any(n >= level for n in levels))
            due = [*levels.pop(level, []), run]
            if len(due) < fan:
                levels[level] = due
    if not written:
        return written
    _store_state(spark, path, {"number": state["number"] + 1, "levels": levels, "held": held, "gone": gone})
    remove(spark, f"{path}/_state/{state['number'] - 1}")
    return written
