"""Parquet tables of which single partitions are replaced, all at one moment and as often as it takes.

``<key>=<value>/version=<n>`` holds a partition as of version n; ``_done/<n>`` marks a version that is complete. Readers take
of each partition its newest marked version. Writing version n again after a failure starts from the marked ones and so
gives the same; nothing in force is touched until the mark appears.
"""

from __future__ import annotations

import urllib.parse
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgermill.session import folders, make_folder, remove

#: how partition folders name a missing value
NULL = "__HIVE_DEFAULT_PARTITION__"
_DONE = "_done"


def last_version(spark: SparkSession, path: str) -> int:
    """0 before anything is written."""
    return max((int(x) for x in folders(spark, f"{path}/{_DONE}")), default=0)


def _versions(spark: SparkSession, path: str, folder: str) -> list[int]:
    return sorted(int(x.removeprefix("version=")) for x in folders(spark, f"{path}/{folder}") if x.startswith("version="))


def _name(value: object) -> str:
    return NULL if value is None else str(value)


def partitions(spark: SparkSession, path: str, key: str, values: Iterable[object] | None = None) -> list[str]:
    """Folders in force, of all partitions or of those with the values given."""
    done = {int(x) for x in folders(spark, f"{path}/{_DONE}")}
    wanted = None if values is None else {_name(v) for v in values}
    found = []
    for folder in folders(spark, path):
        if not folder.startswith(f"{key}=") or (wanted is not None and urllib.parse.unquote(folder.removeprefix(f"{key}=")) not in wanted):
            continue
        marked = [n for n in _versions(spark, path, folder) if n in done]
        if marked:
            found.append(f"{path}/{folder}/version={marked[-1]}")
    return found


def read(spark: SparkSession, path: str, columns: str, key: str, values: Iterable[object] | None = None) -> DataFrame:
    """The table with ``columns`` (key among them), or only the partitions with the values given."""
    shape = f"{columns}, version bigint"
    paths = partitions(spark, path, key, values)
    rows = spark.read.schema(shape).option("basePath", path).parquet(*paths) if paths else spark.createDataFrame([], shape)
    return rows.drop("version")


def replace(rows: DataFrame, path: str, key: str, values: Iterable[object], version: int) -> None:
    """Write ``rows`` as the partitions ``values`` of a version; a partition without rows becomes empty."""
    spark = rows.sparkSession
    for value in values:
        place = f"{path}/{key}={urllib.parse.quote(_name(value), safe=' -._~+')}/version={version}"
        remove(spark, place)
        make_folder(spark, place)
    rows.hint("rebalance", key).withColumn("version", F.lit(version)).write.mode("append").partitionBy(key, "version").parquet(path)


def finish(spark: SparkSession, path: str, version: int) -> None:
    """Put a version in force."""
    make_folder(spark, f"{path}/{_DONE}/{version}")


def tidy(spark: SparkSession, path: str, key: str, keep: int = 2) -> None:
    """Remove what the last ``keep`` versions do not need: readers that started from older ones have had that long."""
    done = sorted(int(x) for x in folders(spark, f"{path}/{_DONE}"))
    if len(done) <= keep:
        return
    oldest = done[-keep]
    for folder in folders(spark, path):
        if folder.startswith(f"{key}="):
            marked = [n for n in _versions(spark, path, folder) if n in done and n <= oldest]
            for n in marked[:-1]:
                remove(spark, f"{path}/{folder}/version={n}")
