"""Loading a folder again and again, each file once.

A load is ``rows/load=<n>`` with the rows and ``files/load=<n>`` with path, size and time of the files they came from;
``_done/<n>`` marks it, so rows and ledger count from the same moment. A load that failed has no mark and is begun anew. A
file that was changed, which shows in its size or time, is loaded again, as a COPY into a table does.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgermill.session import folders, make_folder, remove

LEDGER_COLUMNS = "path string, length bigint, modificationTime timestamp"
#: files of one load, whose names pass through the driver; more files are several loads
FILES = 10_000


def _done(spark: SparkSession, table: str) -> list[int]:
    return sorted(int(x) for x in folders(spark, f"{table}/_done"))


def loaded_files(spark: SparkSession, table: str) -> DataFrame:
    """load, path, length and modificationTime of the files loaded so far."""
    shape = f"{LEDGER_COLUMNS}, load bigint"
    paths = [f"{table}/files/load={n}" for n in _done(spark, table)]
    return spark.read.schema(shape).option("basePath", f"{table}/files").parquet(*paths) if paths else spark.createDataFrame([], shape)


def loaded_rows(spark: SparkSession, table: str) -> DataFrame:
    """The rows of all finished loads; there must be one."""
    paths = [f"{table}/rows/load={n}" for n in _done(spark, table)]
    return spark.read.option("basePath", f"{table}/rows").parquet(*paths).drop("load")


def _listed(spark: SparkSession, folder: str) -> DataFrame:
    """Files of a folder from its listing; their content is not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "length", "modificationTime")


def load_new(
    spark: SparkSession, folder: str, table: str, reader: Callable[[SparkSession, list[str]], DataFrame], files: int = FILES
) -> int:
    """Load the files of ``folder`` that ``table`` does not have; returns their number.

    reader: rows of a list of files, as ``files.load_transactions_json`` reads them. A file that does not fit stops its load, of
    which nothing then counts.
    """
    taken = 0
    while True:
        known = loaded_files(spark, table).drop("load")
        new = _listed(spark, folder).join(known, ["path", "length", "modificationTime"], "left_anti").orderBy("modificationTime", "path").limit(files).collect()
        if not new:
            return taken
        number = 1 + max(_done(spark, table), default=0)
        rows, ledger = f"{table}/rows/load={number}", f"{table}/files/load={number}"
        for begun in (rows, ledger):
            remove(spark, begun)
        reader(spark, [f.path for f in new]).write.parquet(rows)
        spark.createDataFrame(new, LEDGER_COLUMNS).coalesce(1).write.parquet(ledger)
        make_folder(spark, f"{table}/_done/{number}")
        taken += len(new)


def load_report(spark: SparkSession, table: str) -> DataFrame:
    """Files and bytes of each load."""
    return loaded_files(spark, table).groupBy("load").agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
