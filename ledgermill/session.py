"""Session settings and the shared folder used for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    # committed_at and the fixture timestamps are UTC wall clocks
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # one append or one rebuilt day must never wipe its neighbours
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # CDC envelopes are stored column by column, so a scan reads only the paths a query names
    "spark.sql.variant.writeShredding.enabled": "true",
    "spark.sql.variant.inferShreddingSchema": "true",
}


def build_session(master: str | None = None, name: str = "ledgermill", **extra: str) -> SparkSession:
    """A session with this package's settings; the cluster's own settings stay untouched."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> None:
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    A session without that setting is refused: a machine-local folder would lose data on a cluster.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder shared by the driver and all executors")
    return folder.rstrip("/")


def name_folder(spark: SparkSession, folder: str) -> None:
    """For entry points and tests: the folder to use where the session names none."""
    if not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()):
        spark.sparkContext.setCheckpointDir(folder)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of this package's own making, in whatever store it lies."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def scratch(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/ledgermill/{label}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below ``path``, from the store's own listing; none if it is not there."""
    store, at = _file_system(spark, path)
    if not store.exists(at):
        return []
    return [f.getPath().getName() for f in store.listStatus(at) if f.isDirectory()]


def make_folder(spark: SparkSession, path: str) -> None:
    """An empty folder, with those above it. As a mark it appears at one moment, and again changes nothing."""
    store, at = _file_system(spark, path)
    store.mkdirs(at)
