"""The given tables, and tables written between the steps of an operator."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: where intermediate tables go when the session names no folder (a single machine, as in tests)
LOCAL_FOLDER = "/tmp/ledgermill-llm"
#: Spark removes a job's shuffle files when it ends; otherwise they stay until the driver's memory is collected
CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(frame: DataFrame, partitions: int | None = None) -> DataFrame:
    """The frame, written once to the folder of spark.checkpoint.dir and read from there: later steps neither repeat its
    work nor lose it with an executor. Its shuffle files are not needed any more and go."""
    spark = frame.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = LOCAL_FOLDER
    path = f"{folder.rstrip('/')}/llm-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANED, None)
    spark.conf.set(CLEANED, "true")
    try:
        (frame if partitions is None else frame.coalesce(partitions)).write.parquet(path)
    finally:
        spark.conf.unset(CLEANED) if before is None else spark.conf.set(CLEANED, before)
    return spark.read.schema(frame.schema).parquet(path)


def _text():
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def _key() -> list:
    doc_id = F.col("doc_id").cast("long")
    return [F.xxhash64(doc_id, _text()).alias("k1"), F.xxhash64(_text(), doc_id, F.lit(1)).alias("k2")]


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text (null: empty) and a key (k1, k2) of 128 bits that is never null. Equal rows share a key."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text().alias("text"), *_key())


def held(docs: DataFrame) -> DataFrame:
    """row (all columns as they are) and the key as in keyed(): no column of docs can clash with an operator's."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *_key())


def released(rows: DataFrame, docs: DataFrame, text=None) -> DataFrame:
    """The columns of docs out of `row`, with another expression for text if one is given."""
    shown = {"text": text} if text is not None else {}
    return rows.select(*[shown.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
