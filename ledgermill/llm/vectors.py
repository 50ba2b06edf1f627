"""Vectors as rows: which take part, and comparing queries with candidates cell by cell."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: queries compared in one cell; more are spread over several
QUERY_BLOCK = 4096


def usable(frame: DataFrame) -> DataFrame:
    """vec_id and embedding (doubles) of the rows that take part. vec_id is a key: of rows that share one, the smallest."""
    vector = F.col("embedding").cast("array<double>")
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = frame.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("embedding"))
    good = rows.filter("vec_id IS NOT NULL AND embedding IS NOT NULL AND size(embedding) > 0").filter(~odd)
    return good.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def matrix(table: pa.Table, name: str, kind: type = np.float64) -> np.ndarray:
    """A list column whose lists have one length, as rows of a matrix."""
    column = table.column(name).combine_chunks()
    flat = np.asarray(column.flatten(), kind)
    return flat.reshape(table.num_rows, -1)


def in_cells(candidates: DataFrame, queries: DataFrame, by: list[str], blocks: int, query_blocks: int, run: Callable, schema: str) -> DataFrame:
    """run(candidates, queries) for every cell: one block of candidates and one of queries that agree in `by`.

    Candidates are dealt to `blocks` by vec_id, queries to `query_blocks` by query_id. Each side is copied to the other's
    blocks, so a cell's size does not grow with the tables."""
    c = candidates.withColumn("_b", F.pmod(F.xxhash64("vec_id"), F.lit(blocks))).withColumn("_q", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(query_blocks - 1).cast("long"))))
    fresh = queries.select(*[F.col(name).alias(name) for name in queries.columns])  # the sides may come from one table
    q = fresh.withColumn("_q", F.pmod(F.xxhash64("query_id"), F.lit(query_blocks))).withColumn("_b", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    keys = [*by, "_b", "_q"]
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64()}
    fields = pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in schema.split(", "))])

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        return run(left, right).cast(fields) if left.num_rows and right.num_rows else fields.empty_table()

    return c.groupBy(*keys).cogroup(q.groupBy(*keys)).applyInArrow(cell, schema)


def top(scored: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest scores of each query, ties to the smaller vec_id."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
