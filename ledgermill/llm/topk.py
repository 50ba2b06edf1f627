"""Exact top-k search by inner product with a uniform threshold in three phases.

A vector's components are dealt to NODES slices; a slice's inner product is a local score, and the score is their sum.
Local scores are raised by the query's smallest one in that slice, so none is negative and the order stays.
1. Every slice gives its k best local scores. The full scores of the rows they name are looked up; the k-th best of them,
   tau1, is a safe bound for the k-th score (sums of what the slices gave would be one too, but a far lower one).
2. The cutoff tau1 / NODES goes to all slices, which give every local score that reaches it. A row below it everywhere
   cannot be among the best.
3. With the better bound tau2 from these sums, rows whose missing scores could still lift them to it are resolved from the
   vectors themselves.

Components are whole numbers, floor(SCALE * x); sums stay exact, in doubles as long as they are below 2**53 and in
64-bit integers beyond. Rows that take no part: see vectors.usable; vectors of different lengths are not compared.
An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgermill.llm.store import written
from ledgermill.llm.vectors import QUERY_BLOCK, in_cells, matrix, top, usable

NODES = 2
SCALE = 1024
#: candidates compared in one cell
BLOCK = 8192


def _products(left: pa.Table, right: pa.Table) -> np.ndarray:
    """Inner products of whole numbers, queries by candidates; a row's own query is marked by the smallest integer."""
    c, q = matrix(left, "part", np.int64), matrix(right, "part", np.int64)
    if float(np.abs(c).max()) * float(np.abs(q).max()) * c.shape[1] < 2**53:
        out = (q.astype(float) @ c.T.astype(float)).astype(np.int64)
    else:
        out = q @ c.T
    out[np.asarray(right.column("query_id"))[:, None] == np.asarray(left.column("vec_id"))[None, :]] = np.iinfo(np.int64).min
    return out


def _heads(k: int):
    """k best local scores of each query in a cell; low: the smallest local score there."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        local = _products(left, right)
        own = local == np.iinfo(np.int64).min
        low = np.where(own, np.iinfo(np.int64).max, local).min(axis=1)
        ids, queries = np.asarray(left.column("vec_id")), np.asarray(right.column("query_id"))
        width = min(k, local.shape[1])
        kth = np.partition(local, local.shape[1] - width, axis=1)[:, local.shape[1] - width]
        row, at = np.nonzero((local >= kth[:, None]) & ~own)
        order = np.lexsort((ids[at], -local[row, at], row))  # ties go to the smaller vec_id
        row, at = row[order], at[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        row, at = row[place < k], at[place < k]
        return pa.table(
            {"query_id": queries[row], "node": np.full(len(row), left.column("node")[0].as_py(), np.int32), "vec_id": ids[at], "local": local[row, at], "low": low[row]}
        )

    return run


def _reaching(left: pa.Table, right: pa.Table) -> pa.Table:
    """Raised local scores that reach the cutoff: NODES times the score against tau1, in whole numbers."""
    local = _products(left, right)
    own = local == np.iinfo(np.int64).min
    raised = np.where(own, 0, local - np.asarray(right.column("low"))[:, None])
    row, at = np.nonzero((raised * NODES >= np.asarray(right.column("tau"))[:, None]) & ~own)
    return pa.table({"query_id": np.asarray(right.column("query_id"))[row], "vec_id": np.asarray(left.column("vec_id"))[at], "raised": raised[row, at]})


def _kth(sums: DataFrame, k: int, name: str) -> DataFrame:
    """query_id and the k-th largest sum; 0 where there are fewer."""
    order = Window.partitionBy("query_id").orderBy(F.desc("sum"))
    best = sums.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= k)
    return best.groupBy("query_id").agg(F.when(F.count("*") == k, F.min("sum")).otherwise(0).alias(name))


def _scored(pairs: DataFrame, queries: DataFrame, rows: DataFrame) -> DataFrame:
    """query_id, vec_id, score of pairs (query_id, vec_id), from the vectors."""
    both = pairs.join(queries.select("query_id", F.col("ints").alias("_a")), "query_id").join(rows.select("vec_id", F.col("ints").alias("_b")), "vec_id")
    score = F.aggregate(F.zip_with("_a", "_b", lambda a, b: a * b), F.lit(0).cast("long"), lambda s, x: s + x)
    return both.select("query_id", "vec_id", score.alias("score"))


def search(vectors: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose vec_id is divisible by `every`, the k others of highest integer
    inner product, ties to the smaller vec_id."""
    ints = F.transform("embedding", lambda x: F.floor(x * SCALE))
    rows = written(usable(vectors).select("vec_id", F.size("embedding").alias("dim"), ints.alias("ints")))
    queries = rows.filter(F.col("vec_id") % every == 0).withColumnRenamed("vec_id", "query_id")
    blocks, query_blocks = (max(1, -(-f.count() // n)) for f, n in ((rows, BLOCK), (queries, QUERY_BLOCK)))
    width = F.ceil(F.col("dim") / NODES).cast("int")
    node = F.explode(F.sequence(F.lit(0), F.least(F.lit(NODES - 1), F.floor((F.col("dim") - 1) / width).cast("int")))).alias("node")
    part = F.slice("ints", F.col("node") * width + 1, width).alias("part")
    c = rows.select("*", node).select("vec_id", "dim", "node", part)
    q = queries.select("*", node).select("query_id", "dim", "node", part)

    heads = written(in_cells(c, q, ["dim", "node"], blocks, query_blocks, _heads(k), "query_id long, node int, vec_id long, local long, low long"))
    lows = heads.groupBy("query_id", "node").agg(F.min("low").alias("low"))
    order = Window.partitionBy("query_id", "node").orderBy(F.desc("local"), "vec_id")
    best = heads.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= k).select("query_id", "vec_id").distinct()
    raised = _scored(best, queries, rows).join(lows.groupBy("query_id").agg(F.sum("low").alias("low")), "query_id")
    tau1 = written(_kth(raised.withColumn("sum", F.col("score") - F.col("low")), k, "tau"))

    told = q.join(lows, ["query_id", "node"]).join(tau1, "query_id")
    sent = in_cells(c, told, ["dim", "node"], blocks, query_blocks, _reaching, "query_id long, vec_id long, raised long")
    seen = sent.groupBy("query_id", "vec_id").agg(F.sum("raised").alias("sum"), F.count("*").alias("seen")).join(tau1, "query_id")
    # NODES times the most the row can reach: a score that was not sent is below tau1 / NODES
    most = F.col("sum") * NODES + (NODES - F.col("seen")) * F.col("tau")
    open_ = written(seen.select("query_id", "vec_id", "sum", "seen", most.alias("most")).filter(F.col("most") >= F.col("tau") * NODES))
    tau2 = _kth(open_, k, "tau2")
    left = open_.join(tau2, "query_id").filter(F.col("most") >= F.col("tau2") * NODES).select("query_id", "vec_id")

    return top(_scored(left, queries, rows), k)


#: DuckDB SQL for search(): every query against every row
SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS ints FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.ints, c.ints)::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10"""
