"""Nearest neighbours by learned partitions.

On a bounded sample: the neighbour graph, its division into equal parts with few edges cut, and a small classifier that
learns, for a vector, in which parts its neighbours lie. Every row of the table is put into its most probable part.
A query goes to its most probable parts, as many as hold enough of its neighbours by the classifier's own account
(how much is enough is set on sample rows that it was not fitted to), and is compared there with every row by exact cosine.

The sample is the SAMPLE rows of smallest id hash; the model's size depends on its parameters alone. Large parts are
cut into blocks of rows, so no task holds a whole part.

Rows: null, zero, and vectors with null or non-finite components take no part, nor do rows without id; vec_id is a key
(rows that repeat an id as a whole count once). Each length of vectors has a sample and a router of its own; lengths of
fewer than ROUTED rows are one part. Fewer candidates than k: all that the parts hold. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.store import written
from ledgermill.llm.vectors import QUERY_BLOCK, in_cells, matrix, top, usable

SAMPLE = 5000
PARTS = 16
NEIGHBOURS = 10
#: share of the neighbours that the parts a query goes to are to hold, on average
COVERAGE = 0.97
HIDDEN = 64
STEPS = 300
#: rows of a length from which a router is fitted for it
ROUTED = 512
#: rows that a task compares at a time
BLOCK = 4096


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest others of every row of a matrix of unit vectors, as row numbers."""
    out = np.empty((len(x), min(k, len(x) - 1)), np.int64)
    for a in range(0, len(x), 1024):
        near = x[a : a + 1024] @ x.T
        near[np.arange(len(near)), np.arange(a, a + len(near))] = -np.inf
        out[a : a + 1024] = np.argpartition(-near, out.shape[1] - 1, axis=1)[:, : out.shape[1]]
    return out


def balanced_parts(graph: np.ndarray, parts: int, rng: np.random.Generator) -> np.ndarray:
    """Equal parts of a graph: halves by the slowest mode of averaging over neighbours, halved again."""
    n = len(graph)
    part = np.zeros(n, np.int64)
    source, target = np.repeat(np.arange(n), graph.shape[1]), graph.ravel()
    made = 1
    while made < parts:
        same = part[source] == part[target]
        a, b = np.concatenate([source[same], target[same]]), np.concatenate([target[same], source[same]])
        degree = np.bincount(a, minlength=n) + 1.0
        x = rng.standard_normal(n)
        size = np.bincount(part, minlength=made)
        for _ in range(60):
            x = 0.5 * x + 0.5 * (np.bincount(a, x[b], n) + x) / degree
            x -= (np.bincount(part, x * degree, made) / np.bincount(part, degree, made))[part]
            x /= np.sqrt(np.bincount(part, x * x, made) / size)[part] + 1e-30
        order = np.lexsort((x, part))
        rank = np.empty(n, np.int64)
        rank[order] = np.arange(n) - np.repeat(np.cumsum(size) - size, size)
        part = 2 * part + (rank >= (size // 2)[part])
        made *= 2
    return part


class Router:
    """Probability of every part for unit vectors: one hidden layer, fitted to where the sample's neighbours lie."""

    def __init__(self, x: np.ndarray, parts: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.parts = max(1, min(parts, 1 << int(np.log2(max(1, len(x) // 4)))))
        if self.parts == 1:
            return
        graph = neighbour_graph(x, NEIGHBOURS)
        part = balanced_parts(graph, self.parts, rng)
        where = part[graph]
        aim = np.zeros((len(x), self.parts))
        np.add.at(aim, (np.repeat(np.arange(len(x)), graph.shape[1]), where.ravel()), 1.0)
        aim /= aim.sum(axis=1, keepdims=True)
        d = x.shape[1]
        fit, check = np.arange(len(x)) % 5 != 0, np.arange(len(x)) % 5 == 0
        fit_rows = np.flatnonzero(fit)
        w = [rng.standard_normal((d, HIDDEN)) * np.sqrt(2.0), np.zeros(HIDDEN), rng.standard_normal((HIDDEN, self.parts)) / np.sqrt(HIDDEN), np.zeros(self.parts)]
        m, v = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w]
        for step in range(1, STEPS + 1):
            rows = rng.choice(fit_rows, min(512, len(fit_rows)))
            h = np.maximum(x[rows] @ w[0] + w[1], 0)
            e = (_softmax(h @ w[2] + w[3]) - aim[rows]) / len(rows)
            back = (e @ w[2].T) * (h > 0)
            grads = [x[rows].T @ back + 1e-4 * w[0], back.sum(0), h.T @ e + 1e-4 * w[2], e.sum(0)]
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                w[i] = w[i] - 0.01 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
        self.weights = w
        # rows lie where the classifier puts them, so neighbours are looked for there
        own = self.scores(x).argmax(axis=1)
        parts_, mass = self._ranked(x[check])
        place = np.argsort(parts_, axis=1)  # rank of every part for each held-out row
        need = np.take_along_axis(place, own[graph[check]], axis=1)  # ranks that reach each neighbour
        before = np.take_along_axis(mass, need, axis=1)  # probability of the better parts
        self.mass = float(np.quantile(before, COVERAGE))

    def scores(self, x: np.ndarray) -> np.ndarray:
        w = self.weights
        return _softmax(np.maximum(x @ w[0] + w[1], 0) @ w[2] + w[3])

    def _ranked(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Parts of each row from the most probable on, and the probability of all before each."""
        p = self.scores(x)
        parts = np.argsort(-p, axis=1, kind="stable")
        mass = np.cumsum(np.take_along_axis(p, parts, axis=1), axis=1)
        return parts, np.concatenate([np.zeros((len(x), 1)), mass[:, :-1]], axis=1)

    def home(self, x: np.ndarray) -> np.ndarray:
        """The part of each row."""
        return self.scores(x).argmax(axis=1) if self.parts > 1 else np.zeros(len(x), np.int64)

    def visited(self, x: np.ndarray) -> list[np.ndarray]:
        """The parts that each query goes to."""
        if self.parts == 1:
            return [np.zeros(1, np.int64)] * len(x)
        parts, before = self._ranked(x)
        return [p[b <= self.mass] for p, b in zip(parts, before, strict=True)]


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit(rows: DataFrame, parts: int = PARTS) -> dict[int, Router]:
    """A router from a sample for every length of vectors. rows: as usable() gives them, without zeros."""
    sized = rows.withColumn("dim", F.size("embedding"))
    routers = {}
    for dim, n in sorted((r["dim"], r["count"]) for r in sized.groupBy("dim").count().filter(f"count >= {ROUTED}").collect()):
        own = sized.filter(F.col("dim") == dim)
        sample = own.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("embedding").collect()
        routers[dim] = Router(unit(np.array([r.embedding for r in sample], float)), parts)
    return routers


def _nearest(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        c, q = matrix(left, "embedding"), matrix(right, "embedding")
        ids, queries = np.asarray(left.column("vec_id")), np.asarray(right.column("query_id"))
        c_norm, q_norm = np.sqrt((c * c).sum(axis=1)), np.sqrt((q * q).sum(axis=1))
        near = (q / q_norm[:, None]) @ (c / c_norm[:, None]).T
        near[queries[:, None] == ids[None, :]] = -np.inf
        bound = -np.partition(-near, min(k, near.shape[1]) - 1, axis=1)[:, min(k, near.shape[1]) - 1]
        out = []
        for i in range(len(queries)):
            # a block product may round equal vectors differently: what is close to the k-th is summed again row by row
            at = np.flatnonzero((near[i] >= bound[i] - 1e-9) & np.isfinite(near[i]))
            score = (c[at] * q[i]).sum(axis=1) / (c_norm[at] * q_norm[i])
            best = np.lexsort((ids[at], -score))[:k]
            out.append((np.full(len(best), queries[i]), ids[at][best], score[best]))
        columns = [np.concatenate(x) for x in zip(*out, strict=True)]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), columns, strict=True)))

    return run


def search(vectors: DataFrame, every: int = 50, k: int = 5, parts: int = PARTS) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose vec_id is divisible by `every`, the k nearest others found."""
    rows = written(usable(vectors).filter(F.exists("embedding", lambda x: x != 0)))
    routers = fit(rows, parts)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.diff(np.asarray(batch.column(1).offsets, np.int64))
            for dim in np.unique(size).tolist():
                own = batch.take(pa.array(np.flatnonzero(size == dim)))
                home, visits = np.zeros(own.num_rows, np.int64), [[0]] * own.num_rows
                if dim in routers:
                    x = unit(matrix(pa.Table.from_batches([own]), "embedding"))
                    home, visits = routers[dim].home(x), [v.tolist() for v in routers[dim].visited(x)]
                added = [pa.array(np.full(own.num_rows, dim), pa.int32()), pa.array(home), pa.array(visits, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([*own.columns, *added], names=["vec_id", "embedding", "dim", "part", "visits"])

    indexed = written(rows.mapInArrow(route, "vec_id long, embedding array<double>, dim int, part long, visits array<long>"))
    queries = indexed.filter(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "dim", "embedding", F.explode("visits").alias("part"))
    largest = indexed.groupBy("dim", "part").count().agg(F.max("count")).first()[0] or 1
    asked = queries.groupBy("dim", "part").count().agg(F.max("count")).first()[0] or 1
    found = in_cells(indexed.drop("visits"), queries, ["dim", "part"], -(-largest // BLOCK), -(-asked // QUERY_BLOCK), _nearest(k), "query_id long, vec_id long, score double")
    return top(found, k)
