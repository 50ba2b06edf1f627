"""Hard negatives by threshold joins with an inverted index that leaves out what suffix norms cover.

Every anchor has windows of scores to be filled with the best rows that lie in them: one window for its positives (rows of
its own label), then one for each positive (rows of other labels, scored between two shares of the positive's score).
A round joins the open windows with all rows above a threshold; windows that stay short are asked again with a lower one,
down to their lower end. A join works cell by cell, a block of anchors against a block of rows:
- a row's last dimensions are left out of the cell's index from where its suffix norm, times the largest suffix norm of
  an anchor, is below the smallest threshold: rows that meet an anchor in no indexed dimension cannot reach it;
- partial scores are accumulated over the index, and a pair ends where its partial score and both remaining norms
  together stay below the anchor's threshold;
- what is left is scored in full, and each window takes its best rows of the cell.

Components are whole numbers, floor(SCALE * x); scores are exact while 100 times a score fits into 64 bits.

Rows: a null label, null or empty vector, null or non-finite component, or null vec_id takes no part. vec_id is a key (of rows
that share one, the smallest counts). Vectors of different lengths are not compared. Fewer rows than a window asks for:
all there are. A positive of negative score has an empty window. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgermill.llm.store import written
from ledgermill.llm.vectors import QUERY_BLOCK, in_cells, matrix

SCALE = 256
#: rows and windows compared in one cell
BLOCK, WINDOWS = 8192, QUERY_BLOCK
#: dimensions accumulated between two looks at the remaining norms
STEP = 8
#: thresholds of the rounds: shares of the largest possible score for positives, of the positive's score for negatives
POSITIVE_LEVELS = (0.6, 0.35, 0.2)
NEGATIVE_LEVELS = (80, 60)

_FOUND = "query_id long, positive_id long, vec_id long, score long"


def rows_of(vectors: DataFrame, label: Column) -> DataFrame:
    """vec_id, label, dim, ints of the rows that take part; label: an expression over the table's columns."""
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    ints = F.transform(F.col("embedding").cast("array<double>"), lambda x: F.floor(x * SCALE))
    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), "embedding")
    good = own.filter("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND size(embedding) > 0").filter(~odd)
    one = good.groupBy("vec_id").agg(F.min(F.struct("label", ints.alias("ints"))).alias("r"))
    return one.select("vec_id", "r.label", F.size("r.ints").alias("dim"), "r.ints")


def suffix_norms(x: np.ndarray) -> np.ndarray:
    """Norm of every row from each dimension on; a last column of zeros."""
    squares = np.cumsum((x * x)[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.concatenate([squares, np.zeros((len(x), 1))], axis=1))


def reaching(q: np.ndarray, c: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of q, row of c) that may have an inner product of `least` (one for each row of q); all that do are among them."""
    by = np.argsort(-(c * c).sum(axis=0), kind="stable")  # weighty dimensions first: norms that remain fall fast
    q, c = q[:, by], c[:, by]
    size = c.shape[1]
    rest_q, rest_c = suffix_norms(q), suffix_norms(c)
    slack = 1e-9 * (1 + rest_q[:, 0].max() * rest_c[:, 0].max())
    uncovered = rest_c * rest_q.max(axis=0) >= least.min() - slack
    last = size - uncovered[:, ::-1].argmax(axis=1)
    indexed = np.where(uncovered.any(axis=1), np.minimum(last + 1, size), 0)  # dimensions of each row that the index holds
    order = np.argsort(-indexed, kind="stable")
    held = indexed[order]
    index = np.where(np.arange(size) < held[:, None], c[order], 0.0)
    partial = np.zeros((len(q), len(c)))
    for at in range(0, size, STEP):
        n = int(np.searchsorted(-held, -at))  # rows whose postings reach this dimension come first
        if not n:
            break
        partial[:, :n] += q[:, at : at + STEP] @ index[:n, at : at + STEP].T
    bound = rest_q[:, held] * rest_c[order, held]
    alive = (partial + bound >= least[:, None] - slack) & (held > 0)
    # what the index leaves out, as long as many pairs are alive
    first = int(held[held > 0].min()) if (held > 0).any() else size
    left = np.where(np.arange(size) < held[:, None], 0.0, c[order])
    for at in range(first, size, STEP):
        if alive.sum() * 20 <= alive.size:
            break
        partial += q[:, at : at + STEP] @ left[:, at : at + STEP].T
        done = np.maximum(held, min(at + STEP, size))
        alive &= partial + rest_q[:, done] * rest_c[order, done] >= least[:, None] - slack
    i, j = np.nonzero(alive)
    return i, order[j]


def _inner(q: np.ndarray, c: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    out = np.empty(len(i), np.int64)
    for at in range(0, len(i), 1 << 16):
        out[at : at + (1 << 16)] = (q[i[at : at + (1 << 16)]] * c[j[at : at + (1 << 16)]]).sum(axis=1)
    return out


def _windows(need: int, same_label: bool):
    """The `need` best rows of a cell for every window: low <= 100 * score <= high, and the label's rule."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        c, every = matrix(left, "ints", np.int64), matrix(right, "ints", np.int64)
        ids, labels = np.asarray(left.column("vec_id")), np.asarray(left.column("label"))
        anchors, first, owner = np.unique(np.asarray(right.column("query_id")), return_index=True, return_inverse=True)
        q, own = every[first], np.asarray(right.column("label"))[first]
        low, high, positive = (np.asarray(right.column(x)) for x in ("low", "high", "positive_id"))
        least = np.full(len(anchors), np.iinfo(np.int64).max)
        np.minimum.at(least, owner, low)
        out = []
        for a in range(0, len(anchors), 256):
            some = slice(a, a + 256)
            i, j = reaching(q[some].astype(float), c.astype(float), least[some] / 100)
            good = (ids[j] != anchors[some][i]) & ((labels[j] == own[some][i]) == same_label)
            i, j = i[good] + a, j[good]
            score = _inner(q, c, i, j)
            order = np.lexsort((ids[j], -score, i))
            i, j, score = i[order], j[order], score[order]
            begin = np.searchsorted(i, np.arange(len(anchors) + 1))
            for w in np.flatnonzero((owner >= a) & (owner < a + 256)):
                s = score[begin[owner[w]] : begin[owner[w] + 1]]
                fit = np.flatnonzero((100 * s >= low[w]) & (100 * s <= high[w]))[:need]
                at = j[begin[owner[w]] : begin[owner[w] + 1]][fit]
                out.append((np.full(len(fit), anchors[owner[w]]), np.full(len(fit), positive[w]), ids[at], s[fit]))
        columns = [np.concatenate(x) for x in zip(*out, strict=True)]
        return pa.table(dict(zip(("query_id", "positive_id", "vec_id", "score"), columns, strict=True)))

    return run


def _filled(rows: DataFrame, windows: DataFrame, levels: list[Column], need: int, same_label: bool) -> DataFrame:
    """query_id, positive_id, vec_id, score: the `need` best rows of every window (query_id, positive_id, label, dim, ints, low,
    high). levels: falling lower ends of the rounds, as 100 times a score; the last round goes down to `low` itself."""
    by = ["dim", "label"] if same_label else ["dim"]
    blocks, query_blocks = (max(1, -(-f.count() // n)) for f, n in ((rows, BLOCK), (windows, WINDOWS)))
    order = Window.partitionBy("query_id", "positive_id").orderBy(F.desc("score"), "vec_id")
    open_, found = windows, None
    for n, level in enumerate([*levels, F.col("low")]):
        asked = written(open_.withColumn("start", F.greatest(F.col("low"), level)))
        told = asked.filter("start <= high").withColumn("low", F.col("start")).drop("start")
        got = in_cells(rows, told, by, blocks, query_blocks, _windows(need, same_label), _FOUND)
        every = got if found is None else found.unionByName(got)
        found = written(every.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= need).drop("nth"))
        if n == len(levels):
            break
        have = found.groupBy("query_id", "positive_id").agg(F.count("*").alias("have"))
        short = asked.join(have, ["query_id", "positive_id"], "left").filter(F.coalesce("have", F.lit(0)) < need)
        # the next round starts right below this one
        open_ = short.filter(F.col("start") > F.col("low")).withColumn("high", F.least(F.col("high"), F.col("start") - 1)).drop("have", "start")
    return found


def mine(
    vectors: DataFrame, label: Column | None = None, every: int = 100, positives: int = 5, negatives: int = 10, lowest: int = 30, highest: int = 90
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose vec_id is divisible by `every`. A negative's score lies between `lowest` and `highest` percent of
    its positive's. label: expression for a row's label, the column `label` if none is given."""
    rows = written(rows_of(vectors, F.col("label") if label is None else label))
    anchors = rows.filter(F.col("vec_id") % every == 0).withColumnRenamed("vec_id", "query_id")
    norm = F.sqrt(F.aggregate("ints", F.lit(0.0), lambda s, x: s + x * x))
    longest = rows.agg(F.max(norm)).first()[0] or 0.0
    reach = norm * F.lit(100.0 * longest) + 100  # no score, 100 times, is beyond it
    whole = anchors.withColumns({"positive_id": F.lit(0).cast("long"), "low": -F.ceil(reach), "high": F.ceil(reach)})
    best = _filled(rows, whole, [F.floor(reach * share) for share in POSITIVE_LEVELS], positives, True)

    good = best.select("query_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    bounds = {"low": F.col("positive_score") * lowest, "high": F.col("positive_score") * highest}
    windows = written(anchors.join(good, "query_id").withColumns(bounds).filter("low <= high"))
    levels = [F.col("positive_score") * share for share in NEGATIVE_LEVELS if lowest < share < highest]
    hard = _filled(rows, windows, levels, negatives, False)
    order = Window.partitionBy("query_id", "positive_id").orderBy(F.desc("score"), "vec_id")
    return hard.join(good, ["query_id", "positive_id"]).select(
        F.col("query_id").alias("anchor_id"),
        "positive_id",
        F.row_number().over(order).alias("rank"),
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


#: DuckDB SQL for mine() with every seventh row's label moved by one: every anchor against every row
SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS ints FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.ints, c.ints)::BIGINT AS score
    FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
        row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
    FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10"""
