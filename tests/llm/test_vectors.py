"""Exact top-k against brute force; recall of the learned partitions."""

import math

import numpy as np
import pytest

from ledgermill.llm import partitions, topk
from ledgermill.llm.vectors import usable

ROW = "vec_id long, embedding array<float>, label int, query_id long, part string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, 1, "p") for i, v in rows], ROW)


def brute_top(rows, every, k):
    vectors = {i: [math.floor(1024 * float(np.float32(x))) for x in v] for i, v in rows}
    out = {}
    for q in vectors:
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(vectors[q], v, strict=True)), i) for i, v in vectors.items() if i != q)
            out.update({(q, n): (i, -s) for n, (s, i) in enumerate(scored[:k], 1)})
    return out


ODD = [(900, None), (901, [None, 1.0, 1, 1, 1]), (902, [math.nan, 1, 1, 1, 1]), (903, [math.inf, 1, 1, 1, 1]), (None, [1, 1, 1, 1, 1]), (904, [])]


@pytest.mark.parametrize("block,scale", [(8192, 1), (17, 1), (8192, 1e5)])
def test_top_k_as_by_brute_force(spark, monkeypatch, block, scale):
    monkeypatch.setattr(topk, "BLOCK", block)
    rng = np.random.default_rng(4)
    rows = [(i, (rng.standard_normal(5) * scale).tolist()) for i in range(150)]
    rows += [(i, rows[7][1]) for i in range(150, 190)]  # many ties
    got = topk.search(frame(spark, rows + ODD), every=10, k=4).collect()
    assert {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in got} == brute_top(rows, 10, 4)


def test_top_k_of_few_rows(spark):
    assert topk.search(frame(spark, [])).count() == 0
    assert topk.search(frame(spark, [(0, [1, 1])])).count() == 0
    rows = [(0, [1.0, 2]), (1, [0.5, -1]), (2, [-3, 0.001])]
    got = topk.search(frame(spark, [*rows, rows[1]])).collect()  # a repeated row counts once
    assert {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in got} == brute_top(rows, 100, 10)


def test_zero_vectors_take_part_in_inner_products(spark):
    rows = [(0, [1.0, 1]), (1, [0.0, 0]), (2, [-1, -1])]
    got = topk.search(frame(spark, rows)).collect()
    assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 0), (2, -(2 << 20))]


def cosine(a, b):
    a, b = np.array(a, np.float32).astype(float), np.array(b, np.float32).astype(float)
    return float((a * b).sum() / np.sqrt((a * a).sum()) / np.sqrt((b * b).sum()))


def test_recall_and_scores_of_partitions(spark):
    rng = np.random.default_rng(9)
    centres = rng.standard_normal((12, 24))
    x = np.concatenate([centres[rng.integers(0, 12, 1500)] + 0.4 * rng.standard_normal((1500, 24)), rng.standard_normal((700, 24))])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = partitions.search(frame(spark, [*rows, *ODD, (905, [0.0] * 24)]), every=20, k=5).collect()
    unit = partitions.unit(x.astype(np.float32).astype(float))
    hits = total = 0
    for q in range(0, len(x), 20):
        near = unit @ unit[q]
        near[q] = -2
        mine = {r.vec_id for r in got if r.query_id == q}
        assert len(mine) == 5
        hits, total = hits + len(mine & set(np.argsort(-near)[:5].tolist())), total + 5
    assert hits / total >= 0.9
    assert all(abs(r.score - cosine(x[r.query_id], x[r.vec_id])) < 1e-12 for r in got)


def test_partitions_of_few_rows_and_ties(spark):
    assert partitions.search(frame(spark, [])).count() == 0
    rows = [(0, [1.0, 0]), (1, [2, 0]), (2, [3, 0]), (3, [0.0, 0]), (4, [-1, 0]), (5, [5, 0])]
    got = partitions.search(frame(spark, rows), k=3).collect()
    assert [(r["rank"], r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 1, 1.0), (2, 2, 1.0), (3, 5, 1.0)]


def test_every_length_is_searched(spark):
    """Each length has its own parts; queries of all lengths get rows."""
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(8 if i % 3 else 5).tolist()) for i in range(1800)] + [(1800 + i, [1.0 + i, 1.0]) for i in range(60)]
    got = partitions.search(frame(spark, rows), every=50, k=5).collect()
    size = {i: len(v) for i, v in rows}
    asked = [i for i, _ in rows if i % 50 == 0]
    assert {q: len([r for r in got if r.query_id == q]) for q in asked} == dict.fromkeys(asked, 5)
    assert all(size[r.query_id] == size[r.vec_id] for r in got)


def test_parts_are_equal_and_cut_few_edges():
    rng = np.random.default_rng(2)
    x = partitions.unit(np.repeat(np.eye(8), 50, axis=0) + 0.05 * rng.standard_normal((400, 8)))
    graph = partitions.neighbour_graph(x, 5)
    part = partitions.balanced_parts(graph, 8, rng)
    assert np.bincount(part).tolist() == [50] * 8
    assert (part[graph] == part[:, None]).mean() > 0.9


def test_usable_rows(spark):
    rows = [(1, [1.0]), (1, [0.5]), *ODD]
    assert [(r.vec_id, r.embedding) for r in usable(frame(spark, rows)).collect()] == [(1, [0.5])]
