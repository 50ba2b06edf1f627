"""Hard negatives, near-duplicate vectors and whitening against brute force."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgermill.llm import closeness, negatives, whitening

ROW = "vec_id long, embedding array<float>, label int, query_id long, part string, node string, a long, dim string"
ODD = [(900, None), (901, [None, 1.0, 1, 1, 1]), (902, [math.nan, 1, 1, 1, 1]), (903, [math.inf, 1, 1, 1, 1]), (904, [])]


def frame(spark, rows, labels=None):
    label = labels or {}
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], label.get(i, 0), 1, "p", "n", 2, "d") for i, v in rows], ROW)


def ints(v):
    return [math.floor(256 * float(np.float32(x))) for x in v]


def brute_negatives(rows, labels, every):
    vectors = {i: ints(v) for i, v in rows if labels[i] is not None}
    out = set()
    for a in vectors:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(vectors[a], v, strict=True)), i) for i, v in vectors.items() if i != a)
        for p, i in [(p, i) for p, i in scored if labels[i] == labels[a]][:5]:
            near = [(s, n) for s, n in scored if labels[n] != labels[a] and 30 * -p <= 100 * -s <= 90 * -p]
            out |= {(a, i, rank, n, -p, -s) for rank, (s, n) in enumerate(near[:10], 1)}
    return out


@pytest.mark.parametrize("block,scale", [(8192, 1), (23, 0.2), (8192, 300)])
def test_hard_negatives_as_by_brute_force(spark, monkeypatch, block, scale):
    monkeypatch.setattr(negatives, "BLOCK", block)
    monkeypatch.setattr(negatives, "WINDOWS", 40 if block == 23 else 4096)
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((6, 12))
    rows = [(i, (scale * (centres[i % 6] * (i % 3) + rng.standard_normal(12))).tolist()) for i in range(260)]
    rows += [(i, rows[10][1]) for i in range(260, 300)]  # ties
    labels = {i: None if i % 41 == 5 else int(rng.integers(0, 4)) for i, _ in rows}
    got = negatives.mine(frame(spark, rows + ODD, labels), every=10).collect()
    assert {tuple(r) for r in got} == brute_negatives(rows, labels, 10)
    assert len(got) == len({tuple(r) for r in got})


def test_hard_negatives_of_few_rows(spark):
    assert negatives.mine(frame(spark, [])).count() == 0
    assert negatives.mine(frame(spark, [(0, [1, 1]), (1, [1, 1])])).count() == 0  # no other label
    rows = [(0, [1.0, 0]), (1, [0.9, 0.1]), (2, [0.5, 0.5]), (3, [-1, 0]), (4, [0, 1.0]), (5, [0.0, 0.0])]
    labels = {0: 1, 1: 1, 2: 2, 3: 1, 4: 3, 5: None}
    got = negatives.mine(frame(spark, [*rows, rows[1]], labels)).collect()  # a repeated row counts once
    assert {tuple(r) for r in got} == brute_negatives(rows, labels, 100)


def test_index_keeps_every_pair_that_reaches_the_threshold():
    rng = np.random.default_rng(8)
    for least in (-2.0, 0.0, 1.5, 4.0, 9.0, 40.0):
        q, c = rng.standard_normal((30, 20)), rng.standard_normal((200, 20)) * np.linspace(2, 0.05, 20)
        i, j = negatives.reaching(q, c, np.full(30, least))
        true = {tuple(x) for x in np.argwhere(q @ c.T >= least).tolist()}
        assert true <= set(zip(i.tolist(), j.tolist(), strict=True))
        assert least < 4 or len(i) < 30 * 200 / 2  # and prunes


def brute_links(rows):
    x = {i: np.array(np.float32(v), float) for i, v in rows}
    ids = sorted(x)
    near = {i: {j for j in ids if i != j and len(x[i]) == len(x[j]) and (x[i] * x[j]).sum() / (np.linalg.norm(x[i]) * np.linalg.norm(x[j])) >= 0.9} for i in ids}
    component = {}
    for i in ids:
        if i not in component:
            todo = [i]
            while todo:
                k = todo.pop()
                if k not in component:
                    component[k] = i
                    todo += near[k]
    return {i: (len(near[i]), component[i], component[i] == i) for i in ids}


def cluster(rng, centre, n, noise):
    return [(centre + noise * rng.standard_normal(len(centre)) / math.sqrt(len(centre))).tolist() for _ in range(n)]


@pytest.mark.parametrize("block,dim", [(32768, 16), (40, 16), (32768, 3), (32768, 7)])
def test_links_as_by_brute_force(spark, monkeypatch, block, dim):
    monkeypatch.setattr(closeness, "BLOCK", block)
    rng = np.random.default_rng(dim)
    unit = closeness.unit(rng.standard_normal((9, dim)))
    vectors = [v for n, c in enumerate(unit) for v in cluster(rng, c, 30, 0.1 + 0.12 * n)]  # balls, overlapping ones, loose groups
    vectors += cluster(rng, unit[0], 60, 0.12) + cluster(rng, unit[0] + 0.3 * unit[1], 20, 0.1) + rng.standard_normal((60, dim)).tolist()
    vectors += [[3 * y for y in vectors[5]]] + [vectors[2]] * 25 + [vectors[-3]] * 3
    ids = rng.permutation(len(vectors)).tolist()
    rows = list(zip(ids, vectors, strict=True))
    odd = [*ODD, (905, [0.0] * dim), (906, [1.0, 1.0]), (907, [2.0, 2.0])]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in closeness.links(frame(spark, rows + odd)).collect()}
    want = brute_links([*rows, (906, [1.0, 1.0]), (907, [2.0, 2.0])])
    want |= {i: (0, i, True) for i, _ in [*ODD, (905, None)]}
    assert got == want


def test_dense_groups_become_balls(spark):
    rng = np.random.default_rng(1)
    centre = closeness.unit(rng.standard_normal((1, 64)))[0]
    x = np.float32(cluster(rng, centre, 400, 0.11))
    nodes = spark.createDataFrame([(i, 1, 64, v.tolist()) for i, v in enumerate(x)], "node long, copies long, dim int, embedding array<float>")
    inside = closeness.balls(nodes, math.sqrt(0.2) / 2).collect()
    assert len({r.node for r in inside}) == len(inside) > 340
    assert len({r.hub for r in inside}) < 20


def test_links_of_few_rows(spark):
    assert closeness.links(frame(spark, [])).count() == 0
    got = closeness.links(frame(spark, [(3, [1, 0]), (3, [1, 0]), (5, [2, 0]), (None, [1, 0]), (7, None)])).collect()
    assert sorted((r.vec_id is None, r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in got) == [(False, 3, 1, 3, True), (False, 5, 1, 3, False), (False, 7, 0, 7, True), (True, 0, 0, None, True)]


def brute_white(rows, k=4):
    x = [(i, ints(v)) for i, v in rows]
    fit = sorted({tuple(v) for _, v in x})
    n, s = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centred = np.array([[float(Fraction(n * a - b, n)) for a, b in zip(v, s, strict=True)] for v in fit])
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1], u[:, ::-1]
    out = {}
    for i, v in x:
        d = np.array([float(Fraction(n * a - b, n)) for a, b in zip(v, s, strict=True)])
        for c in range(min(k, len(s))):
            out[i, c + 1] = (n, sum((n * a - b) ** 2 for a, b in zip(v, s, strict=True)), abs(float(d @ u[:, c] / math.sqrt(e[c]))), e[c] / e.sum())
    return out


@pytest.mark.parametrize("scale", [1, 1e5, 3e13])
def test_whitening_as_by_brute_force(spark, monkeypatch, scale):
    monkeypatch.setattr(whitening, "ROWS", 70)
    rng = np.random.default_rng(6)
    mixed = rng.standard_normal((9, 9)) * np.linspace(3, 0.3, 9)
    rows = [(i, (scale * (rng.standard_normal(9) @ mixed)).tolist()) for i in range(200)]
    rows += [(i, rows[4][1]) for i in range(200, 260)]  # copies count once in the fit
    got = whitening.whiten(frame(spark, rows + ODD)).collect()
    want = brute_white(rows)
    assert len(got) == len(want) == 4 * 260
    sign = {}
    for r in got:
        n, deviation, white, explained = want[r.vec_id, r.component]
        assert (r.n, r.deviation) == (n, deviation if deviation < 10**38 else None)
        assert abs(abs(r.whitened) - white) < 1e-6 and abs(r.explained / explained - 1) < 1e-9 and r.identity_error < 1e-9
        sign.setdefault(r.component, []).append(r.whitened)
    assert all(np.ptp(v) > 2 for v in sign.values())


def test_bit_sliced_products_are_exact():
    rng = np.random.default_rng(5)
    for low, high in ((-200, 200), (0, 1), (-(2**40), 2**41), (-(2**63), 2**63 - 1)):
        x = rng.integers(low, high, (131, 5), endpoint=True)
        s, q = whitening.products(x)
        big = x.astype(object)
        assert s.tolist() == big.sum(axis=0).tolist()
        assert all(q[a, b] == (big[:, a] * big[:, b]).sum() for a in range(5) for b in range(a, 5))


def test_whitening_of_few_rows_and_lengths(spark):
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [(1, [1, 2]), (2, [1, 2])])).count() == 0  # no variance
    rows = [(1, [1.0, 2]), (2, [3.0, 1]), (None, [0.0, 5]), (4, [2.0]), (5, [4.0]), (5, [4.0])]
    got = whitening.whiten(frame(spark, rows)).withColumn("n", F.col("n")).collect()
    assert sorted((r.vec_id or 0, r.component, r.n) for r in got) == [(0, 1, 3), (0, 2, 3), (1, 1, 3), (1, 2, 3), (2, 1, 3), (2, 2, 3), (4, 1, 2), (5, 1, 2), (5, 1, 2)]
    assert all(abs(abs(r.whitened) - 1) < 1e-12 for r in got if r.n == 2)
