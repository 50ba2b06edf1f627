"""Weighted sampling, near-duplicate classes, and the pipeline's stages."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgermill.llm import neardup


def jaccard(a, b, idf):
    """Weighted Jaccard similarity from dictionaries."""

    def weighted(text):
        words = (text or "").split()
        runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)] or ([tuple(words)] if words else [])
        return {r: runs.count(r) * idf.get(r, 1.0) for r in set(runs)}

    x, y = weighted(a), weighted(b)
    low = sum(min(x[r], y[r]) for r in x.keys() & y.keys())
    return low / (sum(x.values()) + sum(y.values()) - low) if low else 0.0


NO_IDF = neardup.Weights([], [])


def test_samples_agree_as_often_as_texts_are_similar():
    rng = random.Random(5)
    base = [str(rng.random()) for _ in range(400)]
    texts = [" ".join(base)]
    for changes in (2, 8, 20):
        own = list(base)
        for i in rng.sample(range(400), changes):
            own[i] = "x" + str(rng.random())
        texts.append(" ".join(own))
    texts.append(" ".join(base + base[:200]))  # repeated shingles weigh more
    samples, total = neardup.sample(pa.array([*texts, "", None, "one two"]), NO_IDF)
    for n in range(1, 5):
        want = jaccard(texts[0], texts[n], {})
        got = (samples[0] == samples[n]).mean()
        assert abs(got - want) < 4 * (want * (1 - want) / neardup.SAMPLES) ** 0.5 + 0.02
    assert total.tolist()[-3:] == [0, 0, 1] and not samples[-3:-1].any()
    assert np.array_equal(neardup.sample(pa.array(texts[2:3]), NO_IDF)[0][0], samples[2])


def test_weights_of_common_shingles(spark, odd_rows):
    common = "to be or not to"
    docs = odd_rows([(i, f"{common} w{i}a w{i}b w{i}c w{i}d w{i}e" if i < 30 else f"v{i}a v{i}b v{i}c v{i}d v{i}e v{i}f") for i in range(200)])
    idf = neardup.weights(docs)
    assert len(idf.codes) == 1
    assert idf.weights[0] == pytest.approx((1 + np.log(200 / 30)) / (1 + np.log(20)))
    codes = neardup.shingles(neardup.Words(pa.array([common])))[0] & neardup._MASK
    assert idf.of(codes)[0] == idf.weights[0]


def test_every_shingle_weighs_by_its_documents(spark, odd_rows, monkeypatch):
    """Counts of all shingles, the rare ones too, over all rows and however these are dealt; classes by these weights."""
    monkeypatch.setattr(neardup, "BATCH_BYTES", 2000)
    rng = random.Random(21)
    rows = near_rows(3)
    rows += [(1000 + i, rows[i % 3][1]) for i in range(9)] + [(2000, None), (2001, ""), (2002, "a b"), (2003, "a b")]
    runs = {i: {tuple(w[j : j + 5]) for j in range(len(w) - 4)} or ({tuple(w)} if w else set()) for i, w in ((n, (t or "").split()) for n, (_, t) in enumerate(rows))}
    held = Counter(r for own in runs.values() for r in own)
    rng.shuffle(rows)
    nodes = neardup._nodes(odd_rows(rows)).repartition(7)
    total, batches = neardup._size(nodes)
    assert total == len(rows) and batches > 50
    texts = {r.node: r.text for r in nodes.collect()}
    got = neardup._signed(nodes, neardup.Weights([], [], total), batches).collect()
    assert sorted(r.node for r in got) == sorted(texts)
    for r in got:
        words = texts[r.node].split()
        own = [words[j : j + 5] for j in range(len(words) - 4)] or ([words] if words else [])
        code = lambda run: int(neardup.shingles(neardup.Words(pa.array([" ".join(run)])))[0][0] & neardup._MASK)
        assert list(r.documents) == [n for _, n in sorted({code(run): held[tuple(run)] for run in own}.items())]
    idf = {run: (1 + np.log(total / n)) / (1 + np.log(20)) for run, n in held.items()}
    assert max(idf.values()) > 1.3  # a shingle of one document weighs more than one in 5 % of them
    known = {}

    def similar(a, b):
        if (a, b) not in known:
            known[a, b] = jaccard(a, b, idf)
        return known[a, b] >= 0.8 - 1e-9

    got = sorted((tuple(r) for r in neardup.classes(odd_rows(rows)).collect()), key=repr)
    assert got == brute_classes(rows, similar)


def test_verified_similarity_equals_its_definition():
    rng = random.Random(1)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 40))) for _ in range(25)]
    sets = neardup._sets(pa.array(texts), NO_IDF)
    for i in range(25):
        for j in range(25):
            assert neardup.weighted_jaccard(sets[i], sets[j]) == pytest.approx(jaccard(texts[i], texts[j], {}))


def brute_classes(rows, similar):
    """Class of every row by the smallest id, from all pairs of texts."""
    texts = sorted({t or "" for _, t in rows})
    root = {t: t for t in texts}

    def find(t):
        while root[t] != t:
            t = root[t]
        return t

    for i, a in enumerate(texts):
        for b in texts[:i]:
            if similar(a, b):
                root[find(a)] = find(b)
    ids = {}
    for i, t in rows:
        if i is not None:
            ids[find(t or "")] = min(i, ids.get(find(t or ""), i))
    sizes = {}
    for _, t in rows:
        sizes[find(t or "")] = sizes.get(find(t or ""), 0) + 1
    return sorted(((i, ids.get(find(t or "")), sizes[find(t or "")]) for i, t in rows), key=repr)


def near_rows(seed):
    """Groups of near copies around a text, chains of copies of copies, and unrelated texts."""
    rng = random.Random(seed)
    word = lambda: str(rng.randrange(10**6))
    rows = []

    def add(words):
        rows.append((len(rows), " ".join(words)))

    def changed(words, n):
        out = list(words)
        for i in rng.sample(range(len(out)), n):
            out[i] = word()
        return out

    for _ in range(4):
        base = [word() for _ in range(300)]
        for _ in range(12):
            add(changed(base, rng.randint(0, 12)))
        step = base
        for _ in range(8):
            step = changed(step, 4)
            add(step)
    boiler = [word() for _ in range(60)]
    for _ in range(40):
        add(boiler + [word() for _ in range(rng.randint(20, 200))])
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_as_by_all_pairs(odd_rows, monkeypatch, seed):
    monkeypatch.setattr(neardup, "COMMON", 2.0)  # no shingle is common, so that the definition alone decides
    rows = near_rows(seed)
    rows += [(500, None), (501, ""), (502, " \n"), (503, "a b"), (504, "a b"), (505, "a b c"), (None, "a b"), (None, "alone"), rows[3], rows[3], (2, "other text")]
    sets = {}

    def similar(a, b):
        for t in (a, b):
            if t not in sets:
                sets[t] = neardup._sets(pa.array([t]), NO_IDF)[0]
        return bool(a.split() and b.split()) and neardup.weighted_jaccard(sets[a], sets[b]) >= 0.8 - 1e-9

    got = sorted((tuple(r) for r in neardup.classes(odd_rows(rows)).collect()), key=repr)
    assert got == brute_classes(rows, similar)


def test_one_row_of_each_class_stays(odd_rows):
    words = [f"w{i}" for i in range(200)]
    rows = [(7, " ".join(words)), (3, " ".join(["x", *words[1:]])), (3, " ".join(["x", *words[1:]])), (9, "own"), (None, "own"), (None, None), (12, "")]
    docs = odd_rows(rows)
    out = neardup.representatives(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id, r["a b"]) for r in out.collect()) == [(3, 7), (9, 7), (12, 7)]
    assert neardup.representatives(odd_rows([])).count() == 0
    assert neardup.classes(odd_rows([])).count() == 0


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(1, 30)] + [(100, 50), (51, 50), (100, 51)]
    got = {r.node: r.class_ for r in neardup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 31)} | {100: 50, 50: 50, 51: 50}


def planted_classes(spark, odd_rows, monkeypatch, sketches, similar):
    """Classes of texts in one bucket, given their sketches and which pairs are similar; text 0 is the hub."""
    docs = odd_rows([(i, f"text {i}") for i in range(len(sketches))])
    nodes = sorted(r.node for r in neardup._nodes(docs).select("node").collect())
    kind = "node long, bands array<long>, sketch binary, total double, cells binary, unit double"
    rows = [(n, [7, *range(100 + 20 * i, 115 + 20 * i)], bytearray(bytes(s)), 256.0, bytearray(b"\x01" * 256), 1.0) for i, (n, s) in enumerate(zip(nodes, sketches, strict=True))]
    links = spark.createDataFrame([(nodes[min(p)], nodes[max(p)]) for p in similar], "a long, b long")
    monkeypatch.setattr(neardup, "_signed", lambda *_: spark.createDataFrame(rows, kind))
    monkeypatch.setattr(neardup, "_verified", lambda pairs, *_: pairs.join(links, ["a", "b"]))
    known = {frozenset((nodes[x], nodes[y])) for x, y in similar}

    def planted(_):
        return lambda own, texts: lambda i, others: np.array([frozenset((int(own[i]), int(own[j]))) in known for j in others], bool)

    monkeypatch.setattr(neardup, "_exact", planted)
    place = {n: i for i, n in enumerate(nodes)}
    groups = {}
    for r in neardup._classes(docs).collect():
        groups.setdefault(r.class_, set()).add(place[r.node])
    return sorted(map(sorted, groups.values()))


def sketch(*changes):
    """64 samples; those at the given places are the text's own."""
    out = [0] * 64
    for at, value in changes:
        out[at] = value
    return out


def test_border_link_behind_many_closer_texts(spark, odd_rows, monkeypatch):
    closer = [sketch((62, i + 1), (63, i + 1)) for i in range(21)]
    x, y = sketch(*[(i, 1) for i in range(9)]), sketch(*[(i, 2) for i in range(9, 19)])
    assert sum(a == b for a, b in zip(x, y, strict=True)) == 45
    assert planted_classes(spark, odd_rows, monkeypatch, [*closer, x, y], [(21, 22)]) == [[21, 22]]


def test_link_across_that_slides_to_the_front(spark, odd_rows, monkeypatch):
    large = [sketch((63, i + 1)) for i in range(20)]
    small = [sketch(*[(at, 1) for at in range(11)], (62, i + 1)) for i in range(4)]
    links = [(0, i) for i in range(1, 20)] + [(20, 21), (20, 22), (20, 23), (1, 20)]
    assert sum(a == b for a, b in zip(small[0], large[0], strict=True)) == 51
    assert planted_classes(spark, odd_rows, monkeypatch, large + small, links) == [list(range(24))]


def test_large_buckets_meet_block_by_block(spark, odd_rows, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 8)
    members = spark.createDataFrame([(1, 5, i, 60) for i in range(60)] + [(2, 5, i, 3) for i in range(3)], "band int, hash long, node long, n long")
    met, size = set(), {}
    for r in neardup._blocks(members).groupBy("band", "hash", "x", "y").agg({"*": "count", "node": "collect_list", "block": "collect_list"}).collect():
        own = dict(zip(r["collect_list(node)"], r["collect_list(block)"], strict=True))
        size[r.band, r.x, r.y] = len(own)
        for i in own:
            for j in own:
                if i < j and {own[i], own[j]} == {r.x, r.y}:
                    assert (r.band, i, j) not in met
                    met.add((r.band, i, j))
    assert len(met) == 60 * 59 // 2 + 3 and max(size.values()) < 40 and (2, 0, 0) in size
    closer = [sketch((62, i + 1), (63, i + 1)) for i in range(21)]
    x, y = sketch(*[(i, 1) for i in range(9)]), sketch(*[(i, 2) for i in range(9, 19)])
    assert planted_classes(spark, odd_rows, monkeypatch, [*closer, x, y], [(21, 22), (3, 21)]) == [[3, 21, 22]]


def test_bound_by_cells_is_never_below_the_similarity():
    rng = random.Random(8)
    base = [str(rng.random()) for _ in range(300)]
    texts = [" ".join(base[rng.randint(0, 60) :] + ["a b c d e"] * rng.randint(0, 3000)) for _ in range(12)] + ["", "one", " ".join(base)]
    idf = neardup.Weights(sorted(int(c) for c in neardup.shingles(neardup.Words(pa.array(["a b c d e"])))[0] & neardup._MASK), [0.3])
    own = neardup.weighted(pa.array(texts), idf)
    held, unit = neardup.cells(len(texts), *own)
    total, sets = neardup.sample(pa.array(texts), idf)[1], neardup._sets(pa.array(texts), idf)
    held = held * unit[:, None].astype(np.float32)
    for i in range(len(texts)):
        bound = neardup.most_alike(held[i], total[i], held, total)
        assert all(bound[j] >= neardup.weighted_jaccard(sets[i], sets[j]) - 1e-6 for j in range(len(texts)))


FOLDER = "/root/testdata/sf0.001"


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "line_dedup", "near_dedup", "pii", "packing"] and corpus_pipeline.ORACLE_SQL is None
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    sizes = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.written(stage(spark, docs, FOLDER))
        assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
        sizes.append(out.count())
        if len(sizes) == 1:
            kept = {r.doc_id for r in out.select("doc_id").collect()}
            lost = {r.doc_id for r in docs.select("doc_id").collect()} - kept
            assert all(labels.get(i) != 1 for i in lost)
        assert out.filter("n_chars <> length(text)").count() == 0
        docs = out
    assert sizes[0] == sizes[1] >= sizes[2] == sizes[3]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    assert corpus_pipeline.run(spark, FOLDER).count() == packed.count()


def test_block_similarity_equals_its_definition():
    rng = random.Random(12)
    texts = [" ".join(rng.choice("abcd") for _ in range(rng.randint(0, 30))) for _ in range(40)] + ["a b c d e f g"] * 3
    idf = neardup.Weights(sorted(int(c) for c in neardup.shingles(neardup.Words(pa.array(["a b c d e"])))[0] & neardup._MASK), [0.3])
    sets = neardup._sets(pa.array(texts), idf)
    similar = neardup._exact(idf)(np.arange(len(texts)), pa.array(texts))
    every = np.arange(len(texts))
    for i in range(len(texts)):
        want = [neardup.weighted_jaccard(sets[i], s) >= 0.8 - 1e-9 for s in sets]
        assert similar(i, every).tolist() == want


def test_few_rows_leave_a_block(spark, odd_rows, monkeypatch):
    """A bucket of texts that are all similar, none of them to the hub: links, not pairs, leave the task."""
    monkeypatch.setattr(neardup, "_verified", lambda pairs, *_: pairs.filter("false"))
    base = [f"w{i}" for i in range(60)]
    docs = odd_rows([(n, " ".join([*base, f"x{n}"])) for n in range(40)])
    idf = neardup.weights(docs)
    nodes = neardup._nodes(docs)
    texts = neardup._signed(nodes, idf)
    banded = texts.select("node", "total", F.posexplode("bands").alias("band", "hash"))
    none = spark.createDataFrame([], "node long, class_ long")
    found = neardup._across(banded, texts, none, nodes.select("node", "text"), neardup._exact(idf)).collect()
    assert 39 <= len(found) <= 39 * neardup.BANDS
    assert len({r.class_ for r in neardup._classes(docs).collect()}) == 1
