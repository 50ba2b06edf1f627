"""Repeated windows and repeated runs of lines against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from ledgermill.llm import lines, substrings


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_windows(rows, window):
    words = [(t or "").encode().split() for _, t in rows]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(rows, words, strict=True):
        gone = {i + d for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for d in range(window)}
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def test_the_cover_holds_all_differences():
    assert {(a - b) % substrings.PERIOD for a in substrings.COVER for b in substrings.COVER} == set(range(substrings.PERIOD))


@pytest.mark.parametrize("seed,batch", [(1, 1_500_000), (2, 40)])
def test_windows_as_by_brute_force(spark, odd_rows, monkeypatch, seed, batch):
    monkeypatch.setattr(substrings, "BATCH", batch)
    rng = random.Random(seed)
    passages = [[rng.choice("abcdefgh") * 3 for _ in range(rng.randint(30, 60))] for _ in range(5)]
    rows = []
    for i in range(60):
        text = []
        for _ in range(rng.randint(0, 3)):
            text += [str(rng.random()) for _ in range(rng.randint(0, 25))]
            text += rng.choice(passages)[rng.randint(0, 4) :]
        rows.append((i, "  ".join(text) + "\n"))
    rows += [(100, None), (101, ""), (102, "a " * 40), (None, "x " * 34), rows[5], rows[5], (103, rows[5][1])]
    got = Counter(tuple(r) for r in substrings.digests(odd_rows(rows)).collect())
    assert got == brute_windows(rows, 35)


def test_kept_words_and_empty_table(odd_rows):
    run = " ".join(f"w{i}" for i in range(40))
    rows = [(1, f"first {run} end"), (2, run), (3, "é own")]
    got = {r.doc_id: r.kept for r in substrings.remove_repeats(odd_rows(rows)).collect()}
    assert got == {1: "first end", 2: "", 3: "é own"}
    assert substrings.digests(odd_rows([])).count() == 0
    with pytest.raises(ValueError):
        substrings.digests(odd_rows(rows), window=20)


def brute_lines(rows, m):
    """Later copies in the order of doc_id (null first) and line; equal rows one after the other."""
    order = sorted(range(len(rows)), key=lambda n: (rows[n][0] is not None, rows[n][0] or 0, n))
    seen, out = set(), {}
    for n in order:
        every = (rows[n][1] or "").split("\n")
        at = [i for i, x in enumerate(every) if x.strip(" \t\r")]
        runs = [tuple(every[i] for i in at[p : p + m]) for p in range(len(at) - m + 1)]
        gone = set()
        for p, run in enumerate(runs):
            if run in seen:
                gone |= set(at[p : p + m])
            seen.add(run)
        out[n] = "\n".join(x for i, x in enumerate(every) if i not in gone)
    return Counter((rows[n][0], digest(t)) for n, t in out.items())


@pytest.mark.parametrize("m", [1, 2, 3, 5])
def test_lines_as_by_brute_force(odd_rows, m):
    rng = random.Random(m)
    rows = []
    for i in range(50):
        rows.append((i, "\n".join(rng.choice(["a", "b", "c", "", "  ", "d" * 50, str(rng.random())]) for _ in range(rng.randint(0, 14)))))
    rows += [(60, None), (61, ""), (None, "a\nb\nc\na\nb"), rows[7], rows[7]]
    got = Counter((r.doc_id, r.kept_sha256) for r in lines.runs(odd_rows(rows), m).collect())
    assert got == brute_lines(rows, m)


def test_maximal_runs_and_kept_columns(odd_rows):
    rows = [(1, "x\ny\nz\nown"), (2, "new\nx\ny\n\nz\ntail"), (3, "x\nz")]
    docs = odd_rows(rows)
    got = {r.doc_id: (r.n_lines, r.n_removed, r.n_runs, r.longest_run) for r in lines.runs(docs).collect()}
    assert got == {1: (4, 0, 0, 0), 2: (6, 3, 1, 3), 3: (2, 0, 0, 0)}
    out = lines.without_repeats(docs)
    assert out.schema.names == docs.schema.names
    kept = {r.doc_id: r for r in out.collect()}
    assert kept[2].text == "new\n\ntail" and kept[1].text == rows[0][1] and kept[3]["a b"] == 7
    assert lines.without_repeats(odd_rows([])).count() == 0
    assert [r.text for r in lines.without_repeats(odd_rows([(1, None)])).collect()] == [None]


def test_ranks_are_places_in_the_order(spark):
    groups = spark.createDataFrame([(a, b, n) for n, (a, b) in enumerate([(3, 1), (1, 9), (1, 2), (2, 2), (3, 0)], 2)], "a long, b long, n long")
    got = {(r.a, r.b): r["rank"] for r in lines._ranked(groups, ["a", "b"]).collect()}
    sizes, want, before = defaultdict(int), {}, 0
    for r in groups.collect():
        sizes[r.a, r.b] = r.n
    for key in sorted(sizes):
        want[key], before = before, before + sizes[key]
    assert got == want


def test_intervals_of_every_depth_as_by_brute_force(odd_rows):
    """All suffixes that share their first 2, 4, 8, ... lines with another, and the first of each group."""
    from ledgermill.llm.store import keyed

    rng = random.Random(7)
    passages = [[f"p{n} {i} {rng.choice('ab')}" for i in range(size)] for n, size in enumerate((3, 6, 11, 40))]
    texts = []
    for _ in range(25):
        own = []
        for _ in range(rng.randint(0, 3)):
            own += [rng.choice("xyz") for _ in range(rng.randint(0, 4))]
            passage = rng.choice(passages)
            own += passage[rng.randint(0, 3) : len(passage) - rng.randint(0, 3)]
        texts.append("\n".join(own))
    rows = keyed(odd_rows(list(enumerate(texts)))).cache()
    number = {(r.k1, r.k2): r.doc_id for r in rows.select("k1", "k2", "doc_id").collect()}
    got = {d: {(number[r.k1, r.k2], r["at"]): (r["first"].doc_id, r["first"]["at"]) for r in found.collect()} for d, found in lines.intervals(rows)}
    want, depth = {}, 2
    split = [[x for x in t.split("\n") if x.strip()] for t in texts]
    while True:
        groups = defaultdict(list)
        for n, own in enumerate(split):
            for i in range(len(own) - depth + 1):
                groups[tuple(own[i : i + depth])].append((n, i))
        shared = {s: min(g) for g in groups.values() if len(g) > 1 for s in g}
        if not shared:
            break
        want[depth] = shared
        depth *= 2
    assert got == want and max(want) >= 16
