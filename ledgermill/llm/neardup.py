"""Near-duplicate classes by consistent weighted sampling over TF-IDF shingles.

A text is a weighted set of its shingles of five words (all its words, if fewer): how often the shingle occurs, times its
inverse document frequency idf = (1 + log(1 / share)) / (1 + log(1 / COMMON)), where share is the part of all documents that
hold the shingle. Every shingle is counted, exactly and over all rows: one in a single document weighs most, one in COMMON of
them weighs 1, one in all of them least. For each of the SAMPLES hash functions the improved consistent weighted sampling scheme draws one (shingle, level); two texts draw the same with
the probability of their weighted Jaccard similarity. Bands of ROWS samples are matched, matches are verified by the exact
weighted Jaccard similarity of the whole texts, and texts linked by SIMILAR or more form a class, chains included.

Equal texts are one text from the start. In a band's bucket every text is compared with one hub first. Buckets that
still hold texts of several classes are then compared across classes, the pairs of closest samples first (ROUNDS); the pairs
of one class are never expanded, nor are pairs that an exact bound on their similarity excludes (CELLS).

Rows: null text is empty; texts without words are only like equal texts (null and empty are equal); repeated rows are
copies; null doc_id is allowed and never names a class of which another member has an id; other columns are kept in
representatives() and ignored elsewhere. Empty tables give empty results. Equal texts are told by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgermill.llm.arrays import Words, mix, slices, spans_hash
from ledgermill.llm.store import held, released, written

SHINGLE = 5
SIMILAR = 0.8
BANDS, ROWS = 16, 4
SAMPLES = BANDS * ROWS
#: the share of all documents at which a shingle weighs 1; above 1 document counts are left out and every shingle weighs 1
COMMON = 0.05
#: texts are counted in batches of about this many bytes, and of at most as many texts
BATCH_BYTES, BATCH_TEXTS = 4 << 20, 100_000
#: In how many places the samples of a pair must agree. Texts of similarity 0.8 agree in 51 of 64 places on average; 36 is
#: 4.7 deviations below.
AGREE = 36
#: parts of all shingles; a text's weight in each of them bounds what it can share with another
CELLS = 256
#: texts of a bucket that a task takes on either side; larger buckets are compared block by block
BLOCK = 2048
#: mean shingles of a block's texts; blocks of longer texts have fewer
SHINGLES = 512
_U = np.uint64
_BITS, _MASK = _U(44), _U((1 << 44) - 1)
#: a 44-bit hash travels as its highest 12 bits, once for many, and its 32 low ones
_LOW, _HEADS = _U(32), 1 << 12
_DRAWS = 1 << 16
_SIGNS = ("bands", "sketch", "total", "cells", "unit")


class _Draws:
    """Random numbers of the sampling scheme: gamma(2, 1) r, log of gamma(2, 1) c and uniform b, by a hash of the shingle."""

    def __init__(self):
        rng = np.random.default_rng(17)
        self.r = rng.gamma(2.0, 1.0, _DRAWS).astype(np.float32)
        self.c = np.log(rng.gamma(2.0, 1.0, _DRAWS)).astype(np.float32)
        self.b = rng.random(_DRAWS).astype(np.float32)
        self.odd = rng.integers(1, 2**63, SAMPLES, dtype=np.uint64) | _U(1)

    def levels(self, log: np.ndarray, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        """Levels of weights, given as logarithms, for the draws at some places."""
        return np.floor(log / self.r[at] + self.b[at])

    def values(self, log: np.ndarray, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        """What is compared: the smallest value of a text is its sample."""
        return self.c[at] - self.r[at] * (self.levels(log, at) - self.b[at] + 1)


_DRAWN = _Draws()


def shingles(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every shingle of a slice, row after row, and the row of each."""
    size = np.diff(words.first)
    count = np.where(size >= SHINGLE, size - SHINGLE + 1, (size > 0).astype(np.int64))
    row = np.repeat(np.arange(len(size)), count)
    place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    start = words.first[row] + place
    return spans_hash(words.hashes(), start, start + np.minimum(size[row], SHINGLE), 0xD1342543DE82EF95), row


class Weights:
    """Inverse document frequencies. A shingle's weight follows from the number of documents that hold it, out of `total`, where
    that number is at hand; else from a list of shingles (44-bit hashes, sorted) and their weights, all others weighing 1."""

    def __init__(self, codes: list[int], weights: list[float], total: int = 0):
        self.codes, self.weights, self.total = np.array(codes, np.uint64), np.array(weights, float), total
        self.unit = 1 + np.log(1 / COMMON) if COMMON <= 1 else None

    def by_documents(self, documents: np.ndarray) -> np.ndarray:
        if self.unit is None:
            return np.ones(len(documents))
        return (1 + np.log(self.total / np.minimum(documents, self.total))) / self.unit

    def of(self, codes: np.ndarray) -> np.ndarray:
        if not len(self.codes):
            return np.ones(len(codes))
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, self.weights[at], 1.0)


def _distinct(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and 44-bit hash of every distinct shingle of a text, row after row and sorted, and how often it occurs."""
    codes, row = shingles(Words(texts))
    keys, times = np.unique((row.astype(np.uint64) << _BITS) | (codes & _MASK), return_counts=True)
    return (keys >> _BITS).astype(np.int64), keys & _MASK, times


def _lists(values: np.ndarray, row: np.ndarray, n: int) -> pa.ListArray:
    """The values of each of n rows; row: sorted, one for each value."""
    ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))


def _flat(lists: pa.ChunkedArray | pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The values of a column of lists, and the row of each."""
    size = np.asarray(lists.value_lengths()) if isinstance(lists, pa.ListArray) else np.concatenate([np.zeros(0, np.int64), *[c.value_lengths() for c in lists.chunks]])
    values = lists.flatten() if isinstance(lists, pa.ListArray) else np.concatenate([np.zeros(0, np.int32), *[c.flatten() for c in lists.chunks]])
    return np.asarray(values), np.repeat(np.arange(len(size)), size.astype(np.int64))


def _codes(head: pa.ChunkedArray, low: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """44-bit hashes out of their two parts, and the row of each."""
    values, row = _flat(low)
    heads = np.asarray(head).astype(np.uint64)
    return (heads[row] << _LOW) | values.view(np.uint32).astype(np.uint64), row


def _in_batches(nodes: DataFrame, batches: int) -> tuple[DataFrame, DataFrame]:
    """Rows (node, text) dealt to batches by their doc_id and text, so that copies are spread; and each batch's distinct shingles
    with the number of rows that hold them, as lists by the highest bits of their hashes."""
    spread = max(1, _HEADS // min(batches, _HEADS))

    def count(table: pa.Table) -> pa.Table:
        codes, n = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for batch in slices(table.to_batches()):
            each, times = np.unique(_distinct(batch.column("text"))[1], return_counts=True)
            codes.append(each)
            n.append(times)
        known, inverse = np.unique(np.concatenate(codes), return_inverse=True)
        total = np.bincount(inverse, np.concatenate(n), len(known)).astype(np.int64)
        heads, row = np.unique((known >> _LOW).astype(np.int32), return_inverse=True)
        low = known.astype(np.uint32).view(np.int32)
        batch = np.full(len(heads), table.column("batch")[0].as_py(), np.int64)
        return pa.table({"part": heads // spread, "batch": batch, "head": heads, "low": _lists(low, row, len(heads)), "n": _lists(total, row, len(heads))})

    batch = F.pmod(F.xxhash64("node", "doc_id", F.lit(BATCH_BYTES)), F.lit(batches).cast("long"))
    dealt = nodes.select(batch.alias("batch"), "node", "text")
    return dealt, dealt.groupBy("batch").applyInArrow(count, "part int, batch long, head int, low array<int>, n array<long>")


def _size(nodes: DataFrame) -> tuple[int, int]:
    """Number of rows, and of the batches that they make."""
    total, size = nodes.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    return total, max(1, -(-(size or 0) // BATCH_BYTES), -(-total // BATCH_TEXTS))


def _counted(nodes: DataFrame, batches: int) -> tuple[DataFrame, DataFrame]:
    """Rows dealt to batches, and for each batch how many rows of the whole table hold its shingles, where that is more than 1.

    Every row counts and no shingle is left out. Batches send their shingles, each once, to the part that its hash falls in; a
    part sums the counts and sends them back to the batches that hold the shingle. One in all documents is an entry a batch."""

    def add(table: pa.Table) -> pa.Table:
        codes, row = _codes(table.column("head"), table.column("low"))
        _, inverse = np.unique(codes, return_inverse=True)
        total = np.bincount(inverse, _flat(table.column("n"))[0]).astype(np.int64)[inverse]
        many = total > 1
        low = codes[many].astype(np.uint32).view(np.int32)
        lists = [_lists(v, row[many], table.num_rows) for v in (low, total[many])]
        return pa.table({"batch": table.column("batch"), "head": table.column("head"), "low": lists[0], "n": lists[1]})

    dealt, counts = _in_batches(nodes, batches)
    return dealt, counts.groupBy("part").applyInArrow(add, "batch long, head int, low array<int>, n array<long>").filter(F.size("low") > 0)


def weights(docs: DataFrame) -> Weights:
    """The shingles in more than COMMON of the documents and their weights, to look at: by the same counts that _counted()
    gives for every shingle."""
    nodes = _nodes(docs)
    total, batches = _size(nodes)
    entries = _in_batches(nodes, batches)[1].select("head", F.inline(F.arrays_zip("low", "n")))
    counts = entries.groupBy("head", "low").agg(F.sum("n").alias("n")).filter(F.col("n") > COMMON * total)
    common = sorted(((r.head << 32) | (r.low & 0xFFFFFFFF), r.n) for r in counts.collect())
    return Weights([c for c, _ in common], Weights([], [], total).by_documents(np.array([n for _, n in common], np.int64)).tolist())


def weighted(texts: pa.Array, idf: Weights) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, 44-bit hash and weight of every distinct shingle of a text, row after row."""
    row, codes, times = _distinct(texts)
    return row, codes, times * idf.of(codes)


def cells(n: int, row: np.ndarray, codes: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weight of n texts in each of CELLS parts of all shingles, in units of the text (a power of 2) and never too low."""
    part = (mix(codes) >> _U(56)).astype(np.int64) % CELLS
    held = np.bincount(row * CELLS + part, weight, n * CELLS).reshape(n, CELLS)
    unit = np.exp2(np.ceil(np.log2(np.maximum(held.max(axis=1, initial=0), 1) / 255)))
    return np.minimum(np.ceil(held / unit[:, None]), 255).astype(np.uint8), unit


def most_alike(held: np.ndarray, total: np.ndarray, other: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """What the weighted Jaccard similarity of one text and each of others cannot exceed, by their weights in the cells."""
    low = np.minimum(held, other).sum(axis=1, dtype=float)
    return low / np.maximum(total + totals - low, 1e-9)


def sample(texts: pa.Array, idf: Weights) -> tuple[np.ndarray, np.ndarray]:
    """SAMPLES hashes of (shingle, level) for every text (0 without words), and the text's total weight."""
    return _drawn(len(texts), *weighted(texts, idf))


def _drawn(n: int, row: np.ndarray, codes: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    out = np.zeros((n, SAMPLES), np.uint64)
    total = np.bincount(row, weight, n).astype(float)  # of no rows it would count in integers
    if not len(row):
        return out, total
    first = np.flatnonzero(np.diff(row, prepend=-1))
    owner = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(row))))
    # most shingles have the weight of one that occurs once, in one document: its values are looked up
    kinds, times = np.unique(weight, return_counts=True)
    usual = times.argmax()
    odd = np.flatnonzero(weight != kinds[usual])
    log = np.log(weight).astype(np.float32)
    spread = mix(codes)
    d = _DRAWN
    plain = d.values(np.log(kinds).astype(np.float32)[usual])
    for k in range(SAMPLES):
        at = ((spread * d.odd[k]) >> _U(48)).astype(np.int64)
        value = plain[at]
        value[odd] = d.values(log[odd], at[odd])
        lowest = np.flatnonzero(value == np.minimum.reduceat(value, first)[owner])
        lowest = lowest[np.flatnonzero(np.diff(owner[lowest], prepend=-1))]  # ties go to the smallest shingle
        levels = d.levels(log[lowest], at[lowest]).astype(np.int64).astype(np.uint64)
        out[row[lowest], k] = mix(spread[lowest] ^ (levels * _U(0x9E3779B97F4A7C15)) ^ _U(k + 1))
    return out, total


def _nodes(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("node"))


def _signs(n: int, row: np.ndarray, codes: np.ndarray, weight: np.ndarray) -> dict[str, pa.Array]:
    """The columns _SIGNS of n texts."""
    samples, total = _drawn(n, row, codes, weight)
    held, unit = cells(n, row, codes, weight)
    bands = np.zeros((n, BANDS), np.uint64)
    for i in range(ROWS):
        bands = mix(bands ^ samples[:, i::ROWS]) + _U(i)
    values = pa.array(bands.view(np.int64).ravel())
    ends = pa.array(np.concatenate([[0], np.cumsum(np.where(total > 0, BANDS, 0))]), pa.int32())
    lists = pa.ListArray.from_arrays(ends, values.filter(pa.array(np.repeat(total > 0, BANDS))))
    sketch = pa.array([s.tobytes() for s in samples.astype(np.uint8)], pa.binary())
    parts = pa.array([h.tobytes() for h in held], pa.binary())
    return dict(zip(_SIGNS, (lists, sketch, pa.array(total), parts, pa.array(unit)), strict=True))


def _signed(nodes: DataFrame, idf: Weights, batches: int = 0) -> DataFrame:
    """node, bands (16 hashes, none without words), sketch (a byte of each sample), total weight, weight in each cell and its
    unit; one row for a text.

    With a number of batches the documents of every shingle are counted, and a column documents holds them for the distinct
    shingles of a text, in the order of their 44-bit hashes; without, weights are looked up in idf."""
    kind = "node long, bands array<long>, sketch binary, total double, cells binary, unit double"

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(found):
            signs = _signs(batch.num_rows, *weighted(batch.column("text"), idf))
            yield pa.RecordBatch.from_pydict({"node": batch.column("node"), **signs})

    def give(texts: pa.Table, counts: pa.Table) -> pa.Table:
        known = _codes(counts.column("head"), counts.column("low"))[0]
        n = _flat(counts.column("n"))[0]
        order = np.argsort(known)
        # one more beyond the last, so that every search ends at an entry
        known, n = np.append(known[order], _MASK + _U(1)), np.append(n[order], 1)
        out = []
        for batch in slices(texts.to_batches()):
            row, codes, times = _distinct(batch.column("text"))
            at = np.searchsorted(known, codes)
            documents = np.where(known[at] == codes, n[at], 1).astype(np.int32)
            signs = _signs(batch.num_rows, row, codes, times * idf.by_documents(documents))
            out.append(pa.table({"node": batch.column("node"), **signs, "documents": _lists(documents, row, batch.num_rows)}))
        return pa.concat_tables(out)

    if not batches:
        signed, more = nodes.select("node", "text").mapInArrow(run, kind), []
    else:
        dealt, counts = _counted(nodes, batches)
        signed, more = dealt.groupBy("batch").cogroup(counts.groupBy("batch")).applyInArrow(give, f"{kind}, documents array<int>"), ["documents"]
    return signed.groupBy("node").agg(*[F.first(c).alias(c) for c in (*_SIGNS, *more)])


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Of two texts given as sorted distinct shingles and their weights."""
    shared, at, bt = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    low = np.minimum(a[1][at], b[1][bt]).sum()
    return float(low / (a[1].sum() + b[1].sum() - low)) if len(shared) else 0.0


def _sets(texts: pa.Array, idf: Weights, documents: pa.ListArray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sorted distinct shingles of every text and their weights."""
    codes, row = shingles(Words(texts))
    held = None
    if documents is not None:
        values, owner = _flat(documents)
        held = np.split(idf.by_documents(values), np.searchsorted(owner, np.arange(1, len(texts))))
    out = []
    for i, part in enumerate(np.split(codes, np.searchsorted(row, np.arange(1, len(texts))))):
        own, times = np.unique(part, return_counts=True)
        short = own & _MASK
        out.append((own, times * (idf.of(short) if held is None else held[i][np.unique(short, return_inverse=True)[1]])))
    return out


def _verified(pairs: DataFrame, texts: DataFrame, idf: Weights) -> DataFrame:
    """(a, b) of the pairs whose texts are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text_b", 2 << 20):
            hubs, seen = np.asarray(batch.column("a")), {}
            new = np.flatnonzero(np.append(True, hubs[1:] != hubs[:-1]))
            for i in new.tolist():  # one text of a run of equal hubs
                if hubs[i] not in seen:
                    seen[hubs[i]] = _sets(batch.column("text_a").slice(i, 1), idf, batch.column("documents_a").slice(i, 1))[0]
            others = _sets(batch.column("text_b"), idf, batch.column("documents_b"))
            good = [weighted_jaccard(seen[h], own) >= SIMILAR - 1e-9 for h, own in zip(hubs, others, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    first, second = (texts.select(F.col("node").alias(x), F.col("text").alias(f"text_{x}"), F.col("documents").alias(f"documents_{x}")) for x in "ab")
    return pairs.join(second, "b").join(first, "a").mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """node, class_: the smallest node that links lead to, for every node of a link."""
    edges = written(links.union(links.select("b", "a")).distinct())
    labels = written(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("class_")))
    while True:
        near = edges.join(labels, edges.b == labels.node).groupBy("a").agg(F.min("class_").alias("low"))
        step = labels.join(near, labels.node == near.a, "left").select("node", F.least("class_", "low").alias("to"), F.col("class_").alias("was"))
        # then straight to where that label points
        jump = labels.select(F.col("node").alias("to"), F.col("class_").alias("further"))
        moved = written(step.join(jump, "to", "left").select("node", F.least("to", "further").alias("class_"), "was"))
        labels = moved.select("node", "class_")
        if moved.filter("class_ <> was").isEmpty():
            return labels


def _blocks(members: DataFrame) -> DataFrame:
    """members, copied to x <= y, two blocks of their bucket, one of which is their own `block`; every two members of a bucket
    meet where x and y are their blocks. n: a bucket's size."""
    blocks = F.ceil(F.col("n") / BLOCK).cast("long")
    dealt = members.withColumn("block", F.pmod(F.xxhash64("node", F.lit(BLOCK)), blocks))
    each = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    return each.withColumn("x", F.least("block", "_other")).withColumn("y", F.greatest("block", "_other")).drop("_other", "n")


def _exact(idf: Weights) -> Callable[[np.ndarray, pa.Array], Callable[[int, np.ndarray], np.ndarray]]:
    """For the texts of a block, as strings or as structs of text and documents: which others one of them is similar to, by
    the definition."""

    def prepare(nodes: np.ndarray, texts: pa.Array) -> Callable[[int, np.ndarray], np.ndarray]:
        sets = _sets(texts.field("text"), idf, texts.field("documents")) if pa.types.is_struct(texts.type) else _sets(texts, idf)
        size = np.array([len(codes) for codes, _ in sets], np.int64)
        begin = np.concatenate([[0], np.cumsum(size)])
        known, place = np.unique(np.concatenate([codes for codes, _ in sets]), return_inverse=True)
        weight = np.concatenate([w for _, w in sets])
        total = np.array([w.sum() for _, w in sets])
        held = np.zeros(len(known))

        def similar(one: int, others: np.ndarray) -> np.ndarray:
            own = slice(begin[one], begin[one + 1])
            held[place[own]] = weight[own]
            low = np.zeros(len(others))
            for at in range(0, len(others), 256):
                some = others[at : at + 256]
                each = size[some]
                start = np.cumsum(each) - each
                entry = np.repeat(begin[some] - start, each) + np.arange(each.sum())
                shared = np.concatenate([np.minimum(held[place[entry]], weight[entry]), [0.0]])
                low[at : at + 256] = np.where(each > 0, np.add.reduceat(shared, np.minimum(start, len(shared) - 1)), 0.0)
            held[place[own]] = 0.0
            return (low > 0) & (low >= (SIMILAR - 1e-9) * (total[one] + total[others] - low))

        return similar

    return prepare


def _across(buckets: DataFrame, texts: DataFrame, classes: DataFrame, some: DataFrame, prepare: Callable) -> DataFrame:
    """Links (a, b) that join classes within a bucket.

    In a block every two texts of different classes whose samples agree often enough, and whose weights in the cells let
    them be similar, are compared in the task that holds them, in the first bucket that they share. Texts are read once per
    block; what leaves a task are links between classes that it had not joined yet, fewer than it has texts."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        node, label, total = (np.asarray(table.column(c)) for c in ("node", "class_", "total"))
        sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(len(node), SAMPLES)
        held = np.frombuffer(b"".join(table.column("cells").to_pylist()), np.uint8).reshape(len(node), CELLS)
        held = held * np.asarray(table.column("unit"))[:, None].astype(np.float32)
        kinds, inverse, sizes = np.unique(label, return_inverse=True, return_counts=True)
        earlier = np.array(table.column("bands").to_pylist(), np.int64)[:, : table.column("band")[0].as_py()]
        block = np.asarray(table.column("block"))
        within = table.column("x")[0].as_py() == table.column("y")[0].as_py()
        similar, joined = None, np.arange(len(kinds))  # classes by number, and the class each has been joined to here
        a, b = [], []
        for i in np.flatnonzero(inverse != sizes.argmax()).tolist():
            fits = np.minimum(total, total[i]) >= (SIMILAR - 1e-9) * np.maximum(total, total[i])
            other = np.flatnonzero(fits & (joined[inverse] != joined[inverse[i]]) & (within | (block != block[i])))
            other = other[(sketch[other] == sketch[i]).sum(axis=1) >= AGREE]
            # an upper bound, so no similar pair is dropped
            other = other[most_alike(held[i], total[i], held[other], total[other]) >= SIMILAR - 1e-4]
            other = other[~(earlier[other] == earlier[i]).any(axis=1)]  # compared where they met first
            if not len(other):
                continue
            if similar is None:
                text = table.column("text").combine_chunks()
                similar = prepare(node, text.chunk(0) if isinstance(text, pa.ChunkedArray) else text)
            for j in other[similar(i, other)].tolist():
                if joined[inverse[i]] != joined[inverse[j]]:
                    joined[joined == joined[inverse[j]]] = joined[inverse[i]]
                    a.append(min(node[i], node[j]))
                    b.append(max(node[i], node[j]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    named = buckets.join(classes, "node", "left").withColumn("class_", F.coalesce("class_", "node"))
    # a block's size is bounded in texts and, by their total weights, in shingles
    size = F.greatest(F.count("*"), F.ceil(F.sum("total") / SHINGLES).cast("long"))
    mixed = named.groupBy("band", "hash").agg(F.min("class_").alias("x"), F.max("class_").alias("y"), size.alias("n")).filter("x <> y")
    members = _blocks(named.drop("total").join(mixed.select("band", "hash", "n"), ["band", "hash"])).join(texts.select("node", *_SIGNS), "node").join(some, "node")
    return members.groupBy("band", "hash", "x", "y").applyInArrow(run, "a long, b long").distinct()


def _classes(docs: DataFrame) -> DataFrame:
    """node, class_ of every text that is linked to another."""
    nodes = _nodes(docs)
    total, batches = _size(nodes)
    idf = Weights([], [], total)
    texts = written(_signed(nodes, idf, batches))
    banded = texts.select("node", "total", F.posexplode("bands").alias("band", "hash"))
    hubs = banded.groupBy("band", "hash").agg(F.count("*").alias("n"), F.min("node").alias("hub")).filter("n > 1").drop("n")
    buckets = written(banded.join(hubs, ["band", "hash"]))
    some = nodes.join(buckets.select("node").distinct(), "node").groupBy("node").agg(F.first("text").alias("text"))
    counts = [c for c in texts.columns if c == "documents"]
    some = written(some.join(texts.select("node", *counts), "node"))
    # most texts of a bucket are linked to its first one, which leaves few classes to compare
    first = buckets.filter("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    links = written(_verified(first, some, idf))
    whole = some.select("node", F.struct("text", *counts).alias("text"))
    across = written(_across(buckets.drop("hub"), texts, components(links), whole, _exact(idf)))
    return components(links.union(across))


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (smallest doc_id of the class), class_rows for every row."""
    nodes = _nodes(docs).select("doc_id", "node")
    named = nodes.join(_classes(docs), "node", "left").select("doc_id", F.coalesce("class_", "node").alias("class_"))
    first = named.groupBy("class_").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_rows"))
    return named.join(first, "class_").select("doc_id", "class_id", "class_rows")


def representatives(docs: DataFrame) -> DataFrame:
    """The row of smallest doc_id of each class, with all its columns."""
    rows = held(docs).select("row", F.col("row.doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col("row.text").cast("string"), F.lit(""))).alias("node"))
    known = _classes(docs)
    # the first row of each text, then the first text of each class: both find one small row before texts move
    ids = rows.select("doc_id", "node").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    named = ids.join(known, "node", "left").withColumn("class_", F.coalesce("class_", "node"))
    kept = named.groupBy("class_").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "node")).alias("k")).select(F.col("k.node").alias("node"), F.col("k.doc_id").alias("first_id"))
    copies = rows.join(kept, "node").filter(F.col("doc_id").eqNullSafe(F.col("first_id")))
    one = copies.withColumn("nth", F.row_number().over(Window.partitionBy("node").orderBy("doc_id"))).filter("nth = 1")
    return released(one, docs)
