"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of PASSAGE words. Each passage is described by what its characters and words look like
and encoded by a learned layer; gated attention, learned from document labels alone, weighs the passages, and the
weighted sum is scored. Every passage of every text is encoded, and a text's passages never leave their task.

The model is fitted on the driver to TRAIN_ROWS labelled rows at most, those of smallest id hash, and to every
passage of each, so its input is bounded by the rows and grows with their length only.

Rows: a null or empty text is one empty passage and has a score; repeated rows give a row each; null doc_id is never
held out; of several labels for an id the lowest counts, null labels do not; without any labels every score is 0.5.
Other columns are kept out of the score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.arrays import Words, slices

PASSAGE = 64
TRAIN_ROWS = 4000
ENCODED, GATED, STEPS, BAGS = 24, 16, 500, 256

# classes of bytes: other, blank, line end, lower, upper, digit, full stop, comma, bar, exclamation, signs, beyond ASCII
_CLASS = np.zeros(256, np.int32)
for _n, _chars in enumerate((" \t\r\x0b\x0c", "\n", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".", ",", "|", "!?", "#$%&*@^~+=<>_"), 1):
    _CLASS[list(_chars.encode())] = _n
_CLASS[128:] = 11
_CLASSES = 12
FEATURES = _CLASSES + 10


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def passages(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of a slice, row after row, and each row's first passage (one more at the end)."""
    words = Words(texts)
    size = np.diff(words.first)
    count = np.maximum(1, -(-size // PASSAGE))
    first = np.concatenate([[0], np.cumsum(count)])
    row = np.repeat(np.arange(len(size)), count)
    place = np.arange(first[-1]) - first[row]
    begin = words.first[row] + place * PASSAGE
    n = np.minimum(words.first[row + 1] - begin, PASSAGE).astype(float)
    start = np.append(words.start, len(words.data))
    byte = np.append(np.where(place == 0, words.at[row], start[begin]), len(words.data))
    length = np.diff(byte)
    kinds = np.zeros((len(row), _CLASSES), np.int64)
    for a in range(0, len(row), 512):  # few passages at a time, since this takes whole numbers for every byte
        own = np.repeat(np.arange(len(length[a : a + 512]), dtype=np.int32), length[a : a + 512])
        one = _CLASS[words.data[byte[a] : byte[a] + len(own)]]
        kinds[a : a + 512] = np.bincount(own * _CLASSES + one, minlength=len(length[a : a + 512]) * _CLASSES).reshape(-1, _CLASSES)
    shares = kinds / np.maximum(length, 1)[:, None]

    per = np.maximum(n, 1)
    of = np.repeat(np.arange(len(row)), n.astype(np.int64))
    mean = lambda x: np.bincount(of, x, len(row)) / per
    wide = (words.end - words.start).astype(float)
    code = words.hashes()
    small = np.concatenate([[0], np.cumsum(_CLASS[words.data] == 3, dtype=np.int32)])
    large = _CLASS[words.data[words.start]] == 4 if len(words) else np.zeros(0, bool)
    loud = (small[words.end] == small[words.start]) & large & (wide > 1)
    again = np.zeros(len(words))
    again[1:] = (code[1:] == code[:-1]) & (of[1:] == of[:-1])
    key = np.sort((of.astype(np.uint64) << np.uint64(40)) | (code >> np.uint64(24)))
    fresh = np.ones(len(key), bool)
    fresh[1:] = key[1:] != key[:-1]
    distinct = np.bincount((key[fresh] >> np.uint64(40)).astype(np.int64), minlength=len(row)) / per
    last = _CLASS[words.data[words.end - 1]] if len(words) else np.zeros(0, np.int64)
    average = mean(wide)
    spread = np.sqrt(np.maximum(mean(wide * wide) - average**2, 0))
    bare = np.where(wide == 1, 1.0, 0.0)
    more = [average / 10, spread / 10, mean(again), distinct, mean(large), mean(loud), mean(last == 6), mean(last == 10), mean(bare), np.log1p(n)]
    return np.column_stack([shares, *more]).astype(np.float32), first


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Model:
    """Weights: encoder (W, b), attention (V, U, w), scorer (c, d); centre and scale of the features."""

    weights: list[np.ndarray]
    centre: np.ndarray
    scale: np.ndarray

    def forward(self, x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        w, b, v, u, g, c, d = self.weights
        bag = np.repeat(np.arange(len(first) - 1), np.diff(first))
        x = np.clip((x - self.centre) / self.scale, -6, 6)
        h = np.tanh(x @ w + b)
        a, gate = np.tanh(h @ v), _sigmoid(h @ u)
        s = (a * gate) @ g
        e = np.exp(s - np.maximum.reduceat(s, first[:-1])[bag])
        weight = e / np.add.reduceat(e, first[:-1])[bag]
        z = np.add.reduceat(weight[:, None] * h, first[:-1])
        return {"x": x, "h": h, "a": a, "gate": gate, "weight": weight, "z": z, "score": _sigmoid(z @ c + d[0]), "bag": bag}

    def gradients(self, x: np.ndarray, first: np.ndarray, label: np.ndarray) -> list[np.ndarray]:
        w, b, v, u, g, c, d = self.weights
        f = self.forward(x, first)
        h, a, gate, weight, bag = f["h"], f["a"], f["gate"], f["weight"], f["bag"]
        miss = (f["score"] - label) / len(label)
        to_z = (miss[:, None] * c)[bag]
        to_weight = (to_z * h).sum(axis=1)
        to_s = weight * (to_weight - np.add.reduceat(weight * to_weight, first[:-1])[bag])
        to_a = to_s[:, None] * g * gate * (1 - a * a)
        to_gate = to_s[:, None] * g * a * gate * (1 - gate)
        to_h = (weight[:, None] * to_z + to_a @ v.T + to_gate @ u.T) * (1 - h * h)
        return [f["x"].T @ to_h, to_h.sum(axis=0), h.T @ to_a, h.T @ to_gate, (a * gate).T @ to_s, f["z"].T @ miss, miss.sum(keepdims=True)]


def fit(bags: list[np.ndarray], labels: np.ndarray, seed: int = 3) -> Model | None:
    if not bags:
        return None
    rng = np.random.default_rng(seed)
    every = np.concatenate(bags).astype(float)
    shapes = [(FEATURES, ENCODED), (ENCODED,), (ENCODED, GATED), (ENCODED, GATED), (GATED,), (ENCODED,), (1,)]
    weights = [rng.standard_normal(s) / np.sqrt(s[0]) if len(s) == 2 else 0.1 * rng.standard_normal(s) for s in shapes]
    model = Model(weights, every.mean(axis=0), every.std(axis=0) + 1e-3)
    m, v = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes]
    for step in range(1, STEPS + 1):
        rows = rng.choice(len(bags), min(BAGS, len(bags)), replace=False)
        some = [bags[i] for i in rows]
        first = np.concatenate([[0], np.cumsum([len(x) for x in some])])
        for i, g in enumerate(model.gradients(np.concatenate(some).astype(float), first, labels[rows])):
            g = g + 1e-4 * model.weights[i]
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.999 * v[i] + 0.001 * g * g
            model.weights[i] = model.weights[i] - 0.02 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    return model


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model | None:
    """The model of the labelled rows that are not held out."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).filter("doc_id IS NOT NULL AND quality IN (0, 1)")
    chosen = known.filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x, first = passages(batch.column("text"))
            bags = [x[a:b].tobytes() for a, b in zip(first, first[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), pa.array(bags, pa.binary())], names=["doc_id", "quality", "bag"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = texts.join(F.broadcast(chosen), "doc_id").mapInArrow(run, "doc_id long, quality int, bag binary")
    # an id that repeats in the documents is taken once, so that the sample stays within its bound
    got = sorted(found.groupBy("doc_id", "quality").agg(F.min("bag").alias("bag")).collect())
    bags = [np.frombuffer(r.bag, np.float32).reshape(-1, FEATURES) for r in got]
    return fit(bags, np.array([r.quality for r in got], float))


def _scores(model: Model | None, texts: pa.Array) -> np.ndarray:
    if model is None:
        return np.full(len(texts), 0.5)
    x, first = passages(texts)
    return model.forward(x.astype(float), first)["score"]


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    model = train(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(_scores(model, batch.column("text")))], names=["doc_id", "held_out", "score"])

    doc_id = F.col("doc_id").cast("long").alias("doc_id")
    rows = docs.select(doc_id, held_out(doc_id).alias("held_out"), F.col("text").cast("string").alias("text"))
    scored = rows.mapInArrow(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of docs, all columns, whose score is `least` or more."""
    model = train(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array(_scores(model, batch.column("text")) >= least))

    return docs.mapInArrow(run, docs.schema)
