"""Whitening of vectors from exact, bit-sliced cross-products.

Components are whole numbers, floor(SCALE * c). The fit list holds each distinct vector once. In every task a batch's
values are shifted to start at 0, and bit plane p of dimension a is packed across the rows into 64-bit words; the
product sum of two dimensions is the sum over their planes of 2**(p + q) * popcount(plane AND plane). Shifts are undone and
tasks are added in whole numbers, so sums S and products Q of all n rows are exact. The driver gets these alone (the
dimensions squared, whatever the rows), centres them as integers, n * Q - S S', and takes eigenvectors of that over n**2.

Vectors of different lengths are whitened apart, each length with its own fit list. Components whose eigenvalue is not
above SMALLEST of the variance are not returned: a fit list of one vector gives no rows.

Rows: a null or empty vector, or one with null or non-finite entries, is dropped. Values beyond 64 bits are taken as the
largest or smallest of 64 bits. Null and repeated vec_id are allowed: each row gets its results. deviation is null beyond
38 digits. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.store import written

SCALE = 256
SMALLEST = 1e-12
#: rows whose planes are packed together
ROWS = 8192
_LIMB = 48
_WHITE = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double"


def rows_of(vectors: DataFrame) -> DataFrame:
    """vec_id, dim, ints of the rows that take part."""
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    ints = F.transform(F.col("embedding").cast("array<double>"), lambda x: F.floor(x * SCALE))
    good = vectors.select("vec_id", "embedding").filter("embedding IS NOT NULL AND size(embedding) > 0").filter(~odd)
    return good.select(F.col("vec_id").cast("long").alias("vec_id"), F.size("embedding").alias("dim"), ints.alias("ints"))


def matrices(batch: pa.RecordBatch, rows: int = ROWS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and values of the rows of one length in a batch, at most `rows` at a time."""
    ints = batch.column(batch.schema.get_field_index("ints"))
    at = np.asarray(ints.offsets, np.int64)
    flat = np.asarray(ints.values, np.int64)
    size = np.diff(at)
    for dim in np.unique(size).tolist():
        every = np.flatnonzero(size == dim)
        for part in np.split(every, range(rows, len(every), rows)):
            yield part, flat[at[part][:, None] + np.arange(dim)]


def planes(values: np.ndarray, bits: int) -> np.ndarray:
    """Bit plane p of column a of unsigned values, packed across the rows into words: [column, plane, word]."""
    columns = np.ascontiguousarray(values.T)
    out = np.zeros((columns.shape[0], bits, -(-len(values) // 64)), np.uint64)
    raw = out.view(np.uint8)
    for p in range(bits):
        packed = np.packbits(((columns >> np.uint64(p)) & np.uint64(1)).astype(np.uint8), axis=1)
        raw[:, p, : packed.shape[1]] = packed
    return out


def products(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Column sums, and product sums of every two columns (a <= b; 0 below), as Python integers."""
    n, dim = values.shape
    shift = values.min(axis=0)
    above = values.astype(np.uint64) - shift.astype(np.uint64)  # modulo 2**64, which the difference stays below
    bits = max(1, int(above.max()).bit_length())
    sliced = planes(above, bits)
    narrow = 2 * bits + n.bit_length() < 62
    kind = np.int64 if narrow else object
    weight = np.array([1 << p for p in range(bits)], kind)
    total = np.bitwise_count(sliced).sum(axis=2, dtype=np.int64).astype(kind) @ weight
    product = np.zeros((dim, dim), kind)
    for a in range(dim):
        for p in range(bits):
            both = np.bitwise_count(sliced[a, p] & sliced[a:]).sum(axis=2, dtype=np.int64)
            product[a, a:] += (both.astype(kind) @ weight) * weight[p]
    s, q, m = total.astype(object), product.astype(object), shift.astype(object)
    # x = y + m in every column: the shift goes out of the sums again
    q = q + np.triu(np.multiply.outer(m, s) + np.multiply.outer(s, m) + n * np.multiply.outer(m, m))
    return s + n * m, q


@dataclass
class Fit:
    """n, sums S, eigenvalues and unit eigenvectors (columns) by falling eigenvalue, and the whole variance."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    variance: float
    identity_error: float = 0.0


def _solved(n: int, sums: list[int], product: dict[tuple[int, int], int]) -> Fit:
    dim = len(sums)
    v = np.empty((dim, dim))
    for a in range(dim):
        for b in range(a, dim):
            v[a, b] = v[b, a] = (n * product[a, b] - sums[a] * sums[b]) / (n * n)  # whole numbers up to the division
    e, u = np.linalg.eigh(v)
    return Fit(n, sums, e[::-1], u[:, ::-1], float(np.trace(v)))


def _limbs(x: int) -> tuple[int, int, int]:
    return x & ((1 << _LIMB) - 1), (x >> _LIMB) & ((1 << _LIMB) - 1), x >> (2 * _LIMB)


def _whole(row) -> int:
    return row.l0 + (row.l1 << _LIMB) + (row.l2 << (2 * _LIMB))


def scatter(distinct: DataFrame) -> dict[int, Fit]:
    """For every length of vectors the fit to all rows of `distinct` (ints). dim entries of sums, dim * dim / 2 of products
    and one count leave each task and meet as plain sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for part, values in matrices(batch):
                s, q = products(values)
                old = held.get(values.shape[1], [0, 0, 0])
                held[values.shape[1]] = [old[0] + len(part), old[1] + s, old[2] + q]
        for dim, (n, s, q) in held.items():
            cells = [(-1, -1, n), *((-1, a, s[a]) for a in range(dim)), *((a, b, q[a, b]) for a in range(dim) for b in range(a, dim))]
            a, b, x = zip(*cells, strict=True)
            parts = zip(*map(_limbs, map(int, x)), strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim] * len(a), pa.int32()), pa.array(a, pa.int32()), pa.array(b, pa.int32()), *(pa.array(p, pa.int64()) for p in parts)],
                names=["dim", "a", "b", "l0", "l1", "l2"],
            )

    parts = distinct.select("ints").mapInArrow(run, "dim int, a int, b int, l0 long, l1 long, l2 long")
    got: dict[int, dict[tuple[int, int], int]] = {}
    for row in parts.groupBy("dim", "a", "b").agg(*[F.sum(x).alias(x) for x in ("l0", "l1", "l2")]).collect():
        got.setdefault(row.dim, {})[row.a, row.b] = _whole(row)
    return {dim: _solved(x[-1, -1], [x[-1, a] for a in range(dim)], x) for dim, x in got.items()}


def _kept(fit: Fit, components: int) -> int:
    """How many components of those asked for have a variance."""
    return int((fit.values[:components] > SMALLEST * fit.variance).sum()) if fit.variance > 0 else 0


def _centred(fit: Fit, values: np.ndarray) -> np.ndarray:
    """n * x - S of every row, in 64-bit integers where these are sure to hold, else in Python integers."""
    largest = fit.n * (int(np.abs(values.astype(float)).max()) + 1) + max(map(abs, fit.sums))
    kind = np.int64 if largest < 1 << 62 else object
    return values.astype(kind) * fit.n - np.array(fit.sums, kind)


def _projected(fit: Fit, centred: np.ndarray, components: int) -> np.ndarray:
    return (centred / fit.n).astype(float) @ fit.vectors[:, :components] / np.sqrt(fit.values[:components])


def _deviation(centred: np.ndarray) -> list[Decimal | None]:
    if centred.dtype != object and float(np.abs(centred.astype(float)).max()) ** 2 * centred.shape[1] < 2**62:
        return [Decimal(x) for x in (centred * centred).sum(axis=1).tolist()]
    sums = (sum(x * x for x in row) for row in centred.astype(object).tolist())
    return [Decimal(x) if x < 10**38 else None for x in sums]


def _errors(distinct: DataFrame, fits: dict[int, Fit], components: int) -> dict[int, float]:
    """For every length the largest absolute entry of (covariance of the whitened fit list) - identity, measured over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for _, values in matrices(batch):
                fit = fits[values.shape[1]]
                w = _projected(fit, _centred(fit, values), _kept(fit, components))
                old = held.get(values.shape[1], [0.0, 0.0])
                held[values.shape[1]] = [old[0] + w.sum(axis=0), old[1] + w.T @ w]
        for dim, (s, q) in held.items():
            k = len(s)
            cells = [*((-1, a, float(s[a])) for a in range(k)), *((a, b, float(q[a, b])) for a in range(k) for b in range(k))]
            if cells:
                a, b, x = zip(*cells, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array([dim] * len(a), pa.int32()), pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(x)], names=["dim", "a", "b", "x"])

    parts = distinct.select("ints").mapInArrow(run, "dim int, a int, b int, x double")
    got: dict[int, dict[tuple[int, int], float]] = {}
    for row in parts.groupBy("dim", "a", "b").agg(F.sum("x").alias("x")).collect():
        got.setdefault(row.dim, {})[row.a, row.b] = row.x
    errors = {}
    for dim, x in got.items():
        n = fits[dim].n
        k = sum(1 for a, _ in x if a == -1)
        errors[dim] = max(abs(x[a, b] / n - x[-1, a] / n * x[-1, b] / n - (a == b)) for a in range(k) for b in range(k))
    return errors


def fit(rows: DataFrame, components: int) -> dict[int, Fit]:
    """Fits by length of vector. rows: as rows_of() gives them. Each distinct vector counts once."""
    distinct = written(rows.select("ints").distinct())
    fits = scatter(distinct)
    for dim, error in _errors(distinct, fits, components).items():
        fits[dim].identity_error = error
    return fits


def whiten(vectors: DataFrame, components: int = 4) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error for every row and component."""
    rows = rows_of(vectors)
    fits = fit(rows, components)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("vec_id"))
            for part, values in matrices(batch):
                own = fits[values.shape[1]]
                k = _kept(own, components)
                if not k:
                    continue
                centred = _centred(own, values)
                each = pa.array(np.repeat(part, k))
                number = np.tile(np.arange(k), len(part))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(each),
                        pa.array(number + 1, pa.int32()),
                        pa.array(np.full(len(each), own.n), pa.int64()),
                        pa.array(_deviation(centred), pa.decimal128(38, 0)).take(pa.array(np.repeat(np.arange(len(part)), k))),
                        pa.array(_projected(own, centred, k).ravel()),
                        pa.array((own.values[:k] / own.variance)[number]),
                        pa.array(np.full(len(each), own.identity_error)),
                    ],
                    names=[x.split()[0] for x in schema.split(", ")],
                )

    schema = f"{_WHITE}, identity_error double"
    return rows.mapInArrow(run, schema)
