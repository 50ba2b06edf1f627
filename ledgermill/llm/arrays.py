"""Words, windows and 64-bit hashes of whole Arrow string columns, without a Python object for each word.

Words are maximal runs of bytes other than space and \\t..\\r; both are single bytes in UTF-8, so cutting bytes cuts text.
A batch is taken in slices of a MB, so memory follows the slice (or one very long text) and not the batch.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_U = np.uint64
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_BYTE = np.random.default_rng(11).integers(1, 2**63, 256, dtype=np.uint64)
_OTHER = np.random.default_rng(12).integers(1, 2**63, 256, dtype=np.uint64)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


class Memo(dict):
    """Results by word, at most `limit` bytes of them, in two generations: when the young one holds half of the limit it becomes
    the old one, and the old one goes. Words found in the old one are young again, so frequent words stay. Words of more than
    LONGEST letters are not kept, so texts without spaces between words cannot fill it with long runs."""

    LONGEST = 48
    #: bytes of an entry beside its letters and its result
    ENTRY = 150

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.held, self.old = limit, 0, {}

    @classmethod
    def bytes_of(cls, results: dict[str, bytes]) -> int:
        return cls.ENTRY * len(results) + len("".join(results).encode()) + sum(map(len, results.values()))

    def keep(self, results: dict[str, bytes]) -> None:
        if max(map(len, results), default=0) > self.LONGEST:
            results = {word: result for word, result in results.items() if len(word) <= self.LONGEST}
        size = self.bytes_of(results)
        if 2 * size > self.limit:
            return
        if 2 * (self.held + size) > self.limit:
            self.old, self.held = dict(self), 0
            self.clear()
        self.held += size
        self.update(results)

    def again(self, word: str) -> bytes | None:
        """The result of a word that is not in the young generation, if the old one has it."""
        result = self.old.get(word)
        if result is not None:
            self.keep({word: result})
        return result

    def forget(self) -> None:
        self.clear()
        self.held, self.old = 0, {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**j and base**-j modulo 2**64 for j < n; base is odd."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        back = pow(base, -1, 1 << 64)
        have = tuple(np.multiply.accumulate(np.concatenate([np.ones(1, _U), np.full(size - 1, b, _U)])) for b in (base, back))
        if size <= 2 * SLICE_BYTES:
            _POWERS[base] = have
    return have[0][:n], have[1][:n]


def spans_hash(codes: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Hash of codes[start:end] for every pair, from running sums: the same codes give the same value at any place."""
    up, down = _powers(base, len(codes) + 1)
    sums = np.zeros(len(codes) + 1, _U)
    np.cumsum(codes * up[:-1], out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(_U))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array end to end, and where each text starts (one more at the end). Null: empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), at - at[0]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def give_back() -> None:
    """Return freed memory to the system. A worker lives on after its task, and would keep what large arrays have taken."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not in every C library
    if trim is not None:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most `limit` bytes of text, or of one row. At their end freed memory is given back."""
    for batch in batches:
        if not batch.num_rows:
            continue
        i = batch.schema.get_field_index(column)
        if batch.column(i).type != pa.string() and not pa.types.is_large_string(batch.column(i).type):
            batch = batch.set_column(i, column, batch.column(i).cast(pa.string()))
        at = text_bytes(batch.column(i))[1]
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
            yield batch.slice(first, last - first)
            first = last
    give_back()


class Words:
    """Words of a slice: byte start and end, the row each stands in, and each row's first word (one more at the end)."""

    def __init__(self, texts: pa.Array):
        self.data, self.at = text_bytes(texts)
        ink = ~_BLANK[self.data]
        begins, ends = ink.copy(), ink.copy()
        begins[1:] &= ~ink[:-1]
        ends[:-1] &= ~ink[1:]
        edge = np.unique(self.at)
        inner = edge[(edge > 0) & (edge < len(ink))]
        begins[inner] = ink[inner]
        ends[inner - 1] = ink[inner - 1]
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, self.at)
        self.row = np.repeat(np.arange(len(texts)), np.diff(self.first))

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self, other: bool = False) -> np.ndarray:
        """64 bits for each word; other: 64 more, from other values of the bytes and another base."""
        values, base = (_OTHER, 0xA0761D6478BD642F) if other else (_BYTE, 0x9E3779B97F4A7C15)
        return spans_hash(values[self.data], self.start, self.end, base)

    def windows(self, codes: np.ndarray, size: int, starts: np.ndarray, base: int = 0xD1342543DE82EF95) -> np.ndarray:
        """Hash of the `size` words from each start; the caller keeps the windows inside a row."""
        return spans_hash(codes, starts, starts + size, base)
