"""Packing of tokenised documents into sequences of fixed length by the sum-of-squares rule.

A piece goes where the sum over residual gaps of (number of open sequences with that gap) squared becomes smallest, a new
sequence included. Pieces are dealt to groups of bounded size, each packed in a task of its own, longest piece first.
Sequences that a group leaves with room are opened again: their pieces meet in fewer groups, until one group holds
them or another round would not help. No piece is ever dropped; one that fills a sequence needs no search.

Null text is empty; an empty document is its end token alone. Repeated rows are packed once each. Other columns of the
input are ignored.
"""

from __future__ import annotations

import os
import string
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.arrays import Memo, slices
from ledgermill.llm.store import written

LENGTH = 2048
END = 0
#: pieces packed by one task at a time
GROUP = 20_000
#: bytes of a worker's memo of plain words, and half of that for other runs while a partition is read
MEMO = 128 << 20

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PLACED = f"{_PIECES}, sequence_id long, offset long, room long"


#: letters whose lower case and composed form are one letter each, and signs: the vocabulary's split cuts between both
_LETTERS = "".join(map(chr, [*range(65, 91), *range(97, 123), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)]))
_SIGNS = string.punctuation
_WORD = "^[A-Za-zÀ-ÖØ-öø-ÿ]+$"
#: words handed to the library as one text
JOINED = 64


class Encoder:
    """ids of texts by the tokenizers library. White space separates words in this vocabulary, so Arrow cuts a slice of texts
    at it, and each distinct run of other characters is encoded once. A run that is a plain word with signs behind it has the
    ids of both; plain words go to the library many at a time, since the last id of each word is one that ends words."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.known, self.plain = Memo(MEMO // 2), Memo(MEMO)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True

    def _each(self, runs: list[str]) -> Iterator[bytes]:
        for at in range(0, len(runs), 1024):
            for got in self.tokenizer.encode_batch_fast(runs[at : at + 1024], add_special_tokens=False):
                yield np.array(got.ids, "<u4").tobytes()

    def _words(self, words: list[str]) -> Iterator[bytes]:
        joined = [" ".join(words[at : at + JOINED]) for at in range(0, len(words), JOINED)]
        for got in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False):
            ids = np.array(got.ids, "<u4")
            ends = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            data = ids.tobytes()
            yield from (data[a:b] for a, b in zip([0, *ends], ends, strict=False))

    @staticmethod
    def _remembered(memo: Memo, runs: pa.Array, learned: Callable[[list[str]], Iterable[bytes]]) -> np.ndarray:
        """ids of distinct runs, from the memo or else learned."""
        keys = runs.to_numpy(zero_copy_only=False)
        ids = np.fromiter(map(memo.get, keys), object, len(keys))
        missing = np.flatnonzero(np.equal(ids, None))
        if len(missing):
            lost = keys[missing].tolist()
            fresh = {run: memo.old.get(run) for run in lost}
            new = [run for run, found in fresh.items() if found is None]
            fresh.update(zip(new, learned(new), strict=True))
            memo.keep(fresh)
            ids[missing] = np.fromiter(map(fresh.__getitem__, lost), object, len(lost))
        return ids

    def _runs(self, runs: pa.Array) -> np.ndarray:
        """ids of distinct runs."""
        words = pc.ascii_rtrim(runs, characters=_SIGNS)
        is_plain = pc.match_substring_regex(words, _WORD)
        ids = np.empty(len(runs), object)
        plain = is_plain.to_numpy(zero_copy_only=False)
        words = pc.utf8_lower(words.filter(is_plain)).dictionary_encode()
        signs = pc.utf8_ltrim(runs.filter(is_plain), characters=_LETTERS).dictionary_encode()
        of_words = self._remembered(self.plain, words.dictionary, self._words)
        of_signs = self._remembered(self.known, signs.dictionary, self._each)
        ids[plain] = of_words[words.indices.to_numpy()] + of_signs[signs.indices.to_numpy()]
        ids[~plain] = self._remembered(self.known, runs.filter(pc.invert(is_plain)), self._each)
        return ids

    def encode_all(self, texts: pa.Array) -> Iterator[bytes]:
        """ids of each text as little-endian 32-bit integers. Null: empty."""
        texts = texts.fill_null("")
        # Arrow's wider white space has these separators of files and records, which the vocabulary does not cut at
        wide = not pc.any(pc.match_substring_regex(texts, "[\\x1c-\\x1f]")).as_py()
        words = (pc.utf8_split_whitespace if wide else pc.ascii_split_whitespace)(texts)
        runs = words.flatten().dictionary_encode()
        ids, at, index = self._runs(runs.dictionary), words.offsets.to_numpy(), runs.indices.to_numpy()
        for first, last in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            yield b"".join(ids[index[first:last]].tolist())

    def encode(self, text: str) -> bytes:
        return next(self.encode_all(pa.array([text], pa.string())))


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def pieces(docs: DataFrame, path: str, length: int = LENGTH) -> DataFrame:
    """Each document's ids and an end token, cut into pieces of at most `length`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        end = np.array([END], "<u4").tobytes()
        for batch in slices(batches):
            row, piece, start, size, crc = [], [], [], [], []
            for i, ids in enumerate(own.encode_all(batch.column(1))):
                ids += end
                for n, at in enumerate(range(0, len(ids), 4 * length)):
                    cut = ids[at : at + 4 * length]
                    row.append(i)
                    piece.append(n)
                    start.append(at // 4)
                    size.append(len(cut) // 4)
                    crc.append(zlib.crc32(cut))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(size, pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )
        own.known.forget()  # a worker lives on after its task

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, _PIECES)


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence and offset of each piece, and the room left in each sequence, by the sum-of-squares rule."""
    open_with = np.zeros(capacity + 1, np.int64)  # sequences by gap; gap 0 is closed and counts nothing
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    room: list[int] = []
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    gaps = np.arange(capacity)
    for i, size in enumerate(lengths.tolist()):
        # change of the sum for every gap that the piece fits: the old gap loses a sequence, the new one gains it
        was = open_with[size:capacity]
        change = 2 * (open_with[: capacity - size] - was) + (gaps[: capacity - size] > 0)
        change[was == 0] = np.iinfo(np.int64).max
        best = int(change.argmin()) if len(change) else -1
        fresh = 2 * int(open_with[capacity - size]) if size < capacity else -1
        if best >= 0 and change[best] <= fresh:
            gap = best + size
            bin_ = waiting[gap].pop()
            open_with[gap] -= 1
        else:
            gap, bin_ = capacity, len(room)
            room.append(capacity)
        sequence[i], offset[i] = bin_, capacity - gap
        left = gap - size
        room[bin_] = left
        if left:
            open_with[left] += 1
            waiting[left].append(bin_)
    return sequence, offset, np.array(room, np.int64)


def _packer(length: int, level: int):
    order = [("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")]

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by(order)
        sequence, offset, room = place(np.asarray(table.column("length"), np.int64), length)
        ids = (table.column("deal")[0].as_py() * (1 << 20) + sequence) * 8 + level
        placed = table.select(_names())  # ids stay as Arrow has them, beside nulls too
        for name, values in (("sequence_id", ids), ("offset", offset), ("room", room[sequence])):
            placed = placed.append_column(name, pa.array(values, pa.int64()))
        return placed

    return run


def pack(docs: DataFrame, path: str, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece."""
    all_pieces = written(pieces(docs, path, length))
    number = F.monotonically_increasing_id()  # of files already written, so a task run again numbers alike
    done = [
        all_pieces.filter(F.col("length") == length).select(
            *all_pieces.columns, (number * 8 + 7).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.lit(0).cast("long").alias("room")
        )
    ]
    open_ = all_pieces.filter(F.col("length") < length)
    before = None
    for level in range(7):
        rows = open_.count()
        if not rows or (before is not None and rows > before // 2):
            break
        groups = -(-rows // group)
        own = open_.select(*_names(), F.pmod(F.xxhash64(number), F.lit(groups)).alias("deal"))
        placed = written(own.groupBy("deal").applyInArrow(_packer(length, level), _PLACED))
        if groups == 1:
            done.append(placed)
            open_ = None
            break
        last = placed
        done.append(placed.filter("room = 0"))
        open_, before = placed.filter("room > 0"), rows
    if open_ is not None and before is not None:
        done.append(last.filter("room > 0"))  # they keep the places of the last round
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.drop("room")


def _names() -> list[str]:
    return [c.split()[0] for c in _PIECES.split(", ")]
