"""Byte-level BPE encoding and decoding by dynamic programming over prefixes.

For every prefix of a word there is exactly one token that can stand last in its encoding. Scanning the word, the
matcher lists the tokens that end at each byte (an automaton over all token strings follows suffix links); the one whose
left neighbour, the last token of the remaining prefix, is compatible with it is stored. Back-pointers from the full
word give the ids. Two tokens are compatible if merging their bytes by rank never joins across the border.

Rows: null text is empty; an empty text has no ids; the special token's string in a text is its id, as the tokenizers
library does by default. Repeated rows and null doc_id give a row each; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.arrays import Memo, slices

#: bytes of a worker's memo of words, and of that of stretches between spaces
MEMO = 160 << 20
#: entries of the memo of pairs; each is of one size
PAIRS = 500_000
SCHEMA = "doc_id long, n_tokens long, ids binary, decoded string"

_BLANKS = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# the split of the public byte-level vocabulary, with its white space spelled out
_WORD = regex.compile(
    rf"'(?:s|t|re|ve|m|ll|d)| ?\p{{L}}+| ?\p{{N}}+| ?[^{_BLANKS}\p{{L}}\p{{N}}]+|[{_BLANKS}]+(?![^{_BLANKS}])|[{_BLANKS}]+"
)
_RUN = regex.compile(rf" [{_BLANKS}]")


def _byte_letters() -> dict[str, int]:
    """The printable letter that vocabulary files write for each byte, by the usual rule."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


class Codec:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            given = json.load(file)
        letters = _byte_letters()
        raw = {t: bytes(letters[c] for c in t) for t in given["model"]["vocab"]}
        self.bytes_of = {i: raw[t] for t, i in given["model"]["vocab"].items()}
        self.id_of = {b: i for i, b in self.bytes_of.items()}
        self.specials = {t["content"]: t["id"] for t in given["added_tokens"]}
        self.bytes_of |= {i: t.encode() for t, i in self.specials.items()}
        #: rank of joining two tokens, and the two parts of each token that a merge makes (its first merge counts)
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for n, pair in enumerate(given["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            left, right, whole = (self.id_of[x] for x in (raw[a], raw[b], raw[a] + raw[b]))
            self.rank[left, right] = n
            self.parts.setdefault(whole, (left, right, n))
        self.matcher = ahocorasick.Automaton()
        for token, i in self.id_of.items():
            self.matcher.add_word(token.decode("latin-1"), (len(token), i))
        self.matcher.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.words, self.chunks = Memo(MEMO), Memo(MEMO)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")") if self.specials else None

    def compatible(self, left: int, right: int) -> bool:
        """True if both tokens stay apart when their joined bytes are merged by rank.

        Undoing merges from the latest back gives the border's two neighbours at every moment of the process; the tokens
        merge across the border if, at some moment, joining those neighbours ranks before the next merge beside it."""
        known = self.pairs.get((left, right))
        if known is not None:
            return known
        a, b, good = left, right, True
        last = 1 << 30  # the merge that ends this moment on the left or right; ties go to the left pair
        while good:
            joined = self.rank.get((a, b), 1 << 30)
            good = joined >= last
            pa_, pb = self.parts.get(a), self.parts.get(b)
            if pa_ is None and pb is None:
                break
            if pb is None or (pa_ is not None and pa_[2] > pb[2]):
                # the left token's last merge stands left of the border: at equal rank it comes first
                a, last = pa_[1], pa_[2]
            else:
                # the right token's last merge stands right of the border: at equal rank the border comes first
                b, last = pb[0], pb[2] + 1
        if len(self.pairs) > PAIRS:
            self.pairs.clear()
        self.pairs[left, right] = good
        return good

    def word(self, word: str) -> bytes:
        """ids of one word as little-endian 32-bit integers."""
        found = self.words.get(word) or self.words.again(word)
        if found is None:
            data = word.encode("utf-8")
            last: list[tuple[int, int] | None] = [None] * (len(data) + 1)
            here: list[tuple[int, int]] = []
            at = -1
            for end, match in chain(self.matcher.iter(data.decode("latin-1")), [(len(data), (0, 0))]):
                if end != at:
                    self._settle(last, here, at + 1)
                    here, at = [], end
                here.append(match)
            ids, end = [], len(data)
            while end:
                size, token = last[end]
                ids.append(token)
                end -= size
            found = np.array(ids[::-1], "<u4").tobytes()
            self.words.keep({word: found})
        return found

    def _settle(self, last: list, tokens: list[tuple[int, int]], end: int) -> None:
        for size, token in tokens:
            before = end - size
            if not before or (last[before] is not None and self.compatible(last[before][1], token)):
                last[end] = (size, token)
                return

    def plain(self, text: str) -> bytes:
        """ids of a text that holds no special token."""
        if _RUN.search(text):
            return b"".join(map(self.word, _WORD.findall(text)))
        # no blank follows a space: every space starts a word, and the text can be cut before each
        head, *rest = text.split(" ")
        out, chunks = [b"".join(map(self.word, _WORD.findall(head)))], self.chunks
        for chunk in rest:
            ids = chunks.get(chunk)
            if ids is None:
                ids = chunks.again(chunk)
            if ids is None:
                ids = b"".join(map(self.word, _WORD.findall(" " + chunk)))
                chunks.keep({chunk: ids})
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        if self.cut is None or not any(s in text for s in self.specials):
            return self.plain(text)
        parts = self.cut.split(text)
        return b"".join(np.array([self.specials[p]], "<u4").tobytes() if p in self.specials else self.plain(p) for p in parts if p)

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


@cache
def codec(path: str) -> Codec:
    """One for each worker process and vocabulary."""
    return Codec(path)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit) and the text decoded from them, for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in slices(batches):
            ids = [own.encode(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()), pa.array(map(own.decode, ids), pa.string())],
                names=["doc_id", "n_tokens", "ids", "decoded"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """encode() with lower-case hex SHA-256 of ids and decoded text in place of both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in slices(batches):
            rows = []
            for text in batch.column(1).to_pylist():
                ids = own.encode(text or "")
                rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(own.decode(ids).encode()).hexdigest()))
            n, a, b = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)
