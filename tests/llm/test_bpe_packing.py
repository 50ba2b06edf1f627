"""Tokenising against the tokenizers library; packing rules."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgermill.llm import bpe, packing

BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
LIBRARY, WORD_LIBRARY = Tokenizer.from_file(BYTES), Tokenizer.from_file(WORDS)
ODD = ["", "  a  b \n\n x'll don't　zz  ", "<|endoftext|>hi<|endoftext|>", "a\n \nb", "日本語 🙂🙂 naïvé", "x" * 3000, "=-" * 400, "a" * 41, " \x1c a\x85b", "12 3", "\x00\x01", "Óo Σας İ a's'S"]


def ids_of(library, text):
    return np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@settings(max_examples=150, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet="abtheing '\n1.\t", max_size=80)))
def test_same_ids_as_the_library(text):
    own = bpe.codec(BYTES)
    assert own.encode(text) == ids_of(LIBRARY, text)
    assert own.decode(own.encode(text)) == text
    assert packing.encoder(WORDS).encode(text) == ids_of(WORD_LIBRARY, text)


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text):
    assert bpe.codec(BYTES).encode(text) == ids_of(LIBRARY, text)
    assert packing.encoder(WORDS).encode(text) == ids_of(WORD_LIBRARY, text)


def test_small_memo_gives_the_same(monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 3)
    monkeypatch.setattr(packing, "MEMO", 3)
    text = "the quick brown fox jumps over the lazy dog, again and again."
    assert bpe.Codec(BYTES).encode(text) == ids_of(LIBRARY, text)
    own = packing.Encoder(WORDS)
    assert [own.encode(text), own.encode(text)] == [ids_of(WORD_LIBRARY, text)] * 2


def test_rows_of_digests(odd_rows):
    docs = odd_rows([(1, "hello world"), (None, None), (1, "hello world"), (2, "")])
    got = sorted(map(tuple, bpe.digests(docs, BYTES).collect()), key=repr)
    empty = hashlib.sha256(b"").hexdigest()
    ids = ids_of(LIBRARY, "hello world")
    full = (1, 2, hashlib.sha256(ids).hexdigest(), hashlib.sha256(b"hello world").hexdigest())
    assert got == sorted([full, full, (None, 0, empty, empty), (2, 0, empty, empty)], key=repr)
    assert bpe.digests(docs.limit(0), BYTES).count() == 0
    assert [r.decoded for r in bpe.encode(docs.filter("doc_id = 1"), BYTES).collect()] == ["hello world"] * 2


def check_packed(rows, texts, length):
    bins, parts = defaultdict(list), defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
        parts[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    for own in bins.values():
        own.sort()
        assert own[0][0] == 0 and all(a[0] + a[1] == b[0] for a, b in zip(own, own[1:], strict=False))
        assert sum(n for _, n in own) <= length
    for doc_id, text in texts.items():
        ids = ids_of(WORD_LIBRARY, text or "") + b"\0\0\0\0"
        want = [(n, at, min(length, len(ids) // 4 - at), zlib.crc32(ids[4 * at : 4 * (at + length)])) for n, at in enumerate(range(0, len(ids) // 4, length))]
        assert sorted(parts[doc_id]) == want
    return len(bins)


def test_packing_places_every_piece(odd_rows):
    texts = {i: " ".join(["the"] * (i * 7 % 90)) for i in range(120)} | {200: None, 201: "a " * 1000}
    rows = packing.pack(odd_rows(list(texts.items())), WORDS, length=64, group=32).collect()
    used = check_packed(rows, texts, 64)
    total = sum(r.length for r in rows)
    assert used <= 1.1 * -(-total // 64) + 1
    one = packing.pack(odd_rows(list(texts.items())), WORDS, length=64).collect()
    assert check_packed(one, texts, 64) <= 1.1 * -(-total // 64) + 1


def test_packing_of_nothing_and_of_repeats(odd_rows):
    assert packing.pack(odd_rows([]), WORDS).count() == 0
    rows = packing.pack(odd_rows([(1, "a b"), (1, "a b"), (None, "c")]), WORDS).collect()
    assert sorted((r.offset, r.length) for r in rows) == [(0, 3), (3, 3), (6, 2)]


def test_sum_of_squares_rule():
    """Each choice against trying every gap and counting anew."""
    rng = np.random.default_rng(0)
    sizes, capacity = rng.integers(1, 21, 200), 20
    sequence, offset, room = packing.place(sizes, capacity)
    left = []
    for size, bin_, at in zip(sizes.tolist(), sequence.tolist(), offset.tolist(), strict=True):
        def cost(gaps):
            return sum(gaps.count(g) ** 2 for g in set(gaps) if g)

        options = {g: cost([*left[: left.index(g)], *left[left.index(g) + 1 :], g - size]) for g in set(left) if g >= size}
        options[None] = cost([*left, capacity - size])
        taken = None if bin_ == len(left) else left[bin_]
        assert options[taken] == min(options.values())
        if taken is None:
            left.append(capacity)
        assert at == capacity - left[bin_]
        left[bin_] -= size
    assert left == room.tolist()


def test_ids_beside_nulls_stay_exact(odd_rows):
    big = 2**60 + 1
    rows = packing.pack(odd_rows([(big, "a b"), (None, "c"), (big + 2, "d")]), WORDS).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.length) for r in rows) == [(False, big, 3), (False, big + 2, 2), (True, 0, 2)]


@pytest.mark.parametrize("kind", ["ideographs", "base64", "words"])
def test_memos_are_bounded_in_bytes(monkeypatch, kind):
    """Texts without spaces, and very many distinct words, leave no more in a worker than the limit."""
    limit = 200_000
    monkeypatch.setattr(bpe, "MEMO", limit)
    monkeypatch.setattr(packing, "MEMO", limit)
    rng = np.random.default_rng(1)
    letters = {"ideographs": [chr(c) for c in range(0x4E00, 0x5E00)], "base64": list("ABCDEFabcdef0123456789+/"), "words": list("abcdefgh")}[kind]
    size, runs = (9, 400) if kind == "words" else (400, 20)
    text = [" ".join("".join(rng.choice(letters, size)) for _ in range(runs)) for _ in range(12)]
    codec, encoder = bpe.Codec(BYTES), packing.Encoder(WORDS)
    for t in text:
        assert codec.encode(t) == ids_of(LIBRARY, t)
        assert encoder.encode(t) == ids_of(WORD_LIBRARY, t)
    for memo in (codec.words, codec.chunks, encoder.known, encoder.plain):
        young, old = memo.bytes_of(memo), memo.bytes_of(memo.old)
        assert young <= memo.held and young + old <= limit
        assert kind == "words" or max(map(len, memo), default=0) <= memo.LONGEST


class Counting:
    """The library's tokenizer, counting the texts that it is handed."""

    def __init__(self, own):
        self.own, self.calls, self.texts = own, 0, 0

    def encode_batch_fast(self, texts, **how):
        self.calls += 1
        self.texts += len(texts)
        return self.own.encode_batch_fast(texts, **how)


def test_a_slice_is_encoded_at_once():
    """The library is asked for the words of a slice together, not once for each text that has a new word."""
    rng = np.random.default_rng(3)
    texts = [" ".join("".join(rng.choice(list("abcdefgh"), 6)) + end for end in (",", "", ".")) + " the end." for _ in range(300)]
    own = packing.Encoder(WORDS)
    own.tokenizer = Counting(own.tokenizer)
    assert list(own.encode_all(pa.array(texts))) == [ids_of(WORD_LIBRARY, t) for t in texts]
    assert own.tokenizer.calls <= 3 and own.tokenizer.texts <= 900 / packing.JOINED + 5
    assert list(own.encode_all(pa.array(texts[::-1]))) == [ids_of(WORD_LIBRARY, t) for t in texts[::-1]]
    assert own.tokenizer.calls <= 3


MIXED = [*ODD, None, "ÀÉ×÷ß ÿ, Ÿ' J\u030c J\u030c, \u212a \u0130I", "a\u00a0b\u3000c d\u2028e", "don't I'LL s's 's' 12a, a12 a,b <|endoftext|>, the<|endoftext|>", "\x1cthe\x1f the, \x0b\x0c", "THE The the the. the.) \u200bthe \u0301the e\u0301,"]


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_odd_texts_of_one_slice(kind):
    own = packing.Encoder(WORDS)
    whole = pa.array(MIXED * 2, kind)
    for texts in (whole, whole.slice(3, 11), whole.slice(2, 0), pa.array([None, ""], kind)):
        assert list(own.encode_all(texts)) == [ids_of(WORD_LIBRARY, t or "") for t in texts.to_pylist()]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=40), st.text(alphabet="aBtéÀ \u0301\u00a0\n.,'1Σ", max_size=40)), max_size=6))
def test_same_ids_as_the_library_over_a_slice(texts):
    assert list(packing.encoder(WORDS).encode_all(pa.array(texts, pa.string()))) == [ids_of(WORD_LIBRARY, t or "") for t in texts]


def test_every_white_space_as_the_library_has_it():
    blanks = [chr(c) for c in range(0x11000) if chr(c).isspace()] + list("\u180e\u200b\u200d\u2060\ufeff")
    texts = [f"the{c}end, {c}{c}A{c}'s{c}" for c in blanks]
    own = packing.Encoder(WORDS)
    want = [ids_of(WORD_LIBRARY, t) for t in texts]
    assert list(own.encode_all(pa.array(texts))) == want
    assert [own.encode(t) for t in texts] == want
    own.tokenizer = Counting(own.tokenizer)
    assert own.encode("end\u00a0the\u3000the, end.") == ids_of(WORD_LIBRARY, "end the the, end.")
    assert own.tokenizer.calls <= 2
