"""Words and hashes of Arrow slices against plain Python."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgermill.llm.arrays import Words, slices, text_bytes

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab \t\n\x0bé\x1c日", max_size=12)), min_size=1, max_size=6)


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.integers(0, 3))
def test_words_of_a_slice(texts, skip):
    array = pa.array([None] * skip + texts, pa.string()).slice(skip)
    words = Words(array)
    want = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    data = words.data.tobytes()
    got = [[data[words.start[i] : words.end[i]].decode() for i in range(words.first[r], words.first[r + 1])] for r in range(len(texts))]
    assert got == want
    assert words.row.tolist() == [r for r, x in enumerate(want) for _ in x]
    # equal words have equal hashes, others do not
    flat, codes = [w for x in want for w in x], words.hashes().tolist()
    assert len(set(zip(flat, codes, strict=True))) == len(set(flat)) == len(set(codes))


def test_windows_depend_on_words_alone():
    words = Words(pa.array(["q a b c", "a b c a b c"]))
    codes = words.hashes()
    got = words.windows(codes, 3, np.array([1, 4, 7]))
    assert got[0] == got[1] == got[2]
    assert words.windows(codes, 3, np.array([5]))[0] != got[0]


def test_slices_keep_rows_and_bound_bytes():
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(["x" * 10, None, "", "y" * 100, "z", "z" * 9, ""])], names=["i", "text"])
    parts = list(slices(iter([batch, batch.slice(0, 0)]), limit=12))
    assert [i for p in parts for i in p.column("i").to_pylist()] == list(range(7))
    assert all(len(text_bytes(p.column("text"))[0]) <= 12 or p.num_rows == 1 for p in parts)
