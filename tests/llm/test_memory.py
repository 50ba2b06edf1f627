"""What a worker that lives through all stages keeps."""

import subprocess
import sys

PROGRAM = """
import resource, numpy as np, pyarrow as pa, public_tokenizers
from ledgermill.llm import bpe, packing, quality
from ledgermill.llm.arrays import Words, slices

rng = np.random.default_rng(2)
words = ["".join(rng.choice(list("abcdefghijklmnop"), rng.integers(2, 9))) for _ in range(60000)]
texts = pa.array([" ".join(rng.choice(words, 900)) for _ in range(1600)])
batch = pa.RecordBatch.from_arrays([texts], names=["text"])
size = lambda: int(open("/proc/self/statm").read().split()[1]) * 4096 >> 20
encoder, codec = packing.encoder(public_tokenizers.path("word_bpe_49k.json")), bpe.codec(public_tokenizers.path("byte_bpe_50k.json"))
base = size()
for _ in range(2):
    for part in slices(iter([batch])):
        quality.passages(part.column(0))
        Words(part.column(0)).hashes()
        for t in part.column(0).to_pylist():
            encoder.encode(t)
    for t in texts.to_pylist()[:200]:
        codec.encode(t)
print(size() - base, (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss >> 10) - base)
"""


def test_a_reused_worker_stays_small():
    """MB kept, and at the peak, over two rounds of the stages' Python work on 11 MB of text."""
    out = subprocess.run([sys.executable, "-c", PROGRAM], capture_output=True, text=True, check=True, timeout=300)
    kept, peak = map(int, out.stdout.split())
    assert kept < 260 and peak < 320


KEPT = """
import numpy as np, pyarrow as pa
from ledgermill.llm import neardup
from ledgermill.llm.arrays import slices

rng = np.random.default_rng(2)
words = ["".join(rng.choice(list("abcdefghijklmnop"), rng.integers(2, 9))) for _ in range(60000)]
batch = pa.RecordBatch.from_arrays([pa.array([" ".join(rng.choice(words, 900)) for _ in range(2500)])], names=["text"])
size = lambda: int(open("/proc/self/statm").read().split()[1]) * 4096 >> 20
peak = 0
for part in slices(iter([batch])):
    row, codes, times = neardup._distinct(part.column(0))
    signs = neardup._signs(part.num_rows, row, codes, times * 1.5)
    del row, codes, times, signs
    peak = max(peak, size())
print(peak, size())
"""


def test_a_worker_gives_memory_back():
    """MB in the middle of a task's rows and behind them."""
    out = subprocess.run([sys.executable, "-c", KEPT], capture_output=True, text=True, check=True, timeout=300)
    peak, kept = map(int, out.stdout.split())
    assert kept < peak - 50
