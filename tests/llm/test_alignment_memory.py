"""What a worker of the alignment holds, in a process of its own."""

import subprocess
import sys
from types import SimpleNamespace

import numpy as np
import pyarrow as pa

from tidemark.llm import alignment

#: A worker of an executor of 3,000 MB shares it with another one and with a JVM of 1,800 MB of heap.
MOST_MB = 170

_WORKER = """
import random, resource
import numpy as np, public_tokenizers, pyarrow as pa
from tidemark.llm import alignment
rng = random.Random(5)
letters = "etaoinshrdlucmfw"
word = lambda: "".join(rng.choices(letters, k=rng.randint(3, 9)))
often = [word() for _ in range(3000)]
text = lambda: " ".join(rng.choice(often) if rng.random() < 0.7 else word() for _ in range(400))
paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
alignment.tokenizers(*paths)
most = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024
before = most()
batches = ([pa.array([text() for _ in range(1000)])] for _ in range(4))
for _, known, t in alignment._aligned_slices(batches, *paths):
    c = t.chunks
    known.pairs(np.bincount(t.order[np.repeat(t.good, np.diff(t.at))], minlength=len(c.good)))
    t.lists(c.links, c.group_at)
print(most() - before)
"""


def test_worker_memory_is_bounded():
    done = subprocess.run([sys.executable, "-c", _WORKER], capture_output=True, text=True, check=True, timeout=300)
    assert float(done.stdout) < MOST_MB


def test_second_pass_looks_up_some_links_at_a_time(monkeypatch):
    rng = np.random.default_rng(3)
    lists = [rng.integers(0, 50, n).astype(np.int32) for n in (0, 700, 3, 0, 900, 1, 400)]
    array = pa.array([x.tolist() for x in lists], pa.list_(pa.int32()))
    codes, totals, best = np.arange(50), rng.integers(1, 99, 50), rng.integers(0, 2, 50)
    seen = []
    monkeypatch.setattr(alignment, "SLICE_LINKS", 800)
    monkeypatch.setattr(alignment, "_ends", lambda x, plain=alignment._ends: seen.append(len(x)) or plain(x))
    shared = SimpleNamespace(value=(codes, totals, best))
    out = [(rows, [x.to_pylist() for x in arrays]) for rows, arrays in alignment._ranked([[array]], shared)]
    assert [i for rows, _ in out for i in range(rows.start, rows.stop)] == list(range(len(lists)))
    assert sum((a for _, (a, _) in out), []) == [int(best[x].sum()) for x in lists]
    assert sum((b for _, (_, b) in out), []) == [int(totals[x].sum()) for x in lists]
    assert max(seen) <= 900
