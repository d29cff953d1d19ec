"""Looking up the keys of a large Arrow batch takes little memory beside keys and result."""

import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa

from textlens.operators import lexicon_values as V


def looked_up(batch, hashes, valences):
    sent = SimpleNamespace(value=(np.array(hashes, np.int64), np.array(valences, np.float64)))
    tracemalloc.start()
    out = next(V._looker(sent)(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return out, peak


def test_lookup_takes_bounded_memory():
    keys = np.arange(3_000_000) % 1000
    texts = pa.ListArray.from_arrays(pa.array(np.arange(0, 3_000_001, 1000, dtype=np.int32)), pa.array(keys))
    batch = pa.ListArray.from_arrays(pa.array(np.arange(3001, dtype=np.int32)), texts)
    out, peak = looked_up(batch, [3, 5], [0.5, -1.0])
    assert peak < 14 * len(keys)
    found = out.flatten().flatten()
    assert found.null_count == len(keys) - 2 * 3000 and found[3].as_py() == 0.5 and found[1005].as_py() == -1.0
    assert looked_up(batch, [], [])[0].flatten().flatten().null_count == len(keys)
