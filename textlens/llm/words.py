"""Words as every operator here sees them: runs of ``[^\\x20\\x09-\\x0D]``.

Native columns for the operators that stay in SQL, and flat NumPy arrays for the ones that work on
Arrow batches. ``bytes.split()`` without an argument separates at exactly these six characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SPACE_CLASS = r"[\x20\x09-\x0D]"
# Texts hashed together in one NumPy step; a longer single text is still hashed whole.
STEP_BYTES = 1 << 20

_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03))
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
# For comparisons that ignore punctuation: every ASCII byte that is no letter or digit separates.
_IS_MARK = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def words(text: Column | str) -> Column:
    """Array of the words of a text; empty for null."""
    column = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.coalesce(column, F.lit("")), SPACE_CLASS + "+"), "")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out, dtype=np.uint64)


_CACHED: dict[tuple[int, int], np.ndarray] = {}


def _cached_powers(base: np.uint64, n: int) -> np.ndarray:
    size = 1 << max(16, int(n).bit_length())
    key = (int(base), size)
    if size > 4 * STEP_BYTES:
        return _powers(base, n)
    if key not in _CACHED:
        _CACHED[key] = _powers(base, size)
    return _CACHED[key]


def flat_words(texts: list[bytes], seeds: int = 1, lower: bool = False, marks: bool = False):
    """Words of several texts at once: (starts, ends, counts per text, a hash array per seed, bytes).

    The hash of a word is a polynomial over its bytes modulo 2^64, read off prefix sums, so no
    Python object exists per word. ``lower`` folds A-Z before anything else;
    ``marks`` splits at ASCII punctuation as well.
    """
    data = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    if lower:
        capital = (data >= 65) & (data <= 90)
        data = np.where(capital, data + 32, data).astype(np.uint8)
    space = (_IS_MARK if marks else _IS_SPACE)[data]
    edges = np.flatnonzero(np.diff(np.concatenate(([True], space)).view(np.int8)))
    # Runs alternate: a word starts where a space ends.
    starts, ends = edges[0::2], edges[1::2]
    limits = np.cumsum(np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts)))
    counts = np.diff(np.concatenate(([0], np.searchsorted(starts, limits))))
    hashes = []
    for base in _BASES[:seeds]:
        powers = _cached_powers(base, len(data))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data + np.uint64(1)) * powers[: len(data)], dtype=np.uint64)))
        back = _cached_powers(np.uint64(_inverse(int(base))), len(data))
        hashes.append(mix((sums[ends] - sums[starts]) * back[starts] + np.uint64(0x51_7C_C1)))
    return starts, ends, counts, hashes, data


def rolling(h: np.ndarray, n: int, base: np.uint64 = _BASES[0]) -> np.ndarray:
    """Hash of every run of n consecutive word hashes (``len(h) - n + 1`` of them)."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out = h[: len(h) - n + 1].copy()
    for k in range(1, n):
        out = out * base + h[k : len(h) - n + 1 + k]
    return mix(out)


def steps(sizes: list[int], limit: int = STEP_BYTES) -> Iterator[slice]:
    """Consecutive slices whose sizes add up to the limit at most (one item may exceed it)."""
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > limit:
            yield slice(start, i)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield slice(start, len(sizes))
