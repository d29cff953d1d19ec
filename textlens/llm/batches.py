"""Batches of documents that talk to buckets of keys in few, compact rows.

Operators that look keys up across the corpus would shuffle one row per word otherwise. Here the
documents are dealt once into batches of a bounded number of bytes; a batch sends its distinct keys
to each bucket of the key space as one sorted, delta-coded array, and a bucket answers with an array
in the same order. Both sides hold a bounded share of the data at any size: the number of batches
follows the bytes, and keys are hashes, so no frequent key makes a bucket larger (it is there once
per batch).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

BATCH = "__batch"
BATCH_BYTES = 8 << 20


def text_bytes(docs: DataFrame, text: str) -> int:
    return docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]


def batch_count(docs: DataFrame, text: str, batch_bytes: int = BATCH_BYTES) -> int:
    return max(1, -(-text_bytes(docs, text) // batch_bytes))


def in_batches(docs: DataFrame, keys: list[str], count: int) -> DataFrame:
    """Documents with their batch number, dealt by it. The batch is a hash of ``keys``.

    Hash over the text as well as the id, so that rows with a null or repeated id are dealt out too.
    """
    batch = F.pmod(F.xxhash64(*keys), F.lit(count)).cast("int")
    return docs.withColumn(BATCH, batch).repartition(count, BATCH)


def pack(keys: np.ndarray) -> bytes:
    """Sorted unsigned 64-bit keys: the first one, then differences in as few bytes as the largest needs."""
    if len(keys) == 0:
        return b""
    steps = np.diff(keys)
    width = max(1, (int(steps.max()).bit_length() + 7) // 8) if len(steps) else 1
    return keys[:1].tobytes() + bytes([width]) + narrow(steps, width)


def unpack(blob: bytes) -> np.ndarray:
    if len(blob) == 0:
        return np.zeros(0, np.uint64)
    steps = widen(blob[9:], blob[8])
    return np.cumsum(np.concatenate((np.frombuffer(blob[:8], np.uint64), steps)), dtype=np.uint64)


def narrow(values: np.ndarray, width: int) -> bytes:
    return values.astype(np.uint64, copy=False).view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def widen(blob: bytes, width: int) -> np.ndarray:
    raw = np.frombuffer(blob, np.uint8).reshape(-1, width)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :width] = raw
    return out.view(np.uint64).ravel()


def pack_counts(values: np.ndarray) -> bytes:
    """Small numbers in any order, byte planes apart so that the zeros compress."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    planes = np.frombuffer(narrow(values, width), np.uint8).reshape(-1, width).T
    return bytes([width]) + planes.tobytes()


def unpack_counts(blob: bytes) -> np.ndarray:
    width = blob[0]
    planes = np.frombuffer(blob[1:], np.uint8).reshape(width, -1)
    return widen(np.ascontiguousarray(planes.T).tobytes(), width)


def pack_bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def unpack_bits(blob: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(blob, np.uint8), count=n).astype(bool)


def bucket_bounds(keys: np.ndarray, buckets: int) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of the non-empty buckets of sorted keys; buckets are equal ranges of the key space."""
    of = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    edges = np.flatnonzero(np.diff(of, prepend=np.uint64(buckets + 1)))
    ends = np.append(edges[1:], len(keys))
    return [(int(of[a]), int(a), int(b)) for a, b in zip(edges, ends)]
