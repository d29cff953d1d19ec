"""Substring dedup: words inside a long exact repeat of earlier text are removed.

Fixed-block anchors. Every document is cut into non-overlapping reference blocks of
``(window + 1) // 2`` words; any window of ``window`` words holds one of them whole. All rolling
block-sized windows probe the index of reference blocks. A hit at two places marks the windows
around it as candidates; candidates are compared whole, by 96-bit hashes, and the runs of windows
that start earlier somewhere else are the maximal exact repeats, which are cut out.

No pair of places is ever formed: a key meets each batch of documents once (``batches``), and what
a bucket answers is whether an earlier batch of documents has it. Documents move once.

Defined results: order is (id, start), nulls before all ids (ids that are no whole numbers are numbered in the order of their text
first); rows with a null or repeated id and
different texts are ordered by batch and text; identical rows are the same document and get the same result.
Null or empty text has no words and keeps the empty text. Texts shorter than a window are kept (with
words joined by one space). All other columns are kept; the added ones replace columns of the same name.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from textlens.llm import batches as B
from textlens.llm.words import flat_words, rolling, steps, _BASES
from textlens.operators.labels import distinct_labels, number_sorted

WINDOW = 20
ADDED = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_removed", T.LongType()),
    T.StructField("kept_text", T.StringType()),
    T.StructField("removed", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
    ]))),
])
SENT = "bucket int, __batch int, keys binary"
NULL_ID = np.iinfo(np.int64).min


def _ordered(table: pa.Table, id_column: str, text: str) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct (id, text) of a batch in document order, their ids, and the place of each row among them."""
    texts = [t.encode() if t is not None else b"" for t in table[text].to_pylist()]
    ids = np.asarray(table[id_column].cast(pa.int64()).fill_null(NULL_ID))
    place: dict[tuple[int, bytes], int] = {k: 0 for k in sorted(zip(ids.tolist(), texts))}
    for i, k in enumerate(place):
        place[k] = i
    rows = np.fromiter((place[k] for k in zip(ids.tolist(), texts)), np.int64, len(texts))
    return [t for _, t in place], np.fromiter((i for i, _ in place), np.int64, len(place)), rows


class _Windows:
    """Hashes of all windows of the documents of a batch, in document order."""

    def __init__(self, texts: list[bytes], n: int, seeds: int = 1):
        parts = [[] for _ in range(seeds)]
        doc, pos, counts = [], [], []
        first = 0
        for part in steps([len(t) for t in texts]):
            _, _, count, hashes, _ = flat_words(texts[part], seeds=seeds)
            begins = np.cumsum(count) - count
            place = np.arange(int(count.sum()), dtype=np.int64) - np.repeat(begins, count)
            whole = np.repeat(count, count) - place >= n
            whole = whole[: max(0, len(place) - n + 1)]
            for out, h, base in zip(parts, hashes, _BASES):
                out.append(rolling(h, n, base)[whole])
            doc.append(np.repeat(np.arange(first, first + len(count)), count)[: len(whole)][whole].astype(np.int32))
            pos.append(place[: len(whole)][whole].astype(np.int32))
            counts.append(count)
            first += len(count)
        joined = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
        self.hashes = [joined(p, np.uint64) for p in parts]
        self.doc, self.pos, self.counts = joined(doc, np.int32), joined(pos, np.int32), joined(counts, np.int64)


def _sent(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    bucket, batch, keys = zip(*rows) if rows else ((), (), ())
    return pa.table({
        "bucket": pa.array(bucket, pa.int32()), B.BATCH: pa.array(batch, pa.int32()), "keys": pa.array(keys, pa.binary()),
    })


def _batch_of(table: pa.Table) -> int:
    return table[B.BATCH][0].as_py()


def probe(block: int, buckets: int, id_column: str, text: str) -> Callable[[pa.Table], pa.Table]:
    """Send the rolling windows of a batch: which are reference blocks, which occur more than once."""

    def run(table: pa.Table) -> pa.Table:
        keys, is_block, many = _blocks(_ordered(table, id_column, text)[0], block)[:3]
        rows = []
        for bucket, a, b in B.bucket_bounds(keys, buckets):
            body = B.pack_bits(is_block[a:b]) + B.pack_bits(many[a:b])
            rows.append((bucket, _batch_of(table), np.int64(b - a).tobytes() + body + B.pack(keys[a:b])))
        return _sent(rows)

    return run


def _blocks(texts: list[bytes], block: int):
    w = _Windows(texts, block)
    keys, inverse, count = np.unique(w.hashes[0], return_inverse=True, return_counts=True)
    is_block = np.zeros(len(keys), bool)
    is_block[inverse[w.pos % block == 0]] = True
    return keys, is_block, count > 1, inverse, w


def _opened(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = int(np.frombuffer(blob[:8], np.int64)[0])
    size = (n + 7) // 8
    return (
        B.unpack(blob[8 + 2 * size :]),
        B.unpack_bits(blob[8 : 8 + size], n),
        B.unpack_bits(blob[8 + size : 8 + 2 * size], n),
    )


def index(table: pa.Table) -> pa.Table:
    """Of a bucket's keys, those that are a reference block somewhere and occur at a second place."""
    batch = table[B.BATCH].to_pylist()
    bucket = table["bucket"][0].as_py()
    opened = [_opened(blob) for blob in table["keys"].to_pylist()]
    keys, inverse = np.unique(np.concatenate([o[0] for o in opened]), return_inverse=True)
    is_block = np.zeros(len(keys), bool)
    is_block[inverse[np.concatenate([o[1] for o in opened])]] = True
    many = np.concatenate([o[2] for o in opened])
    places = np.bincount(inverse, minlength=len(keys)) + np.bincount(inverse[many], minlength=len(keys))
    hit = (is_block & (places > 1))[inverse]
    ends = np.cumsum([len(o[0]) for o in opened])
    rows = []
    for b, o, end in zip(batch, opened, ends):
        mine = hit[end - len(o[0]) : end]
        if mine.any():
            rows.append((bucket, b, B.pack(o[0][mine])))
    return _sent(rows)


def candidates(window: int, block: int, buckets: int, id_column: str, text: str):
    """Send the whole windows around hits with the first id of the batch that has them."""

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if docs.num_rows == 0 or answers.num_rows == 0:
            return _sent([])
        texts, ids, _ = _ordered(docs, id_column, text)
        hits = np.sort(np.concatenate([B.unpack(blob) for blob in answers["keys"].to_pylist()]))
        small = _Windows(texts, block)
        hit = np.concatenate((np.zeros(1, np.int64), np.cumsum(_among(small.hashes[0], hits))))
        # Where each document's block-sized windows begin in the flat array; its long windows begin
        # at the same words, and a long one spans window - block + 1 small ones.
        begins = np.cumsum(np.maximum(small.counts - block + 1, 0)) - np.maximum(small.counts - block + 1, 0)
        del small
        w = _Windows(texts, window, seeds=2)
        at = begins[w.doc] + w.pos
        near = hit[at + window - block + 1] > hit[at]
        h1, h2, doc = w.hashes[0][near], (w.hashes[1][near] >> np.uint64(32)).astype(np.uint32), ids[w.doc[near]]
        order = np.lexsort((doc, h2, h1))
        h1, h2, doc = h1[order], h2[order], doc[order]
        new = np.ones(len(h1), bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        h1, h2, doc = h1[new], h2[new], doc[new]
        rows = []
        for bucket, a, b in B.bucket_bounds(h1, buckets):
            least = doc[a:b].min()
            ids_ = B.pack_counts((doc[a:b] - least).view(np.uint64))
            body = np.array([b - a, least, len(ids_)], np.int64).tobytes() + h2[a:b].tobytes() + ids_
            rows.append((bucket, _batch_of(docs), body + B.pack(h1[a:b])))
        return _sent(rows)

    return run


def _among(values: np.ndarray, sorted_keys: np.ndarray) -> np.ndarray:
    if len(sorted_keys) == 0:
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(sorted_keys, values), len(sorted_keys) - 1)
    return sorted_keys[at] == values


def owners(table: pa.Table) -> pa.Table:
    """Tell every batch which of its windows start earlier in another batch."""
    batch, bucket = table[B.BATCH].to_pylist(), table["bucket"][0].as_py()
    h1, h2, doc, of = [], [], [], []
    for i, blob in enumerate(table["keys"].to_pylist()):
        n, least, size = np.frombuffer(blob[:24], np.int64)
        at = 24 + 4 * n
        h2.append(np.frombuffer(blob[24:at], np.uint32))
        doc.append(B.unpack_counts(blob[at : at + size]).view(np.int64) + least)
        h1.append(B.unpack(blob[at + size :]))
        of.append(np.full(n, batch[i], np.int32))
    h1, h2, doc, of = (np.concatenate(x) for x in (h1, h2, doc, of))
    order = np.lexsort((of, doc, h2, h1))
    h1, h2, of = h1[order], h2[order], of[order]
    later = np.zeros(len(h1), bool)
    later[1:] = (h1[1:] == h1[:-1]) & (h2[1:] == h2[:-1])
    h1, of = h1[later], of[later]
    return _sent([(bucket, b, B.pack(np.unique(h1[of == b]))) for b in np.unique(of).tolist()])


def cut(window: int, id_column: str, text: str, schema: pa.Schema):
    """Remove the covered words of each document of a batch."""

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if docs.num_rows == 0:
            return schema.empty_table()
        texts, _, rows = _ordered(docs, id_column, text)
        w = _Windows(texts, window)
        found = [B.unpack(blob) for blob in answers["keys"].to_pylist()]
        repeated = _among(w.hashes[0], np.sort(np.concatenate(found)) if found else np.zeros(0, np.uint64))
        # Windows stand in document order, so all but the first of a key start earlier in this batch.
        _, first = np.unique(w.hashes[0], return_index=True)
        inside = np.ones(len(w.hashes[0]), bool)
        inside[first] = False
        repeated |= inside
        at = np.flatnonzero(repeated)
        begin = np.cumsum(w.counts) - w.counts
        edge = np.zeros(int(w.counts.sum()) + 1, np.int64)
        place = begin[w.doc[at]] + w.pos[at]
        np.add.at(edge, place, 1)
        np.add.at(edge, place + window, -1)
        covered = np.cumsum(edge)[:-1] > 0
        results = []
        for t, a, n in zip(texts, begin.tolist(), w.counts.tolist()):
            words, gone = t.split(), covered[a : a + n]
            removed = int(gone.sum())
            if removed:
                runs = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
                spans = [{"start": int(x), "end": int(y)} for x, y in zip(runs[0::2], runs[1::2])]
                words = [x for x, g in zip(words, gone.tolist()) if not g]
            else:
                spans = []
            results.append((n, removed, b" ".join(words).decode(), spans))
        out = docs.select([f.name for f in schema if f.name in docs.column_names and f.name not in ADDED.fieldNames()])
        for k, name in enumerate(ADDED.fieldNames()):
            out = out.append_column(schema.field(name), pa.array([results[r][k] for r in rows.tolist()], schema.field(name).type))
        return out.select(schema.names).cast(schema)

    return run


def remove_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    batch_bytes: int = B.BATCH_BYTES,
) -> DataFrame:
    """Documents with ``kept_text``, ``n_words``, ``n_removed`` and the ``removed`` word spans."""
    from pyspark.sql.pandas.types import to_arrow_schema

    block = (window + 1) // 2
    docs = docs.drop(*[c for c in ADDED.fieldNames() if c in docs.columns])
    if not isinstance(docs.schema[id_column].dataType, T.IntegralType):
        return _numbered(docs, id_column, text, window, batch_bytes)
    count = B.batch_count(docs, text, batch_bytes)
    dealt = B.in_batches(docs, [id_column, text], count)
    schema = T.StructType(docs.schema.fields + ADDED.fields)
    sent = dealt.groupBy(B.BATCH).applyInArrow(probe(block, count, id_column, text), SENT)
    hits = sent.groupBy("bucket").applyInArrow(index, SENT)
    around = dealt.groupBy(B.BATCH).cogroup(hits.groupBy(B.BATCH)).applyInArrow(
        candidates(window, block, count, id_column, text), SENT
    )
    later = around.groupBy("bucket").applyInArrow(owners, SENT)
    return dealt.groupBy(B.BATCH).cogroup(later.groupBy(B.BATCH)).applyInArrow(
        cut(window, id_column, text, to_arrow_schema(schema)), schema
    )


def _numbered(docs: DataFrame, id_column: str, text: str, window: int, batch_bytes: int) -> DataFrame:
    """The same for ids of any type: they are sorted and numbered on the cluster."""
    order = "__order"
    numbers = number_sorted(distinct_labels(docs, id_column)).select(F.col("class_id").alias(order), F.col("label").alias("__label"))
    joined = docs.join(numbers, F.col(id_column).cast("string") == F.col("__label"), "left").drop("__label")
    return remove_repeats(joined, order, text, window, batch_bytes).drop(order)


def oracle_sql(documents: str = "documents", window: int = WINDOW) -> str:
    """DuckDB SQL of the digest query, from whole windows as strings."""
    return rf"""
    WITH s AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM {documents}),
    g AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + {window - 1}), ' ') AS g
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - {window - 2})) AS i FROM s)),
    r AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS k FROM g) WHERE k > 1),
    c AS (SELECT DISTINCT doc_id, i + k AS p FROM r, range({window}) AS v(k)),
    p AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM s),
    k AS (SELECT p.doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY p.p) AS kept FROM p ANTI JOIN c ON p.doc_id = c.doc_id AND p.p = c.p GROUP BY p.doc_id)
    SELECT s.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(k.n, 0))::BIGINT AS n_removed,
        sha256(coalesce(kept, '')) AS kept_sha256 FROM s LEFT JOIN k USING (doc_id)"""
