"""LM scoring by a weighted backoff automaton.

The model is an interpolated bigram model with absolute discounting over an add-one unigram model:

    P1(w)     = (c(w) + 1) / (N + V + 1)
    P(w | h)  = max(c(h w) - D, 0) / c(h) + D * n(h) / c(h) * P1(w)

with n(h) the number of different words seen after h. As an automaton, each history seen in training
is a state; a seen word has an arc with its probability; any other word leaves by the failure arc, of
weight D * n(h) / c(h), to the root, which holds P1. A history without training is the root itself.
One left-to-right traversal carries the state (the start state, then the last token's) and adds up the
logarithms of arcs and failure arcs. P sums to one over the V known tokens and one unknown token.

No table of the vocabulary is broadcast: every batch of documents (``batches``) sends its distinct
histories and bigrams with their training counts to buckets of the key space and gets the totals
back, that is the part of the automaton its texts can reach. Only N, V and the number of training
documents are global numbers.

Defined results: null text is empty and scores its end token alone. Capitals A-Z are folded. Rows
with null or repeated ids are scored one by one; a null id is in training. Empty tables give an empty
result. Columns of the input are kept; added ones replace columns of the same name. Words are
compared by 64-bit hashes, words after one history by 48 bits of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from textlens.llm import batches as B
from textlens.llm.words import flat_words, steps

DISCOUNT = 0.5
HELD_OUT_OF, HELD_OUT = 7, 2
START = np.uint64(0x5354415254)
END = np.uint64(0x454E44454E44)
WORD_BITS = np.uint64((1 << 48) - 1)
HELD = "__held"
ADDED = T.StructType([
    T.StructField("n_tokens", T.LongType()),
    T.StructField("n_known", T.LongType()),
    T.StructField("base_score", T.DoubleType()),
    T.StructField("score", T.DoubleType()),
])
SENT = "bucket int, __batch int, body binary"


def held_out(id_column: str = "doc_id", of: int = HELD_OUT_OF, remainder: int = HELD_OUT) -> Column:
    """crc32 of the id as text; a null id counts as the empty text and is in training."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % of == remainder


class _Stream:
    """All tokens of a batch in reading order, the end token after each text."""

    def __init__(self, table: pa.Table, text: str):
        texts = [t.encode() if t is not None else b"" for t in table[text].to_pylist()]
        held = np.asarray(table[HELD])
        tokens, counts = [], []
        for part in steps([len(t) for t in texts]):
            _, _, count, (h,), _ = flat_words(texts[part], lower=True)
            tokens.append(np.insert(h, np.cumsum(count), END))
            counts.append(count + 1)
        self.tokens = np.concatenate(tokens) if tokens else np.zeros(0, np.uint64)
        self.counts = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        self.begins = np.cumsum(self.counts) - self.counts
        self.trained = np.repeat(~held, self.counts)
        before = np.roll(self.tokens, 1)
        before[self.begins] = START
        # Every token and the start are histories, so a history carries its own unigram count.
        self.histories, index = np.unique(np.concatenate((self.tokens, [START])), return_inverse=True)
        self.token = index[:-1]
        start = index[-1]
        self.history = np.roll(self.token, 1)
        self.history[self.begins] = start
        # Bigrams are sorted by history, then by word.
        word = self.tokens & WORD_BITS
        order = np.lexsort((word, self.history))
        h, w = self.history[order], word[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (w[1:] != w[:-1])
        of = np.cumsum(new) - 1
        self.bigram = np.empty(len(h), np.int64)
        self.bigram[order] = of
        self.bigram_history, self.bigram_word = h[new], w[new]
        trained = self.trained.astype(np.float64)
        whole = lambda x: np.rint(x).astype(np.int64)
        self.c1 = whole(np.bincount(self.token, trained, len(self.histories)))
        self.c1[start] = int((~held).sum())
        self.c2 = whole(np.bincount(self.bigram, trained, len(self.bigram_history)))
        self.followers = np.bincount(self.bigram_history, minlength=len(self.histories))


def _table(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    bucket, batch, body = zip(*rows) if rows else ((), (), ())
    return pa.table({
        "bucket": pa.array(bucket, pa.int32()), B.BATCH: pa.array(batch, pa.int32()), "body": pa.array(body, pa.binary()),
    })


def _framed(*parts: bytes) -> bytes:
    return np.array([len(p) for p in parts], np.int64).tobytes() + b"".join(parts)


def _frames(body: bytes, n: int) -> list[bytes]:
    sizes = np.frombuffer(body[: 8 * n], np.int64).tolist()
    out, at = [], 8 * n
    for size in sizes:
        out.append(body[at : at + size])
        at += size
    return out


def counted(buckets: int, text: str):
    """Send histories, their unigram counts and the bigrams of a batch."""

    def run(table: pa.Table) -> pa.Table:
        s = _Stream(table, text)
        batch = table[B.BATCH][0].as_py()
        ends = np.cumsum(s.followers)
        rows = []
        for bucket, a, b in B.bucket_bounds(s.histories, buckets):
            x, y = int(ends[a] - s.followers[a]), int(ends[b - 1])
            rows.append((bucket, batch, _framed(
                B.pack(s.histories[a:b]), B.pack_counts(s.c1[a:b]), B.pack_counts(s.followers[a:b]),
                B.narrow(s.bigram_word[x:y], 6), B.pack_counts(s.c2[x:y]),
            )))
        return _table(rows)

    return run


def totals(table: pa.Table) -> pa.Table:
    """Add up a bucket's counts and answer each batch in its own order."""
    batch, bucket = table[B.BATCH].to_pylist(), table["bucket"][0].as_py()
    keys, c1, followers, words, c2 = zip(*(_opened(body) for body in table["body"].to_pylist()))
    histories, index = np.unique(np.concatenate(keys), return_inverse=True)
    total1 = np.rint(np.bincount(index, np.concatenate(c1).astype(np.float64), len(histories))).astype(np.int64)
    history = np.repeat(index, np.concatenate(followers))
    word = np.concatenate(words)
    order = np.lexsort((word, history))
    new = np.ones(len(order), bool)
    h, w = history[order], word[order]
    new[1:] = (h[1:] != h[:-1]) | (w[1:] != w[:-1])
    pair = np.empty(len(order), np.int64)
    pair[order] = np.cumsum(new) - 1
    total2 = np.rint(np.bincount(pair, np.concatenate(c2).astype(np.float64), int(new.sum()))).astype(np.int64)
    kinds = np.bincount(h[new][total2 > 0], minlength=len(histories))
    rows, at1, at2 = [], 0, 0
    for b, k, w in zip(batch, keys, words):
        mine, pairs = index[at1 : at1 + len(k)], pair[at2 : at2 + len(w)]
        at1, at2 = at1 + len(k), at2 + len(w)
        rows.append((bucket, b, _framed(
            B.pack_counts(total1[mine]), B.pack_counts(kinds[mine]), B.pack_counts(total2[pairs]),
        )))
    return _table(rows)


def _opened(body: bytes):
    keys, c1, followers, words, c2 = _frames(body, 5)
    return B.unpack(keys), B.unpack_counts(c1), B.unpack_counts(followers).astype(np.int64), B.widen(words, 6), B.unpack_counts(c2)


def traverse(text: str, n: int, v: int, discount: float, schema: pa.Schema):
    """Score the texts of a batch on the part of the automaton they reach."""

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if docs.num_rows == 0:
            return schema.empty_table()
        s = _Stream(docs, text)
        # Buckets are ranges of the sorted keys, so their answers in order are the arrays sent.
        bodies = [body for _, body in sorted(zip(answers["bucket"].to_pylist(), answers["body"].to_pylist()))]
        c1, kinds, c2 = (
            np.concatenate([B.unpack_counts(x) for x in column]).astype(np.float64)
            for column in zip(*(_frames(body, 3) for body in bodies))
        )
        root = (c1 + 1) / (n + v + 1)
        state = c1 > 0
        fail = np.ones(len(c1))
        fail[state] = discount * kinds[state] / c1[state]
        seen = c2 > 0
        arc = np.zeros(len(c2))
        arc[seen] = (c2[seen] - discount) / c1[s.bigram_history[seen]]
        # The traversal: state after the last token, then its arc, or failure arc and root arc.
        p1 = root[s.token]
        p = arc[s.bigram] + fail[s.history] * p1
        per_text = lambda x: np.add.reduceat(x, s.begins)
        values = [s.counts, per_text((c1[s.token] > 0).astype(np.int64)), per_text(np.log10(p1)), per_text(np.log10(p))]
        out = docs
        for name, value in zip(ADDED.fieldNames(), values):
            out = out.append_column(schema.field(name), pa.array(value, schema.field(name).type))
        return out.select(schema.names).cast(schema)

    return run


def _distinct_sent(buckets: int, text: str):
    """Per partition: its distinct training tokens and the number of all of them, by bucket."""

    def run(parts):
        for part in parts:
            table = pa.Table.from_batches([part])
            if table.num_rows == 0:
                continue
            tokens = [np.full(table.num_rows, END, np.uint64)]
            texts = [t.encode() if t is not None else b"" for t in table[text].to_pylist()]
            for x in steps([len(t) for t in texts]):
                tokens.append(np.unique(flat_words(texts[x], lower=True)[3][0], return_counts=True))
            keys = np.concatenate([tokens[0]] + [k for k, _ in tokens[1:]])
            counts = np.concatenate([np.ones(table.num_rows, np.int64)] + [c for _, c in tokens[1:]])
            keys, index = np.unique(keys, return_inverse=True)
            counts = np.rint(np.bincount(index, counts.astype(np.float64))).astype(np.int64)
            rows = [(k, 0, _framed(B.pack(keys[a:b]), B.pack_counts(counts[a:b]))) for k, a, b in B.bucket_bounds(keys, buckets)]
            yield from _table(rows).to_batches()

    return run


def _distinct(table: pa.Table) -> pa.Table:
    keys, counts = zip(*(_frames(body, 2) for body in table["body"].to_pylist()))
    v = len(np.unique(np.concatenate([B.unpack(k) for k in keys])))
    return pa.table({"v": [v], "n": [int(sum(B.unpack_counts(c).sum() for c in counts))]})


def corpus_size(training: DataFrame, text: str, buckets: int) -> tuple[int, int]:
    """N and V: all and distinct training tokens."""
    sent = training.select(text).mapInArrow(_distinct_sent(buckets, text), SENT)
    each = sent.groupBy("bucket").applyInArrow(_distinct, "v long, n long")
    row = each.agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    return row["n"] or 0, row["v"] or 0


def score(
    docs: DataFrame,
    held: Column,
    keys: list[str],
    text: str = "text",
    discount: float = DISCOUNT,
    batch_bytes: int = B.BATCH_BYTES,
) -> DataFrame:
    """Score all rows with a model of the rows where ``held`` is false; adds ``train_tokens``.

    ``keys`` spread the rows over batches (id and text).
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    added = ADDED.fieldNames() + ["train_tokens"]
    docs = docs.withColumn(HELD, F.coalesce(held, F.lit(False))).drop(*[c for c in added if c in docs.columns])
    count = B.batch_count(docs, text, batch_bytes)
    n, v = corpus_size(docs.where(~F.col(HELD)), text, count)
    dealt = B.in_batches(docs, keys, count)
    sent = dealt.groupBy(B.BATCH).applyInArrow(counted(count, text), SENT)
    answers = sent.groupBy("bucket").applyInArrow(totals, SENT)
    schema = T.StructType([f for f in docs.schema.fields if f.name != HELD] + ADDED.fields)
    scored = dealt.groupBy(B.BATCH).cogroup(answers.groupBy(B.BATCH)).applyInArrow(
        traverse(text, n, v, discount, to_arrow_schema(schema)), schema
    )
    return scored.withColumn("train_tokens", F.lit(n).cast("bigint"))
