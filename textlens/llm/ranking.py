"""A quality classifier by Bradley-Terry pairwise ranking.

A document's strength is a weighted sum of features of its text; the odds that one document is preferred to another are
``exp`` of the difference of their strengths. The weights are learned from preference pairs: every labelled document is set
against ``PAIRS`` documents of the other label, and the logistic loss on feature differences, with a weak prior, is
minimised by Newton steps. A step is one Spark aggregate of gradient and curvature over the stored pairs; what reaches the
driver is a square of the number of features.

The threshold is a quantile of strength: the one below which as large a share of the training documents lies as has label 0. A score
is the odds of being preferred to a document at that quantile, moved so that it stands at ``THRESHOLD``:
``score >= THRESHOLD`` means the upper quantile, and the strongest documents come close to 1.

Features are shares, rates and logarithms of counts over the whole text (letters by case, digits, symbols, punctuation, words by
length and shape, repeated words, repeated three-word windows), each with its square. They are computed in flat arrays for
many texts at once. Texts are not shuffled: features are computed where a text lies, and only they meet the labels.

The fit takes every labelled row: counts, pairs, moments and the quantile are of all of them. Positions for the pairs and the
quantile come from a distributed sort, so no label is ever in one task. One document counts for each id (equal ids: the
one smallest in feature order), the highest label for each id with several.

Defined results: null and empty texts have features 0 and get the score these have. Null ids and null labels don't train. Rows are
scored one by one, so repeated rows, ties and empty tables need no rule; other columns are kept, one named like the score is
replaced. With training rows of one label only, every score is that label; without any it is ``THRESHOLD``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from textlens.llm.near_dup import saved
from textlens.llm.words import flat_words, rolling, steps

PAIRS = 4
# Up to this many documents of the rarer label are sent to the tasks that form pairs.
SENT_ROWS = 20_000
THRESHOLD = 0.3
PRIOR = 1e-3
NEWTON_STEPS = 12
FOLDS, HELD_OUT = 5, 0
# Standardised features are cut here, so that one odd text doesn't bend the fit.
REACH = 5.0
WINDOW = 3


def held_out(id_column: str = "doc_id") -> Column:
    """crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def _flags(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in chars]] = True
    return out


_UPPER = _flags("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LOWER = _flags("abcdefghijklmnopqrstuvwxyz")
_DIGIT = _flags("0123456789")
_BYTES = {
    "upper": _UPPER,
    "digit": _DIGIT,
    "beyond_ascii": np.arange(256) >= 128,
    "stop": _flags(".,;:"),
    "call": _flags("!?"),
    "quote": _flags("\"'()[]{}"),
    "sign": _flags("#*$%&|<>"),
    "other": _flags("+-/=@\\^_`~"),
    "line_end": _flags("\n"),
}
_WORD_BYTE = _UPPER | _LOWER | _DIGIT | (np.arange(256) >= 128)
NAMES = (
    "log_bytes", "log_words", *(f"{name}_rate" for name in _BYTES), "upper_share", "word_length", "longest",
    "short_words", "bare_words", "capital_words", "marked_ends", "distinct", "after_itself", "repeated_windows",
)


def _sums(flags: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return (total[ends] - total[begins]).astype(np.float64)


def _distinct(doc: np.ndarray, keys: np.ndarray, texts: int) -> np.ndarray:
    """Distinct keys of each text."""
    order = np.lexsort((keys, doc))
    k, d = keys[order], doc[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (d[1:] != d[:-1])
    return np.bincount(d[new], minlength=texts).astype(np.float64)


def features(texts: list[bytes]) -> np.ndarray:
    """One row of ``NAMES`` for each text."""
    n = len(texts)
    starts, ends, counts, (h,), data = flat_words(texts)
    sizes = np.fromiter(map(len, texts), np.int64, n)
    begins = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    out = np.zeros((n, len(NAMES)))
    column = {name: k for k, name in enumerate(NAMES)}
    words = np.maximum(counts, 1).astype(np.float64)
    out[:, column["log_bytes"]] = np.log1p(sizes)
    out[:, column["log_words"]] = np.log1p(counts)
    totals = {}
    for name, flags in _BYTES.items():
        totals[name] = _sums(flags[data], begins, begins + sizes)
        out[:, column[f"{name}_rate"]] = np.log1p(totals[name] / words)
    letters = totals["upper"] + _sums(_LOWER[data], begins, begins + sizes)
    out[:, column["upper_share"]] = totals["upper"] / np.maximum(letters, 1)
    doc = np.repeat(np.arange(n), counts)
    length = ends - starts
    share = lambda flags: np.bincount(doc, flags, n) / words
    out[:, column["word_length"]] = np.log1p(share(length))
    longest = np.zeros(n)
    np.maximum.at(longest, doc, length)
    out[:, column["longest"]] = np.log1p(longest)
    out[:, column["short_words"]] = share(length <= 3)
    in_words = np.concatenate(([0], np.cumsum(_WORD_BYTE[data], dtype=np.int64)))
    out[:, column["bare_words"]] = share(in_words[ends] == in_words[starts])
    out[:, column["capital_words"]] = share(_UPPER[data[starts]])
    out[:, column["marked_ends"]] = share(~_WORD_BYTE[data[ends - 1]])
    out[:, column["distinct"]] = np.where(counts > 0, _distinct(doc, h, n) / words, 0)
    if len(h) > 1:
        again = np.concatenate(([False], (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])))
        out[:, column["after_itself"]] = share(again)
    if len(h) >= WINDOW:
        inside = doc[WINDOW - 1 :] == doc[: len(doc) - WINDOW + 1]
        own = doc[: len(inside)][inside]
        windows = np.maximum(np.bincount(own, minlength=n), 1)
        seen = _distinct(own, rolling(h, WINDOW)[inside], n)
        out[:, column["repeated_windows"]] = np.where(counts >= WINDOW, 1 - seen / windows, 0)
    return out


def _rows(batch: pa.RecordBatch, text: str):
    texts = [t.encode() if t is not None else b"" for t in batch.column(text).to_pylist()]
    for part in steps([len(t) for t in texts]):
        yield features(texts[part])


def _describer(text: str):
    def run(batches):
        for batch in batches:
            x = np.concatenate([np.zeros((0, len(NAMES))), *_rows(batch, text)])
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(NAMES)), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), lists], ["id", "x"])

    return run


class Ranker:
    """Strengths of documents, and the quantile that is the threshold."""

    def __init__(self, middle: np.ndarray, spread: np.ndarray, weights: np.ndarray, cut: float = 0.0, fixed: float | None = None):
        self.middle, self.spread, self.weights, self.cut, self.fixed = middle, spread, weights, cut, fixed

    def standardised(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.middle) / self.spread, -REACH, REACH)
        return np.concatenate((z, z * z), 1)

    def strength(self, x: np.ndarray) -> np.ndarray:
        return (self.standardised(x) * self.weights).sum(1)

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.fixed is not None:
            return np.full(len(x), self.fixed)
        above = self.strength(x) - self.cut + math.log(THRESHOLD / (1 - THRESHOLD))
        out = 1 / (1 + np.exp(-np.clip(above, -40, 40)))
        # The quantile itself counts as above, whatever the rounding of the line before.
        return np.where(self.strength(x) >= self.cut, np.maximum(out, THRESHOLD), np.minimum(out, np.nextafter(THRESHOLD, 0)))

    def score(self, docs: DataFrame, text: str = "text", name: str = "score") -> DataFrame:
        """Documents with their score; a column of that name is replaced."""
        docs = docs.drop(name)

        def run(batches):
            for batch in batches:
                scores = np.concatenate([np.zeros(0), *map(self.scores, _rows(batch, text))])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], [*batch.schema.names, name])

        return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def _sampled(labels: DataFrame, id_column: str, label: str, sample: int | None) -> DataFrame:
    """(id, label): every labelled id once; with a ``sample``, those with a hash below a cut, so many on average at most."""
    slim = labels.select(F.col(id_column).alias("id"), F.col(label).cast("int").alias("label")).where("id IS NOT NULL AND label IS NOT NULL")
    one = slim.groupBy("id").agg(F.max("label").alias("label"))
    n = one.count() if sample is not None else 0
    if sample is None or n <= sample:
        return one
    return one.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(sample / n * (1 << 30)))


def placed(rows: DataFrame, *order: Column | str) -> DataFrame:
    """Rows with ``at``, their place from 0 in a total order, sorted across the cluster.

    The sorted rows are stored, which fixes their partitions; only one number a partition reaches the driver.
    """
    stored = saved(rows.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftright("_place", 33)
    sizes = sorted(stored.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    before, total = {}, 0
    for number, n in sizes:
        before[number], total = total, total + n
    if not before:
        return stored.withColumn("at", F.col("_place")).drop("_place")
    offsets = stored.sparkSession.createDataFrame(list(before.items()), "_part long, _before long")
    joined = stored.join(F.broadcast(offsets), part == F.col("_part"))  # a row a partition
    return joined.withColumn("at", F.col("_before") + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))).drop("_place", "_part", "_before")


def _stepper(ranker: Ranker):
    """Gradient and curvature of the loss over a task's pairs; cell -1 counts them, -2 sums the loss."""
    w = ranker.weights

    def run(batches):
        gradient, curvature, n, loss = np.zeros(len(w)), np.zeros((len(w), len(w))), 0, 0.0
        for batch in batches:
            good, bad = (np.asarray(batch.column(c).flatten()).reshape(batch.num_rows, -1) for c in ("good", "bad"))
            d = ranker.standardised(good) - ranker.standardised(bad)
            margin = np.clip((d * w).sum(1), -40, 40)
            p = 1 / (1 + np.exp(margin))
            gradient -= (d * p[:, None]).sum(0)
            curvature += (d * (p * (1 - p))[:, None]).T @ d
            loss += np.log1p(np.exp(-margin)).sum()
            n += batch.num_rows
        values = np.concatenate(([loss, n], gradient, curvature.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values)) - 2), pa.array(values)], ["cell", "value"])

    return run


def preference_pairs(rows: DataFrame, pairs: int = PAIRS) -> DataFrame:
    """(good, bad): features of documents of label 1 and 0; each document of either label in ``pairs`` pairs at least.

    Opponents are dealt by position: the next ones in turn for each document, so all are used alike and no two labels
    are crossed. ``id`` is unique in ``rows``.
    """
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    numbered = placed(rows, "label", F.xxhash64("id"), "id")
    numbered = numbered.withColumn("at", F.col("at") - F.when(F.col("label") == 1, sizes[0]).otherwise(0))
    many, few = (1, 0) if sizes[1] >= sizes[0] else (0, 1)
    turns = F.explode(F.sequence(F.lit(0), F.lit(pairs - 1))).alias("turn")
    left = numbered.where(F.col("label") == many).select("at", F.col("x").alias("many"), turns)
    left = left.withColumn("facing", (F.col("at") * pairs + F.col("turn")) % sizes[few])
    right = numbered.where(F.col("label") == few).select(F.col("at").alias("facing"), F.col("x").alias("few"))
    # Few opponents, each facing many, are sent; more of them are dealt out by their position.
    right = F.broadcast(right) if sizes[few] <= SENT_ROWS else right
    names = ("good", "bad") if many == 1 else ("bad", "good")
    return left.join(right, "facing").select(F.col("many").alias(names[0]), F.col("few").alias(names[1]))


def fit(
    docs: DataFrame, labels: DataFrame, train: Column, id_column: str = "doc_id", text: str = "text",
    label: str = "quality", sample: int | None = None, pairs: int = PAIRS,
) -> Ranker:
    """Fit on all labelled rows for which ``train`` (a condition on the id) holds, or on a ``sample`` of them if a caller asks."""
    slim = docs.where(train).select(F.col(id_column).alias("id"), F.col(text).alias("text")).where("id IS NOT NULL")
    kind = slim.schema["id"].dataType.simpleString()
    described = slim.mapInArrow(_describer("text"), f"id {kind}, x array<double>")
    one = described.groupBy("id").agg(F.min("x").alias("x"))
    rows = saved(one.join(_sampled(labels.where(train), id_column, label, sample), "id").select("id", "label", "x"))
    width = len(NAMES)
    each = [f(F.get("x", F.lit(k))) for k in range(width) for f in (F.avg, F.stddev_pop)]
    first = rows.agg(F.count(F.lit(1)), F.sum("label"), *each).first()
    n, good = first[0], first[1] or 0
    moments = np.array([v if v is not None else 0.0 for v in first[2:]]).reshape(width, 2)
    ranker = Ranker(moments[:, 0], np.where(moments[:, 1] > 1e-9, moments[:, 1], 1.0), np.zeros(2 * width))
    if good in (0, n):
        ranker.fixed = THRESHOLD if n == 0 else float(good > 0)
        return ranker
    facing = saved(preference_pairs(rows, pairs))
    for _ in range(NEWTON_STEPS):
        sums = facing.mapInArrow(_stepper(ranker), "cell long, value double").groupBy("cell").agg(F.sum("value"))
        values = np.zeros(2 + 2 * width + 4 * width * width)
        for cell, value in sums.collect():  # as many rows as values
            values[cell + 2] = value
        count = max(values[1], 1.0)
        gradient = values[2 : 2 + 2 * width] / count + PRIOR * ranker.weights
        curvature = values[2 + 2 * width :].reshape(2 * width, 2 * width) / count + PRIOR * np.eye(2 * width)
        step = np.linalg.solve(curvature, gradient)
        ranker.weights = ranker.weights - step
        if np.abs(step).max() < 1e-6:
            break
    # Half way between the strengths on both sides of the quantile.
    # Equal strengths are told apart by their row, so that many copies are not one task's.
    strengths = rows.mapInArrow(_strengths(ranker), "strength double").withColumn("row", F.monotonically_increasing_id())
    ranked = placed(strengths, "strength", "row")
    beside = ranked.where(F.col("at").isin(n - good - 1, n - good)).agg(F.avg("strength"))  # two rows
    ranker.cut = beside.first()[0]
    return ranker


def _strengths(ranker: Ranker):
    def run(batches):
        for batch in batches:
            x = np.asarray(batch.column("x").flatten()).reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([pa.array(ranker.strength(x))], ["strength"])

    return run
