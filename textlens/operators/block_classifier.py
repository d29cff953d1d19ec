"""A linear text classifier of any number of classes: one-vs-rest logistic regression in blocks of classes.

Nothing here is as large as classes x features in one place. Coefficients are a table of (block, feature, an array
with a weight for each class of the block); examples are packed into chunks of a bounded number of feature values. The unit of
work is a chunk and a span of blocks: a cogroup of the chunk with the weights of just the features that occur in it. The fewer features
a chunk has, the more blocks a span: a chunk is sent and opened once a span, and its steps work on wide matrices.

An epoch is one pass. Every chunk starts with the weights of the epoch before, goes through its examples in mini-batches
(shuffled by seed, epoch and chunk) with a step size that adapts to each weight, and returns what it changed. The new
weight is the mean over the chunks that saw the feature, weighted by their examples: an aggregate with map-side combine.
So epoch k costs one pass and continues epoch k - 1; batch size and learning rate mean what they usually do.

Scores of a class are independent of other blocks; probabilities are the classes' own, divided by their sum. Each chunk and
span returns its best class, its sum, and the probability of the true class; a chunk's spans are then combined, which is the
argmax over all classes. Weights that are counted and found small are sent to the tasks instead, and rows are
scored where they stand.

Features are hashed words with a damped count, scaled to length one, and a constant. Results don't depend on which executor
does what: chunks are stored before they are used.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from textlens.sources.sinks import materialise

WORD_SEPARATORS = r"[^\p{L}\p{N}]+"
# What a weight's sum of squared gradients starts from: the step that a first, small gradient makes stays small.
FIRST_SQUARES = 0.1
# Classes of a block, feature values of a chunk.
BLOCK = 32
CHUNK_VALUES = 1 << 19
# Words, and products of values and classes, that a task works on at once, however large an Arrow batch is.
WORDS_AT_ONCE = 1 << 18
PRODUCTS_AT_ONCE = 1 << 20
# Weights that a unit holds, and blocks of a span at most.
UNIT_WEIGHTS = 1 << 22
SPAN = 32
# Values are set into a matrix of rows x features if at least one of so many of its cells is filled.
SPARSE = 16
# Weights up to this size are sent to the tasks that score.
SENT_BYTES = 64 << 20
WEIGHTS = "block int, feature int, w array<float>, g array<float>"
CHUNK = "chunk bigint, span int, edges binary, feature binary, value binary, y array<bigint>"


def hashed_words(text: Column, num_features: int) -> Column:
    """Feature numbers of the words of a text, in order; none for null."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), WORD_SEPARATORS), lambda w: w != "")
    return F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(num_features)).cast("int"))


class Examples:
    """Feature values of several examples, row by row."""

    def __init__(self, edges: np.ndarray, feature: np.ndarray, value: np.ndarray):
        self.edges, self.feature, self.value = edges, feature, value
        self.rows = len(edges) - 1

    @classmethod
    def of(cls, words: pa.Array, num_features: int) -> Examples:
        """The same whatever ``WORDS_AT_ONCE`` is; it bounds what counting takes beside words and result."""
        parts = [cls._counted(words.slice(low, high - low), num_features) for low, high in word_ranges(words)]
        if len(parts) == 1:
            return parts[0]
        sizes = [np.diff(x.edges) for x in parts]
        return cls(
            np.concatenate(([0], np.cumsum(np.concatenate([np.zeros(0, np.int64), *sizes])))),
            np.concatenate([np.zeros(0, np.int32), *[x.feature for x in parts]]),
            np.concatenate([np.zeros(0, np.float32), *[x.value for x in parts]]),
        )

    @classmethod
    def _counted(cls, words: pa.Array, num_features: int) -> Examples:
        sizes = np.asarray(words.value_lengths().fill_null(0)).astype(np.int64)
        row = np.repeat(np.arange(len(sizes)), sizes)
        key = row * (num_features + 1) + np.asarray(words.flatten()).astype(np.int64)
        constant = np.arange(len(sizes)) * (num_features + 1) + num_features
        key, count = np.unique(key, return_counts=True)
        value = np.log1p(count)
        row = key // (num_features + 1)
        length = np.sqrt(np.bincount(row, value * value, len(sizes)))
        key, order = np.unique(np.concatenate((key, constant)), return_index=True)
        value = np.concatenate((value / length[row], np.ones(len(sizes))))[order]
        edges = np.searchsorted(key, np.arange(len(sizes) + 1) * (num_features + 1))
        return cls(edges, (key % (num_features + 1)).astype(np.int32), value.astype(np.float32))

    def part(self, low: int, high: int) -> Examples:
        a, b = self.edges[low], self.edges[high]
        return Examples(self.edges[low : high + 1] - a, self.feature[a:b], self.value[a:b])

    def cut(self, values: int) -> Iterator[tuple[int, int]]:
        """Ranges of rows with about so many values each."""
        low = 0
        while low < self.rows:
            high = int(np.searchsorted(self.edges, self.edges[low] + values, "right")) - 1
            high = min(max(high, low + 1), self.rows)
            yield low, high
            low = high

    def scores(self, weights: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Sum of weight x value per row and class; ``place``: row of each feature value's weights, -1 for none."""
        if not len(place):
            return np.zeros((self.rows, weights.shape[1]), np.float32)
        found, column = np.unique(place, return_inverse=True)
        if self.rows * len(found) <= SPARSE * len(place):
            row = np.repeat(np.arange(self.rows), np.diff(self.edges))
            own = np.where(found[:, None] >= 0, weights[found], 0)
            return self._matrix(row, column, self.value, (self.rows, len(found))) @ own
        products = np.where(place[:, None] >= 0, weights[place], 0) * self.value[:, None]
        # Every row has at least its constant, so no range is empty.
        return np.add.reduceat(products, self.edges[:-1], axis=0)


    @staticmethod
    def _matrix(row: np.ndarray, column: np.ndarray, value: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
        cells = np.bincount(row * shape[1] + column, value, shape[0] * shape[1])
        return cells.reshape(shape).astype(np.float32)


def word_ranges(words: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most ``WORDS_AT_ONCE`` words, or one row each."""
    ends = np.cumsum(np.asarray(words.value_lengths().fill_null(0)).astype(np.int64))
    low = 0
    while low < len(ends):
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + WORDS_AT_ONCE, "right")))
        yield low, high
        low = high


def _packer(num_features: int, values: int, payload: bool):
    """Rows (words, y, payload) as chunks."""

    def run(batches):
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            all_ = Examples.of(batch.column("words"), num_features)
            for low, high in all_.cut(values):
                x = all_.part(low, high)
                one = lambda a, t: pa.array([a.astype(t).tobytes()], pa.binary())
                lists = lambda name: pa.ListArray.from_arrays(
                    pa.array([0, high - low], pa.int32()), batch.column(name).slice(low, high - low)
                )
                span = min(SPAN, max(1, UNIT_WEIGHTS // (BLOCK * len(np.unique(x.feature)))))
                columns = [pa.array([(part << 33) + number]), pa.array([span], pa.int32()), one(x.edges, np.int64), one(x.feature, np.int32), one(x.value, np.float32), lists("y")]
                names = ["chunk", "span", "edges", "feature", "value", "y"]
                if payload:
                    columns.append(lists("payload"))
                    names.append("payload")
                number += 1
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def pack(rows: DataFrame, num_features: int, values: int = CHUNK_VALUES) -> DataFrame:
    """Chunks of rows (words, y and possibly a struct ``payload``), stored."""
    payload = "payload" in rows.columns
    kept = rows.select("words", F.col("y").cast("bigint").alias("y"), *(["payload"] if payload else []))
    schema = T.StructType.fromDDL(CHUNK)
    if payload:
        schema = T.StructType([*schema.fields, T.StructField("payload", T.ArrayType(kept.schema["payload"].dataType))])
    return materialise(kept.mapInArrow(_packer(num_features, values, payload), schema))


def _opened(table: pa.Table) -> tuple[Examples, np.ndarray]:
    blob = lambda name, t: np.frombuffer(table[name][0].as_py(), t)
    x = Examples(blob("edges", np.int64), blob("feature", np.int32), blob("value", np.float32))
    return x, np.asarray(table["y"][0].values.fill_null(-1))


def _width(block: int, classes: int, span: int = 1) -> int:
    return min(BLOCK * span, classes - block * BLOCK)


def _filled(out: np.ndarray, table: pa.Table, name: str, features: np.ndarray, first: int) -> None:
    """Set the weights of a table (block, feature, ``name``) into a matrix of features x classes from block ``first`` on."""
    blocks, lists = np.asarray(table["block"]), table[name].combine_chunks()
    at = np.searchsorted(features, np.asarray(table["feature"]))
    for block in np.unique(blocks):
        own = np.flatnonzero(blocks == block)
        low = (block - first) * BLOCK
        width = min(BLOCK, out.shape[1] - low)
        out[at[own], low : low + width] = np.asarray(lists.take(pa.array(own)).flatten(), np.float32).reshape(-1, width)


def _arrays(values: np.ndarray) -> pa.Array:
    """Rows of a matrix cut into blocks of classes, block by block."""
    parts = [values[:, low : low + BLOCK].astype(np.float32) for low in range(0, values.shape[1], BLOCK)]
    sizes = np.concatenate([np.full(len(part), part.shape[1]) for part in parts])
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([part.ravel() for part in parts])))


@dataclass(frozen=True)
class Steps:
    """How an epoch moves the weights."""

    batch_size: int = 64
    learning_rate: float = 0.5
    regularization: float = 0.0
    seed: int = 42

    def trainer(self, classes: int, num_features: int, epoch: int):
        """One chunk's pass for one span of blocks: new weights of its features; the loss stands at feature -1."""

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows:
                return pa.table({"block": pa.array([], pa.int32()), "feature": pa.array([], pa.int32()), "n": pa.array([], pa.int64()),
                                 "w": pa.array([], pa.list_(pa.float32())), "g": pa.array([], pa.list_(pa.float32()))})
            x, y = _opened(left)
            span = left["span"][0].as_py()
            block = left["unit"][0].as_py() * span
            width = _width(block, classes, span)
            features, place = np.unique(x.feature, return_inverse=True)
            w = np.zeros((len(features), width), np.float32)
            g = np.zeros((len(features), width), np.float32)
            # Every class starts as one of many: its constant gives it the odds of a guess.
            w[features == num_features] = -np.log(classes - 1)
            if right.num_rows:
                _filled(w, right, "w", features, block)
                _filled(g, right, "g", features, block)
            order = np.random.default_rng([self.seed, epoch, left["chunk"][0].as_py()]).permutation(x.rows)
            losses = np.zeros(width)
            for start in range(0, x.rows, self.batch_size):
                losses += self._step(x, y - block * BLOCK, place, w, g, order[start : start + self.batch_size])
            n = np.bincount(place, minlength=len(features))
            blocks = -(-width // BLOCK)
            # A block's loss stands in all its places.
            loss = np.repeat(np.add.reduceat(losses, np.arange(0, width, BLOCK)), BLOCK)[None, :width]
            return pa.table({
                "block": pa.array(np.repeat(np.arange(block, block + blocks), len(features) + 1).astype(np.int32)),
                "feature": pa.array(np.tile(np.concatenate((features, [-1])), blocks).astype(np.int32)),
                "n": pa.array(np.tile(np.concatenate((n, [x.rows])), blocks)),
                "w": _arrays(np.concatenate((w, loss / x.rows))),
                "g": _arrays(np.concatenate((g, np.zeros((1, width), np.float32)))),
            })

        return run

    def _step(self, x: Examples, y: np.ndarray, place: np.ndarray, w: np.ndarray, g: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Move the weights by one mini-batch; its loss before that, class by class."""
        sizes = x.edges[rows + 1] - x.edges[rows]
        begins = np.cumsum(sizes) - sizes
        values = np.arange(sizes.sum()) + np.repeat(x.edges[rows] - begins, sizes)
        at, value, row = place[values], x.value[values], np.repeat(np.arange(len(rows)), sizes)
        touched, column = np.unique(at, return_inverse=True)
        dense = len(rows) * len(touched) <= SPARSE * len(at)
        if dense:
            matrix = x._matrix(row, column, value, (len(rows), len(touched)))
            z = matrix @ w[touched]
        else:
            z = np.add.reduceat(w[at] * value[:, None], begins, axis=0)
        z = np.clip(z, -30, 30)
        small = np.exp(-np.abs(z))
        error = np.where(z >= 0, 1, small) / (1 + small)
        losses = np.maximum(z, 0) + np.log1p(small)
        own = np.flatnonzero((y[rows] >= 0) & (y[rows] < w.shape[1]))
        error[own, y[rows][own]] -= 1
        losses[own, y[rows][own]] -= z[own, y[rows][own]]
        if dense:
            gradient = matrix.T @ error
        else:
            order = np.argsort(at, kind="stable")
            edge = np.flatnonzero(np.diff(at[order], prepend=-1))
            gradient = np.add.reduceat((error[row] * value[:, None])[order], edge, axis=0)
        if self.regularization:
            gradient += self.regularization * w[touched]
        squares = g[touched] + gradient * gradient
        g[touched] = squares
        w[touched] -= self.learning_rate * gradient / np.sqrt(squares + FIRST_SQUARES)
        return losses.sum(0)


class BlockClassifier:
    """Weights of all classes as a table, with epochs that continue one another."""

    def __init__(self, spark: SparkSession, classes: int, num_features: int, weights: DataFrame | None = None, sent_bytes: int = SENT_BYTES):
        if classes < 2:
            raise ValueError("a classifier needs at least two classes")
        self.spark, self.classes, self.num_features, self.sent_bytes = spark, classes, num_features, sent_bytes
        self.weights = weights if weights is not None else spark.createDataFrame([], WEIGHTS)
        self._sent: tuple[np.ndarray, np.ndarray] | None = None
        self._counted = False

    @property
    def blocks(self) -> int:
        return -(-self.classes // BLOCK)

    def _pulled(self, chunks: DataFrame) -> DataFrame:
        """(chunk, unit, block, feature, w, g): the weights a chunk needs."""
        found = chunks.select("chunk", "span", "feature").mapInArrow(_chunk_features, "chunk bigint, span int, feature int")
        unit = F.expr("block div span").cast("int").alias("unit")
        return found.join(self.weights, "feature").select("chunk", unit, "block", "feature", "w", "g")

    def _dealt(self, chunks: DataFrame) -> DataFrame:
        """A chunk once for each span of blocks; what rides along with it only once."""
        last = F.floor(F.lit(self.blocks - 1) / F.col("span")).cast("int")
        dealt = chunks.withColumn("unit", F.explode(F.sequence(F.lit(0), last)))
        if "payload" in chunks.columns:
            dealt = dealt.withColumn("payload", F.when(F.col("unit") == 0, F.col("payload")))
        return dealt

    def train_epoch(self, chunks: DataFrame, epoch: int, steps: Steps) -> tuple[BlockClassifier, float]:
        """The classifier after one more pass, and the mean loss of a row during it, each row before its step."""
        passed = self._dealt(chunks).groupBy("chunk", "unit").cogroup(self._pulled(chunks).groupBy("chunk", "unit"))
        out = passed.applyInArrow(steps.trainer(self.classes, self.num_features, epoch), "block int, feature int, n bigint, w array<float>, g array<float>")
        widest = min(BLOCK, self.classes)
        mean = lambda c, k: (F.sum(F.get(c, F.lit(k)) * F.col("n")) / F.sum("n")).cast("float")
        sums = [mean(c, k).alias(f"{c}{k}") for c in ("w", "g") for k in range(widest)]
        merged = out.groupBy("block", "feature").agg(F.sum("n").alias("n"), *sums)
        # The last block may be narrower; its missing places are null.
        lists = [F.filter(F.array(*[f"{c}{k}" for k in range(widest)]), lambda v: v.isNotNull()).alias(c) for c in ("w", "g")]
        stored = materialise(merged.select("block", "feature", *lists))
        losses = stored.where("feature < 0").agg(F.sum(F.get("w", F.lit(0)))).first()[0]
        after = BlockClassifier(self.spark, self.classes, self.num_features, stored.where("feature >= 0"), self.sent_bytes)
        return after, float(losses or 0.0)

    def sent(self) -> tuple[np.ndarray, np.ndarray] | None:
        """Features and their weights (feature x class) if they are counted and found small, else None."""
        if not self._counted:
            self._counted = True
            rows = self.weights.agg(F.count(F.lit(1)), F.countDistinct("feature")).first()
            if rows[1] * self.classes * 4 <= self.sent_bytes:
                table = self.weights.select("block", "feature", "w").toArrow()
                features, at = np.unique(np.asarray(table["feature"]), return_inverse=True)
                dense = np.zeros((len(features), self.classes), np.float32)
                block = np.asarray(table["block"])
                w = table["w"].combine_chunks()
                for b in range(self.blocks if len(features) else 0):
                    own = np.flatnonzero(block == b)
                    width = _width(b, self.classes)
                    dense[at[own], b * BLOCK : b * BLOCK + width] = np.asarray(w.take(pa.array(own)).flatten()).reshape(-1, width)
                self._sent = features.astype(np.int32), dense
        return self._sent

    def score(self, rows: DataFrame) -> DataFrame:
        """(y, y_pred, p_pred, p_true, payload) of rows (words, y, payload), in one pass.

        p_true is null where y is. With small weights no row moves; else rows are packed, stored and meet the blocks.
        """
        kept = rows.select("words", F.col("y").cast("bigint").alias("y"), "payload")
        small = self.sent()
        if small is not None:
            return kept.mapInArrow(_row_scorer(*small, self.num_features), _scored(kept.schema["payload"]))
        return self.score_chunks(pack(kept, self.num_features))

    def score_chunks(self, chunks: DataFrame) -> DataFrame:
        """The same of packed rows with a payload, block by block."""
        schema = _scored(T.StructField("payload", chunks.schema["payload"].dataType.elementType))
        part = T.StructType([
            T.StructField("chunk", T.LongType()), T.StructField("best", T.ArrayType(T.LongType())),
            *[T.StructField(n, T.ArrayType(T.FloatType())) for n in ("top", "mass", "own")],
            T.StructField("y", T.ArrayType(T.LongType())), chunks.schema["payload"],
        ])
        met = self._dealt(chunks).groupBy("chunk", "unit").cogroup(self._pulled(chunks).groupBy("chunk", "unit"))
        parts = met.applyInArrow(_block_scorer(self.classes, part), part)
        return parts.groupBy("chunk").applyInArrow(_combiner, schema)


def _scored(payload: T.StructField) -> T.StructType:
    kinds = (("y", T.LongType()), ("y_pred", T.LongType()), ("p_pred", T.DoubleType()), ("p_true", T.DoubleType()))
    return T.StructType([*[T.StructField(name, kind) for name, kind in kinds], payload])


def _chunk_features(batches):
    for batch in batches:
        for chunk, span, blob in zip(batch.column("chunk").to_pylist(), batch.column("span").to_pylist(), batch.column("feature")):
            found = np.unique(np.frombuffer(blob.as_buffer(), np.int32))
            spans = pa.array(np.full(len(found), span, np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), chunk)), spans, pa.array(found)], ["chunk", "span", "feature"])


def _summary(z: np.ndarray, y: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(best class, its probability, sum of probabilities, probability of y or 0) of each row within a block."""
    p = 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -30, 30)))
    rows = np.arange(len(p))
    best = z.argmax(1)
    own = np.zeros(len(p))
    inside = np.flatnonzero((y >= first) & (y < first + p.shape[1]))
    own[inside] = p[inside, y[inside] - first]
    return best + first, p[rows, best], p.sum(1), own


def _row_scorer(features: np.ndarray, weights: np.ndarray, num_features: int):
    def run(batches):
        pieces = (batch.slice(low, high - low) for batch in batches for low, high in word_ranges(batch.column("words")))
        for batch in pieces:
            all_ = Examples.of(batch.column("words"), num_features)
            y = np.asarray(batch.column("y").fill_null(-1))
            # Scores are rows x classes numbers, so wide models take fewer rows at once.
            for low, high in all_.cut(max(1, PRODUCTS_AT_ONCE // weights.shape[1])):
                x = all_.part(low, high)
                at = np.minimum(np.searchsorted(features, x.feature), max(len(features) - 1, 0))
                place = np.where(features[at] == x.feature, at, -1) if len(features) else np.full(len(x.feature), -1)
                z = x.scores(weights if len(weights) else np.zeros((1, weights.shape[1]), np.float32), place)
                best, top, mass, own = _summary(z, y[low:high], 0)
                missing = y[low:high] < 0
                yield pa.RecordBatch.from_arrays(
                    [batch.column("y").slice(low, high - low), pa.array(best), pa.array(top / mass),
                     pa.array(own / mass, mask=missing), batch.column("payload").slice(low, high - low)],
                    ["y", "y_pred", "p_pred", "p_true", "payload"],
                )

    return run


def _block_scorer(classes: int, schema: T.StructType):
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return arrow.empty_table()
        x, y = _opened(left)
        span = left["span"][0].as_py()
        block = left["unit"][0].as_py() * span
        features, place = np.unique(x.feature, return_inverse=True)
        w = np.zeros((len(features), _width(block, classes, span)), np.float32)
        if right.num_rows:
            _filled(w, right, "w", features, block)
        # A piece at a time: scores are rows x classes numbers.
        parts = []
        for low, high in x.cut(max(1, PRODUCTS_AT_ONCE // w.shape[1])):
            some = x.part(low, high)
            z = some.scores(w, place[x.edges[low] : x.edges[high]])
            parts.append(_summary(z, y[low:high], block * BLOCK))
        best, top, mass, own = (np.concatenate(found) for found in zip(*parts))
        one = lambda a, t: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), pa.array(a.astype(t)))
        return pa.table([
            left["chunk"], one(best, np.int64), one(top, np.float32), one(mass, np.float32), one(own, np.float32), left["y"], left["payload"],
        ], schema=arrow)

    return run


def _combiner(table: pa.Table) -> pa.Table:
    """The spans of one chunk: the best class of all, smaller numbers first among equals."""
    flat = lambda name, t: np.stack([np.asarray(v.values, t) for v in table[name]])
    best, top, mass, own = flat("best", np.int64), flat("top", np.float64), flat("mass", np.float64), flat("own", np.float64)
    order = np.argsort(best[:, 0], kind="stable")
    best, top = best[order], top[order]
    first = top.argmax(0)
    rows = np.arange(best.shape[1])
    total = mass.sum(0)
    y = table["y"][0].values
    payload = next(p.values for p in table["payload"] if p.is_valid)
    return pa.table({
        "y": y, "y_pred": pa.array(best[first, rows]), "p_pred": pa.array(top[first, rows] / total),
        "p_true": pa.array(own.sum(0) / total, mask=np.asarray(y.is_null())), "payload": payload,
    })
