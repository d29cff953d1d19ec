"""Model scoring: the Arrow UDF around a scorer, its batch modes, and label mapping by join."""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

import textlens
from textlens.operators.small_tables import broadcast_if_small
from textlens.scorers import Scorer

# Texts per model call in each batch mode; None hands over whole Arrow batches.
BATCH_SIZES = {
    "dynamic": {"document": 50_000, "sentence": 20_000},
    "sequential": {"document": 100_000, "sentence": 100_000},
    "none": {"document": None, "sentence": None},
}

# Models a Python worker keeps loaded between tasks.
LOADED_MODELS = 4

# Scorers travel inside the task, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(textlens)


def batch_size(mode: str, level: str) -> int | None:
    if mode not in BATCH_SIZES:
        raise ValueError(f"unknown batch mode {mode!r}; known: {sorted(BATCH_SIZES)}")
    return BATCH_SIZES[mode][level]


def _scoring_function(scorer: Scorer, size: int | None, nested: bool):
    """Body of the UDF, self-contained so that it can be shipped to workers by value."""
    classes = len(scorer.labels)
    identity = hashlib.md5(cloudpickle.dumps(scorer)).hexdigest()

    def loaded() -> Any:
        """The model state, kept by the worker process across the tasks it runs."""
        kept = vars(sys).setdefault("_textlens_loaded", {})
        if identity not in kept:
            while len(kept) >= LOADED_MODELS:
                del kept[next(iter(kept))]
            kept[identity] = scorer.load()
        return kept[identity]

    def in_slices(state: Any, texts: pa.Array) -> np.ndarray:
        step = size or max(1, len(texts))
        order = None
        if len(texts) > step:
            # Texts of like length share a call, so that a model pads little.
            order = np.argsort(np.asarray(pc.binary_length(texts)), kind="stable")
            texts = texts.take(pa.array(order))
        parts = [scorer.logits(state, texts.slice(i, step)) for i in range(0, len(texts), step)]
        scores = np.concatenate(parts) if parts else np.zeros((0, classes))
        if scores.shape != (len(texts), classes):
            raise ValueError(f"the scorer returned {scores.shape}, not {(len(texts), classes)}")
        if order is not None:
            back = np.empty_like(scores)
            back[order] = scores
            scores = back
        return scores

    def rows(state: Any, texts: pa.Array) -> pa.Array:
        """Class scores as a list array; null texts give null lists."""
        valid = np.flatnonzero(texts.is_valid().to_numpy(zero_copy_only=False))
        scores = in_slices(state, texts.take(pa.array(valid)) if texts.null_count else texts)
        offsets = np.zeros(len(texts) + 1, dtype=np.int32)
        offsets[valid + 1] = classes
        mask = texts.is_null() if texts.null_count else None
        flat = pa.array(scores.reshape(-1).astype(np.float64))
        return pa.ListArray.from_arrays(pa.array(np.cumsum(offsets, dtype=np.int32)), flat, mask=mask)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        state = loaded()
        for batch in batches:
            if not nested:
                yield rows(state, batch)
                continue
            # One model call covers the sentences of all documents of the batch.
            lengths = batch.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            mask = batch.is_null() if batch.null_count else None
            yield pa.ListArray.from_arrays(
                pa.array(offsets), rows(state, batch.flatten()), mask=mask
            )

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return run


def model_logits(
    scorer: Scorer, texts: Column, level: str = "document", mode: str = "dynamic", call_size: int | None = None
) -> Column:
    """Logits of each text (``document``) or of each element of an array of texts (``sentence``).

    Arrays are scored in place: no explode, no regroup, no shuffle. The result does not depend on
    the batch mode, nor on ``call_size``, the largest number of texts of one model call. Spark caps an Arrow batch by ``spark.sql.execution.arrow.maxRecordsPerBatch``.
    """
    nested = level == "sentence"
    kind = "array<array<double>>" if nested else "array<double>"
    sizes = [n for n in (batch_size(mode, level), call_size) if n is not None]
    function = _scoring_function(scorer, min(sizes, default=None), nested)
    return F.arrow_udf(function, kind)(texts)


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Append a costly column that no later filter can make Spark compute a second time.

    A filter on a plain computed column is copied below it together with the computation. Here the
    value is the single row of a generator: filters on other columns still pass below it, filters
    on the value stay above. In return the value is computed even if nothing reads it.
    """
    once = df.select("*", F.inline(F.array(F.struct(value.alias("_once")))))
    return once.withColumn(name, F.col("_once")).drop("_once")


def map_labels(
    df: DataFrame, label_map: DataFrame, model: str, raw: str, out: str = "label"
) -> DataFrame:
    """Canonical label by join with a ``(model, raw_label, label)`` table.

    Labels without an entry pass through. A map of checked size is broadcast; with a larger one the
    join is shuffled, and AQE splits the partitions of frequent labels.
    """
    known = broadcast_if_small(label_map)
    entries = (label_map if known is None else known).select(
        F.col("model").alias("_model"), F.col("raw_label").alias("_raw"), F.col("label").alias("_mapped")
    )
    same = (F.lower(F.col(model)) == F.col("_model")) & (F.col(raw) == F.col("_raw"))
    joined = df.join(entries, same, "left").withColumn(out, F.coalesce("_mapped", raw))
    return joined.drop("_model", "_raw", "_mapped")
