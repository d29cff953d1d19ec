"""The seam for models: a scorer turns a batch of texts into one row of class scores per text.

A scorer is a small description (names, paths, settings). ``load`` runs once per Python worker and
returns whatever the model needs; ``logits`` gets that state and an Arrow array of non-null texts.
Only logits cross back to the JVM; probabilities, labels and polarity are column expressions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any, Protocol

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pyspark.sql import Column, functions as F

from textlens.functions.scores import let
from textlens.functions.text import ASCII_PUNCTUATION, WHITESPACE, tokens


class Scorer(Protocol):
    labels: Sequence[str]

    def load(self) -> Any:
        """Load the model; called once per Python worker process."""

    def logits(self, state: Any, texts: pa.Array) -> np.ndarray:
        """Class scores, shape (len(texts), len(labels))."""


class MarkerScorer:
    """Share of marker words per class: a model that needs no files.

    ``column`` states the same scores as a Spark expression, so both ways can be compared.
    """

    def __init__(self, markers: Mapping[str, Sequence[str]], scale: float = 1.0):
        self.labels = tuple(markers)
        self.markers = {label: tuple(words) for label, words in markers.items()}
        self.scale = scale

    def load(self) -> list[pa.Array]:
        return [pa.array(self.markers[label], pa.string()) for label in self.labels]

    def logits(self, state: list[pa.Array], texts: pa.Array) -> np.ndarray:
        bare = pc.utf8_trim(pc.utf8_lower(texts), characters=ASCII_PUNCTUATION + WHITESPACE)
        words = pc.split_pattern_regex(bare, pattern=r"[[:punct:]]*\s+[[:punct:]]*")
        flat, owner = words.flatten(), pc.list_parent_indices(words).to_numpy()

        def per_text(chosen: pa.Array) -> np.ndarray:
            return np.bincount(owner[chosen.to_numpy(zero_copy_only=False)], minlength=len(texts))

        counts = [per_text(pc.is_in(flat, value_set=marked)) for marked in state]
        total = np.maximum(per_text(pc.not_equal(flat, "")), 1)
        return self.scale * (np.stack(counts, axis=1) / total[:, None])

    def column(self, text: Column) -> Column:
        every = sorted({word for words in self.markers.values() for word in words})

        def share(words: Column, hits: Column, label: str) -> Column:
            own = F.filter(hits, lambda word: word.isin(*self.markers[label]))
            return F.size(own) / F.greatest(F.size(words), F.lit(1)) * F.lit(float(self.scale))

        def shares(words: Column) -> Column:
            marked = F.filter(words, lambda word: word.isin(*every))
            return let(marked, lambda hits: F.array(*[share(words, hits, x) for x in self.labels]))

        return F.when(text.isNotNull(), let(tokens(text), shares))


class OnnxScorer:
    """A classifier exported to ONNX with a ``tokenizers`` JSON file beside it.

    Both paths must be readable on every executor (a shared mount, or files shipped with the job).
    ``max_length`` and ``batch_size`` bound one forward pass, not the text handed in.
    """

    def __init__(
        self,
        model_path: str,
        tokenizer_path: str,
        labels: Sequence[str],
        max_length: int = 512,
        batch_size: int = 128,
        device: str | None = None,
    ):
        if batch_size <= 0 or max_length <= 0:
            raise ValueError("batch_size and max_length must be positive")
        self.model_path, self.tokenizer_path = model_path, tokenizer_path
        self.labels = tuple(labels)
        self.max_length, self.batch_size, self.device = max_length, batch_size, device

    def load(self):
        import onnxruntime
        from tokenizers import Tokenizer

        options = onnxruntime.SessionOptions()
        options.intra_op_num_threads = 1  # Spark already runs one task per core
        providers = [
            name for name in ("CUDAExecutionProvider", "CPUExecutionProvider")
            if name in onnxruntime.get_available_providers()
            and not (self.device == "cpu" and name.startswith("CUDA"))
        ]
        session = onnxruntime.InferenceSession(self.model_path, options, providers=providers)
        tokenizer = Tokenizer.from_file(self.tokenizer_path)
        tokenizer.enable_truncation(self.max_length)
        tokenizer.enable_padding()
        return session, tokenizer

    def logits(self, state, texts: pa.Array) -> np.ndarray:
        session, tokenizer = state
        wanted = {item.name for item in session.get_inputs()}
        pieces = []
        for start in range(0, len(texts), self.batch_size):
            encoded = tokenizer.encode_batch(texts.slice(start, self.batch_size).to_pylist())
            feed = {
                "input_ids": np.array([e.ids for e in encoded], dtype=np.int64),
                "attention_mask": np.array([e.attention_mask for e in encoded], dtype=np.int64),
                "token_type_ids": np.array([e.type_ids for e in encoded], dtype=np.int64),
            }
            feed = {name: value for name, value in feed.items() if name in wanted}
            pieces.append(np.asarray(session.run(None, feed)[0], dtype=np.float64))
        return np.concatenate(pieces)
