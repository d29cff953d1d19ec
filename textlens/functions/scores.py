"""Column builders for scores: label mapping, polarity, softmax, binarizing, argmax, formatting."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F

# Raw label of each supported model and the label it stands for.
LABEL_MAP = {
    "distilbert": {},
    "bert": {
        "1 star": "NEGATIVE",
        "2 stars": "NEGATIVE",
        "3 stars": "NEUTRAL",
        "4 stars": "POSITIVE",
        "5 stars": "POSITIVE",
    },
    "roberta": {"LABEL_0": "NEGATIVE", "LABEL_1": "NEUTRAL", "LABEL_2": "POSITIVE"},
    "albert": {"LABEL_0": "NEGATIVE", "LABEL_1": "POSITIVE"},
}

# Softmax is unrolled into one expression per class up to this many classes.
UNROLLED_CLASSES = 16


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times, also inside another lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def check_model_name(model: str) -> str:
    name = model.lower()
    if name not in LABEL_MAP:
        raise ValueError(f"unknown model name: {model!r}; known: {sorted(LABEL_MAP)}")
    return name


def canonical_label(model: str, raw: Column) -> Column:
    """Raw model label to canonical label; labels the model does not map pass through."""
    mapping = LABEL_MAP[check_model_name(model)]
    result = raw
    for source, target in mapping.items():
        result = F.when(raw == source, F.lit(target)).otherwise(result)
    return result


def signed_polarity(label: Column, confidence: Column) -> Column:
    """-c for a negative label, c - 0.5 for a neutral one, c otherwise.

    Labels match by lower-case substring. A neutral label under 0.5 confidence is therefore
    negative, and one above 0.5 positive.
    """
    name = F.lower(label)
    return (
        F.when(name.contains("negative"), -confidence)
        .when(name.contains("positive"), confidence)
        .when(name.contains("neutral"), confidence - F.lit(0.5))
        .otherwise(confidence)
    )


def binarize(score: Column) -> Column:
    """-1.0, 0.0 or 1.0 by sign; NaN counts as 0.0 and null stays null."""
    return (
        F.when(score.isNull(), F.lit(None).cast("double"))
        .when(F.isnan(score), F.lit(0.0))
        .when(score > 0, F.lit(1.0))
        .when(score < 0, F.lit(-1.0))
        .otherwise(F.lit(0.0))
    )


def softmax(logits: Column, classes: int | None = None) -> Column:
    """Class probabilities; shifted by the largest logit so that large values cannot overflow.

    With a known small number of classes the expression is unrolled: generated code computes its
    common parts once. Inside a lambda, where nothing is shared, leave ``classes`` out.
    """
    if classes is not None and classes <= UNROLLED_CLASSES:
        top = F.array_max(logits)
        parts = [F.exp(F.get(logits, F.lit(i)) - top) for i in range(classes)]
        total = sum(parts[1:], parts[0])
        return F.when(logits.isNotNull(), F.array(*[part / total for part in parts]))
    exps = let(F.array_max(logits), lambda top: F.transform(logits, lambda v: F.exp(v - top)))
    return let(
        exps,
        lambda e: let(
            F.aggregate(e, F.lit(0.0), lambda acc, v: acc + v),
            lambda total: F.transform(e, lambda v: v / total),
        ),
    )


def polarity_difference(probabilities: Column, positive: int = 2, negative: int = 0) -> Column:
    """P(positive) - P(negative); the neutral class does not count."""
    return F.get(probabilities, F.lit(positive)) - F.get(probabilities, F.lit(negative))


def argmax(scores: Column) -> Column:
    """Zero-based position of the largest value; the first one wins ties."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("bigint")


def pick_label(labels: Sequence[str], class_id: Column) -> Column:
    return F.get(F.array(*[F.lit(label) for label in labels]), class_id.cast("int"))


def percent_text(share: Column) -> Column:
    """``0.85`` as ``85.0%``; null stays null."""
    return F.concat(F.round(share * 100, 2).cast("string"), F.lit("%"))
