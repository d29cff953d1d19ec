"""Classification metrics as aggregates.

Input is one row per example with a true and a predicted class id. The first step is always the
confusion matrix, aggregated with map-side combine: whatever the size of the input or of its
largest class, what moves afterwards is at most one row per pair of classes that occurs. All
further steps work on that small table. ``groups`` (such as phase and epoch) evaluate several
prediction sets in the same pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from textlens.operators.labels import LabelIndex

MIN_PROBABILITY = 1e-15


def ratio(numerator: Column, denominator: Column) -> Column:
    """Zero where the denominator is zero."""
    return F.when(denominator == 0, F.lit(0.0)).otherwise(numerator / denominator)


def confusion_cells(
    pred: DataFrame, truth: str = "y_true", predicted: str = "y_pred", groups: Sequence[str] = ()
) -> DataFrame:
    """Confusion matrix, cells that occur: groups, y_true, y_pred, n. Rows without a truth do not count."""
    pred = pred.where(F.col(truth).isNotNull())
    keys = [F.col(truth).cast("bigint").alias("y_true"), F.col(predicted).cast("bigint").alias("y_pred")]
    return pred.groupBy(*groups, *keys).agg(F.count("*").alias("n"))


def confusion_matrix(cells: DataFrame, classes: int) -> DataFrame:
    """Every pair of classes, zeros included: y_true, y_pred, n.

    Zero cells are added up with the real ones rather than joined to them: a join would make the
    optimizer filter on the predicted class, and so work out every prediction twice.
    """
    zeros = cells.sparkSession.range(classes * classes).select(
        F.expr(f"id div {classes}").alias("y_true"),
        (F.col("id") % classes).alias("y_pred"),
        F.lit(0).cast("bigint").alias("n"),
    )
    both = cells.select("y_true", "y_pred", "n").unionByName(zeros)
    return both.groupBy("y_true", "y_pred").agg(F.sum("n").alias("n"))


def class_counts(
    cells: DataFrame,
    index: LabelIndex,
    groups: Sequence[str] = (),
    group_values: Sequence[Sequence[Any]] | None = None,
) -> DataFrame:
    """TP, FP, FN and support per class: groups, class_id, label_name, support, tp, fp, fn.

    Each cell adds to its true class and to its predicted class; the label table adds zeros, so
    that classes absent from truth and prediction are reported, and brings the names along. With
    ``groups``, ``group_values`` lists the groups to report.
    """
    zero = F.lit(0).cast("bigint")
    right = F.col("y_true") == F.col("y_pred")
    as_truth = F.struct(
        F.col("y_true").alias("class_id"),
        F.col("n").alias("support"),
        F.when(right, F.col("n")).otherwise(zero).alias("tp"),
        zero.alias("fp"),
        F.when(right, zero).otherwise(F.col("n")).alias("fn"),
    )
    as_prediction = F.struct(
        F.col("y_pred").alias("class_id"), zero.alias("support"), zero.alias("tp"),
        F.when(right, zero).otherwise(F.col("n")).alias("fp"), zero.alias("fn"),
    )
    shares = cells.select(*groups, F.explode(F.array(as_truth, as_prediction)).alias("_part"))
    shares = shares.select(*groups, "_part.*", F.lit(None).cast("string").alias("label_name"))

    listed = index.table.select(
        "class_id", *[zero.alias(name) for name in ("support", "tp", "fp", "fn")],
        F.col("label").alias("label_name"),
    )
    if groups:
        if group_values is None:
            raise ValueError("group_values must list the groups to report")
        types = {name: cells.schema[name].dataType for name in groups}
        wanted = F.array(*[
            F.struct(*[F.lit(value).cast(types[name]).alias(name) for name, value in zip(groups, values)])
            for values in group_values
        ])
        listed = listed.withColumn("_group", F.explode(wanted)).select("_group.*", *listed.columns)
    sums = [F.sum(name).alias(name) for name in ("support", "tp", "fp", "fn")]
    counted = shares.unionByName(listed).groupBy(*groups, "class_id").agg(
        *sums, F.max("label_name").alias("label_name")
    )
    name = F.coalesce("label_name", F.col("class_id").cast("string"))
    return counted.withColumn("label_name", name)


def class_report(counts: DataFrame) -> DataFrame:
    """Append precision, recall and F1; a zero denominator gives 0.0."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.withColumns({
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, tp + fn),
        "f1_score": ratio(2 * tp, 2 * tp + fp + fn),
    })


def report_averages(report: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Macro and support-weighted averages: groups, label_name, precision, recall, f1_score, support.

    The macro average runs over the classes that occur in truth or prediction.
    """
    measures = ("precision", "recall", "f1_score")
    occurs = F.col("tp") + F.col("fp") + F.col("fn") > 0
    macro = [F.avg(F.when(occurs, F.col(m))).alias(f"macro_{m}") for m in measures]
    weighted = [
        ratio(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(f"weighted_{m}") for m in measures
    ]
    wide = report.groupBy(*groups).agg(*macro, *weighted, F.sum("support").alias("support"))
    both = F.array(*[
        F.struct(F.lit(f"{kind} avg").alias("label_name"), *[F.col(f"{kind}_{m}").alias(m) for m in measures])
        for kind in ("macro", "weighted")
    ])
    return wide.select(*groups, F.explode(both).alias("_row"), "support").select(*groups, "_row.*", "support")


def accuracy(cells: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Share of correct predictions, from the confusion cells."""
    right = F.sum(F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(0))
    total = F.sum("n")
    return cells.groupBy(*groups).agg(ratio(right, total).alias("accuracy"), total.alias("support"))


def cross_entropy(true_probability: Column) -> Column:
    return -F.log(F.greatest(true_probability, F.lit(MIN_PROBABILITY)))


def log_loss(
    pred: DataFrame, truth: str = "y_true", probabilities: str = "probs", groups: Sequence[str] = ()
) -> DataFrame:
    """Mean cross-entropy over rows with a truth, every row with the same weight."""
    pred = pred.where(F.col(truth).isNotNull())
    chosen = F.get(F.col(probabilities), F.col(truth).cast("int"))
    return pred.groupBy(*groups).agg(F.avg(cross_entropy(chosen)).alias("log_loss"))


def evaluate(
    pred: DataFrame,
    truth: str = "y_true",
    predicted: str = "y_pred",
    probabilities: str = "probs",
    groups: Sequence[str] = (),
    true_probability: str | None = None,
) -> DataFrame:
    """Confusion cells with the summed cross-entropy: everything an evaluation needs in one pass.

    Rows without a truth do not count. ``true_probability`` names a column that holds the probability of the true
    class, for predictions that do not carry those of all classes.
    """
    pred = pred.where(F.col(truth).isNotNull())
    chosen = F.get(F.col(probabilities), F.col(truth).cast("int")) if true_probability is None else F.col(true_probability)
    keys = [F.col(truth).cast("bigint").alias("y_true"), F.col(predicted).cast("bigint").alias("y_pred")]
    return pred.groupBy(*groups, *keys).agg(
        F.count("*").alias("n"), F.sum(cross_entropy(chosen)).alias("loss")
    )


def evaluation_summary(cells: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Mean loss and accuracy from the cells of ``evaluate``."""
    right = F.sum(F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(0))
    return cells.groupBy(*groups).agg(
        (F.sum("loss") / F.sum("n")).alias("avg_val_loss"),
        ratio(right, F.sum("n")).alias("accuracy"),
        F.sum("n").alias("support"),
    )
