"""Label encoding, splitting, training, prediction, metrics and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from textlens import TextClassifier
from textlens.functions import text as X
from textlens.operators import metrics as M
from textlens.operators import report as R
from textlens.operators.labels import class_count, fit_label_index
from textlens.operators.sentences import spread
from textlens.operators.split import stratified_split as split
from workload.common import (
    PHASE_EPOCHS, SQL_DIM, SQL_EPOCH_GRID, SQL_EPOCH_PRED, SQL_GROUPS, SQL_PRED, SQL_SPLIT, DIGITS,
    documents, epoch_predictions, language_index, language_predictions, rounded, sql_averages,
    sql_report, table,
)

GROUPS = ["phase", "epoch"]
SHARES = ("precision", "recall", "f1_score")
NUM_FEATURES = 1 << 18


def _parts(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    return p.select("p_partkey", X.composite_label("p_brand", "p_type", "p_size").alias("label"))


def label_encode(spark: SparkSession, sf: str) -> DataFrame:
    parts = _parts(spark, sf)
    return fit_label_index(parts, "label").encode(parts, "label", "class_id")


def label_decode(spark: SparkSession, sf: str) -> DataFrame:
    """Predicted language ids as text, with the Spanish ones replaced by a name that is no id."""
    pred = language_predictions(spark, sf)
    ids = F.when(F.col("y_pred") == 2, "macro avg").when(F.col("y_pred") == 3, "17")
    rows = pred.select("doc_id", ids.otherwise(F.col("y_pred").cast("string")).alias("label"))
    return language_index(spark).decode(rows, "label", "label_name")


def num_classes(spark: SparkSession, sf: str) -> DataFrame:
    return class_count(_parts(spark, sf), "label")


def stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    return split(docs, "doc_id", "lang")


def _cells(spark: SparkSession, sf: str) -> DataFrame:
    return M.confusion_cells(language_predictions(spark, sf))


def confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return M.confusion_matrix(_cells(spark, sf), len(language_index(spark).labels))


def confusion_cells(spark: SparkSession, sf: str) -> DataFrame:
    """The matrix as it is kept: cells that occur."""
    return _cells(spark, sf)


def _counts(spark: SparkSession, sf: str) -> DataFrame:
    return M.class_counts(_cells(spark, sf), language_index(spark))


def tp_fp_fn(spark: SparkSession, sf: str) -> DataFrame:
    return _counts(spark, sf).select("class_id", "tp", "fp", "fn")


def class_report(spark: SparkSession, sf: str) -> DataFrame:
    report = M.class_report(_counts(spark, sf))
    return report.select("class_id", "label_name", "support", *[rounded(m).alias(m) for m in SHARES])


def accuracy(spark: SparkSession, sf: str) -> DataFrame:
    return M.accuracy(_cells(spark, sf)).select(rounded("accuracy").alias("accuracy"), "support")


def report_averages(spark: SparkSession, sf: str) -> DataFrame:
    averages = M.report_averages(M.class_report(_counts(spark, sf)))
    return averages.select("label_name", *[rounded(m).alias(m) for m in SHARES], "support")


def log_loss(spark: SparkSession, sf: str) -> DataFrame:
    return M.log_loss(language_predictions(spark, sf)).select(rounded("log_loss").alias("log_loss"))


def evaluate(spark: SparkSession, sf: str) -> DataFrame:
    summary = M.evaluation_summary(M.evaluate(language_predictions(spark, sf)))
    return summary.select(
        rounded("avg_val_loss").alias("avg_val_loss"), rounded("accuracy").alias("accuracy"), "support"
    )


def _full_report(spark: SparkSession, sf: str) -> DataFrame:
    return R.full_report(_counts(spark, sf))


def report_split_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Class rows and summary rows told apart by membership."""
    report = _full_report(spark, sf)
    summary = report.where(R.is_summary()).select("label", F.lit(True).alias("is_summary"), "support")
    classes = report.where(~R.is_summary()).select("label", F.lit(False).alias("is_summary"), "support")
    return classes.unionByName(summary)


def report_pretty(spark: SparkSession, sf: str) -> DataFrame:
    return R.prediction_report(_full_report(spark, sf))


def report_ranked(spark: SparkSession, sf: str) -> DataFrame:
    ranked = R.add_rank(_full_report(spark, sf))
    return ranked.select("rank", "label", "label_name", rounded("f1_score").alias("f1_score"))


def _long(spark: SparkSession, sf: str) -> DataFrame:
    cells = M.confusion_cells(epoch_predictions(spark, sf), groups=GROUPS)
    counts = M.class_counts(cells, language_index(spark), GROUPS, PHASE_EPOCHS)
    return R.metrics_long(R.full_report(counts, GROUPS))


def metrics_long(spark: SparkSession, sf: str) -> DataFrame:
    return _long(spark, sf).withColumns({m: rounded(m) for m in SHARES})


def comparative_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return R.comparative_pivot(_long(spark, sf), PHASE_EPOCHS, pretty=True)


def latest_epoch(spark: SparkSession, sf: str) -> DataFrame:
    return R.latest_epoch(_long(spark, sf))


def metric_series(spark: SparkSession, sf: str) -> DataFrame:
    return R.metric_series(_long(spark, sf)).withColumn("value", rounded("value"))


def _train(spark: SparkSession, sf: str, epochs: int, **options):
    docs = documents(spark, sf, "lang")
    trained = TextClassifier(spark)
    result = trained.train_and_evaluate(
        docs, ["text"], "lang", "doc_id", epochs=epochs, num_features=NUM_FEATURES, **options
    )
    return docs, trained, result


def train_classifier(spark: SparkSession, sf: str) -> DataFrame:
    """Rows evaluated per phase, and whether the model beats guessing the largest class there."""
    _, _, result = _train(spark, sf, epochs=2, save=False)
    classes = result.metrics.where("tp IS NOT NULL").groupBy("phase", "epoch")
    share = classes.agg((F.max("support") / F.sum("support")).alias("share"))
    return result.summary.join(share, ["phase", "epoch"]).select(
        "phase", "epoch", "support", (F.col("accuracy") > F.col("share")).alias("beats_majority")
    )


def epoch_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of each class per phase and epoch, found or missed; what is predicted in all; and whether some were found."""
    _, _, result = _train(spark, sf, epochs=3, save=False)
    classes = result.metrics.where("tp IS NOT NULL")
    made = classes.groupBy("phase", "epoch").agg(F.sum(F.col("tp") + F.col("fp")).alias("predictions"))
    return classes.join(made, ["phase", "epoch"]).select(
        "phase", "epoch", "label_name", "support", (F.col("tp") + F.col("fn")).alias("found_or_missed"), "predictions",
        (F.col("tp") > 0).alias("some_found"),
    )


def epoch_losses(spark: SparkSession, sf: str) -> DataFrame:
    """Training loss per epoch, against the epoch before and against guessing by class shares."""
    docs, _, result = _train(spark, sf, epochs=3, save=False)
    share = docs.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).select((F.col("n") / F.sum("n").over(Window.partitionBy())).alias("p"))
    guess = share.agg(F.sum(-F.col("p") * F.log("p") - (1 - F.col("p")) * F.log(1 - F.col("p"))).alias("guess"))
    before = result.losses.select((F.col("epoch") + 1).alias("epoch"), F.col("avg_train_loss").alias("before"))
    return result.losses.join(before, "epoch", "left").crossJoin(guess).select(  # one row a side
        "epoch", (F.col("avg_train_loss") < F.coalesce("before", "guess")).alias("falls"),
        (F.col("avg_train_loss") < F.col("guess")).alias("below_guess"),
    )


def predict_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions that are labels, and whether nine in ten of all are right."""
    docs, trained, _ = _train(spark, sf, epochs=3, save=False)
    predicted, _ = trained.predict(docs, ["text"], use_checkpoint=False)
    right = predicted.agg((F.avg((F.col("Predicted") == F.col("lang")).cast("int")) >= 0.9).alias("nine_in_ten_right"))
    known = F.col("Predicted").isin(*language_index(spark).labels)
    return predicted.select("doc_id", "lang", known.alias("known_label")).crossJoin(F.broadcast(right))  # one row


def predict_report(spark: SparkSession, sf: str) -> DataFrame:
    """Support of each class, found or missed; what is predicted in all; and whether F1 passes 80 percent."""
    docs, trained, _ = _train(spark, sf, epochs=3, save=False)
    report = trained.predict(docs, ["text"], "lang", use_checkpoint=False)[1].where("tp IS NOT NULL")
    made = report.agg(F.sum(F.col("tp") + F.col("fp")).alias("predictions"))
    return report.crossJoin(F.broadcast(made)).select(  # one row
        "label_name", "support", (F.col("tp") + F.col("fn")).alias("found_or_missed"), "predictions",
        (F.regexp_replace("f1_score", "%", "").cast("double") > 80).alias("passes"),
    )


def train_products(spark: SparkSession, sf: str) -> DataFrame:
    """A class for each brand, type and size: loss per epoch, and whether predictions are of the product's own type."""
    parts = spread(table(spark, sf, "part"), ["p_partkey"])
    parts = parts.withColumn("label", X.composite_label("p_brand", "p_type", "p_size"))
    trained = TextClassifier(spark)
    columns = ["p_brand", "p_type", "p_size"]
    result = trained.train_and_evaluate(
        parts, columns, "label", "p_partkey", epochs=4, num_features=NUM_FEATURES, save=False, batch_size=16, learning_rate=1.0
    )
    predicted, _ = trained.predict(parts, columns, use_checkpoint=False)
    own = F.element_at(F.split("Predicted", r"\|\|\|"), 2) == F.col("p_type")
    checked = predicted.agg(
        (F.avg(own.cast("int")) >= 0.9).alias("own_type"),
        (F.avg((F.col("label") == F.col("Predicted")).cast("int")) > 0.05).alias("far_above_guess"),
    )
    before = result.losses.select((F.col("epoch") + 1).alias("epoch"), F.col("avg_train_loss").alias("before"))
    return result.losses.join(before, "epoch", "left").crossJoin(checked).select(  # one row a side
        "epoch", F.lit(trained.index.size()).cast("bigint").alias("classes"),
        F.coalesce(F.col("avg_train_loss") < F.col("before"), F.lit(True)).alias("falls"), "own_type", "far_above_guess",
    )


def model_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions of a model and of its saved and reloaded copy."""
    docs, trained, _ = _train(spark, sf, epochs=1)
    before, _ = trained.predict(docs, ["text"], use_checkpoint=False)
    copy = TextClassifier(spark).load(trained.model_path)
    both, _ = copy.predict(before.withColumnRenamed("Predicted", "before"), ["text"], use_checkpoint=False)
    return both.select("doc_id", (F.col("before") == F.col("Predicted")).alias("same"))


_LABELS = "p_brand || '|||' || p_type || '|||' || p_size"
_PARTS = f"parts AS (SELECT p_partkey, {_LABELS} AS label FROM part)"
_ROUND = ", ".join(f"round({m}, {DIGITS}) AS {m}" for m in SHARES)
_REPORT = f"{SQL_PRED}, {sql_report([], 'VALUES (0)')}, {sql_averages([])}"
_FULL = f"""{_REPORT}, acc AS (SELECT avg(CASE WHEN y_true = y_pred THEN 1.0::DOUBLE ELSE 0 END) AS accuracy FROM pred),
    full_rep AS (
        SELECT class_id::VARCHAR AS label, label_name, precision, recall, f1_score, support, tp, fp, fn,
            NULL::DOUBLE AS accuracy, 0 AS s FROM rep
        UNION ALL SELECT label_name, label_name, precision, recall, f1_score, support, NULL, NULL, NULL, NULL, 1 FROM av
        UNION ALL SELECT 'accuracy', 'accuracy', NULL, NULL, NULL, NULL, NULL, NULL, NULL, accuracy, 1 FROM acc),
    ranked_rep AS (SELECT row_number() OVER (ORDER BY s, CASE WHEN s = 0 THEN f1_score END DESC NULLS LAST, label)::BIGINT AS rank, *
        FROM full_rep)"""


def _pct(c: str) -> str:
    return f"round({c} * 100, 2)::VARCHAR || '%'"


_LONG = f"""{SQL_EPOCH_PRED}, {sql_report(SQL_GROUPS, SQL_EPOCH_GRID)}, {sql_averages(SQL_GROUPS)},
    long_rep AS (
        SELECT phase, epoch, class_id::VARCHAR AS label, label_name, precision, recall, f1_score, support, tp, fp, fn FROM rep
        UNION ALL SELECT phase, epoch, label_name, label_name, precision, recall, f1_score, support, NULL, NULL, NULL FROM av)"""
_PIVOT = ", ".join(
    "{0} AS {1}__{2}__{3}".format(
        _pct(f"max(CASE WHEN phase = '{p}' AND epoch = {e} THEN {m} END)") if m in SHARES
        else f"max(CASE WHEN phase = '{p}' AND epoch = {e} THEN {m} END)",
        m, p.replace("-", "_"), e,
    )
    for m in R.METRICS for p, e in PHASE_EPOCHS
)

def _sql_phases(epochs: int) -> str:
    """CTE ``phases``(phase, epoch, split) of a training with so many epochs."""
    rows = [f"('dev-set', {k}::BIGINT, 'validation')" for k in range(1, epochs + 1)]
    rows.append(f"('test-set', {epochs + 1}::BIGINT, 'test')")
    return f"phases AS (SELECT * FROM (VALUES {', '.join(rows)}) AS v(phase, epoch, split))"


_TRAINED = f"""WITH {SQL_SPLIT}, {_sql_phases(2)}
    SELECT phase, epoch, count(*)::BIGINT AS support, true AS beats_majority FROM phases JOIN parts USING (split) GROUP BY phase, epoch"""
_EPOCHS = f"""WITH {SQL_SPLIT}, {_sql_phases(3)}
    SELECT phase, epoch, lang AS label_name, count(*)::BIGINT AS support, count(*)::BIGINT AS found_or_missed,
        (sum(count(*)) OVER (PARTITION BY phase, epoch))::BIGINT AS predictions, true AS some_found
    FROM phases JOIN parts USING (split) GROUP BY phase, epoch, lang"""

QUERIES = {
    "label_encode": (
        label_encode,
        f"WITH {_PARTS} SELECT p_partkey, label, (dense_rank() OVER (ORDER BY label) - 1)::BIGINT AS class_id FROM parts",
    ),
    "label_decode": (
        label_decode,
        f"""WITH {SQL_PRED}, r AS (SELECT doc_id, CASE y_pred WHEN 2 THEN 'macro avg' WHEN 3 THEN '17'
            ELSE y_pred::VARCHAR END AS label FROM pred)
            SELECT doc_id, label, CASE label WHEN '0' THEN 'de' WHEN '1' THEN 'en' ELSE label END AS label_name FROM r""",
    ),
    "num_classes": (num_classes, f"WITH {_PARTS} SELECT count(DISTINCT label)::BIGINT AS num_classes FROM parts"),
    "stratified_split": (stratified_split, f"WITH {SQL_SPLIT} SELECT doc_id, lang, split FROM parts"),
    "confusion_matrix": (
        confusion_matrix,
        f"""WITH {SQL_PRED}, {SQL_DIM} SELECT a.class_id AS y_true, b.class_id AS y_pred,
            (SELECT count(*) FROM pred WHERE y_true = a.class_id AND y_pred = b.class_id)::BIGINT AS n
            FROM dim a, dim b""",
    ),
    "confusion_cells": (confusion_cells, f"WITH {SQL_PRED} SELECT y_true, y_pred, count(*)::BIGINT AS n FROM pred GROUP BY ALL"),
    "tp_fp_fn": (tp_fp_fn, f"WITH {_REPORT} SELECT class_id, tp, fp, fn FROM rep"),
    "class_report": (class_report, f"WITH {_REPORT} SELECT class_id, label_name, support, {_ROUND} FROM rep"),
    "accuracy": (
        accuracy,
        f"""WITH {SQL_PRED} SELECT round(avg(CASE WHEN y_true = y_pred THEN 1.0::DOUBLE ELSE 0 END), 6) AS accuracy,
            count(*)::BIGINT AS support FROM pred""",
    ),
    "report_averages": (report_averages, f"WITH {_REPORT} SELECT label_name, {_ROUND}, support FROM av"),
    "log_loss": (
        log_loss,
        f"""WITH {SQL_PRED} SELECT round(avg(-ln(greatest([p0, p1, p2, p3][y_true + 1], 1e-15))), 6) AS log_loss
            FROM pred""",
    ),
    "evaluate": (
        evaluate,
        f"""WITH {SQL_PRED} SELECT round(avg(-ln(greatest([p0, p1, p2, p3][y_true + 1], 1e-15))), 6) AS avg_val_loss,
            round(avg(CASE WHEN y_true = y_pred THEN 1.0::DOUBLE ELSE 0 END), 6) AS accuracy,
            count(*)::BIGINT AS support FROM pred""",
    ),
    "report_split_rows": (
        report_split_rows, f"WITH {_FULL} SELECT label, s = 1 AS is_summary, support FROM full_rep",
    ),
    "report_pretty": (
        report_pretty,
        f"""WITH {_FULL} SELECT rank, label, label_name, {', '.join(f'{_pct(m)} AS {m}' for m in SHARES)},
            support, tp, fp, fn, {_pct('accuracy')} AS accuracy FROM ranked_rep""",
    ),
    "report_ranked": (
        report_ranked, f"WITH {_FULL} SELECT rank, label, label_name, round(f1_score, 6) AS f1_score FROM ranked_rep",
    ),
    "metrics_long": (
        metrics_long, f"WITH {_LONG} SELECT phase, epoch, label, label_name, {_ROUND}, support, tp, fp, fn FROM long_rep",
    ),
    "comparative_pivot": (
        comparative_pivot,
        f"""WITH {_LONG}, wide AS (SELECT label, label_name, {_PIVOT},
            max(CASE WHEN phase = 'test-set' THEN f1_score END) AS by_f1 FROM long_rep GROUP BY label, label_name)
            SELECT * EXCLUDE (by_f1), row_number() OVER (ORDER BY label_name LIKE '% avg',
            CASE WHEN label_name NOT LIKE '% avg' THEN by_f1 END DESC NULLS LAST, label)
            ::BIGINT AS rank FROM wide""",
    ),
    "latest_epoch": (
        latest_epoch, f"WITH {_LONG} SELECT max(epoch) AS latest_epoch FROM long_rep WHERE phase = 'test-set'",
    ),
    "metric_series": (
        metric_series,
        f"""WITH {_LONG}, u AS (
            SELECT 'f1_score' AS metric, f1_score AS value, * FROM long_rep UNION ALL
            SELECT 'precision', precision, * FROM long_rep UNION ALL SELECT 'recall', recall, * FROM long_rep)
            SELECT phase, epoch, label, label_name, metric, round(value, 6) AS value,
            CASE WHEN regexp_full_match(label, '[0-9]+') THEN format('{{:02d}}', label::BIGINT) ELSE label END
            || ' - ' || label_name AS trace_name FROM u""",
    ),
    "train_classifier": (train_classifier, _TRAINED),
    "epoch_metrics": (epoch_metrics, _EPOCHS),
    "epoch_losses": (epoch_losses, "SELECT range AS epoch, true AS falls, true AS below_guess FROM range(1, 4)"),
    "predict_labels": (predict_labels, "SELECT doc_id, lang, true AS known_label, true AS nine_in_ten_right FROM documents"),
    "predict_report": (
        predict_report,
        """SELECT lang AS label_name, count(*)::BIGINT AS support, count(*)::BIGINT AS found_or_missed,
            (sum(count(*)) OVER ())::BIGINT AS predictions, true AS passes FROM documents GROUP BY lang""",
    ),
    "train_products": (
        train_products,
        f"""WITH {_PARTS} SELECT range AS epoch, (SELECT count(DISTINCT label) FROM parts)::BIGINT AS classes, true AS falls,
            true AS own_type, true AS far_above_guess FROM range(1, 5)""",
    ),
    "model_roundtrip": (model_roundtrip, "SELECT doc_id, true AS same FROM documents"),
}
