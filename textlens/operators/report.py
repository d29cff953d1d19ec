"""Report shaping. Inputs are metric tables: one row per class, phase and epoch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from textlens.functions.scores import percent_text
from textlens.operators.metrics import class_report, ratio

# Fixed values.
SUMMARY_ROWS = ("accuracy", "macro avg", "weighted avg")
METRICS = ("f1_score", "precision", "recall", "support", "tp", "fp", "fn")
SHARES = ("f1_score", "precision", "recall")
TEST_PHASE = "test-set"
DEV_PHASE = "dev-set"

LONG_COLUMNS = (
    "phase", "epoch", "label", "label_name", "precision", "recall", "f1_score", "support", "tp", "fp", "fn",
)


def is_summary(column: str = "label_name") -> Column:
    return F.col(column).isin(*SUMMARY_ROWS)


def full_report(counts: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Class rows, accuracy, macro and weighted average of every group, with a ``row_type``.

    In summary rows the label is the row's name. Accuracy has its own row: its value stands in the
    ``accuracy`` column only, all class measures are null. Class rows and totals are two grouping
    sets of one aggregate, so the predictions behind ``counts`` are evaluated once.
    """
    report, groups = class_report(counts), list(groups)
    counted = ("support", "tp", "fp", "fn")
    occurs = F.col("tp") + F.col("fp") + F.col("fn") > 0
    level = report.groupingSets([[*groups, "class_id"], groups], *groups, "class_id").agg(
        F.grouping("class_id").alias("_total"),
        F.max("label_name").alias("label_name"),
        *[F.sum(c).alias(c) for c in counted],
        *[F.max(m).alias(m) for m in SHARES],
        *[F.avg(F.when(occurs, F.col(m))).alias(f"macro_{m}") for m in SHARES],
        *[ratio(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(f"weighted_{m}") for m in SHARES],
        ratio(F.sum("tp"), F.sum("support")).alias("accuracy"),
    )

    def row(kind: str, label: Column, name: Column, **values: Column) -> Column:
        types = dict.fromkeys(SHARES, "double") | dict.fromkeys(counted, "bigint") | {"accuracy": "double"}
        cells = [values.get(c, F.lit(None)).cast(t).alias(c) for c, t in types.items()]
        return F.struct(F.lit(kind).alias("row_type"), label.alias("label"), name.alias("label_name"), *cells)

    def average(kind: str) -> Column:
        name = F.lit(f"{kind} avg")
        shares = {m: F.col(f"{kind}_{m}") for m in SHARES}
        return row("average", name, name, support=F.col("support"), **shares)

    own = row(
        "class", F.col("class_id").cast("string"), F.col("label_name"),
        **{c: F.col(c) for c in (*SHARES, *counted)},
    )
    overall = row("accuracy", F.lit("accuracy"), F.lit("accuracy"), accuracy=F.col("accuracy"))
    summary = F.array(overall, average("macro"), average("weighted"))
    rows = F.explode(F.when(F.col("_total") == 1, summary).otherwise(F.array(own)))
    return level.select(*groups, rows.alias("_row")).select(*groups, "_row.*")


def metrics_long(report: DataFrame) -> DataFrame:
    """Long table of one row per phase, epoch and label; the accuracy entry is not a record of it."""
    return report.where(F.col("row_type") != "accuracy").select(*LONG_COLUMNS)


def latest_epoch(long: DataFrame, phase: str = TEST_PHASE) -> DataFrame:
    return long.where(F.col("phase") == phase).agg(F.max("epoch").alias("latest_epoch"))


def _pivot_name(metric: str, phase: str, epoch: int) -> str:
    return f"{metric}__{phase.replace('-', '_')}__{epoch}"


def comparative_pivot(long: DataFrame, phase_epochs: Sequence[tuple[str, int]], pretty: bool = False) -> DataFrame:
    """One row per label; columns by metric, then phase, then epoch.

    Classes come first, by F1 of the latest test epoch, then the averages. ``rank`` states the
    order. ``phase_epochs`` names the columns, so no job is needed to discover them.
    """
    ordered = sorted(phase_epochs)
    cells = [
        F.first(F.when((F.col("phase") == phase) & (F.col("epoch") == epoch), F.col(metric)), ignorenulls=True)
        .alias(_pivot_name(metric, phase, epoch))
        for metric in METRICS
        for phase, epoch in ordered
    ]
    wide = long.groupBy("label", "label_name").agg(*cells)
    tested = [epoch for phase, epoch in ordered if phase == TEST_PHASE]
    if not tested:
        raise ValueError("the pivot is ordered by test F1 and needs a test-set epoch")
    wide = add_rank(wide, _pivot_name("f1_score", TEST_PHASE, max(tested)))
    names = [_pivot_name(m, phase, epoch) for m in METRICS for phase, epoch in ordered]
    if pretty:
        shares = {n: percent_text(F.col(n)) for n in names if n.split("__")[0] in SHARES}
        wide = wide.withColumns(shares)
    return wide.select("rank", "label", "label_name", *names)


def add_rank(report: DataFrame, by: str = "f1_score") -> DataFrame:
    """Position in the report: classes by falling ``by``, then the summary rows in their own order.

    Ranks a finished report (a row per class), not its input.
    """
    measure = F.when(~is_summary(), F.col(by))
    order = Window.orderBy(is_summary(), measure.desc_nulls_last(), "label")
    return report.withColumn("rank", F.row_number().over(order).cast("bigint"))


def prediction_report(report: DataFrame) -> DataFrame:
    """Ranked report with percentages as text; numbers decide the order, formatting comes last."""
    ranked = add_rank(report)
    return ranked.select(
        "rank", "label", "label_name",
        *[percent_text(F.col(m)).alias(m) for m in ("precision", "recall", "f1_score")],
        "support", "tp", "fp", "fn", percent_text(F.col("accuracy")).alias("accuracy"),
    )


def metric_series(long: DataFrame) -> DataFrame:
    """Chart-ready points: metric, trace_name, label, label_name, phase, epoch, value."""
    points = long.unpivot(
        ["phase", "epoch", "label", "label_name"], list(SHARES), "metric", "value"
    )
    number = F.format_string("%02d", F.col("label").try_cast("bigint"))
    shown = F.when(F.col("label").rlike("^[0-9]+$"), number).otherwise(F.col("label"))
    return points.withColumn("trace_name", F.concat(shown, F.lit(" - "), F.col("label_name")))
