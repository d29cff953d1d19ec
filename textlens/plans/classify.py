"""Multi-class text classification: hashed words, a linear model in blocks of classes, split, evaluation, prediction."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from textlens.functions import text as X
from textlens.operators import metrics as M
from textlens.operators import report as R
from textlens.operators.block_classifier import BlockClassifier, Steps, hashed_words, pack
from textlens.operators.labels import LabelIndex, fit_label_index
from textlens.operators.split import HOLDOUT, SEED, fit_split
from textlens.session import shared_path
from textlens.sources.sinks import materialise, write_table

INPUT_COLUMN = "input_text"
PREDICTED_COLUMN = "Predicted"
NUM_FEATURES = 1 << 18


@dataclass
class TrainingResult:
    """``losses`` has a row per epoch (epoch, avg_train_loss); ``training_loss`` the same as a list."""

    metrics: DataFrame
    pivot: DataFrame
    summary: DataFrame
    training_loss: list[float]
    losses: DataFrame


def with_input_text(df: DataFrame, input_columns: Sequence[str]) -> DataFrame:
    return df.withColumn(INPUT_COLUMN, X.input_text(*input_columns))


class TextClassifier:
    """Train, evaluate, save, load, predict. Any number of classes; an epoch is one pass that continues the last one."""

    def __init__(self, spark: SparkSession, model_path: str | None = None, category: str = "product_type"):
        self.spark = spark
        self.model_path = f"{(model_path or shared_path(spark, 'model')).rstrip('/')}/{category}"
        self.model: BlockClassifier | None = None
        self.index: LabelIndex | None = None

    def train_and_evaluate(
        self,
        df: DataFrame,
        input_columns: Sequence[str],
        label_column: str,
        key_column: str | None = None,
        epochs: int = 3,
        num_features: int = NUM_FEATURES,
        regularization: float = 0.0,
        holdout: float = HOLDOUT,
        seed: int = SEED,
        select_best: str | None = None,
        save: bool = True,
        batch_size: int = 64,
        learning_rate: float = 0.5,
    ) -> TrainingResult:
        """Split 81/9/10, train epoch by epoch, evaluate each on validation and the last on test.

        Without a ``key_column`` rows are told apart by their content, so that equal rows fall on
        the same side of the split.
        ``select_best`` (``f1_score``, ``accuracy``, ``avg_val_loss``) keeps the best epoch on
        validation instead of the last one.
        """
        if epochs <= 0 or batch_size <= 0 or learning_rate <= 0:
            raise ValueError("epochs, batch_size and learning_rate must be positive")
        if select_best not in (None, "f1_score", "accuracy", "avg_val_loss"):
            raise ValueError(f"cannot select the best epoch by {select_best!r}")
        index = fit_label_index(df, label_column)
        model = BlockClassifier(self.spark, index.size(), num_features)

        source = with_input_text(df, input_columns).where(F.col(label_column).isNotNull())
        key = F.xxhash64(label_column, INPUT_COLUMN) if key_column is None else F.col(key_column)
        source = source.select(key.alias("_key"), label_column, INPUT_COLUMN)
        cuts = fit_split(source, "_key", label_column, holdout, seed)
        rows = cuts.assign(index.encode(source, label_column, "y"))
        # Words are read once per epoch, and by whatever replaces a lost executor: stored, columnar.
        ready = materialise(rows.select("split", "y", hashed_words(F.col(INPUT_COLUMN), num_features).alias("words")))
        # Dealt out evenly, so that no chunk holds one class only because the input is sorted; in an order that a shuffle does not change.
        train = ready.where("split = 'train'").select("words", "y").hint("rebalance")
        chunks = pack(train.sortWithinPartitions(F.xxhash64("words", "y")), num_features)
        held_out = ready.where("split <> 'train'").select("words", "y", F.struct("split").alias("payload"))
        packed = None
        steps = Steps(batch_size, learning_rate, regularization, seed)
        models, losses, cells = [], [], []
        for epoch in range(1, epochs + 1):
            model, loss = model.train_epoch(chunks, epoch, steps)
            models.append(model)
            losses.append(loss)
            if model.sent() is not None:
                # Test rows are scored by the last epoch only.
                scored = model.score(held_out if epoch == epochs else held_out.where("payload.split = 'validation'"))
            else:
                packed = pack(held_out, num_features) if packed is None else packed
                scored = model.score_chunks(packed)
            wanted = scored.where("payload.split = 'validation'") if epoch < epochs else scored
            cells.append(self._evaluated(wanted, epoch, epochs))
        evaluated = cells[0]
        for more in cells[1:]:
            evaluated = evaluated.unionByName(more)
        # A few rows per epoch: stored, so that reports do not evaluate again.
        evaluated = materialise(evaluated)

        phase_epochs = [(R.DEV_PHASE, e) for e in range(1, epochs + 1)] + [(R.TEST_PHASE, epochs + 1)]
        groups = ["phase", "epoch"]
        counts = M.class_counts(evaluated, index, groups, phase_epochs)
        report = R.full_report(counts, groups)
        summary = M.evaluation_summary(evaluated, groups)
        long = R.metrics_long(report)

        self.index, self.model = index, models[self._best_epoch(summary, long, select_best, epochs) - 1]
        if save:
            self.save()
        table = self.spark.createDataFrame(list(enumerate(losses, 1)), "epoch bigint, avg_train_loss double")
        return TrainingResult(long, R.comparative_pivot(long, phase_epochs, pretty=True), summary, losses, table)

    @staticmethod
    def _evaluated(scored: DataFrame, epoch: int, epochs: int) -> DataFrame:
        test = F.col("payload.split") == "test"
        rows = scored.select(
            F.when(test, R.TEST_PHASE).otherwise(R.DEV_PHASE).alias("phase"),
            F.when(test, epochs + 1).otherwise(epoch).cast("bigint").alias("epoch"),
            F.col("y").alias("y_true"), "y_pred", "p_true",
        )
        return M.evaluate(rows, groups=["phase", "epoch"], true_probability="p_true")

    @staticmethod
    def _best_epoch(summary: DataFrame, long: DataFrame, select_best: str | None, epochs: int) -> int:
        if select_best is None:
            return epochs
        table = long.where("label = 'macro avg'") if select_best == "f1_score" else summary
        measure = -F.col(select_best) if select_best == "avg_val_loss" else F.col(select_best)
        dev = table.where(F.col("phase") == R.DEV_PHASE)
        return dev.orderBy(measure.desc(), "epoch").first()["epoch"]

    def save(self, path: str | None = None) -> str:
        """Write weights, their sizes and the label list."""
        if self.model is None:
            raise ValueError("no trained model to save")
        path = path or self.model_path
        write_table(self.model.weights, f"{path}/weights")
        sizes = [(self.model.classes, self.model.num_features)]
        write_table(self.spark.createDataFrame(sizes, "classes bigint, num_features bigint").coalesce(1), f"{path}/sizes")
        write_table(self.index.table, f"{path}/labels")
        return path

    def load(self, path: str | None = None) -> TextClassifier:
        path = path or self.model_path
        sizes = self.spark.read.parquet(f"{path}/sizes").first()
        weights = self.spark.read.parquet(f"{path}/weights")
        self.model = BlockClassifier(self.spark, sizes["classes"], sizes["num_features"], weights)
        self.index = LabelIndex.read(self.spark.read.parquet(f"{path}/labels"))
        return self

    def predict(
        self,
        df: DataFrame,
        input_columns: Sequence[str],
        label_column: str | None = None,
        use_checkpoint: bool = True,
        unseen: str = "error",
    ) -> tuple[DataFrame, DataFrame | None]:
        """Append ``input_text`` and ``Predicted``; with a truth column also a ranked report.

        Both results are lazy, and all rows are predicted in one distributed pass, unless the weights are too large to be
        sent to the tasks; the rows are stored in chunks first then.
        """
        if use_checkpoint:
            self.load()
        if self.model is None:
            raise ValueError("no trained model: train one or load one")
        rows = with_input_text(df, input_columns)
        words = hashed_words(F.col(INPUT_COLUMN), self.model.num_features).alias("words")
        kept = [c for c in df.columns if c not in (INPUT_COLUMN, PREDICTED_COLUMN)]
        payload = F.struct(*kept, INPUT_COLUMN).alias("payload")
        scored = self.model.score(rows.select(words, F.lit(None).cast("bigint").alias("y"), payload))
        predicted = self.index.decode(scored, "y_pred", PREDICTED_COLUMN).select("payload.*", PREDICTED_COLUMN)
        if label_column is None:
            return predicted, None
        truth = self.index.encode(rows, label_column, "y", unseen).select(words, "y", F.struct(F.lit(0).alias("none")).alias("payload"))
        cells = M.confusion_cells(self.model.score(truth.where("y is not null")), "y", "y_pred")
        report = R.full_report(M.class_counts(cells, self.index))
        return predicted, R.prediction_report(report)
