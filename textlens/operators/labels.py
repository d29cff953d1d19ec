"""Label index: distinct labels numbered in sorted order, encode and decode by join."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from textlens.session import ensure_checkpoint_dir

# Up to this many classes the index is a driver-made table that is safe to broadcast.
MAX_LOCAL_CLASSES = 20_000
INDEX_SCHEMA = "class_id bigint, label string"


@dataclass(frozen=True)
class LabelIndex:
    """``table`` holds (class_id, label); ``labels`` the same in order when they are few."""

    table: DataFrame
    labels: tuple[str, ...] | None

    @classmethod
    def of(cls, spark: SparkSession, labels: Sequence[str]) -> LabelIndex:
        return cls(spark.createDataFrame(list(enumerate(labels)), INDEX_SCHEMA), tuple(labels))

    @classmethod
    def read(cls, table: DataFrame, max_local: int = MAX_LOCAL_CLASSES) -> LabelIndex:
        """An index of a stored (class_id, label) table; at most ``max_local + 1`` rows reach the driver."""
        head = table.select("class_id", "label").limit(max_local + 1).collect()
        if len(head) > max_local:
            return cls(table.select("class_id", "label"), None)
        return cls.of(table.sparkSession, [row["label"] for row in sorted(head)])

    def lookup(self) -> DataFrame:
        """The table, marked for broadcast only when its size was checked."""
        return self.table if self.labels is None else F.broadcast(self.table)

    def encode(self, df: DataFrame, column: str, out: str, unseen: str = "error") -> DataFrame:
        """Append the class id of a label column; null stays null.

        ``unseen``: ``error`` fails the job on a label that was not fitted, ``keep`` gives it the
        first free id.
        """
        if unseen not in ("error", "keep"):
            raise ValueError("unseen must be 'error' or 'keep'")
        dim = self.lookup().select(F.col("class_id").alias("_id"), F.col("label").alias("_label"))
        joined = df.join(dim, F.col(column).cast("string") == F.col("_label"), "left")
        if unseen == "keep":
            other: Column = F.lit(self.size())
        else:
            message = F.concat(F.lit("label was not seen when the index was fitted: "), F.col(column))
            other = F.raise_error(message).cast("bigint")
        missing = F.col("_id").isNull() & F.col(column).isNotNull()
        return joined.withColumn(out, F.when(missing, other).otherwise(F.col("_id"))).drop("_id", "_label")

    def decode(self, df: DataFrame, column: str, out: str) -> DataFrame:
        """Append the label of a class id; ids that are no known number come back unchanged."""
        dim = self.lookup().select(
            F.col("class_id").cast("string").alias("_id"), F.col("label").alias("_label")
        )
        raw = F.col(column).cast("string")
        joined = df.join(dim, raw == F.col("_id"), "left")
        return joined.withColumn(out, F.coalesce("_label", raw)).drop("_id", "_label")

    def size(self) -> int:
        return self.table.count() if self.labels is None else len(self.labels)


def distinct_labels(df: DataFrame, column: str) -> DataFrame:
    label = F.col(column).cast("string").alias("label")
    return df.select(label).where(F.col("label").isNotNull()).distinct()


def class_count(df: DataFrame, column: str) -> DataFrame:
    """Number of classes. Counted after a distinct, so hot labels collapse before the shuffle."""
    return distinct_labels(df, column).agg(F.count("*").alias("num_classes"))


def fit_label_index(df: DataFrame, column: str, max_local: int = MAX_LOCAL_CLASSES) -> LabelIndex:
    """Number the distinct labels from 0 in sorted order.

    A fit, so it runs a job: at most ``max_local + 1`` labels reach the driver. Beyond that the
    index is sorted and numbered on the cluster and stays a table that is joined by shuffle.
    """
    distinct = distinct_labels(df, column)
    head = [row[0] for row in distinct.limit(max_local + 1).collect()]
    if len(head) <= max_local:
        return LabelIndex.of(df.sparkSession, sorted(head))
    return LabelIndex(number_sorted(distinct), None)


def number_sorted(labels: DataFrame) -> DataFrame:
    """Consecutive numbers for sorted distinct labels without passing them through one task.

    The sorted labels are checkpointed, which fixes the partition of every row; a label's number is
    then its place in its partition plus the rows of all partitions before it. Only one row per
    partition is ever brought together.
    """
    ensure_checkpoint_dir(labels.sparkSession)
    place = F.monotonically_increasing_id()
    placed = labels.orderBy("label").select("label", place.alias("_place")).checkpoint()
    placed = placed.select(
        "label",
        F.shiftright("_place", 33).alias("_part"),
        F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)).alias("_row"),
    )
    counts = placed.groupBy("_part").agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    # One row per partition: bounded by the number of shuffle partitions.
    numbered = placed.join(F.broadcast(offsets), "_part")
    return numbered.select((F.col("_before") + F.col("_row")).alias("class_id"), "label")
