"""Outputs: a materialised result, and the run log."""

from __future__ import annotations

import datetime
import threading
import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from textlens.session import shared_path

# Seconds that a finished action's row count may take to arrive.
OBSERVED_WITHIN = 30
RUN_SCHEMA = (
    "run_id string, started_at timestamp, parameters map<string,string>, "
    "metrics map<string,double>, success double, error string"
)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: str | None = None) -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def materialise(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write a result and read it back: later reads start at the files, whatever is lost.

    Unlike a checkpoint the copy is columnar, so filters and column pruning still reach it.
    """
    spark = df.sparkSession
    path = path or shared_path(spark, "table")
    write_table(df, path)
    return spark.read.schema(df.schema).parquet(path)


class RunLog:
    """One record per run, written whether the run succeeds or fails; errors are raised again.

    The record carries what is known when the block ends. ``observed`` runs an action inside it, so that success, failure
    and the number of rows come from the run itself. A block in which nothing ran leaves a null ``success``.
    """

    def __init__(self, spark: SparkSession, path: str | None, parameters: dict[str, Any]):
        self.spark, self.path = spark, path
        self.parameters = {key: str(value) for key, value in parameters.items()}
        self.metrics: dict[str, float] = {}
        self.ran = False

    def observed(self, df: DataFrame, action: Callable[[DataFrame], Any]) -> Any:
        """Run an action on ``df``; the rows that went through it become the metric ``rows``."""
        seen = Observation()
        outcome = action(df.observe(seen, F.count(F.lit(1)).alias("rows")))
        self.ran = True
        # Waits for the listener only: an action that never read the table leaves no count.
        waiting = threading.Thread(target=lambda: self.metrics.update(rows=float(seen.get["rows"])), daemon=True)
        waiting.start()
        waiting.join(OBSERVED_WITHIN)
        return outcome

    def __enter__(self) -> RunLog:
        self.run_id = uuid.uuid4().hex
        self.started_at = datetime.datetime.now(datetime.timezone.utc)
        return self

    def __exit__(self, kind, error, trace) -> bool:
        if self.path:
            success = 0.0 if error else 1.0 if self.ran else None
            row = (self.run_id, self.started_at, self.parameters, self.metrics, success,
                   str(error) if error else None)
            record = self.spark.createDataFrame([row], RUN_SCHEMA).coalesce(1)
            record = record.withColumn("run_date", F.to_date("started_at"))
            write_table(record, self.path, mode="append", partition_by="run_date")
        return False


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA + ", run_date date").parquet(path)
