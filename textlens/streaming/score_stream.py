"""Scoring a stream of files: in place (no state, no watermark, no shuffle), or batch by batch with any plan."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType, max_files_per_trigger: int | None = None,
    glob: str | None = None,
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def score_stream(
    stream: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    sink: str,
    checkpoint: str,
    available_now: bool = True,
    interval: str = "10 seconds",
) -> StreamingQuery:
    """Start scoring ``stream`` into Parquet files at ``sink``.

    ``score`` is any in-place scoring plan, such as a call of ``score_sentiment`` with a lexicon or a
    model. The sink's own log and ``checkpoint`` make the output exactly-once across restarts.
    """
    writer = score(stream).writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", sink).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def score_stream_in_batches(
    stream: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    sink: str,
    checkpoint: str,
    available_now: bool = True,
    interval: str = "10 seconds",
) -> StreamingQuery:
    """Start scoring ``stream`` batch by batch, with plans that a stream itself can't hold: shuffles, stored rows, several passes.

    A document arrives whole, so its sentences meet again within their batch and no state is kept. A batch writes its own
    folder ``sink/batch=<number>`` and replaces it when it runs again after a restart, so nothing is there twice. Read with
    ``read_batches``.
    """
    def write(batch: DataFrame, number: int) -> None:
        score(batch).write.mode("overwrite").parquet(f"{sink}/batch={number}")

    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def read_batches(spark: SparkSession, sink: str) -> DataFrame:
    """All batches written so far, without their number."""
    return spark.read.parquet(sink).drop("batch")
