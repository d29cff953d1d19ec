"""Tables that are usually as small as a list of classes: checked, then broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

MAX_ROWS = 20_000


def broadcast_if_small(table: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame | None:
    """A copy of the table marked for broadcast, or None when it has more than ``max_rows`` rows.

    Runs a job; at most ``max_rows + 1`` rows reach the driver. Tables made from driver values have
    no size statistics, so without this check Spark would shuffle the large side to meet them.
    """
    head = table.limit(max_rows + 1).collect()
    if len(head) > max_rows:
        return None
    return F.broadcast(table.sparkSession.createDataFrame(head, table.schema))
