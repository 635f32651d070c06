"""Streaming sinks: the interval table and the daily partials.

A batch is committed once by its id, so a replay after a failure does not double rows.
"""

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from downfold.constants import SINK_FLUSH_MS
from downfold.operators.sla import daily_node_partials
from downfold.sources.intervals import write_daily_states, write_intervals

FLUSH = {"processingTime": f"{SINK_FLUSH_MS // 1000} seconds"}


def start_interval_sink(
    intervals: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append a stream of intervals to the interval table."""

    def commit(batch: DataFrame, batch_id: int) -> None:
        write_intervals(batch, path, batch_id)

    writer = intervals.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or FLUSH)).start()


def daily_rollup_stream(
    intervals: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Add the daily partials of each micro-batch of intervals; readers merge them."""

    def commit(batch: DataFrame, batch_id: int) -> None:
        write_daily_states(daily_node_partials(batch), path, batch_id)

    writer = intervals.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or FLUSH)).start()
