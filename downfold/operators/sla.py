"""Daily rollup as mergeable partial states, and the SLA report over them.

An outage is charged wholly to the UTC day on which it started. The percentage is not
clamped: a node that lost more than a day of service to outages of one day is negative.
"""

from pyspark.sql import DataFrame, functions as F

from downfold.constants import DAY_MS


def daily_node_partials(intervals: DataFrame) -> DataFrame:
    """Partial states per node and day of a batch of intervals."""
    return intervals.groupBy("node_id", F.col("down_day").alias("day")).agg(
        F.sum("duration_ms").alias("sum_down_ms"), F.count(F.lit(1)).alias("incidents")
    )


def daily_node_stats(partials: DataFrame) -> DataFrame:
    """Merged states: one row per node and day, from any number of partials."""
    return partials.groupBy("node_id", "day").agg(
        F.sum("sum_down_ms").alias("sum_down_ms"), F.sum("incidents").alias("incidents")
    )


def node_sla_report(partials: DataFrame) -> DataFrame:
    uptime = (1.0 - F.col("sum_down_ms") / float(DAY_MS)) * 100.0
    return daily_node_stats(partials).select(
        "node_id", "day", uptime.alias("uptime_percentage"), F.col("incidents").alias("total_incidents")
    )
