"""Questions about outage intervals: totals, trends, rankings, distributions.

Durations are summed as integer milliseconds and divided once, so results do not depend on
the order in which partitions are merged.
"""

from pyspark.sql import DataFrame, functions as F

from downfold.constants import BANDS
from downfold.functions.scalar import (
    duration_bucket,
    floor_ms,
    hour_of_day,
    mean_ms_as_sec,
    round_half_even,
    threshold_band,
    whole_seconds_between,
)
from downfold.operators.filters import filter_recent


def _count():
    return F.count(F.lit(1))


def _mean_sec():
    return mean_ms_as_sec(F.sum("duration_ms"), _count())


def total_outages(intervals: DataFrame) -> DataFrame:
    return intervals.agg(_count().alias("value"))


def avg_duration(intervals: DataFrame) -> DataFrame:
    return intervals.agg(_mean_sec().alias("value"))


def max_duration(intervals: DataFrame) -> DataFrame:
    return intervals.agg((F.max("duration_ms") / 1000.0).alias("value"))


def affected_nodes(intervals: DataFrame) -> DataFrame:
    return intervals.agg(F.count_distinct("node_id").alias("value"))


def affected_nodes_approx(intervals: DataFrame, rsd: float = 0.02) -> DataFrame:
    """Distinct nodes by sketch: one small buffer per task instead of a shuffle of nodes."""
    return intervals.agg(F.approx_count_distinct("node_id", rsd).alias("value"))


def _uptime():
    window_sec = whole_seconds_between(F.min("down_at"), F.max("up_at"))
    lost = F.sum("duration_ms") / F.nullif(window_sec * 1000.0, F.lit(0.0)) * 100.0
    pct = 100.0 - lost
    # A window of no length has no percentage: null, not 0.
    return F.when(pct.isNotNull(), round_half_even(F.greatest(F.lit(0.0), pct), 2))


def uptime_pct(intervals: DataFrame) -> DataFrame:
    """Share of one common window not lost to outages, clamped at 0."""
    return intervals.agg(_uptime().alias("value"))


def uptime_pct_by_node(intervals: DataFrame) -> DataFrame:
    return intervals.groupBy("node_id").agg(_uptime().alias("uptime_pct"))


def outages_over_time(intervals: DataFrame) -> DataFrame:
    """Outages and mean duration per minute of start."""
    minute = F.timestamp_millis(floor_ms(F.unix_millis("down_at"), 60_000))
    return (
        intervals.groupBy(minute.alias("time"))
        .agg(_count().alias("outages"), _mean_sec().alias("avg_duration_sec"))
        .orderBy("time")
    )


def outages_over_time_stream(intervals: DataFrame, lateness: str = "48 hours") -> DataFrame:
    """The same over an unbounded stream; a minute is final once the watermark has passed it.

    An outage arrives when it ends and counts where it began, so the lateness must cover the
    longest outage. Expiry of node state bounds that to 48 hours.
    """
    return (
        intervals.withWatermark("down_at", lateness)
        .groupBy(F.window("down_at", "1 minute"))
        .agg(_count().alias("outages"), _mean_sec().alias("avg_duration_sec"))
        .select(F.col("window.start").alias("time"), "outages", "avg_duration_sec")
    )


def top_nodes_downtime(intervals: DataFrame, k: int = 15) -> DataFrame:
    """The k nodes with most downtime; ties by node."""
    per_node = intervals.groupBy("node_id").agg(
        _count().alias("outage_count"), F.sum("duration_ms").alias("_ms")
    )
    return (
        per_node.select(
            "node_id", "outage_count", (F.rint(F.col("_ms") / 10) / 100.0).alias("total_downtime_sec")
        )
        .orderBy(F.desc("total_downtime_sec"), "node_id")
        .limit(k)
    )


def duration_histogram(intervals: DataFrame) -> DataFrame:
    return (
        intervals.groupBy(duration_bucket(F.col("duration_ms")).alias("bucket"))
        .agg(_count().alias("count"))
        .orderBy("bucket")
    )


def hourly_pattern(intervals: DataFrame) -> DataFrame:
    return (
        intervals.groupBy(hour_of_day(F.col("down_at")).alias("hour_of_day"))
        .agg(_count().alias("outage_count"), _mean_sec().alias("avg_duration_sec"))
        .orderBy("hour_of_day")
    )


def recent_outages(intervals: DataFrame, k: int = 200) -> DataFrame:
    """The k outages that started last; ties by node and end."""
    return (
        intervals.select("node_id", "down_at", "up_at", (F.col("duration_ms") / 1000.0).alias("duration_sec"))
        .orderBy(F.desc("down_at"), "node_id", "up_at")
        .limit(k)
    )


def node_list(intervals: DataFrame) -> DataFrame:
    return intervals.select("node_id").distinct().orderBy("node_id")


def max_duration_recent(intervals: DataFrame, as_of=None, interval: str = "5 MINUTES") -> DataFrame:
    return max_duration(filter_recent(intervals, as_of, interval))


def outage_count_recent(intervals: DataFrame, as_of=None, interval: str = "5 MINUTES") -> DataFrame:
    return total_outages(filter_recent(intervals, as_of, interval))


def most_outages_of_a_node(intervals: DataFrame) -> DataFrame:
    per_node = intervals.groupBy("node_id").agg(_count().alias("n"))
    return per_node.agg(F.max("n").alias("value"))


def max_outages_per_node(intervals: DataFrame, as_of=None, interval: str = "1 HOUR") -> DataFrame:
    return most_outages_of_a_node(filter_recent(intervals, as_of, interval))


def with_band(df: DataFrame, value: str, band: str, into: str = "band") -> DataFrame:
    """Add the colour band of a value; ``band`` names one of the fixed step sets."""
    return df.withColumn(into, threshold_band(F.col(value), BANDS[band]))
