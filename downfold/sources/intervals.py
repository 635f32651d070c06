"""The outage interval table with its commit record, and the table of daily partials.

Both are tables of days (``daytable``): batches are added once by their id, small parts are
merged, and readers of some days list those days only. Each row of the interval table holds
when the interval came into being, when it was committed, in which batch, and its shard.
"""

import time
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from downfold.functions.scalar import shard_of
from downfold.schemas import DAILY_PARTIALS, INTERVAL_COMMITS, NODE_INTERVALS
from downfold.sources.daytable import DayTable


def interval_table(spark: SparkSession, path: str, **options) -> DayTable:
    return DayTable(spark, path, INTERVAL_COMMITS, "down_day", ["node_id", "down_at"], **options)


def daily_table(spark: SparkSession, path: str, **options) -> DayTable:
    """Parts are merged by adding partials up, so a merged day has one row a node."""
    return DayTable(spark, path, DAILY_PARTIALS, "day", ["node_id"], merge=_added_up, **options)


def _added_up(partials: DataFrame) -> DataFrame:
    return partials.groupBy("node_id", "day").agg(
        F.sum("sum_down_ms").alias("sum_down_ms"), F.sum("incidents").alias("incidents")
    )


def write_intervals(
    intervals: DataFrame, path: str, batch_id: int | None = None, committed_ms: int | None = None, **options
) -> bool:
    """Commit one batch of intervals; false if a batch of this id was committed before.

    Every row gets the time of the commit (``committed_ts``, by default now), its shard and
    its batch. ``created_ts`` is kept where the intervals have it and else is the same time.
    """
    table = interval_table(intervals.sparkSession, path, **options)
    batch_id = table.version().next_batch() if batch_id is None else int(batch_id)
    at = F.timestamp_millis(F.lit(committed_ms if committed_ms is not None else time.time_ns() // 1_000_000))
    created = F.coalesce("created_ts", at) if "created_ts" in intervals.columns else at
    stamped = intervals.select(
        *NODE_INTERVALS.fieldNames(),
        created.alias("created_ts"),
        at.alias("committed_ts"),
        shard_of(F.col("node_id")).cast("int").alias("shard"),
        F.lit(batch_id).cast("long").alias("batch_id"),
    )
    return table.commit(stamped, batch_id)


def read_commits(spark: SparkSession, path: str, first_day=None, last_day=None) -> DataFrame:
    """Intervals with their commit record."""
    return interval_table(spark, path).read(first_day, last_day)


def read_intervals(spark: SparkSession, path: str, first_day=None, last_day=None) -> DataFrame:
    """The intervals that began from ``first_day`` to ``last_day``; folders of other days are not opened."""
    return read_commits(spark, path, first_day, last_day).select(*NODE_INTERVALS.fieldNames())


def read_recent_intervals(spark: SparkSession, path: str, as_of: datetime, lookback: timedelta) -> DataFrame:
    """Intervals that began within ``lookback`` before ``as_of``, or later: one or a few days of the table are read."""
    since = (as_of if as_of.tzinfo else as_of.replace(tzinfo=timezone.utc)).astimezone(timezone.utc) - lookback
    recent = read_intervals(spark, path, first_day=since.date())
    micros = (since - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)
    return recent.where(F.col("down_at") >= F.timestamp_micros(F.lit(micros)))


def write_daily_states(partials: DataFrame, path: str, batch_id: int | None = None, **options) -> bool:
    """Commit one batch of partials; false if a batch of this id was committed before."""
    return daily_table(partials.sparkSession, path, **options).commit(partials, batch_id)


def read_daily_states(spark: SparkSession, path: str, first_day: date | None = None, last_day: date | None = None) -> DataFrame:
    return daily_table(spark, path).read(first_day, last_day)


def compact_daily_states(spark: SparkSession, path: str) -> None:
    """Leave one part a day, with one row a node; readers see either form whole."""
    daily_table(spark, path).compact()
