"""Row filters. All compare bare columns with literals, so they reach the parquet scan."""

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, functions as F

from downfold.functions.scalar import utc_day


def _ts(value):
    """A literal for ISO text or a datetime; without an offset it is UTC, whatever the session's zone.

    Columns pass through, so ``df.agg(F.max("up_at")).scalar()`` can stand for "now".
    """
    if isinstance(value, Column):
        return value
    at = datetime.fromisoformat(value) if isinstance(value, str) else value
    at = at.replace(tzinfo=timezone.utc) if at.tzinfo is None else at.astimezone(timezone.utc)
    return F.lit(at.strftime("%Y-%m-%d %H:%M:%S.%f+00:00")).cast("timestamp")


def filter_time_range(df: DataFrame, start, end, column: str = "down_at") -> DataFrame:
    """Closed range on ``column``; also prunes ``down_day`` partitions where they apply."""
    kept = df.where(F.col(column).between(_ts(start), _ts(end)))
    if column == "down_at" and "down_day" in df.columns:
        kept = kept.where(F.col("down_day").between(utc_day(_ts(start)), utc_day(_ts(end))))
    return kept


def filter_recent(df: DataFrame, as_of, interval: str, column: str = "down_at") -> DataFrame:
    """Rows at or after ``as_of - interval`` (such as ``5 MINUTES``); ``as_of=None`` is now."""
    now = F.current_timestamp() if as_of is None else _ts(as_of)
    since = now - F.expr(f"INTERVAL {interval}")
    kept = df.where(F.col(column) >= since)
    if column == "down_at" and "down_day" in df.columns:
        kept = kept.where(F.col("down_day") >= utc_day(since))
    return kept


def filter_nodes(df: DataFrame, node_ids=None) -> DataFrame:
    """Only the given nodes; None or "All" keeps everything."""
    if node_ids is None or node_ids == "All" or "All" in node_ids:
        return df
    return df.where(F.col("node_id").isin(*node_ids))


def sla_report_for_day(report: DataFrame, day=None) -> DataFrame:
    """One day of the SLA report; ``day=None`` is today in UTC."""
    wanted = utc_day(F.current_timestamp()) if day is None else F.lit(day).cast("date")
    return report.where(F.col("day") == wanted)
