"""What the registered queries share: inputs, SQL fragments, comparable results."""

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, IntegerType, LongType, MapType, TimestampType

from downfold.constants import STATE_TTL_MS
from downfold.operators.metrics import series_key
from downfold.operators.state import downtime_intervals
from downfold.session import pin_utc, work_folder
from downfold.sources import testtables
from downfold.sources.intervals import read_commits
from downfold.streaming import fold


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


def comparable(df: DataFrame) -> DataFrame:
    """The same rows in types that every SQL engine prints alike.

    Timestamps become epoch ms (``x`` to ``x_ms``), dates ISO text, maps JSON text with
    sorted keys, and 32-bit integers 64-bit ones.
    """
    out = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, TimestampType):
            out.append(F.unix_millis(column).alias(f"{field.name}_ms"))
        elif isinstance(field.dataType, DateType):
            out.append(column.cast("string").alias(field.name))
        elif isinstance(field.dataType, MapType):
            out.append(series_key(column).alias(field.name))
        elif isinstance(field.dataType, IntegerType):
            out.append(column.cast(LongType()).alias(field.name))
        else:
            out.append(column)
    return df.select(*out)


def on(table: Callable[[SparkSession, str], DataFrame], operator: Callable[[DataFrame], DataFrame], sql: str | None):
    """A query: read an input table, apply an operator, make the result comparable."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        pin_utc(spark)
        return comparable(operator(table(spark, sf_dir)))

    return Query(run, sql)


def alarms(clock: str = "natural"):
    return lambda spark, sf_dir: testtables.alarms(spark, sf_dir, clock)


def intervals(clock: str = "natural", **options):
    return lambda spark, sf_dir: downtime_intervals(testtables.alarms(spark, sf_dir, clock), **options)


#: Micro-batches in which the job is fed the alarms whose commits are asked about.
CUTS = 4


def commits(clock: str = "fast"):
    """The interval table that the job leaves when all alarms are fed to it, cut by id.

    Its clock is that of the feed: a batch is taken up and committed when its last alarm arrives.
    """

    def last_arrival(batch: DataFrame) -> int:
        return batch.agg(F.max("arrived_ms")).first()[0] or 0

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = work_folder(spark, "commits")
        work = fold.interval_fold(root, ttl_ms=None, clock=last_arrival)
        feed = fold.slim_alarms(testtables.alarms(spark, sf_dir, clock))
        last = feed.agg(F.max("id")).first()[0] or 0
        for n in range(CUTS):
            work(feed.where(F.expr(f"id * {CUTS} div {last + 1} = {n}")), n)
        return read_commits(spark, f"{root}/intervals")

    return run


def messages(clock: str = "natural"):
    return lambda spark, sf_dir: testtables.cdc_messages(spark, sf_dir, clock)


# --- SQL fragments --------------------------------------------------------------------

# An alarm's epoch ms is its microsecond timestamp rounded down; ``epoch_ms`` would round.
_TIME = {
    "natural": ("epoch_us(ts) // 1000", "epoch_us(ts) // 1000"),
    "fast": ("epoch_us(ts) // 1000 // 1000", "epoch_us(ts) // 1000 // 1000"),
    "late": ("epoch_us(ts) // 1000", "epoch_us(ts) // 1000 - CASE WHEN event_id % 7 = 0 THEN 172800000 ELSE 0 END"),
}

SHARD_SQL = """(list_reduce(list_prepend(2166136261::UBIGINT,
  list_transform(string_split(node_id, ''), lambda x: ascii(x)::UBIGINT)),
  lambda a, b: (xor(a, b) * 16777619::UBIGINT) % 4294967296::UBIGINT) % 5)::BIGINT"""


def alarms_sql(clock: str = "natural") -> str:
    happened, event_time = _TIME[clock]
    return f"""alarms AS (
  SELECT event_id AS id, 'NODE_' || user_id AS node_id,
    CASE event_type WHEN 'error' THEN 1417 WHEN 'signup' THEN 1535 ELSE 9999 END AS trap_id,
    {event_time} AS event_time,
    {happened} + coalesce(round(value * 100)::BIGINT, 0) AS created_ms
  FROM events)"""


def states_sql(clock: str = "natural", ttl_ms: int | None = None, order: str = "id") -> str:
    """Alarms with previous state: down, pd (previous was down), pt (its time), both null without one."""
    alive = "" if ttl_ms is None else f"WHEN event_time - pt0 > {ttl_ms} THEN NULL "
    return f"""{alarms_sql(clock)},
lagged AS (
  SELECT *, trap_id IN (1417, 1535) AS down,
    lag(trap_id IN (1417, 1535)) OVER w AS pd0, lag(event_time) OVER w AS pt0
  FROM alarms WINDOW w AS (PARTITION BY node_id ORDER BY {order})),
states AS (
  SELECT *, CASE {alive}WHEN true THEN pd0 END AS pd, CASE {alive}WHEN true THEN pt0 END AS pt FROM lagged)"""


def intervals_sql(clock: str = "natural", ttl_ms: int | None = None, order: str = "id") -> str:
    return f"""{states_sql(clock, ttl_ms, order)},
intervals AS (
  SELECT node_id, pt AS down_ms, event_time AS up_ms, event_time - pt AS duration_ms
  FROM states WHERE pd AND NOT down AND event_time > pt)"""


def commits_sql(clock: str = "fast") -> str:
    return f"""{intervals_sql(clock)},
cut AS (SELECT *, id * {CUTS} // ((SELECT max(id) FROM alarms) + 1) AS batch_id FROM states),
flushed AS (SELECT batch_id, max(created_ms) AS committed_ms FROM cut GROUP BY 1),
commits AS (
  SELECT node_id, pt AS down_ms, event_time AS up_ms, event_time - pt AS duration_ms, created_ms, committed_ms, batch_id,
    {SHARD_SQL} AS shard
  FROM cut JOIN flushed USING (batch_id) WHERE pd AND NOT down AND event_time > pt)"""


INTERVAL_COLUMNS = """node_id, down_ms AS down_at_ms, up_ms AS up_at_ms, duration_ms,
  duration_ms / 1000.0::DOUBLE AS duration_sec, make_timestamp(down_ms * 1000)::DATE::VARCHAR AS down_day"""

DAY = "make_timestamp(down_ms * 1000)::DATE::VARCHAR"

TTL = STATE_TTL_MS

# How the change messages of an event fare, by event_id % 50.
UNDECODABLE = "(0, 3, 4, 5, 6, 7, 8, 9, 12, 13, 14, 15, 16)"
MESSAGES_SQL = f"""messages AS (
  SELECT event_id, ts, 'dbserver1.inventory.histalarms' AS topic,
    CASE WHEN event_id % 50 IN {UNDECODABLE} THEN 'json_unmarshal' END AS reject,
    CASE WHEN event_id % 50 IN (0, 1, 2, 4, 10) THEN '' ELSE 'NODE_' || user_id END AS node_id,
    CASE event_type WHEN 'error' THEN 1417 WHEN 'signup' THEN 1535 ELSE 9999 END AS trap_id,
    epoch_us(ts) // 1000 AS event_time
  FROM events)"""

# Intervals folded from the repeated messages in the order of their offsets.
REPEATED_SQL = f"""{MESSAGES_SQL},
repeated AS (
  SELECT node_id, trap_id IN (1417, 1535) AS down, event_time, (event_id + later) * 3 + nth AS arrival
  FROM messages, (VALUES (0, 0), (5, 1), (30, 2)) AS again(later, nth)
  WHERE reject IS NULL AND node_id <> ''
    AND (later = 0 OR (later = 5 AND event_id % 7 = 0) OR (later = 30 AND event_id % 11 = 0))),
before AS (
  SELECT *, lag(down) OVER w AS pd, lag(event_time) OVER w AS pt
  FROM repeated WINDOW w AS (PARTITION BY node_id ORDER BY arrival)),
intervals AS (
  SELECT node_id, pt AS down_ms, event_time AS up_ms, event_time - pt AS duration_ms
  FROM before WHERE pd AND NOT down AND event_time > pt)"""
