"""Registered queries on the tables and streams the package writes.

Every one reads a whole input table, writes in the shared folder, and reads back.
"""

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from downfold.operators import decode, filters, outages, sla
from downfold.operators.state import with_previous_state, intervals_of
from downfold.plans.outage_queries import MEAN_SEC, PARTIALS_SQL, QUERIES as PLAIN, SLA_SQL
from downfold.plans.tables import (
    INTERVAL_COLUMNS,
    REPEATED_SQL,
    Query,
    alarms_sql,
    commits,
    commits_sql,
    comparable,
    intervals_sql,
)
from downfold.schemas import CDC_MESSAGES, NODE_INTERVALS
from downfold.session import pin_utc, work_folder
from downfold.sources import alarms as alarm_source, intervals as tables, testtables
from downfold.streaming import fold, rollup

AT_ONCE = {"availableNow": True}


def _intervals(spark: SparkSession, sf_dir: str, clock: str = "natural") -> DataFrame:
    return intervals_of(with_previous_state(testtables.alarms(spark, sf_dir, clock)))


def _alarm_stream(spark: SparkSession, sf_dir: str, clock: str = "natural") -> DataFrame:
    # The pattern makes the reader accept a single file as well as a folder.
    files = spark.readStream.schema(testtables.EVENTS_DDL).option("maxFilesPerTrigger", 100)
    return testtables.alarms_of(files.parquet(f"{sf_dir}/events.parquet*"), clock)


def _read_alarms(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    path = work_folder(spark, "alarms")
    testtables.alarms(spark, sf_dir).write.parquet(path)
    return comparable(alarm_source.read_alarms(spark, path))


def _interval_table(spark: SparkSession, sf_dir: str, clock: str = "natural") -> str:
    pin_utc(spark)
    path = work_folder(spark, "intervals")
    tables.write_intervals(_intervals(spark, sf_dir, clock), path)
    return path


def _landed(spark: SparkSession, sf_dir: str, clock: str = "natural") -> str:
    """Intervals as plain files, for streams that read files."""
    pin_utc(spark)
    path = work_folder(spark, "landed")
    _intervals(spark, sf_dir, clock).write.parquet(path)
    return path


def _write_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(tables.read_intervals(spark, _interval_table(spark, sf_dir)))


def _read_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _interval_table(spark, sf_dir)
    return comparable(tables.read_intervals(spark, path, "2024-01-10", "2024-01-12"))


def _read_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = tables.read_intervals(spark, _interval_table(spark, sf_dir))
    return comparable(filters.filter_time_range(df, "2024-01-10 06:00:00", "2024-01-12 18:00:00"))


def _daily_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partials of four batches, committed separately, then compacted and merged at read."""
    pin_utc(spark)
    path = work_folder(spark, "daily")
    source = tables.read_intervals(spark, _interval_table(spark, sf_dir))
    for batch in range(4):
        part = source.where(F.pmod(F.xxhash64("node_id", "down_at"), F.lit(4)) == batch)
        tables.write_daily_states(sla.daily_node_partials(part), path, batch)
    tables.compact_daily_states(spark, path)
    return comparable(sla.daily_node_stats(tables.read_daily_states(spark, path)))


def _compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table after ten batches, one of them sent twice, with parts merged by fours on the way and then all."""
    pin_utc(spark)
    path = work_folder(spark, "intervals")
    source = tables.read_intervals(spark, _interval_table(spark, sf_dir))
    for batch in (0, 1, 2, 3, 4, 5, 6, 7, 3, 8, 9):
        part = source.where(F.pmod(F.xxhash64("node_id", "down_at"), F.lit(10)) == batch)
        tables.write_intervals(part, path, batch, fan=4)
    tables.interval_table(spark, path).compact()
    return comparable(tables.read_intervals(spark, path))


def _commit_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    return comparable(commits()(spark, sf_dir).drop("duration_sec", "down_day"))


def _recent(question, lookback: timedelta):
    """A question about the time before the last closed outage, asked of the written table."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = _interval_table(spark, sf_dir, "fast")
        last = tables.interval_table(spark, path).version().parts[-1:]
        newest = tables.read_intervals(spark, path, last[0].day if last else None).agg(F.max("up_at")).first()[0]
        as_of = newest.astimezone(timezone.utc) if newest else datetime(1970, 1, 1, tzinfo=timezone.utc)
        return comparable(question(tables.read_recent_intervals(spark, path, as_of, lookback)))

    return run


def _message_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    landed, out = work_folder(spark, "messages"), work_folder(spark, "accepted")
    testtables.cdc_messages(spark, sf_dir).write.parquet(landed)
    stream = decode.accepted_alarms(spark.readStream.schema(CDC_MESSAGES).parquet(landed))
    writer = stream.writeStream.format("parquet").option("checkpointLocation", work_folder(spark, "checkpoint"))
    writer.trigger(**AT_ONCE).start(out).awaitTermination()
    return comparable(spark.read.schema(stream.schema).parquet(out).drop("created_at", "arrival"))


def _keyed_stream(spark: SparkSession, sf_dir: str, clock: str = "natural") -> DataFrame:
    pin_utc(spark)
    out = work_folder(spark, "stream-intervals")
    stream = fold.downtime_intervals_stream(_alarm_stream(spark, sf_dir, clock))
    with fold.stateful_settings(spark):
        query = rollup.start_interval_sink(stream, out, work_folder(spark, "checkpoint"), trigger=AT_ONCE)
    query.awaitTermination()
    return comparable(tables.read_intervals(spark, out))


def _job(spark: SparkSession, sf_dir: str, clock: str = "natural") -> str:
    pin_utc(spark)
    root = work_folder(spark, "job")
    query = fold.start_interval_job(
        _alarm_stream(spark, sf_dir, clock), root, work_folder(spark, "checkpoint"), trigger=AT_ONCE
    )
    query.awaitTermination()
    return root


def _message_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job over repeated messages, run once for each of three cuts of the feed."""
    pin_utc(spark)
    landed, root = work_folder(spark, "messages"), work_folder(spark, "job")
    feed = testtables.repeated_messages(spark, sf_dir)
    last = feed.agg(F.max("offset")).first()[0] or 0
    for cut in range(3):
        low = last * cut // 3 if cut else -1
        feed.where((F.col("offset") > low) & (F.col("offset") <= last * (cut + 1) // 3)).write.mode("append").parquet(landed)
        stream = decode.accepted_alarms(spark.readStream.schema(CDC_MESSAGES).parquet(landed))
        fold.start_interval_job(stream, root, f"{root}/checkpoint", ttl_ms=None, trigger=AT_ONCE).awaitTermination()
    return comparable(tables.read_intervals(spark, f"{root}/intervals"))


def _job_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(tables.read_intervals(spark, f"{_job(spark, sf_dir, 'late')}/intervals"))


def _job_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    partials = tables.read_daily_states(spark, f"{_job(spark, sf_dir)}/daily")
    return comparable(sla.node_sla_report(partials))


def _job_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(fold.read_node_state(spark, _job(spark, sf_dir)))


def _rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    landed, out = _landed(spark, sf_dir), work_folder(spark, "daily-stream")
    stream = spark.readStream.schema(NODE_INTERVALS).parquet(landed)
    rollup.daily_rollup_stream(stream, out, work_folder(spark, "checkpoint"), AT_ONCE).awaitTermination()
    return comparable(sla.daily_node_stats(tables.read_daily_states(spark, out)))


def _minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complete mode: every minute seen is kept, whatever the watermark says."""
    pin_utc(spark)
    landed, out = _landed(spark, sf_dir, "fast"), work_folder(spark, "minutes")
    per_minute = outages.outages_over_time_stream(spark.readStream.schema(NODE_INTERVALS).parquet(landed))

    def replace(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(out)

    writer = per_minute.writeStream.outputMode("complete").foreachBatch(replace)
    writer = writer.option("checkpointLocation", work_folder(spark, "checkpoint"))
    writer.trigger(**AT_ONCE).start().awaitTermination()
    return comparable(spark.read.schema(per_minute.schema).parquet(out))


def _final_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append mode: a minute is written once, when the watermark passes it, and leaves the state.

    Intervals arrive in two files, those that began later in the second.
    """
    pin_utc(spark)
    landed, out = work_folder(spark, "landed"), work_folder(spark, "final-minutes")
    source = tables.read_intervals(spark, _interval_table(spark, sf_dir))
    middle = source.agg(F.percentile_approx(F.unix_millis("down_at"), 0.5)).first()[0] or 0
    for later in (False, True):
        part = source.where((F.unix_millis("down_at") > middle) == later)
        part.coalesce(1).write.mode("append").parquet(landed)
    stream = spark.readStream.schema(NODE_INTERVALS).option("maxFilesPerTrigger", 1).parquet(landed)
    minutes = outages.outages_over_time_stream(stream)
    writer = minutes.writeStream.format("parquet").outputMode("append")
    writer = writer.option("checkpointLocation", work_folder(spark, "checkpoint"))
    writer.trigger(**AT_ONCE).start(out).awaitTermination()
    return comparable(spark.read.schema(minutes.schema).parquet(out))


INTERVALS_SQL = f"WITH {intervals_sql()}\nSELECT {INTERVAL_COLUMNS} FROM intervals"

QUERIES = {
    "read_alarms": Query(
        _read_alarms,
        f"WITH {alarms_sql()} SELECT id, node_id, trap_id, event_time, created_ms AS created_at_ms FROM alarms",
    ),
    "write_intervals": Query(_write_intervals, INTERVALS_SQL),
    "read_intervals": Query(
        _read_days,
        f"""WITH {intervals_sql()} SELECT {INTERVAL_COLUMNS} FROM intervals
WHERE make_timestamp(down_ms * 1000)::DATE BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'""",
    ),
    "read_intervals_in_range": Query(
        _read_range,
        f"""WITH {intervals_sql()} SELECT {INTERVAL_COLUMNS} FROM intervals
WHERE down_ms BETWEEN epoch_ms(TIMESTAMP '2024-01-10 06:00:00') AND epoch_ms(TIMESTAMP '2024-01-12 18:00:00')""",
    ),
    "read_intervals_compacted": Query(_compacted, INTERVALS_SQL),
    "interval_commits": Query(
        _commit_record,
        f"""WITH {commits_sql()} SELECT node_id, down_ms AS down_at_ms, up_ms AS up_at_ms, duration_ms,
  created_ms AS created_ts_ms, committed_ms AS committed_ts_ms, shard, batch_id FROM commits""",
    ),
    "max_duration_recent_from_table": Query(
        _recent(outages.max_duration, timedelta(minutes=5)),
        f"""WITH {intervals_sql("fast")} SELECT max(duration_ms) / 1000.0::DOUBLE AS value FROM intervals
WHERE down_ms >= (SELECT max(up_ms) FROM intervals) - 300000""",
    ),
    "outage_count_recent_from_table": Query(
        _recent(outages.total_outages, timedelta(minutes=5)),
        f"""WITH {intervals_sql("fast")} SELECT count(*) AS value FROM intervals
WHERE down_ms >= (SELECT max(up_ms) FROM intervals) - 300000""",
    ),
    "max_outages_per_node_from_table": Query(
        _recent(outages.most_outages_of_a_node, timedelta(hours=1)),
        f"""WITH {intervals_sql("fast")}, per AS (SELECT node_id, count(*) AS n FROM intervals
WHERE down_ms >= (SELECT max(up_ms) FROM intervals) - 3600000 GROUP BY 1) SELECT max(n) AS value FROM per""",
    ),
    "write_daily_states": Query(_daily_states, f"WITH {intervals_sql()}\n{PARTIALS_SQL}"),
    "interval_job_from_messages": Query(
        _message_job, f"WITH {REPEATED_SQL} SELECT {INTERVAL_COLUMNS} FROM intervals"
    ),
    "accepted_alarms_stream": Query(_message_stream, PLAIN["accepted_alarms"].sql),
    "downtime_intervals_stream": Query(_keyed_stream, INTERVALS_SQL),
    "interval_job": Query(_job_intervals, f"WITH {intervals_sql('late')}\nSELECT {INTERVAL_COLUMNS} FROM intervals"),
    "interval_job_sla_report": Query(_job_report, f"WITH {intervals_sql()}\n{SLA_SQL}"),
    "interval_job_node_state": Query(_job_state, PLAIN["latest_node_state"].sql),
    "daily_rollup_stream": Query(_rollup, f"WITH {intervals_sql()}\n{PARTIALS_SQL}"),
    "outages_over_time_append": Query(
        _final_minutes,
        f"""WITH {intervals_sql()} SELECT down_ms // 60000 * 60000 AS time_ms, count(*) AS outages,
  {MEAN_SEC} AS avg_duration_sec
FROM intervals GROUP BY 1 HAVING down_ms // 60000 * 60000 + 60000 <= (SELECT max(down_ms) FROM intervals) - 172800000""",
    ),
    "outages_over_time_stream": Query(
        _minutes,
        f"""WITH {intervals_sql('fast')}
SELECT down_ms // 60000 * 60000 AS time_ms, count(*) AS outages, {MEAN_SEC} AS avg_duration_sec
FROM intervals GROUP BY 1""",
    ),
}
