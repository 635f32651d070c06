"""Registered queries on messages, alarms, states, intervals and the SLA rollup."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from downfold.constants import BANDS
from downfold.functions import scalar
from downfold.functions.ordered import measured_span
from downfold.functions.scalar import ceil_ms
from downfold.operators import decode, filters, metrics, outages, sla, state
from downfold.plans.tables import (
    DAY,
    INTERVAL_COLUMNS,
    MESSAGES_SQL,
    REPEATED_SQL,
    SHARD_SQL,
    TTL,
    Query,
    alarms,
    alarms_sql,
    comparable,
    intervals,
    intervals_sql,
    messages,
    on,
    states_sql,
)
from downfold.session import pin_utc
from downfold.sources import testtables

FIRST, LAST = "2024-01-10 00:00:00", "2024-01-20 23:59:59.999"
#: A slice short enough that small tables have many, so that the plan for large ones is what runs.
FEW_IDS = 64
NODES = ["NODE_1", "NODE_2", "NODE_3"]


def _newest_end(df: DataFrame):
    return df.agg(F.max("up_at")).scalar()


def _accepted(df: DataFrame) -> DataFrame:
    return decode.accepted_alarms(df).drop("created_at", "arrival")


def _decoded(df: DataFrame) -> DataFrame:
    """Fields of decodable messages; what a rejected message still held is not compared."""
    return decode.decode_cdc(df).select(
        "offset",
        "reject",
        *[F.when(F.col("reject").isNull(), F.col(c)).alias(c) for c in ("node_id", "trap_id")],
    )


def _flat_states(df: DataFrame) -> DataFrame:
    return df.select(
        "id",
        "node_id",
        F.when(F.col("prev").isNull(), "").when(F.col("prev.down"), "DOWN").otherwise("UP").alias("prev_status"),
        F.coalesce(F.col("prev.event_time"), F.lit(-1)).alias("prev_time"),
    )


FLAT_STATES_SQL = """SELECT id, node_id,
  CASE WHEN pt IS NULL THEN '' WHEN pd THEN 'DOWN' ELSE 'UP' END AS prev_status, coalesce(pt, -1) AS prev_time
FROM states"""

TRANSITIONS_SQL = """SELECT node_id, from_state, to_state, count(*) AS transitions FROM (
  SELECT node_id, CASE WHEN pt IS NULL THEN '' WHEN pd THEN 'DOWN' ELSE 'UP' END AS from_state,
    CASE WHEN down THEN 'DOWN' ELSE 'UP' END AS to_state
  FROM states WHERE (down AND pd IS NOT TRUE) OR (pd AND NOT down AND event_time > pt))
GROUP BY ALL"""

DELTA = "CASE WHEN down AND pd IS NOT TRUE THEN 1 WHEN NOT down AND pd THEN -1 ELSE 0 END"

MEAN_SEC = "round_even(sum(duration_ms)::DOUBLE / count(*), 0) / 1000.0::DOUBLE"

UPTIME = """round_even(greatest(0.0::DOUBLE, 100.0::DOUBLE - sum(duration_ms)::DOUBLE
  / nullif((max(up_ms) // 1000 - min(down_ms) // 1000) * 1000.0::DOUBLE, 0.0::DOUBLE) * 100.0::DOUBLE)
  * 100.0::DOUBLE, 0) / 100.0::DOUBLE"""


def _on_intervals(operator, select: str, clock: str = "natural"):
    return on(intervals(clock), operator, f"WITH {intervals_sql(clock)}\n{select}")


def _bands(df: DataFrame) -> DataFrame:
    """Every outage in its colour band, and the whole table's totals in theirs."""
    band = scalar.threshold_band(F.col("duration_ms") / 1000.0, BANDS["duration"]).alias("band")
    out = df.groupBy(F.lit("duration").alias("panel"), band).agg(F.count(F.lit(1)).alias("n"))
    for panel, kpi in (
        ("outages", outages.total_outages),
        ("avg_duration", outages.avg_duration),
        ("max_duration", outages.max_duration),
        ("affected_nodes", outages.affected_nodes),
        ("uptime", outages.uptime_pct),
    ):
        one = outages.with_band(kpi(df), "value", panel)
        out = out.unionByName(one.select(F.lit(panel).alias("panel"), "band", F.lit(1).cast("long").alias("n")))
    return out


def _pipeline_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps at which each gauge of the pipeline was in each of its bands, minute by minute."""
    pin_utc(spark)
    table = testtables.alarms(spark, sf_dir, "fast")
    errors = decode.reject_malformed(decode.decode_cdc(testtables.cdc_messages(spark, sf_dir, "fast")))
    minute = ceil_ms(F.unix_millis("created_at"), 60_000)
    late = metrics.ingest_lag(table).where(F.col("lag_ms") > 0).groupBy(minute.alias("at"))
    values = [
        ("down_nodes", state.active_down_series(table), F.col("active_down").cast("double")),
        ("error_rate", metrics.event_rate(errors, "timestamp", 300, 60), F.col("rate")),
        ("lag", late.agg(F.max_by("lag_ms", "id").alias("lag_ms")), F.col("lag_ms") / 1000.0),
    ]
    parts = [
        outages.with_band(df.select(value.alias("value")), "value", panel).groupBy(F.lit(panel).alias("panel"), "band").count()
        for panel, df, value in values
    ]
    return comparable(parts[0].unionByName(parts[1]).unionByName(parts[2]).withColumnRenamed("count", "n"))


def _band_sql(value: str, panel: str) -> str:
    steps = BANDS[panel]
    whens = " ".join(f"WHEN {value} >= {b} THEN '{band}'" for b, band in reversed(steps) if b is not None)
    return f"CASE WHEN {value} IS NULL THEN NULL {whens} ELSE '{steps[0][1]}' END"


PIPELINE_BANDS_SQL = f"""WITH {states_sql("fast")}, {MESSAGES_SQL},
steps AS (SELECT (event_time + 59999) // 60000 AS t, sum({DELTA}) AS d FROM states GROUP BY 1),
down_nodes AS (SELECT sum(d) OVER (ORDER BY t) AS v FROM steps),
errs AS (SELECT epoch_us(ts) // 1000 // 1000 // 60000 AS t FROM messages WHERE reject IS NOT NULL),
error_rate AS (SELECT count(*) / 300.0::DOUBLE AS v FROM (SELECT unnest(generate_series(t - 4, t)) AS s FROM errs) GROUP BY s),
lag AS (SELECT arg_max(created_ms - event_time, id) / 1000.0::DOUBLE AS v FROM alarms WHERE created_ms > event_time
  GROUP BY (created_ms + 59999) // 60000)
{" UNION ALL ".join(f"SELECT '{p}' AS panel, {_band_sql('v', p)} AS band, count(*) AS n FROM {p} GROUP BY 2" for p in ("down_nodes", "error_rate", "lag"))}"""

BANDS_SQL = f"""WITH {intervals_sql("fast")},
kpi AS (SELECT count(*) AS outages, {MEAN_SEC} AS avg_duration, max(duration_ms) / 1000.0 AS max_duration,
  count(DISTINCT node_id) AS affected_nodes, {UPTIME} AS uptime FROM intervals)
SELECT 'duration' AS panel, {_band_sql("duration_ms / 1000.0", "duration")} AS band, count(*) AS n
FROM intervals GROUP BY 2
""" + "".join(
    f"UNION ALL SELECT '{p}', {_band_sql(p, p)}, 1 FROM kpi\n"
    for p in ("outages", "avg_duration", "max_duration", "affected_nodes", "uptime")
)


def _partials_by_batch(df: DataFrame) -> DataFrame:
    """Partials of several batches (here: per hour of start), to be merged again."""
    batch = scalar.hour_of_day(F.col("down_at")).alias("batch")
    return df.groupBy("node_id", F.col("down_day").alias("day"), batch).agg(
        F.sum("duration_ms").alias("sum_down_ms"), F.count(F.lit(1)).alias("incidents")
    )


SLA_SQL = f"""SELECT node_id, {DAY} AS day,
  (1.0::DOUBLE - sum(duration_ms)::DOUBLE / 86400000.0::DOUBLE) * 100.0::DOUBLE AS uptime_percentage,
  count(*) AS total_incidents
FROM intervals GROUP BY ALL"""

PARTIALS_SQL = f"""SELECT node_id, {DAY} AS day, sum(duration_ms)::BIGINT AS sum_down_ms, count(*) AS incidents
FROM intervals GROUP BY ALL"""

KPI = "SELECT {} AS value FROM intervals"
RECENT = "WHERE down_ms >= (SELECT max(up_ms) FROM intervals) - {}"

QUERIES = {
    # decode, projections, filters
    "decode_cdc": on(
        messages(),
        _decoded,
        f"""WITH {MESSAGES_SQL} SELECT event_id AS "offset", reject, CASE WHEN reject IS NULL THEN node_id END AS node_id,
  CASE WHEN reject IS NULL THEN CASE WHEN event_id % 50 IN (2, 10) THEN 0 ELSE trap_id END END AS trap_id FROM messages""",
    ),
    "reject_malformed": on(
        messages(),
        lambda df: decode.reject_malformed(decode.decode_cdc(df)).select("offset", "reject"),
        f'WITH {MESSAGES_SQL} SELECT event_id AS "offset", reject FROM messages WHERE reject IS NOT NULL',
    ),
    "decode_errors": on(
        messages(),
        lambda df: decode.decode_errors(decode.decode_cdc(df)),
        f"""WITH {MESSAGES_SQL} SELECT reject AS type, 'kafka' AS operation, count(*) AS errors
FROM messages WHERE reject IS NOT NULL GROUP BY 1""",
    ),
    "skip_empty_node": on(
        messages(),
        lambda df: decode.skip_empty_node(decode.decode_cdc(df)).select("offset", "node_id"),
        f"""WITH {MESSAGES_SQL} SELECT event_id AS "offset", node_id FROM messages
WHERE reject IS NULL AND node_id <> ''""",
    ),
    "skipped_by_reason": on(
        messages(),
        lambda df: decode.skipped_by_reason(decode.decode_cdc(df)),
        f"""WITH {MESSAGES_SQL} SELECT 'empty_node_id' AS reason, count(*) AS skipped
FROM messages WHERE reject IS NULL AND node_id = '' HAVING count(*) > 0""",
    ),
    "messages_by_status": on(
        messages(),
        decode.messages_by_status,
        f"""WITH {MESSAGES_SQL} SELECT topic, 'ok' AS status, count(*) AS messages
FROM messages WHERE reject IS NULL AND node_id <> '' GROUP BY 1""",
    ),
    "classify_status": on(
        alarms(),
        lambda df: decode.with_status(df).select("id", "trap_id", "status"),
        f"""WITH {alarms_sql()} SELECT id, trap_id, CASE WHEN trap_id IN (1417, 1535) THEN 'DOWN' ELSE 'UP' END AS status
FROM alarms""",
    ),
    "event_time_ms_to_ts": on(
        alarms("late"),
        lambda df: decode.with_status(df).select("id", "event_ts"),
        f"WITH {alarms_sql('late')} SELECT id, event_time AS event_ts_ms FROM alarms",
    ),
    "accepted_alarms": on(
        messages(),
        _accepted,
        f"""WITH {MESSAGES_SQL} SELECT CASE WHEN event_id % 50 <> 11 THEN event_id END AS id, node_id, trap_id, event_time, event_time AS event_ts_ms,
  CASE WHEN trap_id IN (1417, 1535) THEN 'DOWN' ELSE 'UP' END AS status
FROM messages WHERE reject IS NULL AND node_id <> ''""",
    ),
    "downtime_intervals_from_messages": on(
        testtables.repeated_messages,
        lambda df: state.downtime_intervals(decode.accepted_alarms(df)),
        f"WITH {REPEATED_SQL} SELECT {INTERVAL_COLUMNS} FROM intervals",
    ),
    "filter_time_range": _on_intervals(
        lambda df: filters.filter_time_range(df, FIRST, LAST),
        f"""SELECT {INTERVAL_COLUMNS} FROM intervals
WHERE down_ms BETWEEN epoch_ms(TIMESTAMP '{FIRST}') AND epoch_ms(TIMESTAMP '{LAST}')""",
    ),
    "filter_recent": _on_intervals(
        lambda df: filters.filter_recent(df, _newest_end(df), "3 DAYS"),
        f"SELECT {INTERVAL_COLUMNS} FROM intervals {RECENT.format(3 * 86_400_000)}",
    ),
    "filter_nodes": _on_intervals(
        lambda df: filters.filter_nodes(df, NODES),
        f"SELECT {INTERVAL_COLUMNS} FROM intervals WHERE node_id IN ('NODE_1', 'NODE_2', 'NODE_3')",
    ),
    "sla_report_for_day": _on_intervals(
        lambda df: filters.sla_report_for_day(sla.node_sla_report(sla.daily_node_partials(df)), "2024-01-15"),
        f"SELECT * FROM ({SLA_SQL}) WHERE day = '2024-01-15'",
    ),
    # state
    "with_previous_state": on(
        alarms(), lambda df: _flat_states(state.with_previous_state(df)), f"WITH {states_sql()}\n{FLAT_STATES_SQL}"
    ),
    "with_previous_state_ttl": on(
        alarms(),
        lambda df: _flat_states(state.with_previous_state(df, state_ttl_ms=TTL)),
        f"WITH {states_sql(ttl_ms=TTL)}\n{FLAT_STATES_SQL}",
    ),
    "downtime_intervals": _on_intervals(lambda df: df, f"SELECT {INTERVAL_COLUMNS} FROM intervals"),
    "downtime_intervals_fast": _on_intervals(lambda df: df, f"SELECT {INTERVAL_COLUMNS} FROM intervals", "fast"),
    "downtime_intervals_late": _on_intervals(lambda df: df, f"SELECT {INTERVAL_COLUMNS} FROM intervals", "late"),
    "downtime_intervals_ttl": on(
        intervals(state_ttl_ms=TTL),
        lambda df: df,
        f"WITH {intervals_sql(ttl_ms=TTL)}\nSELECT {INTERVAL_COLUMNS} FROM intervals",
    ),
    "downtime_intervals_sliced": on(
        intervals(span=FEW_IDS),
        lambda df: df,
        f"WITH {intervals_sql()}\nSELECT {INTERVAL_COLUMNS} FROM intervals",
    ),
    "downtime_intervals_by_event_time": on(
        alarms("late"),
        lambda df: state.intervals_of(state.by_event_time(df, measured_span(df, "event_time"))),
        f"WITH {intervals_sql('late', order='event_time, id')}\nSELECT {INTERVAL_COLUMNS} FROM intervals",
    ),
    "latest_node_state": on(
        alarms(),
        state.latest_node_state,
        f"""WITH {alarms_sql()}
SELECT node_id, CASE WHEN arg_max(trap_id, id) IN (1417, 1535) THEN 'DOWN' ELSE 'UP' END AS status,
  arg_max(event_time, id) AS last_seen_at_ms, max(id) AS id FROM alarms GROUP BY node_id""",
    ),
    "state_documents": on(
        alarms(),
        lambda df: state.state_documents(state.latest_node_state(df)),
        f"""WITH {alarms_sql()}, latest AS (SELECT node_id, arg_max(trap_id, id) AS trap, arg_max(event_time, id) AS ms
  FROM alarms GROUP BY 1)
SELECT 'node:' || node_id AS key, '{{"status":"' || CASE WHEN trap IN (1417, 1535) THEN 'DOWN' ELSE 'UP' END
  || '","last_seen_at":"' || strftime(make_timestamp(ms * 1000), '%Y-%m-%dT%H:%M:%S')
  || CASE WHEN ms % 1000 = 0 THEN '' ELSE '.' || rtrim(lpad((ms % 1000)::VARCHAR, 3, '0'), '0') END || 'Z"}}' AS value
FROM latest""",
    ),
    "state_transitions": on(alarms(), state.state_transitions, f"WITH {states_sql()}\n{TRANSITIONS_SQL}"),
    "state_transitions_sliced": on(
        alarms(),
        lambda df: state.state_transitions(df, span=FEW_IDS),
        f"WITH {states_sql()}\n{TRANSITIONS_SQL}",
    ),
    "state_transitions_late": on(
        alarms("late"), state.state_transitions, f"WITH {states_sql('late')}\n{TRANSITIONS_SQL}"
    ),
    "active_down_nodes": on(
        alarms(),
        state.active_down_nodes,
        f"WITH {states_sql()} SELECT sum({DELTA})::BIGINT AS active_down FROM states",
    ),
    "active_down_nodes_ttl": on(
        alarms(),
        lambda df: state.active_down_nodes(df, state_ttl_ms=TTL),
        f"WITH {states_sql(ttl_ms=TTL)} SELECT sum({DELTA})::BIGINT AS active_down FROM states",
    ),
    "active_down_series": on(
        alarms(),
        state.active_down_series,
        f"""WITH {states_sql()},
steps AS (SELECT ((event_time + 59999) // 60000) * 60000 AS time_ms, sum({DELTA}) AS d FROM states GROUP BY 1)
SELECT time_ms, (sum(d) OVER (ORDER BY time_ms))::BIGINT AS active_down FROM steps""",
    ),
    "active_down_series_sliced": on(
        alarms(),
        lambda df: state.active_down_series(df, span=FEW_IDS),
        f"""WITH {states_sql()},
steps AS (SELECT ((event_time + 59999) // 60000) * 60000 AS time_ms, sum({DELTA}) AS d FROM states GROUP BY 1)
SELECT time_ms, (sum(d) OVER (ORDER BY time_ms))::BIGINT AS active_down FROM steps""",
    ),
    "state_misses": on(
        alarms(), state.state_misses, f"WITH {states_sql()} SELECT count(*) AS misses FROM states WHERE pt IS NULL"
    ),
    "state_misses_ttl": on(
        alarms(),
        lambda df: state.state_misses(df, state_ttl_ms=TTL),
        f"WITH {states_sql(ttl_ms=TTL)} SELECT count(*) AS misses FROM states WHERE pt IS NULL",
    ),
    "node_flaps": _on_intervals(
        state.node_flaps,
        "SELECT node_id, count(*) AS flaps FROM intervals WHERE duration_ms < 10000 GROUP BY 1",
        "fast",
    ),
    "shard_of": on(
        alarms(),
        lambda df: df.select("node_id").distinct().withColumn("shard", scalar.shard_of(F.col("node_id"))),
        f"WITH {alarms_sql()} SELECT DISTINCT node_id, {SHARD_SQL} AS shard FROM alarms",
    ),
    "shard_balance": on(
        alarms(),
        state.shard_balance,
        f"""WITH {alarms_sql()} SELECT {SHARD_SQL} AS shard, count(*) AS rows, count(DISTINCT node_id) AS nodes
FROM alarms GROUP BY 1""",
    ),
    # questions about outages
    "total_outages": _on_intervals(outages.total_outages, KPI.format("count(*)")),
    "avg_duration": _on_intervals(outages.avg_duration, KPI.format(MEAN_SEC)),
    "max_duration": _on_intervals(outages.max_duration, KPI.format("max(duration_ms) / 1000.0::DOUBLE")),
    "affected_nodes": _on_intervals(outages.affected_nodes, KPI.format("count(DISTINCT node_id)")),
    "uptime_pct": _on_intervals(outages.uptime_pct, KPI.format(UPTIME)),
    "uptime_pct_by_node": _on_intervals(
        outages.uptime_pct_by_node, f"SELECT node_id, {UPTIME} AS uptime_pct FROM intervals GROUP BY 1"
    ),
    "outages_over_time": _on_intervals(
        outages.outages_over_time,
        f"""SELECT down_ms // 60000 * 60000 AS time_ms, count(*) AS outages, {MEAN_SEC} AS avg_duration_sec
FROM intervals GROUP BY 1""",
        "fast",
    ),
    "outages_over_time_in_range": _on_intervals(
        lambda df: outages.outages_over_time(filters.filter_time_range(df, FIRST, LAST)),
        f"""SELECT down_ms // 60000 * 60000 AS time_ms, count(*) AS outages, {MEAN_SEC} AS avg_duration_sec
FROM intervals WHERE down_ms BETWEEN epoch_ms(TIMESTAMP '{FIRST}') AND epoch_ms(TIMESTAMP '{LAST}') GROUP BY 1""",
    ),
    "top_nodes_downtime": _on_intervals(
        outages.top_nodes_downtime,
        """SELECT node_id, count(*) AS outage_count,
  round_even(sum(duration_ms)::DOUBLE / 10, 0) / 100.0::DOUBLE AS total_downtime_sec
FROM intervals GROUP BY 1 ORDER BY total_downtime_sec DESC, node_id LIMIT 15""",
    ),
    "duration_histogram": _on_intervals(
        outages.duration_histogram,
        """SELECT CASE WHEN duration_ms < 500 THEN '1 <0.5s' WHEN duration_ms < 1000 THEN '2 0.5-1s'
  WHEN duration_ms < 2000 THEN '3 1-2s' WHEN duration_ms < 5000 THEN '4 2-5s'
  WHEN duration_ms < 10000 THEN '5 5-10s' WHEN duration_ms < 30000 THEN '6 10-30s'
  WHEN duration_ms < 60000 THEN '7 30-60s' ELSE '8 >60s' END AS bucket, count(*) AS count
FROM intervals GROUP BY 1""",
        "fast",
    ),
    "hourly_pattern": _on_intervals(
        outages.hourly_pattern,
        f"""SELECT down_ms // 3600000 % 24 AS hour_of_day, count(*) AS outage_count, {MEAN_SEC} AS avg_duration_sec
FROM intervals GROUP BY 1""",
    ),
    "recent_outages": _on_intervals(
        outages.recent_outages,
        """SELECT node_id, down_ms AS down_at_ms, up_ms AS up_at_ms, duration_ms / 1000.0::DOUBLE AS duration_sec
FROM intervals ORDER BY down_ms DESC, node_id, up_ms LIMIT 200""",
    ),
    "node_list": _on_intervals(outages.node_list, "SELECT DISTINCT node_id FROM intervals"),
    "max_duration_recent": _on_intervals(
        lambda df: outages.max_duration_recent(df, _newest_end(df)),
        KPI.format("max(duration_ms) / 1000.0::DOUBLE") + " " + RECENT.format(300_000),
        "fast",
    ),
    "outage_count_recent": _on_intervals(
        lambda df: outages.outage_count_recent(df, _newest_end(df)),
        KPI.format("count(*)") + " " + RECENT.format(300_000),
        "fast",
    ),
    "max_outages_per_node": _on_intervals(
        lambda df: outages.max_outages_per_node(df, _newest_end(df)),
        f"""SELECT max(n) AS value FROM
(SELECT node_id, count(*) AS n FROM intervals {RECENT.format(3_600_000)} GROUP BY 1)""",
        "fast",
    ),
    "threshold_band": on(intervals("fast"), _bands, BANDS_SQL),
    "threshold_band_pipeline": Query(_pipeline_bands, PIPELINE_BANDS_SQL),
    # rollup and SLA
    "daily_node_partials": _on_intervals(sla.daily_node_partials, PARTIALS_SQL),
    "daily_node_stats": _on_intervals(lambda df: sla.daily_node_stats(_partials_by_batch(df)), PARTIALS_SQL),
    "node_sla_report": _on_intervals(
        lambda df: sla.node_sla_report(sla.daily_node_partials(df)), SLA_SQL
    ),
}
