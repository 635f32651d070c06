"""Registered queries on metrics, quantiles and alert rules."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from downfold.constants import BATCH_BOUNDS, LATENCY_BOUNDS, OUTAGE_BOUNDS
from downfold.functions.ordered import measured_span
from downfold.functions.quantiles import bucket_histogram, exact_quantiles
from downfold.functions.scalar import hour_of_day
from downfold.operators import alerts, decode, metrics
from downfold.operators.state import (
    active_down_series,
    intervals_of,
    node_flaps,
    state_changes,
    with_previous_state,
)
from downfold.plans.outage_queries import DELTA
from downfold.plans.tables import (
    MESSAGES_SQL,
    Query,
    alarms,
    alarms_sql,
    UNDECODABLE,
    commits,
    commits_sql,
    comparable,
    intervals,
    intervals_sql,
    messages,
    on,
    states_sql,
)
from downfold.session import pin_utc, written
from downfold.sources import testtables

QS = (0.5, 0.95, 0.99)


def _values(numbers, cast: str = "DOUBLE") -> str:
    return ", ".join(f"({n}::{cast})" for n in numbers)


# --- histograms and quantiles in SQL --------------------------------------------------


def histogram_sql(table: str, ms: str, bounds, by: str = "") -> str:
    """CTE ``buckets(by, le, cumulative, sum, count)`` over a ms column."""
    group = f"{by}, " if by else ""
    return f"""bounds(le) AS (VALUES {_values(bounds)}, ('inf'::DOUBLE)),
buckets AS (
  SELECT {group}le, (count(*) FILTER (WHERE {ms} <= le * 1000.0))::BIGINT AS cumulative,
    sum({ms})::DOUBLE / 1000.0::DOUBLE AS sum, count(*) AS count
  FROM {table}, bounds GROUP BY {group}le)"""


def quantile_sql(by: str = "", qs=QS, source: str = "buckets") -> str:
    """Interpolated quantiles from cumulative buckets."""
    group = f"{by}, " if by else ""
    part = f"PARTITION BY {by}" if by else ""
    return f"""SELECT {group}q, CASE WHEN isinf(le) THEN top
  ELSE low + (le - low) * ((q * total - below) / (cumulative - below)) END AS value
FROM (SELECT *, row_number() OVER (PARTITION BY {group}q ORDER BY le) AS rn FROM (
  SELECT *, coalesce(lag(le) OVER w, 0.0::DOUBLE) AS low, coalesce(lag(cumulative) OVER w, 0) AS below,
    max(cumulative) OVER ({part}) AS total, max(le) FILTER (WHERE NOT isinf(le)) OVER ({part}) AS top
  FROM {source} WINDOW w AS ({part} ORDER BY le)), (VALUES {_values(qs)}) AS qs(q)
  WHERE cumulative >= q * total) WHERE rn = 1"""


def exact_quantile_sql(by: str = "") -> str:
    group = f"{by}, " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    return f"""SELECT {group}q, (max(CASE WHEN rn = floor(place) THEN duration_ms END)
  + (max(CASE WHEN rn = ceil(place) THEN duration_ms END) - max(CASE WHEN rn = floor(place) THEN duration_ms END))
  * (any_value(place) - floor(any_value(place)))) / 1000.0::DOUBLE AS value
FROM (SELECT *, q * (n - 1) AS place FROM (
  SELECT *, row_number() OVER ({part}ORDER BY duration_ms) - 1 AS rn, count(*) OVER ({part}) AS n FROM intervals),
  (VALUES {_values(QS)}) AS qs(q))
WHERE rn IN (floor(place), ceil(place)) GROUP BY {group}q"""


# --- rates ----------------------------------------------------------------------------


def rate_sql(table: str, ms: str, window: int, slide: int | None = None, by: str = "", per: str = "1.0") -> str:
    slide = slide or window
    group = f"{by}, " if by else ""
    w, s = window * 1000, slide * 1000
    offsets = f"(SELECT unnest(generate_series(0, {w - s}, {s})) AS o)"
    return f"""SELECT {group}start AS window_start_ms, count(*) AS events,
  count(*) * {per}::DOUBLE / {float(window)}::DOUBLE AS rate
FROM (SELECT *, {ms} // {s} * {s} - o AS start FROM {table}, {offsets}) GROUP BY ALL"""


ACCEPTED = "(SELECT *, 'ok' AS status FROM messages WHERE reject IS NULL AND node_id <> '')"
REJECTED = "(SELECT *, reject AS type, 'kafka' AS operation FROM messages WHERE reject IS NOT NULL)"
UNNAMED = "(SELECT *, 'empty_node_id' AS reason FROM messages WHERE reject IS NULL AND node_id = '')"


def _errors(df: DataFrame) -> DataFrame:
    return decode.reject_malformed(decode.decode_cdc(df)).select(
        "timestamp", F.col("reject").alias("type"), F.lit("kafka").alias("operation")
    )


def _unnamed(df: DataFrame) -> DataFrame:
    plain = decode.decode_cdc(df).where(F.col("reject").isNull() & (F.col("node_id") == ""))
    return plain.select("timestamp", F.lit("empty_node_id").alias("reason"))


def _short(df: DataFrame) -> DataFrame:
    return df.where(F.col("duration_ms") < 10_000)


def _misses(df: DataFrame) -> DataFrame:
    return with_previous_state(df).where(F.col("prev").isNull()).select(
        F.timestamp_millis("event_time").alias("ts")
    )


SAMPLES_SQL = """samples AS (
  SELECT epoch_us(ts) AS us, 'node_work_total' AS metric, 'NODE_' || user_id AS instance,
    CASE event_type WHEN 'view' THEN 'idle' ELSE 'busy' END AS mode, round(value * 100) AS value
  FROM events),
increases AS (
  SELECT *, '{"instance":"' || instance || '","mode":"' || mode || '"}' AS series,
    CASE WHEN value < prev THEN value ELSE value - prev END AS increase
  FROM (SELECT *, lag(value) OVER (PARTITION BY instance, mode ORDER BY us) AS prev FROM samples)
  WHERE prev IS NOT NULL)"""


def _rate_window_sql(seconds: int) -> str:
    return f"us // {seconds * 1_000_000} * {seconds * 1000}"


def _samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testtables.samples(spark, sf_dir)


def _counter_rate(df: DataFrame) -> DataFrame:
    by_us = df.select(F.unix_micros("ts").alias("us"))
    return metrics.counter_rate(df, 3600, measured_span(by_us, "us")).drop("labels")


def _sliding_rates(df: DataFrame) -> DataFrame:
    by_us = df.select(F.unix_micros("ts").alias("us"))
    rates = metrics.counter_rates(df, (60, 120, 300), 60, measured_span(by_us, "us"))
    summed = metrics.sum_by(rates, ["mode"], "increase", also=["window_sec", "window_start"])
    return summed.withColumn("rate", F.col("increase") / F.col("window_sec").cast("double")).drop("increase")


LAG_SQL = "created_ms - event_time"


def _newest(df: DataFrame, column: str):
    return df.agg(F.max(column)).scalar()


def _last_commit(df: DataFrame) -> DataFrame:
    return metrics.staleness(df, "committed_ts", _newest(df, "committed_ts"), ["shard"])


def _worst_commit(df: DataFrame) -> DataFrame:
    return metrics.worst_staleness(df, "committed_ts", _newest(df, "committed_ts"), ["shard"])


def _domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    wide = testtables.cdc_messages(spark, sf_dir, "fast")
    return comparable(metrics.domain_metrics(wide, testtables.alarms(spark, sf_dir, "fast")))


def _domain_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    wide = testtables.cdc_messages(spark, sf_dir, "fast")
    return comparable(metrics.domain_samples(wide, testtables.alarms(spark, sf_dir, "fast")))


def _label_sql(**labels: str) -> str:
    return " || ".join(f"""'{"{" if not i else ","}"{k}":"' || {v} || '"'""" for i, (k, v) in enumerate(sorted(labels.items()))) + " || '}'"


_HEARD = "(epoch_us(ts) // 1000 // 1000)"
_CLOSES = "pd AND NOT down AND event_time > pt"


def _moves_sql(when: str, a: str, b: str) -> str:
    labels = _label_sql(node_id="node_id", from_state=f"'{a}'", to_state=f"'{b}'")
    return f"SELECT 'node_state_transitions_total', {labels}, created_ms, 1 FROM states WHERE {when}"


DOMAIN_SAMPLES_SQL = f"""WITH {states_sql("fast")}, {MESSAGES_SQL},
changes(metric, labels, heard, change) AS (
  SELECT 'messages_total', {_label_sql(topic="topic", status="'ok'")}, {_HEARD}, 1
    FROM messages WHERE reject IS NULL AND node_id <> ''
  UNION ALL SELECT 'errors_total', {_label_sql(type="'json_unmarshal'", operation="'kafka'")}, {_HEARD}, 1
    FROM messages WHERE reject IS NOT NULL
  UNION ALL SELECT 'messages_skipped_total', {_label_sql(reason="'empty_node_id'")}, {_HEARD}, 1
    FROM messages WHERE reject IS NULL AND node_id = ''
  UNION ALL {_moves_sql("down AND pt IS NULL", "", "DOWN")}
  UNION ALL {_moves_sql("down AND NOT pd", "UP", "DOWN")}
  UNION ALL {_moves_sql(_CLOSES, "DOWN", "UP")}
  UNION ALL SELECT 'node_flaps_total', {_label_sql(node_id="node_id")}, created_ms, 1
    FROM states WHERE {_CLOSES} AND event_time - pt < 10000
  UNION ALL SELECT 'cache_misses_total', '{{}}', created_ms, 1 FROM states WHERE pt IS NULL
  UNION ALL SELECT 'interval_records_total', '{{}}', created_ms, 1 FROM states WHERE {_CLOSES}
  UNION ALL SELECT 'active_down_nodes', '{{}}', created_ms, {DELTA} FROM states WHERE {DELTA} <> 0),
steps AS (SELECT metric, labels, heard // 60000 * 60000 + 60000 AS ts_ms, sum(change) AS change FROM changes GROUP BY ALL)
SELECT metric, labels, ts_ms, (sum(change) OVER (PARTITION BY metric, labels ORDER BY ts_ms))::DOUBLE AS value FROM steps"""


DOMAIN_SQL = f"""WITH {states_sql("fast")}, {MESSAGES_SQL},
closed AS (SELECT *, event_time - pt AS ms FROM states WHERE pd AND NOT down AND event_time > pt),
moves AS (
  SELECT node_id, CASE WHEN pt IS NULL THEN '' WHEN pd THEN 'DOWN' ELSE 'UP' END AS a,
    CASE WHEN down THEN 'DOWN' ELSE 'UP' END AS b
  FROM states WHERE (down AND pd IS NOT TRUE) OR (pd AND NOT down AND event_time > pt))
SELECT 'messages_total' AS metric, '{{"status":"ok","topic":"' || topic || '"}}' AS labels,
  (count(*) FILTER (WHERE reject IS NULL AND node_id <> ''))::DOUBLE AS value
  FROM messages GROUP BY topic
UNION ALL SELECT 'errors_total', '{{"operation":"kafka","type":"json_unmarshal"}}', count(*) FROM messages WHERE reject IS NOT NULL
UNION ALL SELECT 'messages_skipped_total', '{{"reason":"empty_node_id"}}', count(*) FROM messages
  WHERE reject IS NULL AND node_id = ''
UNION ALL SELECT 'node_state_transitions_total',
  '{{"from_state":"' || a || '","node_id":"' || node_id || '","to_state":"' || b || '"}}', count(*) FROM moves GROUP BY a, b, node_id
UNION ALL SELECT 'node_flaps_total', '{{"node_id":"' || node_id || '"}}', count(*) FROM closed WHERE ms < 10000 GROUP BY node_id
UNION ALL SELECT 'cache_misses_total', '{{}}', count(*) FROM states WHERE pt IS NULL
UNION ALL SELECT 'active_down_nodes', '{{}}', sum({DELTA}) FROM states
UNION ALL SELECT 'interval_records_total', '{{}}', count(*) FROM closed"""


# --- alert rules ----------------------------------------------------------------------


def _series(spark: SparkSession, sf_dir: str):
    pin_utc(spark)
    table = testtables.alarms(spark, sf_dir, "fast")
    span = written(alerts.plausible_span(table), "span")
    changes = written(state_changes(with_previous_state(table)), "changes")
    commits_df = commits()(spark, sf_dir)
    wide = testtables.cdc_messages(spark, sf_dir, "fast")
    return written(alerts.rule_series(changes, commits_df, table, wide, span), "series"), span


def _evaluate_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    series, span = _series(spark, sf_dir)
    return comparable(alerts.evaluate_rules(alerts.default_rules(spark), series, span))


def _no_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rules on the grid with the value each has there; null is no data."""
    series, span = _series(spark, sf_dir)
    grid = alerts.evaluation_grid(alerts.default_rules(spark), series, span)
    return alerts.no_data_state(grid, series).select("rule", "series", "time_ms", "value")


def _down_over(limit: int, hold_sec: int):
    """One rule on the down-node gauge, evaluated at the steps where the gauge changes."""

    def run(df: DataFrame) -> DataFrame:
        gauge = active_down_series(df).select(
            F.lit("down").alias("rule"),
            F.lit("").alias("series"),
            "time_ms",
            F.col("active_down").cast("double").alias("value"),
        )
        return alerts.alert_state(
            alerts.evaluate_threshold(gauge, "gt", float(limit)), F.lit(hold_sec * 1000)
        ).drop("rule", "series")

    return run


def state_sql(source: str) -> str:
    """Alert states over ``source(rule, series, time_ms, value, breach, for_sec, ...)``."""
    return f"""runs AS (
  SELECT *, sum(CASE WHEN breach THEN 0 ELSE 1 END) OVER (PARTITION BY rule, series ORDER BY time_ms) AS run
  FROM {source}),
held AS (
  SELECT *, min(CASE WHEN breach THEN time_ms END) OVER (PARTITION BY rule, series, run) AS since FROM runs),
stated AS (
  SELECT *, CASE WHEN value IS NULL THEN 'NoData' WHEN NOT breach THEN 'Normal'
    WHEN time_ms - since >= for_sec * 1000 THEN 'Firing' ELSE 'Pending' END AS state FROM held)"""


def _rules_sql() -> str:
    def literal(v):
        return "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)

    rows = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in alerts.RULE_TABLE)
    return f"rules(rule, op, threshold, for_sec, severity, team, summary, no_data_is) AS (VALUES {rows})"


# Each series is stated directly from its meaning at time t, without steps or carrying.
SERIES_SQL = f"""{commits_sql("fast")}, {_rules_sql()},
grid AS (SELECT unnest(generate_series((min(event_time) + 59999) // 60000 * 60000,
  (max(event_time) + 59999) // 60000 * 60000, 60000)) AS t FROM alarms),
errs AS (SELECT epoch_us(ts) // 1000 // 1000 AS ms FROM events WHERE event_id % 50 IN {UNDECODABLE}),
lags AS (
  SELECT (created_ms + 59999) // 60000 * 60000 AS step, {LAG_SQL} AS lag_ms,
    row_number() OVER (ORDER BY (created_ms + 59999) // 60000, id) AS n
  FROM alarms WHERE {LAG_SQL} > 0),
lat AS (SELECT t, committed_ms - created_ms AS ms FROM grid JOIN commits ON committed_ms <= t AND committed_ms > t - 300000),
{histogram_sql("lat", "ms", LATENCY_BOUNDS, "t")},
p95 AS ({quantile_sql("t", (0.95,))}),
per_shard AS (SELECT t, shard, max(committed_ms) AS last FROM grid JOIN commits ON committed_ms <= t GROUP BY ALL),
hour AS (SELECT t, node_id, count(*) AS n FROM grid JOIN intervals ON up_ms <= t AND down_ms >= t - 3600000 GROUP BY ALL),
down AS (SELECT t, sum(d) AS n FROM grid JOIN (SELECT event_time, {DELTA} AS d FROM states) ON event_time <= t GROUP BY t),
rates AS (SELECT t, count(*) / 300.0::DOUBLE AS r FROM grid JOIN errs ON ms <= t AND ms > t - 300000 GROUP BY t),
held_lag AS (SELECT t, arg_max(lag_ms, n) / 1000.0::DOUBLE AS lag FROM grid JOIN lags ON step <= t GROUP BY t),
series AS (
  SELECT 'high_single_outage' AS rule, '' AS series, t, max(duration_ms) / 1000.0::DOUBLE AS value
    FROM grid JOIN intervals ON up_ms <= t AND down_ms >= t - 300000 GROUP BY t
  UNION ALL SELECT 'outage_storm', '', t, count(*) FROM grid JOIN intervals ON up_ms <= t AND down_ms >= t - 300000 GROUP BY t
  UNION ALL SELECT 'node_flapping', '', t, max(n) FROM hour GROUP BY t
  UNION ALL SELECT 'many_nodes_down', '', t, n FROM down
  UNION ALL SELECT 'mass_outage', '', t, n FROM down
  UNION ALL SELECT 'high_error_rate', 'json_unmarshal/kafka', t, r FROM rates
  UNION ALL SELECT 'high_error_rate_sum', '', t, r FROM rates
  UNION ALL SELECT 'consumer_lag', '', t, lag FROM held_lag
  UNION ALL SELECT 'consumer_lag_long', '', t, lag FROM held_lag
  UNION ALL SELECT 'stale_sink', '', t, (t - min(last)) / 1000.0::DOUBLE FROM per_shard GROUP BY t
  UNION ALL SELECT 'slow_commits', '', t, value FROM p95),
keyed AS (SELECT DISTINCT rules.*, coalesce(series.series, '') AS series FROM rules LEFT JOIN series USING (rule)),
filled AS (
  SELECT keyed.*, grid.t AS time_ms, coalesce(series.value, no_data_is)::DOUBLE AS value
  FROM keyed CROSS JOIN grid LEFT JOIN series ON series.rule = keyed.rule AND series.series = keyed.series AND series.t = grid.t)"""

RULES_SQL = f"""WITH {SERIES_SQL},
judged AS (SELECT *, coalesce(value > threshold, false) AS breach FROM filled),
{state_sql("judged")}
SELECT rule, series, time_ms, value, state, '{{"severity":"' || severity || '","team":"' || team || '"}}' AS labels,
  replace(summary, '{{{{ $value }}}}',
    coalesce(printf('%.3f', round_even(value * 1000.0::DOUBLE, 0) / 1000.0::DOUBLE), 'no data')) AS summary
FROM stated"""

GAUGE_SQL = f"""{states_sql()},
steps AS (SELECT ((event_time + 59999) // 60000) * 60000 AS time_ms, sum({DELTA}) AS d FROM states GROUP BY 1),
gauge AS (SELECT 'down' AS rule, '' AS series, time_ms, (sum(d) OVER (ORDER BY time_ms))::DOUBLE AS value FROM steps)"""


def _annotated(df: DataFrame) -> DataFrame:
    """The rendered text of one rule for the worst outage of every node."""
    worst = df.groupBy("node_id").agg((F.max("duration_ms") / 1000.0).alias("value"))
    states = worst.select(
        "node_id",
        "value",
        F.lit("critical").alias("severity"),
        F.lit("sre").alias("team"),
        F.lit("Node outage of {{ $value }} s").alias("summary"),
    )
    return alerts.render_annotations(states).drop("severity", "team")


QUERIES = {
    "event_rate": on(
        messages(),
        lambda df: metrics.event_rate(
            decode.skip_empty_node(decode.decode_cdc(df)).withColumn("status", F.lit("ok")),
            "timestamp", 60, by=["topic", "status"],
        ),
        f"WITH {MESSAGES_SQL} {rate_sql(ACCEPTED, 'event_time', 60, by='topic, status')}",
    ),
    "event_rate_sliding": on(
        messages(),
        lambda df: metrics.event_rate(_errors(df), "timestamp", 300, 60, by=["type", "operation"]),
        f"WITH {MESSAGES_SQL} {rate_sql(REJECTED, 'event_time', 300, 60, by='type, operation')}",
    ),
    "event_rate_skipped": on(
        messages(),
        lambda df: metrics.event_rate(_unnamed(df), "timestamp", 60, by=["reason"]),
        f"WITH {MESSAGES_SQL} {rate_sql(UNNAMED, 'event_time', 60, by='reason')}",
    ),
    "event_rate_intervals": on(
        intervals("fast"),
        lambda df: metrics.event_rate(df, "up_at", 60),
        f"WITH {intervals_sql('fast')} {rate_sql('intervals', 'up_ms', 60)}",
    ),
    "event_rate_flaps_per_minute": on(
        intervals("fast"),
        lambda df: metrics.event_rate(_short(df), "up_at", 60, per_sec=60.0),
        f"""WITH {intervals_sql('fast')}
{rate_sql('(SELECT * FROM intervals WHERE duration_ms < 10000)', 'up_ms', 60, per='60.0')}""",
    ),
    "event_rate_state_misses": on(
        alarms(),
        lambda df: metrics.event_rate(_misses(df), "ts", 60),
        f"WITH {states_sql()} {rate_sql('(SELECT * FROM states WHERE pt IS NULL)', 'event_time', 60)}",
    ),
    "counter_rate": on(
        _samples,
        _counter_rate,
        f"""WITH {SAMPLES_SQL} SELECT metric, series, {_rate_window_sql(3600)} AS window_start_ms,
  sum(increase) AS increase, sum(increase) / 3600.0::DOUBLE AS rate FROM increases GROUP BY ALL""",
    ),
    # sum by (mode) of the rate over 1, 2 and 5 minutes, every minute
    "counter_rate_sliding": on(
        _samples,
        _sliding_rates,
        f"""WITH {SAMPLES_SQL}, lengths(window_sec) AS (VALUES (60), (120), (300)),
steps AS (SELECT mode, {_rate_window_sql(60)} AS step, sum(increase) AS increase FROM increases GROUP BY ALL)
SELECT mode, window_sec::BIGINT AS window_sec, start AS window_start_ms, sum(increase) / window_sec::DOUBLE AS rate
FROM (SELECT mode, increase, window_sec, unnest(generate_series(step - window_sec * 1000 + 60000, step, 60000)) AS start
  FROM steps, lengths) GROUP BY mode, window_sec, start""",
    ),
    "sum_by": on(
        _samples,
        lambda df: metrics.sum_by(metrics.counter_rate(df, 3600), ["mode"], "increase", also=["window_start"]),
        f"""WITH {SAMPLES_SQL} SELECT {_rate_window_sql(3600)} AS window_start_ms, mode, sum(increase) AS increase
FROM increases GROUP BY ALL""",
    ),
    "avg_by": on(
        _samples,
        lambda df: metrics.avg_by(df, ["instance"]),
        f"WITH {SAMPLES_SQL} SELECT instance, avg(value) AS value FROM samples GROUP BY 1",
    ),
    "min_by_metric": on(
        _samples,
        metrics.min_by_metric,
        f"WITH {SAMPLES_SQL} SELECT metric, min(value) AS value FROM samples GROUP BY 1",
    ),
    "bucket_histogram": on(
        intervals("fast"),
        metrics.outage_histogram,
        f"WITH {intervals_sql('fast')}, {histogram_sql('intervals', 'duration_ms', OUTAGE_BOUNDS)} SELECT * FROM buckets",
    ),
    "bucket_histogram_batch_sizes": on(
        commits(),
        lambda df: bucket_histogram(metrics.batch_sizes(df), "records", BATCH_BOUNDS, ["shard"]),
        f"""WITH {commits_sql()}, bounds(le) AS (VALUES {_values(BATCH_BOUNDS)}, ('inf'::DOUBLE)),
sizes AS (SELECT shard, batch_id, count(*) AS n FROM commits GROUP BY ALL)
SELECT shard, le, count(*) FILTER (WHERE n <= le) AS cumulative, sum(n)::DOUBLE AS sum, count(*) AS count
FROM sizes, bounds GROUP BY ALL""",
    ),
    "histogram_quantile": on(
        intervals("fast"),
        metrics.outage_quantiles,
        f"""WITH {intervals_sql('fast')}, {histogram_sql('intervals', 'duration_ms', OUTAGE_BOUNDS)}
{quantile_sql()}""",
    ),
    "histogram_quantile_by_hour": on(
        lambda spark, sf_dir: intervals()(spark, sf_dir).withColumn("hour", hour_of_day(F.col("down_at"))),
        lambda df: metrics.outage_quantiles(df, by=["hour"]),
        f"""WITH {intervals_sql()}, hours AS (SELECT *, down_ms // 3600000 % 24 AS hour FROM intervals),
{histogram_sql('hours', 'duration_ms', OUTAGE_BOUNDS, 'hour')} {quantile_sql('hour')}""",
    ),
    "exact_quantiles": on(
        intervals(),
        lambda df: exact_quantiles(df, "duration_ms", QS).withColumn("value", F.col("value") / 1000.0),
        f"WITH {intervals_sql()} {exact_quantile_sql()}",
    ),
    "exact_quantiles_by_node": on(
        intervals(),
        lambda df: exact_quantiles(df, "duration_ms", QS, ["node_id"]).withColumn("value", F.col("value") / 1000.0),
        f"WITH {intervals_sql()} {exact_quantile_sql('node_id')}",
    ),
    "ratio_of_sums": on(
        commits(),
        lambda df: metrics.ratio_of_sums(metrics.batch_sizes(df), "records", "batches", ["shard"]),
        f"""WITH {commits_sql()} SELECT shard, count(*)::DOUBLE / count(DISTINCT batch_id) AS ratio
FROM commits GROUP BY 1""",
    ),
    "staleness": on(
        commits(),
        _last_commit,
        f"""WITH {commits_sql()} SELECT shard, ((SELECT max(committed_ms) FROM commits) - max(committed_ms)) / 1000.0::DOUBLE
  AS stale_sec FROM commits GROUP BY 1""",
    ),
    "worst_staleness": on(
        commits(),
        _worst_commit,
        f"""WITH {commits_sql()}, per AS (SELECT shard, max(committed_ms) AS last FROM commits GROUP BY 1)
SELECT (max(last) - min(last)) / 1000.0::DOUBLE AS stale_sec FROM per""",
    ),
    "ingest_lag": on(
        alarms("late"),
        lambda df: metrics.ingest_lag(df).select("id", "lag_ms"),
        f"WITH {alarms_sql('late')} SELECT id, {LAG_SQL} AS lag_ms FROM alarms",
    ),
    "ingest_lag_gauge": on(
        alarms("late"),
        lambda df: metrics.ingest_lag_gauge(df, ["node_id"]),
        f"""WITH {alarms_sql('late')} SELECT node_id, arg_max({LAG_SQL}, id) / 1000.0::DOUBLE AS lag_sec
FROM alarms WHERE {LAG_SQL} > 0 GROUP BY 1""",
    ),
    "e2e_latency": on(
        commits(),
        lambda df: metrics.e2e_histogram(df, ["shard"]),
        f"""WITH {commits_sql()}, lat AS (SELECT shard, committed_ms - created_ms AS ms FROM commits),
{histogram_sql('lat', 'ms', LATENCY_BOUNDS, 'shard')} SELECT * FROM buckets""",
    ),
    "e2e_quantiles": on(
        commits(),
        lambda df: metrics.e2e_quantiles(df, by=["shard"]),
        f"""WITH {commits_sql()}, lat AS (SELECT shard, committed_ms - created_ms AS ms FROM commits),
{histogram_sql('lat', 'ms', LATENCY_BOUNDS, 'shard')} {quantile_sql('shard')}""",
    ),
    "last_value": on(
        _samples,
        lambda df: metrics.last_value(df, ["instance", "mode"]),
        f"""WITH {SAMPLES_SQL} SELECT metric, instance, mode, arg_max(value, us) AS value
FROM samples WHERE value IS NOT NULL GROUP BY ALL""",
    ),
    "reduce_last": on(
        _samples,
        lambda df: alerts.reduce_last(
            df.withColumn("instance", metrics.label("instance")), _newest(df, "ts"), 172_800, ["instance"]
        ),
        f"""WITH {SAMPLES_SQL} SELECT instance, arg_max(value, us) AS value FROM samples
WHERE us >= (SELECT max(us) FROM samples) - 172800000000 GROUP BY 1""",
    ),
    "health_score": on(
        messages(),
        lambda df: metrics.health_score(metrics.event_rate(_errors(df), "timestamp", 300, fill=True)),
        f"""WITH {MESSAGES_SQL}, counted AS ({rate_sql(REJECTED, 'event_time', 300)}),
every AS (SELECT unnest(generate_series((SELECT min(window_start_ms) FROM counted),
  (SELECT max(window_start_ms) FROM counted), 300000)) AS window_start_ms)
SELECT window_start_ms, coalesce(events, 0)::BIGINT AS events, coalesce(rate, 0.0)::DOUBLE AS rate,
  100.0::DOUBLE - coalesce(rate, 0.0)::DOUBLE * 10.0::DOUBLE AS health
FROM every LEFT JOIN counted USING (window_start_ms)""",
    ),
    "idle_to_busy_pct": on(
        _samples,
        lambda df: metrics.idle_to_busy_pct(df, 3600),
        f"""WITH {SAMPLES_SQL} SELECT {_rate_window_sql(3600)} AS window_start_ms, instance,
  100.0::DOUBLE - sum(increase) / 3600.0::DOUBLE * 100.0::DOUBLE AS busy_pct
FROM increases WHERE mode = 'idle' GROUP BY ALL""",
    ),
    "compare_filter": on(
        intervals("fast"),
        lambda df: metrics.compare_filter(node_flaps(df), "ge", 5.0, "flaps"),
        f"""WITH {intervals_sql('fast')} SELECT node_id, count(*) AS flaps FROM intervals
WHERE duration_ms < 10000 GROUP BY 1 HAVING count(*) >= 5""",
    ),
    "domain_metrics": Query(_domain, DOMAIN_SQL),
    "domain_metrics_over_time": Query(_domain_samples, DOMAIN_SAMPLES_SQL),
    "evaluate_threshold": on(
        intervals("fast"),
        lambda df: alerts.evaluate_threshold(
            df.groupBy("node_id").agg((F.max("duration_ms") / 1000.0).alias("value")), "gt", 10.0
        ),
        f"""WITH {intervals_sql('fast')} SELECT node_id, max(duration_ms) / 1000.0::DOUBLE AS value,
  max(duration_ms) > 10000 AS breach FROM intervals GROUP BY 1""",
    ),
    "alert_state": on(
        alarms(),
        _down_over(50, 1800),
        f"""WITH {GAUGE_SQL}, judged AS (SELECT *, value > 50 AS breach, 1800 AS for_sec FROM gauge),
{state_sql("judged")} SELECT time_ms, value, breach, state FROM stated""",
    ),
    "no_data_state": Query(_no_data, f"WITH {SERIES_SQL} SELECT rule, series, time_ms, value FROM filled"),
    "render_annotations": on(
        intervals("fast"),
        _annotated,
        f"""WITH {intervals_sql('fast')} SELECT node_id, max(duration_ms) / 1000.0::DOUBLE AS value,
  '{{"severity":"critical","team":"sre"}}' AS labels,
  'Node outage of ' || printf('%.3f', max(duration_ms) / 1000.0::DOUBLE) || ' s' AS summary
FROM intervals GROUP BY 1""",
    ),
    "evaluate_rules": Query(_evaluate_rules, RULES_SQL),
}
