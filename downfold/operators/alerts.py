"""Alert rules evaluated over a time grid.

A series is a long table ``(rule, series, time_ms, value)`` with one row per evaluation
time. All sizes here follow the length of the grid, not the number of alarms: alarms are
reduced to grid steps before any rule looks at them.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from downfold.constants import DAY_MS, LATENCY_BOUNDS, SHARDS, STATE_TTL_MS
from downfold.functions.ordered import lag_in_key, running_max_in_key, running_sum_in_key
from downfold.functions.quantiles import bucket_histogram, histogram_quantile
from downfold.functions.scalar import ceil_ms, floor_ms, round_half_even
from downfold.operators.decode import decode_cdc, reject_malformed
from downfold.operators.metrics import compare, e2e_latency, ingest_lag
from downfold.operators.state import down_delta, intervals_of
from downfold.schemas import RULES

KEY = ["rule", "series"]

MINUTE = 60_000
RECENT = 5 * MINUTE
HOUR = 60 * MINUTE

# Rule bindings (fixed values): condition, hold time, labels, text. ``no_data_is`` is the value
# of an empty window; None means the rule has no data then.
RULE_TABLE = [
    # rule, op, threshold, for_sec, severity, team, summary, no_data_is
    ("high_single_outage", "gt", 10.0, 60, "critical", "sre", "Node outage of {{ $value }} s, limit 10 s", 0.0),
    ("outage_storm", "gt", 20.0, 120, "warning", "sre", "{{ $value }} outages in 5 minutes", 0.0),
    ("node_flapping", "gt", 5.0, 300, "warning", "sre", "One node was down {{ $value }} times in an hour", 0.0),
    ("many_nodes_down", "gt", 50.0, 300, "warning", "", "{{ $value }} nodes are down", 0.0),
    ("mass_outage", "gt", 100.0, 60, "critical", "nms-platform", "{{ $value }} nodes are down", 0.0),
    ("high_error_rate", "gt", 5.0, 120, "critical", "", "{{ $value }} errors per second", 0.0),
    ("high_error_rate_sum", "gt", 5.0, 120, "warning", "nms-platform", "{{ $value }} errors per second", 0.0),
    ("consumer_lag", "gt", 30.0, 120, "critical", "", "Consumer is {{ $value }} s behind", None),
    ("consumer_lag_long", "gt", 30.0, 180, "warning", "nms-platform", "Consumer is {{ $value }} s behind", None),
    ("stale_sink", "gt", 60.0, 60, "critical", "nms-platform", "Last commit {{ $value }} s ago", None),
    ("slow_commits", "gt", 10.0, 180, "warning", "nms-platform", "p95 to commit is {{ $value }} s", None),
]


def default_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RULE_TABLE, RULES)


# --- evaluation steps -----------------------------------------------------------------


def evaluate_threshold(series: DataFrame, op: str, threshold: float, value: str = "value") -> DataFrame:
    """Add ``breach``; a missing value never breaches."""
    return series.withColumn("breach", F.coalesce(compare(F.col(value), op, F.lit(threshold)), F.lit(False)))


def evaluate_thresholds(series: DataFrame) -> DataFrame:
    """The same with operator and threshold taken from columns ``op`` and ``threshold``."""
    value, limit = F.col("value"), F.col("threshold")
    chain = F.lit(False)
    for op in ("gt", "ge", "lt", "le", "eq", "ne"):
        chain = F.when(F.col("op") == op, compare(value, op, limit)).otherwise(chain)
    return series.withColumn("breach", F.coalesce(chain, F.lit(False)))


def reduce_last(series: DataFrame, as_of: Column, lookback_sec: int, by: Sequence[str] = ()) -> DataFrame:
    """Last sample of each series that is not older than the lookback."""
    since = as_of - F.expr(f"INTERVAL {int(lookback_sec)} SECONDS")
    # bare column against bounds, so that both reach the scan
    recent = series.where(F.col("value").isNotNull() & (F.col("ts") >= since) & (F.col("ts") <= as_of))
    return recent.groupBy(*by).agg(F.max_by("value", F.unix_micros("ts")).alias("value"))


def alert_state(series: DataFrame, for_ms: Column | None = None) -> DataFrame:
    """Add ``state`` to rows with ``value`` and ``breach``: NoData, Normal, Pending, Firing.

    A breach fires once it has held without a break for the hold time. The start of a run
    is the latest row at which the breach began, a running maximum; both steps run over
    day-long slices of the grid, so a long grid is not one task.
    """
    hold = F.col("for_sec") * 1000 if for_ms is None else for_ms
    seen = lag_in_key(series, KEY, ["time_ms"], ["breach"], "_prev", DAY_MS)
    begins = F.col("breach") & ~F.coalesce(F.col("_prev.breach"), F.lit(False))
    marked = seen.withColumn("_begin", F.when(begins, F.col("time_ms"))).drop("_prev")
    held = running_max_in_key(marked, KEY, "time_ms", "_begin", "_since", DAY_MS)
    state = (
        F.when(F.col("value").isNull(), "NoData")
        .when(~F.col("breach"), "Normal")
        .when(F.col("time_ms") - F.col("_since") >= hold, "Firing")
        .otherwise("Pending")
    )
    return held.withColumn("state", state).drop("_begin", "_since")


def no_data_state(grid: DataFrame, series: DataFrame) -> DataFrame:
    """Series on every evaluation time of the grid; gaps take the rule's ``no_data_is``."""
    return (
        grid.join(series, [*KEY, "time_ms"], "left")
        .withColumn("value", F.coalesce(F.col("value"), F.col("no_data_is")))
        .drop("no_data_is")
    )


def render_annotations(states: DataFrame) -> DataFrame:
    """Put the value into the summary and collect severity and team as labels."""
    number = F.format_string("%.3f", round_half_even(F.col("value"), 3))
    shown = F.when(F.col("value").isNotNull(), number).otherwise("no data")
    labels = F.create_map(F.lit("severity"), F.col("severity"), F.lit("team"), F.col("team"))
    return states.withColumns(
        {"summary": F.replace(F.col("summary"), F.lit("{{ $value }}"), shown), "labels": labels}
    )


# --- the grid and the series of the rules ---------------------------------------------


def _unfold_times(df: DataFrame, step_ms: int) -> DataFrame:
    """Replace ``start_ms, end_ms`` by one row per evaluation time, unfolded day by day."""
    first, last = ceil_ms(F.col("start_ms"), step_ms), ceil_ms(F.col("end_ms"), step_ms)
    day_starts = F.sequence(floor_ms(first, DAY_MS), floor_ms(last, DAY_MS), F.lit(DAY_MS))
    days = df.withColumn("_day", F.explode(day_starts))
    start = F.greatest(first, ceil_ms(F.col("_day"), step_ms))
    end = F.least(last, F.col("_day") + DAY_MS - 1)
    times = F.explode(F.sequence(start, end, F.lit(step_ms)))
    return days.where(start <= end).withColumn("time_ms", times).drop("start_ms", "end_ms", "_day")


def checked_step(step_ms: int) -> int:
    """Windows are sums of steps, so a step must divide the shortest of them."""
    if step_ms <= 0 or RECENT % step_ms:
        raise ValueError(f"an evaluation step must divide {RECENT} ms")
    return step_ms


def plausible_span(alarms: DataFrame, slack_ms: int = STATE_TTL_MS) -> DataFrame:
    """(start_ms, end_ms) of the alarms whose clocks can be right, as a one-row table.

    An alarm counts if it happened within ``slack_ms`` of the time it reached the feed, or if
    that time is not known. So one device that reports the year 1970 does not stretch the
    grid of every rule over half a century. Both are null if no alarm counts.
    """
    off = F.abs(F.col("event_time") - F.unix_millis("created_at"))
    right = alarms.where(F.coalesce(off <= slack_ms, F.col("created_at").isNull()))
    return right.agg(F.min("event_time").alias("start_ms"), F.max("event_time").alias("end_ms"))


def evaluation_times(span: DataFrame, step_ms: int = MINUTE) -> DataFrame:
    """Evaluation times from a one-row table ``(start_ms, end_ms)``."""
    return _unfold_times(span.select("start_ms", "end_ms"), step_ms)


def evaluation_grid(rules: DataFrame, series: DataFrame, span: DataFrame, step_ms: int = MINUTE) -> DataFrame:
    """Every rule and series at every evaluation time of ``span``, with the rule's columns.

    A rule without any series gets one empty-named series, so that it can report NoData.
    """
    known = series.select(*KEY).distinct()
    keyed = rules.join(known, "rule", "left").withColumn("series", F.coalesce("series", F.lit("")))
    bounds = [span.select(name).scalar().alias(name) for name in ("start_ms", "end_ms")]
    return _unfold_times(keyed.select("*", *bounds), step_ms)


def _rows(df: DataFrame, **rules: str) -> DataFrame:
    """Unfold value columns into (rule, series, time_ms, value) rows."""
    series = F.col("series") if "series" in df.columns else F.lit("")
    structs = [
        F.struct(F.lit(rule).alias("rule"), F.col(column).cast("double").alias("value"))
        for rule, column in rules.items()
    ]
    return (
        df.select(series.alias("series"), "time_ms", F.explode(F.array(*structs)).alias("_r"))
        .select(F.col("_r.rule").alias("rule"), "series", "time_ms", F.col("_r.value").alias("value"))
        .where(F.col("value").isNotNull())
    )


def recent_outage_series(intervals: DataFrame, step_ms: int = MINUTE) -> DataFrame:
    """Longest outage and count over 5 minutes, and most outages of one node over an hour.

    An outage counts at time t once it has ended (up_at <= t) and while its start lies in
    the lookback (down_at >= t - lookback).
    """
    checked_step(step_ms)
    ended = ceil_ms(F.unix_millis("up_at"), step_ms)
    began = floor_ms(F.unix_millis("down_at"), step_ms)
    steps = intervals.select("node_id", "duration_ms", ended.alias("_from"), began.alias("_began"))
    return _fleet_over_5m(steps, step_ms).unionByName(_busiest_node_over_1h(steps, step_ms))


def _fleet_over_5m(steps: DataFrame, step_ms: int) -> DataFrame:
    """Outages are merged per pair of steps before they are repeated for their times."""
    merged = (
        steps.where(F.col("_from") <= F.col("_began") + RECENT)
        .groupBy("_from", "_began")
        .agg(F.count(F.lit(1)).alias("_n"), F.max("duration_ms").alias("_ms"))
    )
    times = F.explode(F.sequence(F.col("_from"), F.col("_began") + RECENT, F.lit(step_ms)))
    fleet = (
        merged.withColumn("time_ms", times)
        .groupBy("time_ms")
        .agg((F.max("_ms") / 1000.0).alias("longest"), F.sum("_n").alias("count"))
    )
    return _rows(fleet, high_single_outage="longest", outage_storm="count")


def _busiest_node_over_1h(steps: DataFrame, step_ms: int) -> DataFrame:
    """The highest per-node count at each time, from the times at which counts change.

    Each outage adds one when it ends and takes one away when its start leaves the hour.
    The running sum gives every node's count as stretches of equal value; only those are
    unfolded to times, and the maximum over nodes is merged before any shuffle. A change of
    0 at the start of a day closes the stretch of the day before; no count outlives the
    first hour of a day without a change in that day.
    """
    gone = F.col("_began") + HOUR + step_ms
    changes = F.array(
        F.struct(F.col("_from").alias("time_ms"), F.lit(1).alias("change")),
        F.struct(gone.alias("time_ms"), F.lit(-1).alias("change")),
        F.struct(floor_ms(F.col("_from"), DAY_MS).alias("time_ms"), F.lit(0).alias("change")),
        F.struct(floor_ms(gone, DAY_MS).alias("time_ms"), F.lit(0).alias("change")),
    )
    per_node = (
        steps.where(F.col("_from") <= F.col("_began") + HOUR)
        .select("node_id", F.explode(changes).alias("_c"))
        .groupBy("node_id", F.col("_c.time_ms").alias("time_ms"))
        .agg(F.sum("_c.change").alias("change"))
    )
    counts = running_sum_in_key(per_node, ["node_id"], "time_ms", "change", "_n", DAY_MS, "_next")
    until = F.coalesce(F.col("_next"), floor_ms(F.col("time_ms"), DAY_MS) + DAY_MS) - 1
    stretch = F.explode(F.sequence(ceil_ms(F.col("time_ms"), step_ms), until, F.lit(step_ms)))
    busiest = (
        counts.where((F.col("_n") > 0) & (ceil_ms(F.col("time_ms"), step_ms) <= until))
        .select(stretch.alias("time_ms"), "_n")
        .groupBy("time_ms")
        .agg(F.max("_n").alias("per_node"))
    )
    return _rows(busiest, node_flapping="per_node")


def down_node_series(changes: DataFrame, times: DataFrame, step_ms: int = MINUTE) -> DataFrame:
    """The down-node gauge at every evaluation time."""
    at = ceil_ms(F.col("event_time"), step_ms)
    summed = changes.groupBy(at.alias("time_ms")).agg(F.sum(down_delta()).cast("long").alias("change"))
    filled = summed.unionByName(times.select("time_ms", F.lit(0).cast("long").alias("change")))
    steps = filled.groupBy("time_ms").agg(F.sum("change").alias("change"))
    gauge = running_sum_in_key(steps, [], "time_ms", "change", "down", DAY_MS)
    return _rows(gauge, many_nodes_down="down", mass_outage="down")


def _sliding(steps: DataFrame, lookback_ms: int, step_ms: int) -> DataFrame:
    """Repeat step rows (``time_ms``) for the evaluation times whose lookback holds them."""
    checked_step(step_ms)
    times = F.sequence(F.col("time_ms"), F.col("time_ms") + lookback_ms - step_ms, F.lit(step_ms))
    return steps.withColumn("time_ms", F.explode(times))


def error_rate_series(messages: DataFrame, step_ms: int = MINUTE) -> DataFrame:
    """Undecodable messages per second over 5 minutes, per (type, operation) and summed."""
    at = ceil_ms(F.unix_millis("timestamp"), step_ms)
    steps = (
        reject_malformed(decode_cdc(messages))
        .groupBy(F.col("reject").alias("type"), F.lit("kafka").alias("operation"), at.alias("time_ms"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    counted = _sliding(steps, RECENT, step_ms).groupBy("type", "operation", "time_ms").agg(F.sum("_n").alias("_n"))
    per_series = counted.select(
        F.concat_ws("/", "type", "operation").alias("series"),
        "time_ms",
        (F.col("_n") / (RECENT / 1000.0)).alias("rate"),
    )
    summed = counted.groupBy("time_ms").agg((F.sum("_n") / (RECENT / 1000.0)).alias("rate"))
    return _rows(per_series, high_error_rate="rate").unionByName(_rows(summed, high_error_rate_sum="rate"))


def lag_series(alarms: DataFrame, times: DataFrame, step_ms: int = MINUTE) -> DataFrame:
    """Ingest lag of the newest alarm that arrived late, held until the next one."""
    at = ceil_ms(F.unix_millis("created_at"), step_ms)
    late = ingest_lag(alarms).where(F.col("lag_ms") > 0)
    latest = late.groupBy(at.alias("time_ms")).agg((F.max_by("lag_ms", "id") / 1000.0).alias("lag"))
    known = latest.select("time_ms", F.col("time_ms").alias("_at"))
    both = known.unionByName(times.select("time_ms", F.lit(None).cast("long").alias("_at")))
    steps = both.groupBy("time_ms").agg(F.max("_at").alias("_at"))
    held = running_max_in_key(steps, [], "time_ms", "_at", "_from", DAY_MS)
    joined = held.select("time_ms", F.col("_from")).join(
        latest.withColumnRenamed("time_ms", "_from"), "_from"
    )
    return _rows(joined, consumer_lag="lag", consumer_lag_long="lag")


def stale_sink_series(commits: DataFrame, times: DataFrame, shards: int = SHARDS, step_ms: int = MINUTE) -> DataFrame:
    """Seconds since the last commit of the shard that has waited longest."""
    at = ceil_ms(F.unix_millis("committed_ts"), step_ms)
    last = commits.groupBy("shard", at.alias("time_ms")).agg(F.max(F.unix_millis("committed_ts")).alias("_last"))
    every_shard = F.explode(F.array(*[F.lit(i) for i in range(shards)]))
    grid = times.select(every_shard.alias("shard"), "time_ms", F.lit(None).cast("long").alias("_last"))
    steps = last.unionByName(grid).groupBy("shard", "time_ms").agg(F.max("_last").alias("_last"))
    held = running_max_in_key(steps, ["shard"], "time_ms", "_last", "_seen", DAY_MS)
    stale = held.groupBy("time_ms").agg(((F.col("time_ms") - F.min("_seen")) / 1000.0).alias("stale"))
    return _rows(stale, stale_sink="stale")


def commit_latency_series(commits: DataFrame, step_ms: int = MINUTE, q: float = 0.95) -> DataFrame:
    """Quantile of the time from creation to commit over 5 minutes."""
    at = ceil_ms(F.unix_millis("committed_ts"), step_ms)
    steps = bucket_histogram(
        e2e_latency(commits).withColumn("time_ms", at), "latency_ms", LATENCY_BOUNDS, ["time_ms"], unit=1000.0
    )
    sliding = _sliding(steps, RECENT, step_ms).groupBy("time_ms", "le").agg(F.sum("cumulative").alias("cumulative"))
    return _rows(histogram_quantile(sliding, [q], ["time_ms"]), slow_commits="value")


def rule_series(
    changes: DataFrame,
    commits: DataFrame,
    alarms: DataFrame,
    messages: DataFrame,
    span: DataFrame,
    step_ms: int = MINUTE,
) -> DataFrame:
    """The series of all rules, from ``state_changes``, interval commits, alarms and messages."""
    times = evaluation_times(span, checked_step(step_ms))
    parts = [
        recent_outage_series(intervals_of(changes), step_ms),
        down_node_series(changes, times, step_ms),
        error_rate_series(messages, step_ms),
        lag_series(alarms, times, step_ms),
        stale_sink_series(commits, times, step_ms=step_ms),
        commit_latency_series(commits, step_ms),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def evaluate_rules(rules: DataFrame, series: DataFrame, span: DataFrame, step_ms: int = MINUTE) -> DataFrame:
    """One row per (rule, series, evaluation time) with value, state and rendered text.

    ``series`` is read twice, for its names and its values; pass a written table.
    """
    grid = evaluation_grid(rules, series, span, step_ms)
    states = alert_state(evaluate_thresholds(no_data_state(grid, series)))
    return render_annotations(states).select(
        "rule", "series", "time_ms", "value", "state", "labels", "summary"
    )
