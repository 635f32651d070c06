"""Per-node state over alarms in arrival order, as DataFrame windows.

The rule: an alarm closes an outage when it is UP, the alarm of the same node right before
it was DOWN, and its event time is later. Only the directly preceding alarm matters, so a
repeated DOWN moves the start forward, and a late or repeated alarm emits nothing but still
becomes the state. That makes the fold a lag by one, which ``functions.ordered`` computes
without putting a whole node into one task.
"""

from pyspark.sql import Column, DataFrame, functions as F

from downfold.constants import DAY_MS, DOWN_TRAPS, FLAP_MS, SHARDS
from downfold.functions.ordered import lag_in_key, running_sum_in_key
from downfold.functions.scalar import ceil_ms, is_down, shard_of, state_key, utc_day

# Slice spans. Arrival ids are unique, so 4 Mi ids bound a window group to 4 Mi rows.
ID_SPAN = 1 << 22
EVENT_TIME_SPAN_MS = 15 * 60_000


def arrival_column(alarms: DataFrame) -> str:
    """Alarms from a feed go by their place in it, rows of an alarm table by ``id``."""
    return "arrival" if "arrival" in alarms.columns else "id"


def with_previous_state(
    alarms: DataFrame,
    order=None,
    state_ttl_ms: int | None = None,
    span: int | None = ID_SPAN,
    down_traps=DOWN_TRAPS,
) -> DataFrame:
    """Add ``down`` and the previous alarm of the node as struct ``prev(down, event_time)``.

    ``prev`` is null for a node's first alarm, and with ``state_ttl_ms`` also when the state
    was not refreshed for longer than that. Expiry is measured in event time here.
    """
    order = [arrival_column(alarms)] if order is None else [order] if isinstance(order, str) else order
    flagged = alarms.withColumn("down", F.coalesce(is_down(F.col("trap_id"), down_traps), F.lit(False)))
    out = lag_in_key(flagged, ["node_id"], order, ["down", "event_time"], "prev", span)
    if state_ttl_ms is not None:
        alive = F.col("event_time") - F.col("prev.event_time") <= state_ttl_ms
        out = out.withColumn("prev", F.when(alive, F.col("prev")))
    return out


def by_event_time(alarms: DataFrame, span: int = EVENT_TIME_SPAN_MS, **options) -> DataFrame:
    """The same with event-time order (ties by id) instead of arrival order.

    ``span`` is in ms here; ``measured_span`` fits it to the data.
    """
    return with_previous_state(alarms, order=("event_time", "id"), span=span, **options)


def closes_outage() -> Column:
    return F.col("prev.down") & ~F.col("down") & (F.col("event_time") > F.col("prev.event_time"))


def intervals_of(states: DataFrame, *also: Column) -> DataFrame:
    """Outage intervals from alarms that carry their previous state; ``also`` is taken from the closing alarm."""
    duration = F.col("event_time") - F.col("prev.event_time")
    down_at = F.timestamp_millis(F.col("prev.event_time"))
    return states.where(closes_outage()).select(
        "node_id",
        down_at.alias("down_at"),
        F.timestamp_millis(F.col("event_time")).alias("up_at"),
        duration.alias("duration_ms"),
        (duration / 1000.0).alias("duration_sec"),
        utc_day(down_at).alias("down_day"),
        *also,
    )


def downtime_intervals(alarms: DataFrame, **options) -> DataFrame:
    """Closed outages, one row per DOWN alarm directly followed by a later UP alarm."""
    return intervals_of(with_previous_state(alarms, **options))


def latest_node_state(alarms: DataFrame, down_traps=DOWN_TRAPS) -> DataFrame:
    """Current state of each node: status and time of its last alarm by arrival.

    Long and boolean aggregation buffers keep this a hash aggregate with map-side merging.
    """
    down, at = is_down(F.col("trap_id"), down_traps), arrival_column(alarms)
    return (
        alarms.groupBy("node_id")
        .agg(
            F.max_by(down, at).alias("_down"),
            F.max_by("event_time", at).alias("event_time"),
            F.max_by("id", at).alias("id"),
        )
        .select(
            "node_id",
            F.when(F.col("_down"), "DOWN").otherwise("UP").alias("status"),
            F.timestamp_millis("event_time").alias("last_seen_at"),
            "id",
        )
    )


def state_documents(states: DataFrame) -> DataFrame:
    """Node states as key-value pairs: ``node:<id>`` and a JSON document."""
    # Fractions of a second without trailing zeros, as RFC 3339 prints them.
    in_utc = F.to_utc_timestamp("last_seen_at", F.current_timezone())
    at = F.date_format(in_utc, "yyyy-MM-dd'T'HH:mm:ss.SSS")
    at = F.concat(F.regexp_replace(at, r"\.?0+$", ""), F.lit("Z"))
    document = F.to_json(F.struct("status", at.alias("last_seen_at")))
    return states.select(state_key(F.col("node_id")).alias("key"), document.alias("value"))


def transition_of() -> tuple[Column, Column, Column]:
    """(is counted, from, to) of an alarm that carries its previous state."""
    goes_down = F.col("down") & ~F.coalesce(F.col("prev.down"), F.lit(False))
    origin = F.when(F.col("prev").isNull(), "").when(F.col("prev.down"), "DOWN").otherwise("UP")
    target = F.when(F.col("down"), "DOWN").otherwise("UP")
    return goes_down | F.coalesce(closes_outage(), F.lit(False)), origin, target


def transitions_of(states: DataFrame) -> DataFrame:
    counted, origin, target = transition_of()
    return (
        states.where(counted)
        .groupBy("node_id", origin.alias("from_state"), target.alias("to_state"))
        .agg(F.count(F.lit(1)).alias("transitions"))
    )


def state_transitions(alarms: DataFrame, **options) -> DataFrame:
    """Transitions by (node, from, to): into DOWN from anything else, and closed outages.

    An UP alarm of a node that was UP or unknown is not a transition.
    """
    return transitions_of(with_previous_state(alarms, **options))


def down_delta() -> Column:
    """Change of the number of down nodes at an alarm that carries its previous state.

    An UP alarm after DOWN counts down even when its event time is not later. After an
    expired state nothing is counted down, so with a TTL the gauge drifts upward, as the
    running gauge it stands for does; ``latest_node_state`` gives the exact figure.
    """
    was_down = F.coalesce(F.col("prev.down"), F.lit(False))
    return F.when(F.col("down") & ~was_down, 1).when(~F.col("down") & was_down, -1).otherwise(0)


def state_changes(states: DataFrame) -> DataFrame:
    """Only the alarms that change the down-node gauge; every closed outage is among them.

    Write this once where several questions about the same fold follow: ``intervals_of``
    and ``down_series_of`` need nothing else.
    """
    return states.where(down_delta() != 0).select("node_id", "event_time", "down", "prev")


def active_down_nodes(alarms: DataFrame, **options) -> DataFrame:
    """Final value of the down-node gauge, one row."""
    states = with_previous_state(alarms, **options)
    return states.agg(F.coalesce(F.sum(down_delta()), F.lit(0)).cast("long").alias("active_down"))


def down_series_of(states: DataFrame, step_ms: int) -> DataFrame:
    """Gauge at the end of every step in which it could change: (time_ms, active_down)."""
    at = ceil_ms(F.col("event_time"), step_ms)
    changes = states.groupBy(at.alias("time_ms")).agg(F.sum(down_delta()).cast("long").alias("change"))
    return running_sum_in_key(changes, [], "time_ms", "change", "active_down", DAY_MS).drop("change")


def active_down_series(alarms: DataFrame, step_ms: int = 60_000, **options) -> DataFrame:
    """The gauge over time. Alarms are summed into steps before anything runs in order."""
    return down_series_of(with_previous_state(alarms, **options), step_ms)


def state_misses(alarms: DataFrame, **options) -> DataFrame:
    """Number of alarms that found no live previous state, one row."""
    states = with_previous_state(alarms, **options)
    return states.agg(F.count_if(F.col("prev").isNull()).alias("misses"))


def node_flaps(intervals: DataFrame, threshold_ms: int = FLAP_MS) -> DataFrame:
    """Outages shorter than the threshold, per node."""
    short = intervals.where(F.col("duration_ms") < threshold_ms)
    return short.groupBy("node_id").agg(F.count(F.lit(1)).alias("flaps"))


def shard_balance(df: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Rows and nodes per shard. Rows are counted per node first, then nodes are hashed."""
    per_node = df.groupBy("node_id").agg(F.count(F.lit(1)).alias("n"))
    return (
        per_node.groupBy(shard_of(F.col("node_id"), shards).alias("shard"))
        .agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("nodes"))
    )


