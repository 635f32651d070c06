"""Metric operators over event tables and over samples ``(ts, metric, labels, value)``."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from downfold.constants import FLAP_MS, LATENCY_BOUNDS, OUTAGE_BOUNDS
from downfold.functions.ordered import lag_in_key
from downfold.functions.quantiles import bucket_histogram, histogram_quantile
from downfold.functions.scalar import floor_ms
from downfold.operators.decode import decode_cdc
from downfold.operators.state import closes_outage, down_delta, with_previous_state

HOUR_US = 3_600_000_000


def event_rate(
    df: DataFrame,
    ts: str,
    window_sec: int,
    slide_sec: int | None = None,
    by: Sequence[str] = (),
    per_sec: float = 1.0,
    fill: bool = False,
) -> DataFrame:
    """Events per second in each window, optionally per label; ``per_sec=60`` is per minute.

    With ``fill``, windows without events between a label's first and last one count 0.

    For sliding windows events are first counted into slide-sized steps, and only those
    counts are repeated for the windows they belong to, not the events.
    """
    slide_sec = slide_sec or window_sec
    if window_sec % slide_sec:
        raise ValueError("the window must be a multiple of the slide")
    slide, window = slide_sec * 1000, window_sec * 1000
    by = list(by)
    steps = (
        df.where(F.col(ts).isNotNull())
        .groupBy(*by, floor_ms(F.unix_millis(ts), slide).alias("_step"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    if slide == window:
        counted = steps.withColumnsRenamed({"_step": "_start", "_n": "events"})
    else:
        starts = F.sequence(F.col("_step") - (window - slide), F.col("_step"), F.lit(slide))
        counted = (
            steps.withColumn("_start", F.explode(starts))
            .groupBy(*by, "_start")
            .agg(F.sum("_n").alias("events"))
        )
    if fill:
        bounds = counted.groupBy(*by).agg(F.min("_start").alias("_low"), F.max("_start").alias("_high"))
        every = F.explode(F.sequence("_low", "_high", F.lit(slide))).alias("_start")
        empty = bounds.where(F.col("_low").isNotNull()).select(*by, every, F.lit(0).cast("long").alias("events"))
        counted = counted.unionByName(empty).groupBy(*by, "_start").agg(F.sum("events").alias("events"))
    return counted.select(
        *by,
        F.timestamp_millis("_start").alias("window_start"),
        "events",
        (F.col("events") * per_sec / float(window_sec)).alias("rate"),
    )


def series_entries(labels: Column) -> Column:
    """Label set as a sorted array of entries, equal for equal sets; a key to group by."""
    return F.sort_array(F.map_entries(labels))


def series_key(labels: Column) -> Column:
    """The same as JSON text. Slower than entries; meant for finished rows."""
    return F.to_json(F.map_from_entries(series_entries(labels)))


def label(name: str) -> Column:
    return F.col("labels")[name]


def _increases(samples: DataFrame, span_us: int | None) -> DataFrame:
    keyed = samples.where(F.col("value").isNotNull()).select(
        "metric", series_entries(F.col("labels")).alias("_series"), F.unix_micros("ts").alias("_us"), "value"
    )
    seen = lag_in_key(keyed, ["metric", "_series"], ["_us"], ["value"], "_prev", span_us)
    before = F.col("_prev.value")
    grown = F.when(F.col("value") < before, F.col("value")).otherwise(F.col("value") - before)
    return seen.where(F.col("_prev").isNotNull()).select("metric", "_series", "_us", grown.alias("increase"))


def counter_increase(samples: DataFrame, span_us: int | None = HOUR_US) -> DataFrame:
    """Increase of each sample over the one before it in its series.

    A fall means the counter was reset, and the whole new value is the increase. The first
    sample of a series has none.
    """
    return _increases(samples, span_us).select(
        "metric", F.map_from_entries("_series").alias("labels"), F.timestamp_micros("_us").alias("ts"), "increase"
    )


def counter_rates(
    samples: DataFrame, windows_sec: Sequence[int], slide_sec: int, span_us: int | None = HOUR_US
) -> DataFrame:
    """Per-second increase of each series in windows of several lengths that start every ``slide_sec``.

    An increase belongs to the step of the later of its two samples, also if the earlier one
    lies in another step, so a burst across the edge of a step is whole in the windows that
    hold both. Increases are summed into steps once; the steps' sums are repeated for the
    windows, not the samples. Resets are handled; windows without a sample have no row.
    """
    if any(w % slide_sec for w in windows_sec):
        raise ValueError("windows must be multiples of the slide")
    slide = slide_sec * 1000
    steps = (
        _increases(samples, span_us)
        .groupBy("metric", "_series", floor_ms(F.floor(F.col("_us") / 1000), slide).alias("_step"))
        .agg(F.sum("increase").alias("increase"))
    )

    def windows(sec: int) -> Column:
        starts = F.sequence(F.col("_step") - (sec * 1000 - slide), F.col("_step"), F.lit(slide))
        return F.transform(starts, lambda start: F.struct(F.lit(sec).cast("long").alias("window_sec"), start.alias("start")))

    summed = (
        steps.withColumn("_w", F.explode(F.concat(*map(windows, windows_sec))))
        .groupBy("metric", "_series", "_w")
        .agg(F.sum("increase").alias("increase"))
    )
    if list(windows_sec) == [slide_sec]:  # every step is its own window
        window = F.struct(F.lit(slide_sec).cast("long").alias("window_sec"), F.col("_step").alias("start"))
        summed = steps.withColumn("_w", window)
    return summed.select(
        "metric",
        F.to_json(F.map_from_entries("_series")).alias("series"),
        F.map_from_entries("_series").alias("labels"),
        F.col("_w.window_sec").alias("window_sec"),
        F.timestamp_millis("_w.start").alias("window_start"),
        "increase",
        (F.col("increase") / F.col("_w.window_sec").cast("double")).alias("rate"),
    )


def counter_rate(
    samples: DataFrame, window_sec: int, span_us: int | None = HOUR_US, slide_sec: int | None = None
) -> DataFrame:
    """``counter_rates`` of one window length, tumbling unless ``slide_sec`` says otherwise."""
    return counter_rates(samples, [window_sec], slide_sec or window_sec, span_us).drop("window_sec")


def _label_columns(labels: Sequence[str]) -> list[Column]:
    return [label(name).alias(name) for name in labels]


def sum_by(series: DataFrame, labels: Sequence[str], value: str = "value", also: Sequence[str] = ()) -> DataFrame:
    """Sum over all series that agree in ``labels`` (and in the plain columns ``also``)."""
    return series.groupBy(*also, *_label_columns(labels)).agg(F.sum(value).alias(value))


def avg_by(series: DataFrame, labels: Sequence[str], value: str = "value", also: Sequence[str] = ()) -> DataFrame:
    return series.groupBy(*also, *_label_columns(labels)).agg(F.avg(value).alias(value))


def min_by_metric(samples: DataFrame, value: str = "value") -> DataFrame:
    return samples.groupBy("metric").agg(F.min(value).alias(value))


def ratio_of_sums(df: DataFrame, num: str, den: str, by: Sequence[str] = ()) -> DataFrame:
    """Sum over sum per label; null where the denominator is 0."""
    ratio = F.sum(num) / F.nullif(F.sum(den), F.lit(0))
    return df.groupBy(*by).agg(ratio.alias("ratio"))


def batch_sizes(commits: DataFrame) -> DataFrame:
    """Rows and one batch per (shard, batch)."""
    return commits.groupBy("shard", "batch_id").agg(
        F.count(F.lit(1)).alias("records"), F.lit(1).cast("long").alias("batches")
    )


def staleness(df: DataFrame, ts: str, as_of: Column, by: Sequence[str] = ()) -> DataFrame:
    """Seconds from the newest ``ts`` of each label to ``as_of``."""
    newest = df.groupBy(*by).agg(F.max(F.unix_millis(ts)).alias("_last"))
    return newest.select(*by, ((F.unix_millis(as_of) - F.col("_last")) / 1000.0).alias("stale_sec"))


def worst_staleness(df: DataFrame, ts: str, as_of: Column, by: Sequence[str]) -> DataFrame:
    """Staleness of the label that has waited longest."""
    return staleness(df, ts, as_of, by).agg(F.max("stale_sec").alias("stale_sec"))


def ingest_lag(df: DataFrame, event_ms: str = "event_time", arrival: str = "created_at") -> DataFrame:
    """Add ``lag_ms``: how long after it happened an alarm arrived."""
    return df.withColumn("lag_ms", F.unix_millis(arrival) - F.col(event_ms))


def ingest_lag_gauge(df: DataFrame, by: Sequence[str] = (), **columns) -> DataFrame:
    """Latest lag per label by arrival; only positive lags set the gauge."""
    late = ingest_lag(df, **columns).where(F.col("lag_ms") > 0)
    return late.groupBy(*by).agg((F.max_by("lag_ms", "id") / 1000.0).alias("lag_sec"))


def e2e_latency(commits: DataFrame) -> DataFrame:
    """Add ``latency_ms``: from creation of an interval to its commit."""
    return commits.withColumn("latency_ms", F.unix_millis("committed_ts") - F.unix_millis("created_ts"))


def e2e_histogram(commits: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return bucket_histogram(e2e_latency(commits), "latency_ms", LATENCY_BOUNDS, by, unit=1000.0)


def e2e_quantiles(commits: DataFrame, qs=(0.5, 0.95, 0.99), by: Sequence[str] = ()) -> DataFrame:
    return histogram_quantile(e2e_histogram(commits, by), qs, by)


def outage_histogram(intervals: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return bucket_histogram(intervals, "duration_ms", OUTAGE_BOUNDS, by, unit=1000.0)


def outage_quantiles(intervals: DataFrame, qs=(0.5, 0.95, 0.99), by: Sequence[str] = ()) -> DataFrame:
    return histogram_quantile(outage_histogram(intervals, by), qs, by)


def last_value(samples: DataFrame, labels: Sequence[str] = ()) -> DataFrame:
    """Newest value that is not null, per metric and labels."""
    return (
        samples.where(F.col("value").isNotNull())
        .groupBy("metric", *_label_columns(labels))
        .agg(F.max_by("value", F.unix_micros("ts")).alias("value"))
    )


def health_score(rates: DataFrame, rate: str = "rate") -> DataFrame:
    """100 less ten points per error per second; full health shows where rates are made with ``fill``."""
    return rates.withColumn("health", 100.0 - F.col(rate) * 10.0)


def idle_to_busy_pct(samples: DataFrame, window_sec: int = 300, slide_sec: int | None = None) -> DataFrame:
    """Busy share per instance and window from counters of idle seconds."""
    idle = counter_rate(samples.where(label("mode") == "idle"), window_sec, slide_sec=slide_sec)
    mean = avg_by(idle, ["instance"], "rate", also=["window_start"])
    return mean.select("window_start", "instance", (100.0 - F.col("rate") * 100.0).alias("busy_pct"))


_COMPARE = {
    "gt": lambda a, b: a > b,
    "ge": lambda a, b: a >= b,
    "lt": lambda a, b: a < b,
    "le": lambda a, b: a <= b,
    "eq": lambda a, b: a == b,
    "ne": lambda a, b: a != b,
}


def compare(value: Column, op: str, x) -> Column:
    return _COMPARE[op](value, x)


def compare_filter(series: DataFrame, op: str, x: float, value: str = "value") -> DataFrame:
    """Keep only the series whose value compares true."""
    return series.where(compare(F.col(value), op, F.lit(x)))


def domain_metrics(messages: DataFrame, alarms: DataFrame, **state_options) -> DataFrame:
    """All domain counters and gauges as one long table ``(metric, labels, value)``.

    Counts by topic and by node serve both their own rows and the fleet totals.
    """
    no_labels = F.create_map().cast("map<string,string>")

    def labels(**pairs) -> Column:
        return F.create_map(*[c for k, v in pairs.items() for c in (F.lit(k), v)])

    def unfold(df: DataFrame, rows) -> DataFrame:
        structs = [
            F.struct(F.lit(m).alias("metric"), lab.alias("labels"), v.cast("long").alias("value"))
            for m, lab, v in rows
        ]
        return df.select(F.explode(F.array(*structs)).alias("_r")).select("_r.*")

    ok, bad = F.col("reject").isNull(), F.col("reject").isNotNull()
    named = F.col("node_id") != ""
    by_topic = decode_cdc(messages).groupBy("topic").agg(
        F.count_if(ok & named).alias("ok"),
        F.count_if(bad).alias("bad"),
        F.count_if(ok & ~named).alias("unnamed"),
    )
    received = unfold(
        by_topic, [("messages_total", labels(topic=F.col("topic"), status=F.lit("ok")), F.col("ok"))]
    )
    dropped = unfold(
        by_topic.agg(F.sum("bad").alias("bad"), F.sum("unnamed").alias("unnamed")),
        [
            ("errors_total", labels(type=F.lit("json_unmarshal"), operation=F.lit("kafka")), F.col("bad")),
            ("messages_skipped_total", labels(reason=F.lit("empty_node_id")), F.col("unnamed")),
        ],
    )

    closes = F.coalesce(closes_outage(), F.lit(False))
    duration = F.col("event_time") - F.col("prev.event_time")
    was_up = F.coalesce(~F.col("prev.down"), F.lit(False))
    per_node = (
        with_previous_state(alarms, **state_options)
        .groupBy("node_id")
        .agg(
            F.count_if(F.col("prev").isNull()).alias("misses"),
            F.sum(down_delta()).alias("down_now"),
            F.count_if(closes).alias("closed"),
            F.count_if(closes & (duration < FLAP_MS)).alias("flaps"),
            F.count_if(F.col("down") & F.col("prev").isNull()).alias("first_down"),
            F.count_if(F.col("down") & was_up).alias("up_down"),
        )
    )

    def moved(origin: str, target: str) -> Column:
        return labels(node_id=F.col("node_id"), from_state=F.lit(origin), to_state=F.lit(target))

    node_rows = unfold(
        per_node,
        [
            ("node_state_transitions_total", moved("", "DOWN"), F.col("first_down")),
            ("node_state_transitions_total", moved("UP", "DOWN"), F.col("up_down")),
            ("node_state_transitions_total", moved("DOWN", "UP"), F.col("closed")),
            ("node_flaps_total", labels(node_id=F.col("node_id")), F.col("flaps")),
        ],
    ).where(F.col("value") > 0)
    fleet = per_node.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("misses", "down_now", "closed")]
    )
    fleet_rows = unfold(
        fleet,
        [
            ("cache_misses_total", no_labels, F.col("misses")),
            ("active_down_nodes", no_labels, F.col("down_now")),
            ("interval_records_total", no_labels, F.col("closed")),
        ],
    )
    out = received.unionByName(dropped).unionByName(node_rows).unionByName(fleet_rows)
    return out.select("metric", "labels", F.col("value").cast("double").alias("value"))


def _event(metric: str, when: Column, change: Column | int = 1, **labels) -> Column:
    """One change of one series, null unless ``when``; labels stand in the order of their names."""
    entry = lambda k, v: F.struct(F.lit(k).alias("key"), (v if isinstance(v, Column) else F.lit(v)).alias("value"))
    none = F.lit([]).cast("array<struct<key:string,value:string>>")
    series = F.array(*[entry(k, labels[k]) for k in sorted(labels)]) if labels else none
    change = (change if isinstance(change, Column) else F.lit(change)).cast("long")
    return F.when(when, F.struct(F.lit(metric).alias("metric"), series.alias("series"), change.alias("change")))


def _changes(df: DataFrame, at_ms: Column, step_ms: int, events: Sequence[Column]) -> DataFrame:
    """Changes of series summed per step, from one pass over ``df``."""
    step = floor_ms(at_ms, step_ms) + step_ms
    return (
        df.select(step.alias("ms"), F.explode(F.array_compact(F.array(*events))).alias("_e"))
        .groupBy("_e.metric", "_e.series", "ms")
        .agg(F.sum("_e.change").alias("change"))
    )


def domain_samples(messages: DataFrame, alarms: DataFrame, step_sec: int = 60, **state_options) -> DataFrame:
    """The domain counters and the down-node gauge as samples ``(ts, metric, labels, value)``.

    A series has a sample at the end of every step in which it changes, with all it has
    counted so far. Messages count when they arrive (``timestamp``), alarms when they reach
    the feed (``created_at``, or else their event time). ``domain_metrics`` has the last
    value of each series. Messages are parsed once and alarms folded once.
    """
    step_ms = step_sec * 1000
    ok, named = F.col("reject").isNull(), F.col("node_id") != ""
    received = _changes(
        decode_cdc(messages), F.unix_millis("timestamp"), step_ms,
        [
            _event("messages_total", ok & named, topic=F.col("topic"), status="ok"),
            _event("errors_total", ~ok, type="json_unmarshal", operation="kafka"),
            _event("messages_skipped_total", ok & ~named, reason="empty_node_id"),
        ],
    )
    node, closes = F.col("node_id"), F.coalesce(closes_outage(), F.lit(False))
    was_up, first = F.coalesce(~F.col("prev.down"), F.lit(False)), F.col("prev").isNull()
    flap = F.col("event_time") - F.col("prev.event_time") < FLAP_MS
    moved = lambda when, a, b: _event("node_state_transitions_total", when, node_id=node, from_state=a, to_state=b)
    folded = _changes(
        with_previous_state(alarms, **state_options), F.coalesce(F.unix_millis("created_at"), "event_time"), step_ms,
        [
            moved(F.col("down") & first, "", "DOWN"),
            moved(F.col("down") & was_up, "UP", "DOWN"),
            moved(closes, "DOWN", "UP"),
            _event("node_flaps_total", closes & flap, node_id=node),
            _event("cache_misses_total", first),
            _event("interval_records_total", closes),
            _event("active_down_nodes", down_delta() != 0, down_delta()),
        ],
    )
    # a series has a row a step at most, so a plain window holds and the messages are read once
    so_far = Window.partitionBy("metric", "series").orderBy("ms").rowsBetween(Window.unboundedPreceding, 0)
    return received.unionByName(folded).select(
        F.timestamp_millis("ms").alias("ts"),
        "metric",
        F.map_from_entries("series").alias("labels"),
        F.sum("change").over(so_far).cast("double").alias("value"),
    )
