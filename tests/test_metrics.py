import math
import random
from datetime import datetime, timedelta, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

from downfold.functions.quantiles import bucket_histogram, exact_quantiles, histogram_quantile
from downfold.operators import alerts as alert_rules, metrics
from downfold.schemas import CDC_MESSAGES, SAMPLES
from downfold.session import work_folder
from downfold.sources import testtables
from helpers import alarms, intervals, parse

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def samples(spark, rows):
    """``rows`` of (second, labels, value)."""
    data = [(T0 + timedelta(seconds=s), "m", labels, v) for s, labels, v in rows]
    return spark.createDataFrame(data, SAMPLES)


def test_counter_reset(spark):
    df = samples(spark, [(0, {"a": "x"}, 10.0), (60, {"a": "x"}, 15.0), (120, {"a": "x"}, 3.0)])
    rows = metrics.counter_rate(df, 300).collect()
    assert [(r.increase, r.rate) for r in rows] == [(8.0, 8.0 / 300)]


@pytest.mark.parametrize("span", [None, 1_000_000, 30_000_000])
def test_series_do_not_mix(spark, span):
    rng = random.Random(2)
    rows = [(s, {"i": rng.choice("xyz"), "j": "k"}, float(rng.randrange(100))) for s in range(200)]
    last, expected = {}, {}
    for _, labels, v in rows:
        key = labels["i"]
        if key in last:
            expected[key] = expected.get(key, 0.0) + (v if v < last[key] else v - last[key])
        last[key] = v
    grown = metrics.counter_increase(samples(spark, rows), span)
    assert {tuple(r) for r in metrics.sum_by(grown, ["i"], "increase").collect()} == set(expected.items())
    rated = metrics.counter_rate(samples(spark, rows), 60, span).groupBy("series").agg(F.sum("increase")).collect()
    assert {r[0]: r[1] for r in rated} == {f'{{"i":"{k}","j":"k"}}': v for k, v in expected.items()}


def test_label_order_does_not_split_a_series(spark):
    df = samples(spark, [(0, {"a": "1", "b": "2"}, 1.0), (1, {"b": "2", "a": "1"}, 4.0)])
    assert [r.increase for r in metrics.counter_increase(df).collect()] == [3.0]


def test_label_aggregates(spark):
    df = samples(spark, [(0, {"i": "a", "m": "x"}, 1.0), (0, {"i": "a", "m": "y"}, 3.0), (0, {"i": "b", "m": "x"}, 5.0)])
    assert {tuple(r) for r in metrics.sum_by(df, ["i"]).collect()} == {("a", 4.0), ("b", 5.0)}
    assert {tuple(r) for r in metrics.avg_by(df, ["i"]).collect()} == {("a", 2.0), ("b", 5.0)}
    assert [tuple(r) for r in metrics.min_by_metric(df).collect()] == [("m", 1.0)]


def test_last_value_skips_nulls(spark):
    df = samples(spark, [(0, {"i": "a"}, 1.0), (5, {"i": "a"}, 2.0), (9, {"i": "a"}, None)])
    assert metrics.last_value(df, ["i"]).first().value == 2.0


def test_sliding_rate_equals_direct_count(spark):
    rng = random.Random(4)
    secs = sorted(rng.sample(range(2000), 300))
    df = spark.createDataFrame([(T0 + timedelta(seconds=s),) for s in secs], "ts timestamp")
    got = {r.window_start: r.events for r in metrics.event_rate(df, "ts", 300, 60).collect()}
    direct = df.groupBy(F.window("ts", "300 seconds", "60 seconds")).count().collect()
    assert got == {r.window.start: r["count"] for r in direct}
    with pytest.raises(ValueError):
        metrics.event_rate(df, "ts", 300, 70)


def test_histogram_edge_is_inclusive(spark):
    df = intervals(spark, [("A", 0, 5.0)])
    got = {r.le: r.cumulative for r in metrics.outage_histogram(df).collect()}
    assert got[5.0] == 1 and got[float("inf")] == 1


def test_quantiles_from_buckets(spark):
    def quantile(values, q, bounds=(1.0, 2.0, 4.0)):
        df = spark.createDataFrame([(float(v),) for v in values], "v double")
        return histogram_quantile(bucket_histogram(df, "v", bounds), [q]).first().value

    assert quantile([0.5, 0.5, 1.5, 1.5], 0.5) == 1.0
    assert quantile([0.5, 0.5, 1.5, 1.5], 0.75) == 1.5
    assert quantile([0.5], 0.5) == 0.5
    assert quantile([3.0, 3.0], 0.5) == 3.0
    assert quantile([9.0], 0.99) == 4.0
    assert math.isnan(quantile([], 0.5))


@pytest.mark.parametrize("width", [1, 7, 100, 1 << 16])
def test_exact_quantiles(spark, width):
    rng = random.Random(width)
    rows = [(rng.choice("ab"), rng.choice([rng.randrange(20), rng.randrange(5000), 777])) for _ in range(700)]
    rows.append(("c", 42))
    df = spark.createDataFrame(rows, "k string, v long")
    qs = [0.0, 0.5, 0.95, 0.99, 1.0]
    got = {(r.k, r.q): r.value for r in exact_quantiles(df, "v", qs, ["k"], width).collect()}
    for k in "abc":
        values = [v for key, v in rows if key == k]
        for q in qs:
            assert got[(k, q)] == pytest.approx(np.quantile(values, q), abs=1e-9)


def test_staleness(spark):
    df = spark.createDataFrame(
        [("a", T0), ("a", T0 + timedelta(seconds=9)), ("b", T0 + timedelta(seconds=4))], "k string, ts timestamp"
    )
    as_of = F.lit(T0 + timedelta(seconds=10))
    assert {tuple(r) for r in metrics.staleness(df, "ts", as_of, ["k"]).collect()} == {("a", 1.0), ("b", 6.0)}
    assert metrics.worst_staleness(df, "ts", as_of, ["k"]).first()[0] == 6.0


def test_ratio_of_nothing_is_null(spark):
    df = spark.createDataFrame([("a", 4, 2), ("b", 3, 0)], "k string, n long, d long")
    assert {tuple(r) for r in metrics.ratio_of_sums(df, "n", "d", ["k"]).collect()} == {("a", 2.0), ("b", None)}


def test_health_and_compare(spark):
    df = spark.createDataFrame([(0.5,), (5.0,)], "rate double")
    assert [r.health for r in metrics.health_score(df).orderBy("rate").collect()] == [95.0, 50.0]
    for op, n in (("gt", 0), ("ge", 1), ("lt", 1), ("le", 2), ("eq", 1), ("ne", 1)):
        assert metrics.compare_filter(df, op, 5.0, "rate").count() == n


def test_busy_share(spark):
    idle = [(s, {"instance": "a", "mode": "idle"}, s * 0.25) for s in range(0, 300, 60)]
    busy = [(s, {"instance": "a", "mode": "user"}, s * 9.0) for s in range(0, 300, 60)]
    row = metrics.idle_to_busy_pct(samples(spark, idle + busy), 300).first()
    assert row.instance == "a" and row.busy_pct == 100.0 - 240 * 0.25 / 300.0 * 100.0


def test_domain_metrics(spark):
    wide = testtables.cdc_messages(spark, "/root/testdata/sf0.001")
    df = alarms(spark, parse("D@0 U@5 U@9 D@20 D@21 U@60"))
    got = {(r.metric, tuple(sorted(r.labels.items()))): r.value for r in metrics.domain_metrics(wide, df).collect()}
    node = ("node_id", "A")
    assert got[("interval_records_total", ())] == 2.0
    assert got[("active_down_nodes", ())] == 0.0
    assert got[("cache_misses_total", ())] == 1.0
    assert got[("node_flaps_total", (node,))] == 1.0
    assert got[("node_state_transitions_total", (("from_state", ""), node, ("to_state", "DOWN")))] == 1.0
    assert got[("node_state_transitions_total", (("from_state", "UP"), node, ("to_state", "DOWN")))] == 1.0
    assert got[("node_state_transitions_total", (("from_state", "DOWN"), node, ("to_state", "UP")))] == 2.0
    counted = {m: v for (m, _), v in got.items() if m in ("messages_total", "errors_total", "messages_skipped_total")}
    assert counted == {"messages_total": 680.0, "errors_total": 260.0, "messages_skipped_total": 60.0}


def test_health_shows_quiet_windows(spark):
    errors = spark.sql("SELECT timestamp_seconds(s) AS ts FROM VALUES (0), (900) AS t(s)")
    scored = metrics.health_score(metrics.event_rate(errors, "ts", 300, fill=True))
    got = sorted((r.window_start.timestamp(), r.events, round(r.health, 3)) for r in scored.collect())
    assert [g[1:] for g in got] == [(1, 99.967), (0, 100.0), (0, 100.0), (1, 99.967)]


def test_burst_over_a_window_edge_keeps_its_peak(spark):
    """600 in the minute from 0:30 to 1:30: half of it in either tumbling minute, all of it in one of two minutes."""
    rows = [(0, {"a": "x"}, 0.0), (29, {"a": "x"}, 0.0)] + [(30 + s, {"a": "x"}, 10.0 * s) for s in range(1, 61)]
    df = samples(spark, [*rows, (200, {"a": "x"}, 600.0)])
    tumbling = [r.rate for r in metrics.counter_rate(df, 60).collect()]
    assert max(tumbling) == 310 / 60
    got = {(r.window_sec, (r.window_start.timestamp() - T0.timestamp()) // 1): r.increase for r in metrics.counter_rates(df, (60, 120), 60).collect()}
    assert got[120, 0.0] == 600.0 and got[60, 0.0] == 290.0 and got[60, 60.0] == 310.0
    halves = metrics.counter_rate(df, 60, slide_sec=30)
    assert max(r.increase for r in halves.collect()) == 590.0  # the last sample lies on the next edge
    with pytest.raises(ValueError):
        metrics.counter_rates(df, (60, 90), 60)


def test_sliding_rates_equal_direct_sums(spark):
    rng = random.Random(8)
    rows = [(s, {"i": rng.choice("xy")}, float(rng.randrange(50))) for s in sorted(rng.sample(range(3000), 400))]
    df = samples(spark, rows)
    grown = [(r.labels["i"], r.ts.timestamp() - T0.timestamp(), r.increase) for r in metrics.counter_increase(df).collect()]
    expected = {}
    for sec in (60, 300):
        for i, at, more in grown:
            for start in range(int(at // 60) * 60 - sec + 60, int(at // 60) * 60 + 1, 60):
                expected[i, sec, start] = expected.get((i, sec, start), 0.0) + more
    got = metrics.counter_rates(df, (60, 300), 60).collect()
    assert {(r.labels["i"], r.window_sec, r.window_start.timestamp() - T0.timestamp()): r.increase for r in got} == expected
    assert all(r.rate == r.increase / r.window_sec for r in got)


@pytest.fixture(scope="module")
def domain(spark):
    sf_dir = "/root/testdata/sf0.001"
    wide, table = testtables.cdc_messages(spark, sf_dir, "fast"), testtables.alarms(spark, sf_dir, "fast")
    made = metrics.domain_samples(wide, table)
    made.write.parquet(path := work_folder(spark, "domain"))
    return made, spark.read.parquet(path), metrics.domain_metrics(wide, table)


def series(df):
    return {(r.metric, tuple(sorted(r.labels.items()))): r.value for r in df.collect()}


def test_domain_samples_end_at_the_totals(domain):
    _, written, totals = domain
    last = {}
    for r in sorted(written.collect(), key=lambda r: r.ts):
        last[r.metric, tuple(sorted(r.labels.items()))] = r.value
    total = series(totals)
    assert {k: v for k, v in total.items() if v} == {k: v for k, v in last.items() if v}
    assert len({r.ts for r in written.collect()}) > 10


def test_messages_of_domain_samples_are_parsed_once(domain):
    plan = domain[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_rates_last_values_and_rules_run_on_domain_samples(domain):
    """The counters feed the rate, last-value and alert operators like any other samples."""
    _, written, totals = domain
    rates = metrics.counter_rates(written.where("metric = 'errors_total'"), (300,), 60)
    assert rates.count() > 10 and rates.agg(F.min("increase")).first()[0] >= 0
    total = series(totals)
    gauge = metrics.last_value(written.where("metric = 'active_down_nodes'"))
    assert gauge.first().value == total["active_down_nodes", ()]
    judged = alert_rules.evaluate_threshold(
        written.where("metric = 'active_down_nodes'").select(
            F.lit("down").alias("rule"), F.lit("").alias("series"), F.unix_millis("ts").alias("time_ms"), "value"
        ), "gt", 5.0,
    )
    assert "Firing" in {r.state for r in alert_rules.alert_state(judged, F.lit(60_000)).collect()}


def test_domain_samples_of_nothing(spark):
    none = spark.createDataFrame([], CDC_MESSAGES)
    assert metrics.domain_samples(none, alarms(spark, [])).count() == 0
    few = metrics.domain_samples(none, alarms(spark, parse("D@0 U@5")).withColumn("created_at", F.lit(None).cast("timestamp")))
    assert series(few.where("metric = 'interval_records_total'")) == {("interval_records_total", ()): 1.0}
