import random

import pytest
from pyspark.sql import functions as F

from downfold.operators import alerts
from downfold.operators.state import state_changes, with_previous_state
from downfold.plans.tables import commits as commits_of_the_job
from downfold.sources import testtables
from helpers import alarms, intervals, parse

MIN = 60_000


def states(spark, values, hold_sec, limit=10.0, step=MIN):
    rows = [("r", "", i * step, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "rule string, series string, time_ms long, value double")
    judged = alerts.evaluate_threshold(df, "gt", limit)
    return [r.state for r in alerts.alert_state(judged, F.lit(hold_sec * 1000)).orderBy("time_ms").collect()]


def test_hold(spark):
    assert states(spark, [11.0, 11.0, 11.0], 120) == ["Pending", "Pending", "Firing"]


def test_reset(spark):
    assert states(spark, [11.0, 1.0, 11.0], 60) == ["Pending", "Normal", "Pending"]


def test_no_data_breaks_a_run(spark):
    assert states(spark, [11.0, None, 11.0, 11.0], 60) == ["Pending", "NoData", "Pending", "Firing"]


def test_limit_itself_is_normal(spark):
    assert states(spark, [10.0], 60) == ["Normal"]


def test_runs_across_days_equal_brute_force(spark):
    rng = random.Random(8)
    step = 3_600_000
    values = [rng.choice([5.0, 20.0, 20.0, 20.0, None]) for _ in range(200)]
    since, expected = None, []
    for i, v in enumerate(values):
        breach = v is not None and v > 10
        since = (since if since is not None else i * step) if breach else None
        if v is None:
            expected.append("NoData")
        elif not breach:
            expected.append("Normal")
        else:
            expected.append("Firing" if i * step - since >= 3 * step else "Pending")
    assert states(spark, values, 3 * step // 1000, step=step) == expected


def test_grid_covers_rules_without_series(spark):
    span = spark.createDataFrame([(30_000, 150_000)], "start_ms long, end_ms long")
    empty = spark.createDataFrame([], "rule string, series string, time_ms long, value double")
    rules = alerts.default_rules(spark)
    out = alerts.evaluate_rules(rules, empty, span)
    assert out.count() == 3 * len(alerts.RULE_TABLE)
    got = {(r.rule, r.state) for r in out.select("rule", "state").distinct().collect()}
    assert ("high_single_outage", "Normal") in got and ("consumer_lag", "NoData") in got and ("outage_storm", "Normal") in got


def test_grid_days(spark):
    span = spark.createDataFrame([(5, 3 * 86_400_000 + 70_000)], "start_ms long, end_ms long")
    times = [r[0] for r in alerts.evaluation_times(span).orderBy("time_ms").collect()]
    assert times == list(range(MIN, 3 * 86_400_000 + 120_001, MIN))


@pytest.mark.parametrize("offset", [0, 84_000])
def test_recent_outages_on_the_grid_equal_brute_force(spark, offset):
    """The second offset puts midnight amid the outages."""
    rng = random.Random(1)
    rows = []
    for _ in range(150):
        start = offset + rng.randrange(0, 7200) + rng.choice([0, 0.5])
        rows.append((rng.choice("abc"), start, start + rng.choice([3, 40.5, 250, 400, 4000])))
    df = intervals(spark, rows)
    got = {}
    for r in alerts.recent_outage_series(df).collect():
        got[(r.rule, r.time_ms // 1000)] = r.value
    for t in range(offset, offset + 12_000, 60):
        recent = [u - d for n, d, u in rows if u <= t and d >= t - 300]
        per_node = {}
        for n, d, u in rows:
            if u <= t and d >= t - 3600:
                per_node[n] = per_node.get(n, 0) + 1
        assert got.get(("high_single_outage", t)) == (max(recent) if recent else None)
        assert got.get(("outage_storm", t)) == (len(recent) or None)
        assert got.get(("node_flapping", t)) == (max(per_node.values()) if per_node else None)


def test_reduce_last(spark):
    df = spark.sql(
        "select timestamp_seconds(s) as ts, cast(v as double) as value, k from values "
        "(0, 1, 'a'), (50, 2, 'a'), (100, null, 'a'), (10, 3, 'b') as t(s, v, k)"
    )
    as_of = F.timestamp_seconds(F.lit(100))
    assert {tuple(r) for r in alerts.reduce_last(df, as_of, 60, ["k"]).collect()} == {("a", 2.0)}
    assert {tuple(r) for r in alerts.reduce_last(df, as_of, 90, ["k"]).collect()} == {("a", 2.0), ("b", 3.0)}


def test_annotations(spark):
    df = spark.createDataFrame(
        [(1.23456, "warning", "sre", "{{ $value }} down"), (None, "critical", "", "lag {{ $value }}")],
        "value double, severity string, team string, summary string",
    )
    got = [(r.summary, r.labels) for r in alerts.render_annotations(df).collect()]
    assert got == [
        ("1.235 down", {"severity": "warning", "team": "sre"}),
        ("lag no data", {"severity": "critical", "team": ""}),
    ]


@pytest.mark.parametrize("limit, fires", [(0, True), (5, False)])
def test_down_nodes_hold_between_changes(spark, limit, fires):
    table = alarms(spark, parse("D@30") + parse("D@90", node="B") + parse("U@600"))
    changes = state_changes(with_previous_state(table))
    span = spark.createDataFrame([(0, 600_000)], "start_ms long, end_ms long")
    times = alerts.evaluation_times(span)
    series = alerts.down_node_series(changes, times).where("rule = 'many_nodes_down'")
    assert [r.value for r in series.orderBy("time_ms").collect()] == [0, 1, 2, 2, 2, 2, 2, 2, 2, 2, 1]
    judged = alerts.evaluate_threshold(series, "gt", float(limit))
    fired = alerts.alert_state(judged, F.lit(300_000)).where("state = 'Firing'").count()
    assert (fired > 0) == fires


def test_all_rules_have_series(spark):
    sf_dir = "/root/testdata/sf0.001"
    table = testtables.alarms(spark, sf_dir, "fast")
    span = table.agg(F.min("event_time").alias("start_ms"), F.max("event_time").alias("end_ms"))
    changes = state_changes(with_previous_state(table))
    commits = commits_of_the_job()(spark, sf_dir)
    wide = testtables.cdc_messages(spark, sf_dir, "fast")
    series = alerts.rule_series(changes, commits, table, wide, span)
    assert {r[0] for r in series.select("rule").distinct().collect()} == {r[0] for r in alerts.RULE_TABLE}


def commits_every(spark, seconds_between, latency, n=12):
    """One interval a commit, committed ``latency`` seconds after it came into being."""
    rows = [((i + 1) * seconds_between - latency, (i + 1) * seconds_between, i % 5) for i in range(n)]
    df = spark.createDataFrame(rows, "created long, committed long, shard int")
    return df.select(F.timestamp_seconds("created").alias("created_ts"), F.timestamp_seconds("committed").alias("committed_ts"), "shard")


@pytest.mark.parametrize(("latency", "states"), [(30, {"Pending", "Firing"}), (11, {"Pending", "Firing"}), (3, {"Normal"})])
def test_slow_commits_fire(spark, latency, states):
    series = alerts.commit_latency_series(commits_every(spark, 60, latency)).where("time_ms <= 720000")
    judged = alerts.evaluate_threshold(series, "gt", 10.0)
    assert {r.state for r in alerts.alert_state(judged, F.lit(180_000)).collect()} == states


def test_slow_commits_fire_on_what_the_job_wrote(spark):
    """Batches of some minutes on the clock of the feed are committed long after most of their intervals ended."""
    sf_dir = "/root/testdata/sf0.001"
    series = alerts.commit_latency_series(commits_of_the_job()(spark, sf_dir))
    judged = alerts.evaluate_threshold(series, "gt", 10.0)
    assert "Firing" in {r.state for r in alerts.alert_state(judged, F.lit(180_000)).collect()}


def test_steps_that_do_not_divide_the_window_are_refused(spark):
    for step in (0, -60_000, 420_000, 600_000):
        with pytest.raises(ValueError):
            alerts.checked_step(step)
    assert alerts.checked_step(150_000) == 150_000


def test_reduce_last_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "samples")
    spark.range(5).selectExpr("timestamp_seconds(id) AS ts", "cast(id AS double) AS value").write.parquet(path)
    last = alerts.reduce_last(spark.read.parquet(path), F.timestamp_seconds(F.lit(3)), 2)
    assert [tuple(r) for r in last.collect()] == [(3.0,)]
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThanOrEqual(t" in plan


def test_a_healthy_fleet_has_data():
    empty = {rule[0]: rule[-1] for rule in alerts.RULE_TABLE}
    assert empty["high_single_outage"] == empty["node_flapping"] == 0.0


def test_a_wrong_clock_does_not_stretch_the_grid(spark):
    """Alarms at time 0 and in the far future leave the evaluation times as they were."""
    table = testtables.alarms(spark, "/root/testdata/sf0.001")
    rules = alerts.default_rules(spark)
    none = spark.createDataFrame([], "rule string, series string, time_ms long, value double")
    wrong = table.limit(2).withColumn("event_time", F.when(F.col("id") % 2 == 0, 0).otherwise(4_000_000_000_000).cast("long"))
    plain, odd = (alerts.plausible_span(t) for t in (table, table.unionByName(wrong)))
    assert plain.first() == odd.first() and plain.first().start_ms > 1_600_000_000_000
    assert alerts.evaluation_times(plain).count() == alerts.evaluation_times(odd).count()
    sizes = {alerts.evaluation_grid(rules, none, span, 300_000).count() for span in (plain, odd)}
    assert len(sizes) == 1


def test_span_of_alarms_without_an_arrival(spark):
    unknown = alarms(spark, parse("D@0 U@9")).withColumn("created_at", F.lit(None).cast("timestamp"))
    assert tuple(alerts.plausible_span(unknown).first()) == (0, 9000)
    assert tuple(alerts.plausible_span(alarms(spark, [])).first()) == (None, None)
