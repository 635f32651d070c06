import random

import pytest
from pyspark.sql import functions as F

from downfold.constants import STATE_TTL_MS
from downfold.functions.ordered import lag_in_key, measured_span, running_max_in_key, running_sum_in_key
from downfold.operators import state
from helpers import alarms, brute_intervals, parse, seconds

CASES = {
    "basic": ("D@0 U@5", [("A", 0, 5, 5)]),
    "both codes": ("1417@0 U@5 1535@10 U@12", [("A", 0, 5, 5), ("A", 10, 12, 2)]),
    "repeated down": ("D@0 D@10 U@15", [("A", 10, 15, 5)]),
    "repeated up": ("D@0 U@5 U@9", [("A", 0, 5, 5)]),
    "first is up": ("U@0 D@5 U@6", [("A", 5, 6, 1)]),
    "zero length": ("D@5 U@5", []),
    "late up overwrites": ("D@10 U@8 U@12", []),
    "late down": ("D@10 D@3 U@12", [("A", 3, 12, 9)]),
    "open outage": ("D@0", []),
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("span", [None, 1, 2, 1 << 22])
def test_rule(spark, name, span):
    text, expected = CASES[name]
    assert seconds(state.downtime_intervals(alarms(spark, parse(text)), span=span)) == expected


def test_open_outage_is_down(spark):
    df = alarms(spark, parse("D@0"))
    assert state.active_down_nodes(df).first()[0] == 1
    assert state.latest_node_state(df).first()["status"] == "DOWN"


def test_nodes_are_independent(spark):
    rows = [("A", 1417, 0), ("B", 1417, 1), ("A", 9999, 4), ("B", 9999, 9)]
    assert seconds(state.downtime_intervals(alarms(spark, rows))) == [("A", 0, 4, 4), ("B", 1, 9, 8)]


def test_expiry(spark):
    late = alarms(spark, parse("D@0 U@172801"))
    options = {"state_ttl_ms": STATE_TTL_MS}
    assert seconds(state.downtime_intervals(late, **options)) == []
    assert state.state_misses(late).first()[0] == 1
    assert state.state_misses(late, **options).first()[0] == 2
    assert state.active_down_nodes(late, **options).first()[0] == 1
    edge = alarms(spark, parse("D@0 U@172800"))
    assert seconds(state.downtime_intervals(edge, **options)) == [("A", 0, 172800, 172800)]


def test_transitions_and_gauge(spark):
    df = alarms(spark, parse("U@0 U@1 D@2 D@3 U@4 D@10 U@8 D@20"))
    got = {(r.from_state, r.to_state): r.transitions for r in state.state_transitions(df).collect()}
    # The UP at 8 is late: no outage and no transition, but the gauge counts it.
    assert got == {("UP", "DOWN"): 3, ("DOWN", "UP"): 1}
    assert state.active_down_nodes(df).first()[0] == 1
    assert state.state_misses(df).first()[0] == 1


def test_gauge_series(spark):
    rows = [("A", 1417, 10), ("B", 1417, 50), ("A", 9999, 70), ("B", 9999, 200)]
    series = state.active_down_series(alarms(spark, rows)).orderBy("time_ms").collect()
    assert [(r.time_ms, r.active_down) for r in series] == [(60_000, 2), (120_000, 1), (240_000, 0)]


def test_changes_hold_all_intervals(spark):
    rows = _history(random.Random(3), 600)
    states = state.with_previous_state(alarms(spark, rows))
    changes = state.state_changes(states)
    assert seconds(state.intervals_of(changes)) == seconds(state.intervals_of(states))


def test_flap_edge(spark):
    df = alarms(spark, parse("D@0 U@9.999 D@20 U@30"))
    assert [tuple(r) for r in state.node_flaps(state.downtime_intervals(df)).collect()] == [("A", 1)]


def _history(rng, n):
    """One node holds a third of all alarms; every tenth alarm comes late."""
    rows = []
    for i in range(n):
        node = "hot" if rng.random() < 1 / 3 else f"n{rng.randrange(20)}"
        late = rng.random() < 0.1
        rows.append((node, rng.choice([1417, 1535, 9999, 9999]), float(i * 7 - (3000 if late else 0) + 10_000)))
    return rows


@pytest.mark.parametrize("span", [1, 3, 64, 1 << 22])
@pytest.mark.parametrize("ttl", [None, 500])
def test_sliced_fold_equals_brute_force(spark, span, ttl):
    rows = _history(random.Random(span), 900)
    options = {} if ttl is None else {"state_ttl_ms": ttl * 1000}
    got = seconds(state.downtime_intervals(alarms(spark, rows), span=span, **options))
    assert got == brute_intervals(rows, ttl)


def test_event_time_order(spark):
    rows = _history(random.Random(11), 600)
    in_order = [r for _, r in sorted(enumerate(rows), key=lambda p: (p[1][2], p[0]))]
    df = alarms(spark, rows)
    sliced = state.intervals_of(state.with_previous_state(df, order=("event_time", "id"), span=60_000))
    assert seconds(sliced) == brute_intervals(in_order)
    assert seconds(state.intervals_of(state.by_event_time(df))) == brute_intervals(in_order)


def test_hot_node_is_spread_over_tasks(spark):
    """The window groups of the hot node are as many as its slices."""
    df = alarms(spark, [("hot", 1417 if i % 2 else 9999, i) for i in range(4000)])
    states = state.with_previous_state(df, span=100)
    plan = states._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(node_id" in plan and "_slice" in plan
    groups = df.select(F.expr("id div 100")).distinct().count()
    assert groups == 41
    assert states.where(F.col("prev").isNull()).count() == 1


def test_lag_keeps_null_payloads_apart_from_no_row(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, 5), ("a", 9, 6)], "k string, o long, v long")
    got = lag_in_key(df, ["k"], ["o"], ["v"], "p", 2).orderBy("o").select("p.v", F.col("p").isNull()).collect()
    assert [tuple(r) for r in got] == [(None, True), (None, False), (5, False)]


def test_running_totals(spark):
    rng = random.Random(5)
    rows = [(rng.choice("ab"), i * 3, rng.choice([None, rng.randrange(-5, 50)])) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, o long, v long")
    for operator, fold in ((running_sum_in_key, sum), (running_max_in_key, max)):
        got = {(r.k, r.o): r.t for r in operator(df, ["k"], "o", "v", "t", 40).collect()}
        for key in "ab":
            seen = []
            for k, o, v in rows:
                if k == key:
                    seen += [] if v is None else [v]
                    expected = fold(seen) if seen else (0 if fold is sum else None)
                    assert got[(k, o)] == expected


def test_measured_span(spark):
    even = spark.range(0, 10_000, 10)
    assert measured_span(even, "id", 100) == 999
    assert measured_span(even.where("id < 0"), "id") == 1
    slices = even.select(F.expr("id div 999").alias("s")).groupBy("s").count()
    assert slices.agg(F.max("count")).first()[0] <= 101


def test_documents_and_bounds_do_not_follow_the_session_zone(spark):
    from downfold.operators import filters

    df = alarms(spark, [("A", 1417, 0)])
    zone = spark.conf.get("spark.sql.session.timeZone")
    found = []
    for name in ("UTC", "Asia/Tokyo", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", name)
        try:
            document = state.state_documents(state.latest_node_state(df)).first().value
            early = filters.filter_recent(df.selectExpr("timestamp_millis(event_time) AS down_at"), "1970-01-01 00:05:00", "5 MINUTES")
            found.append((document, early.count()))
        finally:
            spark.conf.set("spark.sql.session.timeZone", zone)
    assert found == [('{"status":"DOWN","last_seen_at":"1970-01-01T00:00:00Z"}', 1)] * 3
