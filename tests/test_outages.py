from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from downfold.constants import BANDS
from downfold.functions import scalar
from downfold.operators import filters, metrics, outages, sla, state
from downfold.sources import testtables
from helpers import intervals


def value(df):
    return df.first()[0]


def at(text):
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc).timestamp()


def test_bucket_edges(spark):
    df = intervals(spark, [("A", 0, d) for d in (0.499, 0.5, 1, 2, 5, 10, 30, 60)])
    got = {r.bucket[0]: r["count"] for r in outages.duration_histogram(df).collect()}
    assert got == {str(i): 1 for i in range(1, 9)}


def test_totals(spark):
    df = intervals(spark, [("A", 0, 10), ("A", 100, 100.5), ("B", 50, 51)])
    assert value(outages.total_outages(df)) == 3
    assert value(outages.avg_duration(df)) == 3.833
    assert value(outages.max_duration(df)) == 10.0
    assert value(outages.affected_nodes(df)) == 2
    assert value(outages.affected_nodes_approx(df)) == 2
    assert value(outages.uptime_pct(df)) == 88.5
    by_node = {r[0]: r[1] for r in outages.uptime_pct_by_node(df).collect()}
    assert by_node == {"A": 89.5, "B": 0.0}


def test_uptime_is_clamped(spark):
    assert value(outages.uptime_pct(intervals(spark, [("A", 0, 10), ("B", 0, 10)]))) == 0.0


def test_window_shorter_than_a_second_has_no_uptime(spark):
    assert value(outages.uptime_pct(intervals(spark, [("A", 0.1, 0.4)]))) is None


def test_empty_table(spark):
    df = intervals(spark, [])
    assert value(outages.total_outages(df)) == 0
    assert value(outages.affected_nodes(df)) == 0
    for question in (outages.avg_duration, outages.max_duration, outages.uptime_pct, outages.max_outages_per_node):
        assert value(question(df)) is None
    assert sla.node_sla_report(sla.daily_node_partials(df)).count() == 0


def test_rounding_is_half_to_even(spark):
    # Means of 0.5 and 1.5 ms: both ties go to the even neighbour.
    df = intervals(spark, [("A", 0, 0.001), ("A", 1, 1.000)])
    assert value(outages.avg_duration(df)) == 0.0
    df = intervals(spark, [("A", 0, 0.001), ("A", 1, 1.002)])
    assert value(outages.avg_duration(df)) == 0.002


def test_top_nodes_ties_by_node(spark):
    df = intervals(spark, [("C", 0, 5), ("A", 0, 5), ("B", 0, 7)])
    assert [r.node_id for r in outages.top_nodes_downtime(df, 2).collect()] == ["B", "A"]


def test_recent_outages(spark):
    df = intervals(spark, [("A", 10, 12), ("B", 10, 11), ("C", 30, 31)])
    assert [r.node_id for r in outages.recent_outages(df, 2).collect()] == ["C", "A"]


def test_recent_windows(spark):
    end = at("2024-01-01 12:00:00")
    df = intervals(
        spark,
        [("A", end - 300, end - 290), ("A", end - 301, end - 250), ("A", end - 3600, end - 3599), ("B", end - 10, end)],
    )
    as_of = "2024-01-01 12:00:00"
    assert value(outages.outage_count_recent(df, as_of)) == 2
    assert value(outages.max_duration_recent(df, as_of)) == 10.0
    assert value(outages.max_outages_per_node(df, as_of)) == 3
    assert value(outages.outage_count_recent(df, df.agg(F.max("up_at")).scalar())) == 2


def test_filters(spark):
    noon = at("2024-01-01 12:00:00")
    df = intervals(spark, [("A", noon, noon + 1), ("B", noon + 60, noon + 61), ("C", noon + 60.001, noon + 70)])
    closed = filters.filter_time_range(df, "2024-01-01 12:00:00", "2024-01-01 12:01:00")
    assert sorted(r.node_id for r in closed.collect()) == ["A", "B"]
    assert filters.filter_nodes(df, ["A", "C"]).count() == 2
    assert filters.filter_nodes(df, "All").count() == filters.filter_nodes(df).count() == 3


def test_day_of_start_takes_the_whole_outage(spark):
    start = at("2024-01-01 23:59:50")
    report = sla.node_sla_report(sla.daily_node_partials(intervals(spark, [("A", start, start + 20)]))).collect()
    assert [(str(r.day), r.total_incidents) for r in report] == [("2024-01-01", 1)]
    assert report[0].uptime_percentage == (1 - 20 / 86400) * 100


def test_more_than_a_day_is_negative(spark):
    report = sla.node_sla_report(sla.daily_node_partials(intervals(spark, [("A", 0, 172800)]))).first()
    assert report.uptime_percentage == -100.0


def test_partials_merge_in_any_grouping(spark):
    df = intervals(spark, [("A", i * 1000, i * 1000 + 7) for i in range(300)])
    whole = sla.daily_node_partials(df)
    parts = sla.daily_node_partials(df.where("duration_ms % 2 = 0 and minute(down_at) < 30")).unionByName(
        sla.daily_node_partials(df.where("not (duration_ms % 2 = 0 and minute(down_at) < 30)"))
    )
    key = ["node_id", "day", "sum_down_ms", "incidents"]
    assert sorted(map(tuple, sla.daily_node_stats(parts).select(key).collect())) == sorted(
        map(tuple, whole.select(key).collect())
    )


def test_days_and_hours_do_not_follow_the_session_zone(spark):
    df = intervals(spark, [("A", at("2024-01-01 23:30:00"), at("2024-01-01 23:31:00"))])
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        row = df.select(scalar.utc_day(F.col("down_at")).cast("string"), scalar.hour_of_day(F.col("down_at"))).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(row) == ("2024-01-01", 23)


def test_day_pruning_does_not_follow_the_session_zone(spark):
    rows = [("A", at("2024-01-01 23:30:00"), at("2024-01-01 23:31:00"))]
    df = intervals(spark, rows)
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        ranged = filters.filter_time_range(df, "2024-01-02 08:30:00+09:00", "2024-01-01 23:40:00").count()
        recent = filters.filter_recent(df, "2024-01-02 08:35:00+09:00", "5 MINUTES").count()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert (ranged, recent) == (1, 1)


@pytest.mark.parametrize(
    "name, cases",
    [
        ("outages", {0: "green", 99: "green", 100: "yellow", 500: "orange", 2000: "red"}),
        ("uptime", {0: "red", 79.9: "red", 80: "yellow", 95: "green"}),
        ("lag", {29.9: "green", 30: "yellow", 60: "red"}),
    ],
)
def test_bands(spark, name, cases):
    df = spark.createDataFrame([(float(v),) for v in cases], "value double")
    got = {r.value: r.band for r in outages.with_band(df, "value", name).collect()}
    assert got == {float(k): v for k, v in cases.items()}
    assert spark.range(1).select(scalar.threshold_band(F.lit(None).cast("double"), BANDS[name])).first()[0] is None


@pytest.mark.parametrize("clock", ["natural", "fast", "late"])
def test_totals_agree(spark, clock):
    table = testtables.alarms(spark, "/root/testdata/sf0.001", clock)
    df = state.downtime_intervals(table).cache()
    n, ms, shortest = df.agg(F.count(F.lit(1)), F.sum("duration_ms"), F.min("duration_ms")).first()
    daily = sla.daily_node_partials(df).agg(F.sum("sum_down_ms"), F.sum("incidents")).first()
    closed = state.state_transitions(table).where("from_state = 'DOWN'").agg(F.sum("transitions"))
    assert shortest > 0
    assert tuple(daily) == (ms, n)
    assert value(closed) == n
    assert value(outages.duration_histogram(df).agg(F.sum("count"))) == n
    assert value(metrics.outage_histogram(df).agg(F.max("cumulative"))) == n
    assert value(outages.hourly_pattern(df).agg(F.sum("outage_count"))) == n
    if clock != "late":
        overlaps = df.alias("a").join(df.alias("b"), "node_id").where(
            "a.down_at < b.down_at and b.down_at < a.up_at"
        )
        assert overlaps.count() == 0
    df.unpersist()
