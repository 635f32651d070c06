"""The table of days: commits, replays, merges, what readers open, what is left on disk."""

import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from downfold.operators import sla
from downfold.schemas import NODE_INTERVALS
from downfold.session import work_folder
from downfold.sources import intervals as tables
from downfold.sources.daytable import CommitConflict, DayTable
from downfold.streaming import fold
from helpers import alarms, intervals, parse, seconds

DAY = 86_400


def folders(path):
    return sorted(f"{os.path.basename(d)}/{p}" for d, parts, _ in os.walk(f"{path}/data") for p in parts if p.startswith("part="))


def rows_of_batch(spark, n):
    """One outage on the first day and, every third time, one on the second."""
    rows = [("A", n * 10, n * 10 + 3)] + [("B", DAY + n * 10, DAY + n * 10 + 4)] * (n % 3 == 0)
    return intervals(spark, rows)


@pytest.fixture
def table(spark):
    now = [1_000_000]
    made = DayTable(
        spark, work_folder(spark, "days"), NODE_INTERVALS, "down_day", ["node_id", "down_at"],
        fan=3, grace_ms=100, clock=lambda: now[0],
    )
    made.now = now
    return made


def test_folders_do_not_grow_with_batches(spark, table):
    expected = []
    for n in range(20):
        assert table.commit(rows_of_batch(spark, n), n)
        expected += seconds(rows_of_batch(spark, n))
        table.now[0] += 60
    assert seconds(table.read()) == sorted(expected)
    counts = table.parts_by_day()
    # 20 is 202 in base three: two parts of level 2, none of level 1, two of level 0
    assert counts["1970-01-01"] == 4 and counts["1970-01-02"] <= 4
    table.now[0] += 1000
    table.commit(rows_of_batch(spark, 20), 20)
    table.now[0] += 1000
    table.commit(intervals(spark, []), 21)  # what the last merge replaced waits no longer
    assert len(folders(table.path)) == sum(table.parts_by_day().values())
    table.compact()
    assert table.parts_by_day() == {"1970-01-01": 1, "1970-01-02": 1}
    assert seconds(table.read()) == sorted(expected + seconds(rows_of_batch(spark, 20)))


def test_replay_after_a_merge_doubles_nothing(spark, table):
    for n in range(7):
        table.commit(rows_of_batch(spark, n), n)
    before = seconds(table.read())
    assert [table.commit(rows_of_batch(spark, n), n) for n in (0, 5, 6)] == [False] * 3
    table.compact()
    assert not table.commit(rows_of_batch(spark, 6), 6)
    assert seconds(table.read()) == before
    assert table.version().batches == ((0, 6),)
    assert table.commit(rows_of_batch(spark, 9), 9) and table.commit(rows_of_batch(spark, 30))
    assert table.version().batches == ((0, 6), (9, 10))


def test_readers_of_a_day_open_that_day(spark, table):
    for n in range(4):
        table.commit(rows_of_batch(spark, n), n)
    only = table.read("1970-01-02", "1970-01-02")
    assert only.count() == 2 and all("down_day=1970-01-02" in f for f in only.inputFiles())
    assert table.read("1980-01-01").count() == 0
    assert [f for f in only.inputFiles() if "down_day=1970-01-01" in f] == []


def test_rows_are_sorted_in_files(spark, table):
    table.commit(intervals(spark, [(n, s, s + 1) for s in (9, 2, 5) for n in "CAB"]), 0)
    got = [(r.node_id, r.down_at) for r in spark.read.parquet(table.read().inputFiles()[0]).collect()]
    assert got == sorted(got) and len(got) == 9


def test_a_batch_that_did_not_end_is_not_seen(spark, table, monkeypatch):
    table.commit(rows_of_batch(spark, 0), 0)
    with monkeypatch.context() as patch:
        patch.setattr(DayTable, "_publish", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            table.commit(rows_of_batch(spark, 1), 1)
    assert seconds(table.read()) == seconds(rows_of_batch(spark, 0))
    assert table.commit(rows_of_batch(spark, 1), 1)
    assert table.read().count() == 3
    assert len(folders(table.path)) == 4
    table.now[0] = int(datetime.now().timestamp() * 1000) + 10_000
    assert table.remove_strays(older_than_ms=0) == 1 and table.read().count() == 3


def test_of_two_writers_one_fails(spark, table):
    seen = table.version()
    table.commit(rows_of_batch(spark, 0), 0)
    with pytest.raises(CommitConflict):
        table._publish(seen, (), ((1, 1),))
    assert table.read().count() == 2


def test_readers_keep_their_version(spark, table):
    for n in (1, 2):
        table.commit(rows_of_batch(spark, n), n)
    held = table.read()
    table.commit(rows_of_batch(spark, 4), 4)  # merges what the reader holds
    assert table.parts_by_day()["1970-01-01"] == 1
    assert held.count() == 2


def test_empty_batches_and_rows_without_a_day(spark, table):
    assert table.commit(intervals(spark, []), 0)
    assert table.version().batches == ((0, 0),) and table.read().count() == 0
    with pytest.raises(ValueError):
        table.commit(rows_of_batch(spark, 0).withColumn("down_day", F.lit(None).cast("date")), 1)
    assert not table.version().has(1)


def test_log_is_one_file_a_commit(spark, table):
    for n in range(3):
        table.commit(rows_of_batch(spark, 1), n)
    names = sorted(n for n in os.listdir(f"{table.path}/log") if n.endswith(".json"))
    assert names == [f"{n:012d}.json" for n in (1, 2, 3, 4)]  # the fourth is the merge
    assert [p[2] for p in json.load(open(f"{table.path}/log/{names[-1]}"))["parts"]] == [1]


def test_merged_partials_have_one_row_a_node(spark):
    path = work_folder(spark, "daily")
    for n in range(4):
        tables.write_daily_states(sla.daily_node_partials(rows_of_batch(spark, n)), path, n, fan=2)
    assert [tuple(r)[2:] for r in tables.read_daily_states(spark, path, "1970-01-01", "1970-01-01").collect()] == [(12_000, 4)]


def test_commit_record(spark):
    path = work_folder(spark, "commits")
    created = rows_of_batch(spark, 0).withColumn("created_ts", F.timestamp_millis(F.lit(500)))
    tables.write_intervals(created, path, 7, committed_ms=2500)
    tables.write_intervals(rows_of_batch(spark, 1), path, committed_ms=9000)
    got = tables.read_commits(spark, path).orderBy("batch_id", "node_id")
    picked = got.select(F.unix_millis("created_ts"), F.unix_millis("committed_ts"), "shard", "batch_id").collect()
    assert [tuple(r)[:2] + (r.batch_id,) for r in picked] == [(500, 2500, 7), (500, 2500, 7), (9000, 9000, 8)]
    assert all(0 <= r.shard < 5 for r in picked)


def test_job_replayed_after_every_step(spark, monkeypatch):
    """A batch that fails between its writes is folded again from the same state, and counts once."""
    first, second = (fold.slim_alarms(alarms(spark, parse(t))) for t in ("D@0 U@5 D@9", "U@20 D@30 U@31"))
    second = second.withColumns({"id": F.col("id") + 100, "ord": F.col("ord") + 100})
    for step in ("write_intervals", "write_daily_states"):
        root = work_folder(spark, "job")
        times = iter(range(1000, 90_000, 1000))
        work = fold.interval_fold(root, ttl_ms=60_000, clock=lambda _: next(times))  # noqa: B023
        work(first, 0)
        with monkeypatch.context() as patch:
            patch.setattr(fold, step, lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
            with pytest.raises(OSError):
                work(second, 1)
        work(second, 1)
        work(second, 1)
        assert seconds(tables.read_intervals(spark, f"{root}/intervals")) == [("A", 0, 5, 5), ("A", 9, 20, 11), ("A", 30, 31, 1)]
        daily = tables.read_daily_states(spark, f"{root}/daily").agg(F.sum("incidents"), F.sum("sum_down_ms")).first()
        assert tuple(daily) == (3, 17_000)


def test_recent_question_reads_one_day_and_no_fold(spark):
    path = work_folder(spark, "recent")
    tables.write_intervals(intervals(spark, [("A", d * DAY + 100, d * DAY + 101) for d in range(6)]), path)
    recent = tables.read_recent_intervals(spark, path, datetime(1970, 1, 6, 0, 2), timedelta(minutes=5))
    assert recent.count() == 1 and all("down_day=1970-01-0" in f for f in recent.inputFiles())
    assert {f.split("down_day=")[1][:10] for f in recent.inputFiles()} <= {"1970-01-05", "1970-01-06"}
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan and "GreaterThanOrEqual(down_at" in plan


def test_state_follows_the_batch_not_the_fleet(spark):
    """Of 5,000 nodes a batch touches ten: ten rows are written, and the others keep their state."""
    root = work_folder(spark, "job")
    work = fold.interval_fold(root, ttl_ms=None, clock=lambda _: 1000)
    work(fold.slim_alarms(alarms(spark, [(f"n{i}", 1417, 0.0) for i in range(5000)])), 0)
    few = fold.slim_alarms(alarms(spark, [(f"n{i}", 9999, 9.0) for i in range(10)]))
    work(few.withColumns({"id": F.col("id") + 9000, "ord": F.col("ord") + 9000}), 1)
    states = fold.state_table(spark, root)
    assert states.read_batch(1).count() == 10 and states.read().count() == 5010
    assert tables.read_intervals(spark, f"{root}/intervals").count() == 10
    states.merge(least=2)
    assert states.read().count() == 5000
    counts = {r.status: r.n for r in fold.read_node_state(spark, root).groupBy("status").agg(F.count("*").alias("n")).collect()}
    assert counts == {"DOWN": 4990, "UP": 10}
    work(few.withColumns({"id": F.col("id") + 9100, "ord": F.col("ord") + 9100}), 2)
    assert tables.read_intervals(spark, f"{root}/intervals").count() == 10
