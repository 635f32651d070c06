import random

import pytest
from pyspark.sql import functions as F

from downfold.operators import decode, outages, sla, state
from downfold.schemas import CDC_MESSAGES
from downfold.session import work_folder
from downfold.sources import alarms as alarm_source, intervals as tables, testtables
from downfold.streaming import fold, rollup
from helpers import alarms, brute_intervals, intervals, parse, seconds

ONCE = {"availableNow": True}


def land(spark, df, folder, batches, ids):
    """Write alarms in arrival order as one file per batch."""
    step = -(-ids // batches)
    for b in range(batches):
        part = df.where(F.col("id").between(b * step + 1, (b + 1) * step))
        part.coalesce(1).write.mode("append").parquet(folder)


def history(n=240):
    rng = random.Random(6)
    return [
        (rng.choice(["hot", "hot", "a", "b", "c"]), rng.choice([1417, 9999, 9999]), float(i * 5 - rng.choice([0, 0, 0, 40])))
        for i in range(n)
    ]


def test_keyed_stream_equals_batch(spark):
    rows = history()
    landed, out = work_folder(spark, "landed"), work_folder(spark, "out")
    land(spark, alarms(spark, rows), landed, 3, len(rows))
    stream = fold.downtime_intervals_stream(alarm_source.stream_alarms(spark, landed, 1))
    with fold.stateful_settings(spark):
        query = rollup.start_interval_sink(stream, out, work_folder(spark, "cp"), ONCE)
    assert query.awaitTermination(120)
    assert seconds(tables.read_intervals(spark, out)) == brute_intervals(rows)


def test_job_equals_batch_and_survives_restart(spark):
    rows = history()
    df = alarms(spark, rows)
    landed, root, checkpoint = (work_folder(spark, n) for n in ("landed", "root", "cp"))

    def run():
        stream = alarm_source.stream_alarms(spark, landed, 1)
        query = fold.start_interval_job(stream, root, checkpoint, ttl_ms=None, trigger=ONCE)
        assert query.awaitTermination(120)

    land(spark, df.where("id <= 120"), landed, 2, 120)
    run()
    df.where("id > 120").coalesce(1).write.mode("append").parquet(landed)
    run()
    assert seconds(tables.read_intervals(spark, f"{root}/intervals")) == brute_intervals(rows)
    batch = sla.node_sla_report(sla.daily_node_partials(state.downtime_intervals(df)))
    report = sla.node_sla_report(tables.read_daily_states(spark, f"{root}/daily"))
    assert sorted(map(tuple, report.collect())) == sorted(map(tuple, batch.collect()))
    got = fold.read_node_state(spark, root).select("node_id", "status", "last_seen_at", "id")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, state.latest_node_state(df).collect()))


def slim(df):
    return df.select("node_id", "id", "event_time", (F.col("trap_id") == 1417).alias("down"))


def test_fold_of_a_batch_is_the_same_when_repeated(spark):
    _, after = fold.fold_batch(slim(alarms(spark, parse("D@0 U@3 D@9"))), None, None, 0)
    second = slim(alarms(spark, parse("U@20 D@30"))).withColumn("id", F.col("id") + 100)
    for _ in range(2):
        out, last = fold.fold_batch(second, after, None, 0)
        assert seconds(out) == [("A", 9, 20, 11)]
        assert [(r.id, r.down, r.event_time) for r in last.collect()] == [(102, True, 30_000)]


def test_stored_state_precedes_smaller_ids(spark):
    """Arrival decides: a later micro-batch follows the state even with smaller ids."""
    first = slim(alarms(spark, parse("D@0 U@3"))).withColumn("id", F.col("id") + 100)
    _, after = fold.fold_batch(first, None, None, 0)
    out, last = fold.fold_batch(slim(alarms(spark, parse("D@1 U@2"))), after, None, 0)
    assert seconds(out) == [("A", 1, 2, 1)]
    assert [(r.id, r.down) for r in last.collect()] == [(2, False)]
    unchanged, kept = fold.fold_batch(slim(alarms(spark, [])), after, None, 0)
    assert unchanged.count() == 0 and [(r.id, r.down) for r in kept.collect()] == [(102, False)]


def test_state_expires_in_the_job(spark):
    _, after = fold.fold_batch(slim(alarms(spark, parse("D@0"))), None, 1000, 5000)
    closing = slim(alarms(spark, parse("U@20"))).withColumn("id", F.col("id") + 10)
    assert fold.fold_batch(closing, after, 1000, 6000)[0].count() == 1
    assert fold.fold_batch(closing, after, 1000, 6001)[0].count() == 0


def test_replay_takes_the_time_of_the_first_run(spark):
    states = fold.state_table(spark, work_folder(spark, "root"))
    assert fold.batch_time(states, 0, lambda: 7) == 7
    _, last = fold.fold_batch(slim(alarms(spark, parse("D@0"))), None, 1000, 5000)
    states.commit(last.withColumns({"batch": F.lit(0).cast("long"), "bucket": F.lit(1)}), 0, merge=False)
    assert [fold.batch_time(states, n, lambda: 7) for n in (0, 1, 2)] == [5000, 7, 7]
    assert fold.wall_clock(last) > 1_600_000_000_000


def test_replayed_batch_does_not_double(spark):
    df = intervals(spark, [("A", 0, 5), ("B", 90_000, 90_007)])
    path, daily = work_folder(spark, "i"), work_folder(spark, "d")
    for _ in range(2):
        tables.write_intervals(df, path, 3)
        tables.write_daily_states(sla.daily_node_partials(df), daily, 3)
    tables.write_intervals(intervals(spark, [("A", 10, 11)]), path, 4)
    assert tables.read_intervals(spark, path).count() == 3
    assert tables.read_daily_states(spark, daily).agg(F.sum("incidents")).first()[0] == 2
    only = tables.read_intervals(spark, path, "1970-01-02", "1970-01-02")
    assert [r.node_id for r in only.collect()] == ["B"]
    assert all("down_day=1970-01-02" in name for name in only.inputFiles())


@pytest.mark.parametrize("batches", [1, 3])
def test_rollup_stream(spark, batches):
    rows = [("A", i * 40_000, i * 40_000 + 9) for i in range(6)]
    landed, out = work_folder(spark, "landed"), work_folder(spark, "out")
    for b in range(batches):
        intervals(spark, rows[b::batches]).coalesce(1).write.mode("append").parquet(landed)
    stream = spark.readStream.schema(intervals(spark, []).schema).option("maxFilesPerTrigger", 1).parquet(landed)
    assert rollup.daily_rollup_stream(stream, out, work_folder(spark, "cp"), ONCE).awaitTermination(120)
    merged = sla.daily_node_stats(tables.read_daily_states(spark, out))
    direct = sla.daily_node_partials(intervals(spark, rows))
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, direct.collect()))


def test_compaction_keeps_sums(spark):
    path = work_folder(spark, "d")
    for b in range(3):
        part = sla.daily_node_partials(intervals(spark, [("A", b, b + 2)]))
        tables.write_daily_states(part, path, b)
    tables.compact_daily_states(spark, path)
    assert [tuple(r)[2:] for r in tables.read_daily_states(spark, path).collect()] == [(6000, 3)]


def test_messages_to_report(spark):
    """Change messages, damaged ones included, through the job to the SLA report."""
    landed, root = work_folder(spark, "messages"), work_folder(spark, "root")
    messages = testtables.cdc_messages(spark, "/root/testdata/sf0.001")
    for low in (0, 400):
        part = messages.where(F.col("offset").between(low, low + 399 if low == 0 else 10**9))
        part.coalesce(1).write.mode("append").parquet(landed)
    stream = spark.readStream.schema(messages.schema).option("maxFilesPerTrigger", 1).parquet(landed)
    query = fold.start_interval_job(decode.accepted_alarms(stream), root, work_folder(spark, "cp"), trigger=ONCE)
    assert query.awaitTermination(120)
    batch = state.downtime_intervals(decode.accepted_alarms(messages))
    assert batch.count() > 100
    assert seconds(tables.read_intervals(spark, f"{root}/intervals")) == seconds(batch)
    report = sla.node_sla_report(tables.read_daily_states(spark, f"{root}/daily"))
    expected = sla.node_sla_report(sla.daily_node_partials(batch))
    assert sorted(map(tuple, report.collect())) == sorted(map(tuple, expected.collect()))


@pytest.mark.parametrize("cuts", [[4], [3, 1], [1, 1, 1, 1], [2, 2]])
def test_feed_is_folded_in_arrival_order(spark, cuts):
    """A row sent again closes an outage though its id is older, however the feed is cut."""
    feed = [(10, 1417, 1000), (11, 9999, 5000), (12, 1417, 8000), (10, 9999, 9000)]
    rows = [
        ("t", 0, n, None, '{"payload":{"after":{"id":%d,"node_id":"A","trap_id":%d,"event_time":%d}}}' % message)
        for n, message in enumerate(feed, 1)
    ]
    expected = [("A", 1, 5, 4), ("A", 8, 9, 1)]
    whole = decode.accepted_alarms(spark.createDataFrame(rows, CDC_MESSAGES))
    assert seconds(state.downtime_intervals(whole)) == expected
    last = state.latest_node_state(whole).first()
    assert (last.status, last.id) == ("UP", 10)

    landed, root, out, cp = (work_folder(spark, n) for n in ("messages", "root", "out", "cp"))
    at = 0
    for size in cuts:
        spark.createDataFrame(rows[at : at + size], CDC_MESSAGES).coalesce(1).write.mode("append").parquet(landed)
        at += size
        stream = spark.readStream.schema(CDC_MESSAGES).parquet(landed)
        job = fold.start_interval_job(decode.accepted_alarms(stream), root, f"{root}/cp", ttl_ms=None, trigger=ONCE)
        assert job.awaitTermination(120)
        keyed = fold.downtime_intervals_stream(decode.accepted_alarms(stream), ttl_ms=None)
        with fold.stateful_settings(spark):
            assert rollup.start_interval_sink(keyed, out, cp, ONCE).awaitTermination(120)
    assert seconds(tables.read_intervals(spark, f"{root}/intervals")) == expected
    assert seconds(tables.read_intervals(spark, out)) == expected


def test_final_minutes_leave_the_state(spark):
    """Append mode: minutes come out once the watermark has passed, and only later ones are kept."""
    landed, out = work_folder(spark, "landed"), work_folder(spark, "out")
    for hours in (range(3), range(3, 6)):
        rows = [("A", h * 3600 + s, h * 3600 + s + 7) for h in hours for s in (0, 5, 70)]
        intervals(spark, rows).coalesce(1).write.mode("append").parquet(landed)
    stream = spark.readStream.schema(intervals(spark, []).schema).option("maxFilesPerTrigger", 1).parquet(landed)
    minutes = outages.outages_over_time_stream(stream, lateness="1 hour")
    writer = minutes.writeStream.format("parquet").outputMode("append").option("checkpointLocation", work_folder(spark, "cp"))
    query = writer.trigger(**ONCE).start(out)
    assert query.awaitTermination(120)
    got = sorted((int(r.time.timestamp()) if r.time.tzinfo else r.time.timestamp(), r.outages) for r in spark.read.parquet(out).collect())
    expected = [(h * 3600 + m * 60, 2 - m) for h in range(5) for m in range(2)]
    # the watermark is an hour before 5:01:10
    assert got == [e for e in expected if e[0] + 60 <= 4 * 3600 + 70]
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(kept) > kept[-1] == 12 - len(got)
