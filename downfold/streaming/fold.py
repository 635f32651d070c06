"""The outage fold on a stream of alarms, in two forms that both equal the batch fold.

``downtime_intervals_stream`` is a streaming DataFrame with keyed state. A micro-batch hands
each node's new alarms to one call, so the reader's admission limit (offsets or files per
trigger) must bound a micro-batch to what one task can hold for a node.

``start_interval_job`` folds each micro-batch with the batch operators, JVM-side and sliced,
so even a backlog in which one node holds most rows is spread over tasks. It writes the
interval table, the daily partials and the node state.
"""

import sys
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from downfold.constants import DOWN_TRAPS, STATE_TTL_MS
from downfold.functions.ordered import lag_in_key
from downfold.functions.scalar import is_down, utc_day
from downfold.operators.sla import daily_node_partials
from downfold.operators.state import ID_SPAN, arrival_column, intervals_of
from downfold.schemas import JOB_STATE
from downfold.sources.daytable import DayTable
from downfold.sources.intervals import write_daily_states, write_intervals

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

STATE_DDL = "down BOOLEAN, event_time BIGINT"
# Workers get the processor's code itself, so they need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

EMITTED_DDL = "node_id STRING, down_ms BIGINT, up_ms BIGINT"


class OutageFold(StatefulProcessor):
    """Per node: the last alarm's status and time, forgotten when not refreshed in time."""

    def __init__(self, ttl_ms: int | None):
        self._ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._last = handle.getValueState("last", STATE_DDL, self._ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # Three plain arrays per node are all that is kept of a micro-batch.
        parts = [(p["ord"].to_numpy(), p["event_time"].to_numpy(), p["down"].to_numpy(bool)) for p in rows]
        order, times, down = (np.concatenate(column) for column in zip(*parts, strict=True))
        by_arrival = np.argsort(order, kind="stable")
        times, down = times[by_arrival], down[by_arrival]

        # Without a live state, an UP at the first alarm's own time stands for "no outage open".
        before_down, before_time = self._last.get() if self._last.exists() else (False, times[0])
        prev_down = np.concatenate(([before_down], down[:-1]))
        prev_time = np.concatenate(([before_time], times[:-1]))
        closes = prev_down & ~down & (times > prev_time)
        self._last.update((bool(down[-1]), int(times[-1])))
        if closes.any():
            yield pd.DataFrame({"node_id": key[0], "down_ms": prev_time[closes], "up_ms": times[closes]})

    def close(self) -> None:
        pass


def downtime_intervals_stream(
    alarm_stream: DataFrame,
    ttl_ms: int | None = STATE_TTL_MS,
    order: str | None = None,
    down_traps=DOWN_TRAPS,
) -> DataFrame:
    """Streaming outage intervals; state expires by processing time when not refreshed.

    Inside a micro-batch alarms go by ``order``: the arrival of messages, the id of table
    rows. With messages the cut into micro-batches therefore does not matter.
    """
    order = order or arrival_column(alarm_stream)
    slim = alarm_stream.select(
        "node_id",
        F.col(order).cast("long").alias("ord"),
        "event_time",
        F.coalesce(is_down(F.col("trap_id"), down_traps), F.lit(False)).alias("down"),
    )
    folded = slim.groupBy("node_id").transformWithStateInPandas(
        statefulProcessor=OutageFold(ttl_ms),
        outputStructType=EMITTED_DDL,
        outputMode="Append",
        timeMode="ProcessingTime" if ttl_ms is not None else "None",
    )
    duration = F.col("up_ms") - F.col("down_ms")
    down_at = F.timestamp_millis("down_ms")
    return folded.select(
        "node_id",
        down_at.alias("down_at"),
        F.timestamp_millis("up_ms").alias("up_at"),
        duration.alias("duration_ms"),
        (duration / 1000.0).alias("duration_sec"),
        utc_day(down_at).alias("down_day"),
    )


@contextmanager
def stateful_settings(spark: SparkSession):
    """Settings a query with keyed state and expiry takes when it starts, undone after.

    Expired state is skipped when read, so batches without data are not needed for it. With
    them a query that should end when all input is read never would.
    """
    wanted = {
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    }
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


# Place of a stored state in a node's order: before every alarm of the new micro-batch.
BEFORE_ALL = -(1 << 62)


def fold_batch(batch: DataFrame, state: DataFrame | None, ttl_ms: int | None, now_ms: int):
    """(intervals, new state) of one micro-batch of ``(node_id, id, event_time, down)`` rows.

    An interval comes into being (``created_ts``) when the alarm that closes it reaches the
    feed: at the batch's ``arrived_ms`` where it has that, else at ``now_ms``. The stored state of a node takes part as an alarm before all new ones, whatever their
    ids: it can open an outage but not close one. Inside the batch the order is by ``ord``
    where the batch has it, else by id.
    """
    order = F.col("ord" if "ord" in batch.columns else "id").alias("ord")
    arrived = F.coalesce("arrived_ms", F.lit(now_ms)) if "arrived_ms" in batch.columns else F.lit(now_ms)
    rows = batch.select(
        "node_id", "id", "event_time", "down", F.lit(now_ms).alias("seen_ms"), order, arrived.alias("arrived_ms")
    )
    if state is not None:
        live = state if ttl_ms is None else state.where(F.col("seen_ms") >= now_ms - ttl_ms)
        before = live.withColumns({"ord": F.lit(BEFORE_ALL), "arrived_ms": F.col("seen_ms")})
        rows = rows.unionByName(before.select(rows.columns))
    seen = lag_in_key(rows, ["node_id"], ["ord"], ["down", "event_time"], "prev", ID_SPAN)
    last = rows.groupBy("node_id").agg(
        *[F.max_by(name, "ord").alias(name) for name in ("id", "event_time", "down", "seen_ms")]
    )
    return intervals_of(seen, F.timestamp_millis("arrived_ms").alias("created_ts")), last


#: Parts by node in which the job's state is kept, and how long readers of an older state keep it.
STATE_BUCKETS, STATE_GRACE_MS = 16, 60_000


def _bucket() -> Column:
    return F.pmod(F.crc32(F.col("node_id").cast("binary")), F.lit(STATE_BUCKETS)).cast("int")


def _newest(states: DataFrame) -> DataFrame:
    """Of each node the state of the last batch that touched it."""
    kept = [F.max_by(c, "batch").alias(c) for c in ("id", "event_time", "down", "seen_ms")]
    return states.groupBy("bucket", "node_id").agg(*kept, F.max("batch").alias("batch"))


def state_table(spark: SparkSession, root: str) -> DayTable:
    """The job's node state: a batch adds the nodes it touched, merges leave the newest of each node."""
    return DayTable(
        spark, f"{root}/state", JOB_STATE, "bucket", ["node_id"], merge=_newest, grace_ms=STATE_GRACE_MS
    )


def _state_before(table: DayTable, batch: DataFrame, batch_id: int) -> DataFrame:
    """The state that the nodes of a micro-batch had before it; other buckets are not read."""
    touched = batch.select("node_id", _bucket().alias("bucket")).distinct()
    buckets = [r["bucket"] for r in touched.select("bucket").distinct().collect()]
    older = table.read_days(buckets).where(F.col("batch") < batch_id)
    return _newest(older.join(touched.select("node_id"), "node_id", "left_semi")).drop("bucket")


def wall_clock(batch: DataFrame) -> int:
    """Epoch ms now."""
    return time.time_ns() // 1_000_000


def batch_time(table: DayTable, batch_id: int, now: Callable[[], int]) -> int:
    """Processing time of a micro-batch in epoch ms: the one its state holds if this is a replay, else now."""
    kept = table.read_batch(batch_id).agg(F.max("seen_ms")).first()[0]
    return kept if kept is not None else now()


def slim_alarms(alarms: DataFrame, down_traps=DOWN_TRAPS) -> DataFrame:
    """What the job needs of alarms, bounded or streaming; ``arrived_ms`` is when an alarm reached the feed."""
    arrived = F.unix_millis("created_at") if "created_at" in alarms.columns else F.lit(None).cast("long")
    return alarms.select(
        "node_id",
        "id",
        "event_time",
        F.coalesce(is_down(F.col("trap_id"), down_traps), F.lit(False)).alias("down"),
        F.col(arrival_column(alarms)).alias("ord"),
        arrived.alias("arrived_ms"),
    )


def interval_fold(
    root: str, ttl_ms: int | None = STATE_TTL_MS, clock: Callable[[DataFrame], int] = wall_clock
) -> Callable[[DataFrame, int], None]:
    """The work of the job on one micro-batch of ``slim_alarms`` and its id.

    ``clock`` gives the time at which a batch is taken up and the time at which its
    intervals are committed. The state goes first, with the time of the batch: a replay
    after a failure at any later point folds from the same state at the same time, and what
    is committed already is left as it is.
    """

    def fold(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        states = state_table(spark, root)
        batch.persist()
        if states.version().has(batch_id):
            now_ms = batch_time(states, batch_id, lambda: clock(batch))
        else:
            states.merge()  # now, and not after a commit: a replay needs the state before its batch
            now_ms = clock(batch)
        intervals, last = fold_batch(batch, _state_before(states, batch, batch_id), ttl_ms, now_ms)
        intervals.persist()
        try:
            stamped = last.withColumns({"batch": F.lit(batch_id).cast("long"), "bucket": _bucket()})
            states.commit(stamped, batch_id, merge=False)
            write_intervals(intervals, f"{root}/intervals", batch_id, clock(batch))
            write_daily_states(daily_node_partials(intervals), f"{root}/daily", batch_id)
        finally:
            intervals.unpersist()
            batch.unpersist()

    return fold


def start_interval_job(
    alarm_stream: DataFrame,
    root: str,
    checkpoint: str,
    ttl_ms: int | None = STATE_TTL_MS,
    trigger: dict | None = None,
    down_traps=DOWN_TRAPS,
    clock: Callable[[DataFrame], int] = wall_clock,
) -> StreamingQuery:
    """Fold a stream of alarms into ``root/intervals``, ``root/daily`` and ``root/state``.

    A micro-batch reads the state of the nodes it touches and adds their new state; parts
    of the state are merged now and then. So what it writes follows the batch, not the
    fleet. A replayed micro-batch starts from the same state, takes the time its first run
    left with its state, and adds nothing that its first run has committed.
    """
    slim = slim_alarms(alarm_stream, down_traps)
    writer = slim.writeStream.foreachBatch(interval_fold(root, ttl_ms, clock)).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "2 seconds"})).start()


def read_node_state(spark: SparkSession, root: str) -> DataFrame:
    """The newest node state a job wrote, as ``latest_node_state`` gives it."""
    return _newest(state_table(spark, root).read()).select(
        "node_id",
        F.when(F.col("down"), "DOWN").otherwise("UP").alias("status"),
        F.timestamp_millis("event_time").alias("last_seen_at"),
        "id",
    )
