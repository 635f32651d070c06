"""Small alarm histories and a brute-force fold to hold the operators against."""

from datetime import datetime, timezone

from pyspark.sql import functions as F

from downfold.schemas import ALARMS, NODE_INTERVALS

DOWN, UP = 1417, 9999


def alarms(spark, rows):
    """``rows`` of (node, trap, second) in arrival order."""
    data = [
        (i, node, trap, round(sec * 1000), datetime.fromtimestamp(0, timezone.utc))
        for i, (node, trap, sec) in enumerate(rows, 1)
    ]
    return spark.createDataFrame(data, ALARMS)


def parse(text, node="A", start=0.0):
    """``"D@0 U@5"`` as rows of one node; a number is a trap code."""
    out = []
    for part in text.split():
        what, sec = part.split("@")
        trap = {"D": DOWN, "U": UP}.get(what) or int(what)
        out.append((node, trap, start + float(sec)))
    return out


def intervals(spark, rows):
    """``rows`` of (node, down second, up second) as an interval table."""
    data = [(n, round(d * 1000), round(u * 1000)) for n, d, u in rows]
    df = spark.createDataFrame(data, "node_id string, d long, u long")
    return df.select(
        "node_id",
        F.timestamp_millis("d").alias("down_at"),
        F.timestamp_millis("u").alias("up_at"),
        (F.col("u") - F.col("d")).alias("duration_ms"),
        ((F.col("u") - F.col("d")) / 1000.0).alias("duration_sec"),
        F.timestamp_millis("d").cast("date").alias("down_day"),
    ).to(NODE_INTERVALS)


def seconds(df):
    """Intervals as sorted (node, down second, up second, seconds)."""
    picked = df.select(
        "node_id",
        (F.unix_millis("down_at") / 1000.0).alias("d"),
        (F.unix_millis("up_at") / 1000.0).alias("u"),
        "duration_sec",
    )
    return sorted(tuple(r) for r in picked.collect())


def brute_intervals(rows, ttl_sec=None):
    """The rule applied one alarm after another."""
    state, out = {}, []
    for node, trap, sec in rows:
        down = trap in (1417, 1535)
        before = state.get(node)
        if before and ttl_sec is not None and sec - before[1] > ttl_sec:
            before = None
        if before and before[0] and not down and sec > before[1]:
            out.append((node, before[1], sec, round(sec - before[1], 6)))
        state[node] = (down, sec)
    return sorted(out)
