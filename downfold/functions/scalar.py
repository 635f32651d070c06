"""Column expressions shared by the operators. All are built-in Spark expressions."""

from functools import reduce

from pyspark.sql import Column, functions as F

from downfold.constants import (
    DAY_MS,
    DOWN_TRAPS,
    DURATION_BUCKETS,
    FNV_OFFSET_BASIS,
    FNV_PRIME,
    SHARDS,
)


def is_down(trap_id: Column, down_traps=DOWN_TRAPS) -> Column:
    return trap_id.isin(*down_traps)


def classify_status(trap_id: Column, down_traps=DOWN_TRAPS) -> Column:
    """DOWN for the given trap codes, UP for everything else (null included)."""
    return F.when(is_down(trap_id, down_traps), "DOWN").otherwise("UP")


def event_time_ms_to_ts(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def state_key(node_id: Column) -> Column:
    return F.concat(F.lit("node:"), node_id)


def round_half_even(x: Column, digits: int) -> Column:
    """Round half to even on the scaled double, so that no decimal conversion is involved."""
    scale = float(10**digits)
    return F.rint(x * scale) / scale


def mean_ms_as_sec(sum_ms: Column, n: Column) -> Column:
    """Mean of millisecond values in seconds, rounded to 3 digits. Null when empty."""
    return F.rint(sum_ms / n) / 1000.0


def floor_ms(ms: Column, step_ms: int) -> Column:
    return ms - F.pmod(ms, F.lit(step_ms))


def ceil_ms(ms: Column, step_ms: int) -> Column:
    return ms + F.pmod(-ms, F.lit(step_ms))


def utc_day(ts: Column) -> Column:
    """UTC date of a timestamp, independent of the session time zone."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.unix_millis(ts) / DAY_MS).cast("int"))


def hour_of_day(ts: Column) -> Column:
    return F.pmod(F.floor(F.unix_millis(ts) / 3_600_000), F.lit(24)).cast("int")


def whole_seconds_between(start: Column, end: Column) -> Column:
    """Difference of the two floored epoch seconds."""
    return F.unix_seconds(end) - F.unix_seconds(start)


def duration_bucket(duration_ms: Column) -> Column:
    """Labelled duration bucket; upper bounds are strict."""
    bounded = [(b, label) for b, label in DURATION_BUCKETS if b is not None]
    chain = reduce(
        lambda acc, step: acc.when(duration_ms < step[0], step[1]),
        bounded[1:],
        F.when(duration_ms < bounded[0][0], bounded[0][1]),
    )
    return chain.otherwise(DURATION_BUCKETS[-1][1])


def threshold_band(value: Column, steps) -> Column:
    """Band of the highest inclusive lower bound reached; null stays null."""
    chain = F.when(value.isNull(), F.lit(None).cast("string"))
    for bound, band in sorted((s for s in steps if s[0] is not None), reverse=True):
        chain = chain.when(value >= bound, band)
    return chain.otherwise(steps[0][1])


def fnv1a_32(text: Column) -> Column:
    """FNV-1a over the UTF-8 bytes, as a long in [0, 2**32)."""
    octets = F.encode(text, "UTF-8")
    positions = F.sequence(F.lit(1), F.greatest(F.octet_length(octets), F.lit(1)))
    hashed = F.aggregate(
        positions,
        F.lit(FNV_OFFSET_BASIS).cast("long"),
        lambda acc, i: F.pmod(
            acc.bitwiseXOR(F.conv(F.hex(F.substring(octets, i, F.lit(1))), 16, 10).cast("long")) * FNV_PRIME,
            F.lit(1 << 32),
        ),
    )
    return F.when(F.octet_length(octets) == 0, F.lit(FNV_OFFSET_BASIS).cast("long")).otherwise(hashed)


def shard_of(node_id: Column, shards: int = SHARDS) -> Column:
    return F.pmod(fnv1a_32(node_id), F.lit(shards)).cast("int")
