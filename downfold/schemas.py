"""Explicit schemas of the tables that come from outside."""

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(**fields):
    return StructType([StructField(name, dtype, True) for name, dtype in fields.items()])


ALARMS = _struct(
    id=LongType(),
    node_id=StringType(),
    trap_id=IntegerType(),
    event_time=LongType(),
    created_at=TimestampType(),
)

# trap_id is a long here so that any integer decodes; only membership matters. The row id is
# text because nothing rests on it: a feed is ordered by partition and offset.
CDC_VALUE = _struct(
    payload=_struct(
        after=_struct(
            id=StringType(),
            node_id=StringType(),
            trap_id=LongType(),
            event_time=LongType(),
        )
    ),
    _corrupt=StringType(),
)

# Columns the Kafka reader provides and file-based stand-ins must provide.
CDC_MESSAGES = _struct(
    topic=StringType(),
    partition=IntegerType(),
    offset=LongType(),
    timestamp=TimestampType(),
    value=StringType(),
)

NODE_INTERVALS = _struct(
    node_id=StringType(),
    down_at=TimestampType(),
    up_at=TimestampType(),
    duration_ms=LongType(),
    duration_sec=DoubleType(),
    down_day=DateType(),
)

# Rows of the interval table: intervals with their commit record.
INTERVAL_COMMITS = StructType(
    NODE_INTERVALS.fields
    + _struct(
        created_ts=TimestampType(),
        committed_ts=TimestampType(),
        shard=IntegerType(),
        batch_id=LongType(),
    ).fields
)

DAILY_PARTIALS = _struct(
    node_id=StringType(),
    day=DateType(),
    sum_down_ms=LongType(),
    incidents=LongType(),
)

# Node state of the interval job; seen_ms is the time of the micro-batch that last refreshed a
# node, bucket a hash of the node.
JOB_STATE = _struct(
    bucket=IntegerType(),
    node_id=StringType(),
    id=LongType(),
    event_time=LongType(),
    down=BooleanType(),
    seen_ms=LongType(),
    batch=LongType(),
)

SAMPLES = _struct(
    ts=TimestampType(),
    metric=StringType(),
    labels=MapType(StringType(), StringType()),
    value=DoubleType(),
)

RULES = _struct(
    rule=StringType(),
    op=StringType(),
    threshold=DoubleType(),
    for_sec=LongType(),
    severity=StringType(),
    team=StringType(),
    summary=StringType(),
    no_data_is=DoubleType(),
)
