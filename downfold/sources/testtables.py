"""The input tables of the package, derived in Spark from the whole ``events`` table.

Every event becomes one alarm of the node named after its user; nothing is sampled.
Three clocks exist because one set of timestamps cannot reach every branch:

- ``natural``: event time is the event's own timestamp (outages last hours)
- ``fast``: the same divided by 1000 (outages last seconds)
- ``late``: natural, but every seventh alarm carries a time 48 hours in the past

An alarm is inserted (``created_at``) a tenth of a second per unit of the event's value
after it happened, so ingest lag varies. Arrival order is ``id``.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from downfold.constants import CDC_TOPIC

EVENTS_DDL = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"

# Alarm code per event type; all other types are recoveries.
TRAP_BY_EVENT = {"error": 1417, "signup": 1535}
RECOVERY_TRAP = 9999


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_DDL).parquet(f"{sf_dir}/events.parquet")


def _trap():
    chain = F.when(F.col("event_type") == "error", TRAP_BY_EVENT["error"])
    return chain.when(F.col("event_type") == "signup", TRAP_BY_EVENT["signup"]).otherwise(RECOVERY_TRAP)


def alarms_of(events_df: DataFrame, clock: str = "natural") -> DataFrame:
    """Alarms from an events table, bounded or streaming."""
    natural = F.unix_millis(F.col("ts").cast("timestamp"))
    happened = F.floor(natural / 1000).cast("long") if clock == "fast" else natural
    event_time = happened
    if clock == "late":
        event_time = happened - F.when(F.col("event_id") % 7 == 0, 172_800_000).otherwise(0)
    delay = F.coalesce(F.rint(F.col("value") * 100).cast("long"), F.lit(0))
    return events_df.select(
        F.col("event_id").alias("id"),
        F.concat(F.lit("NODE_"), F.col("user_id").cast("string")).alias("node_id"),
        _trap().cast("int").alias("trap_id"),
        event_time.alias("event_time"),
        F.timestamp_millis(happened + delay).alias("created_at"),
    )


def alarms(spark: SparkSession, sf_dir: str, clock: str = "natural") -> DataFrame:
    return alarms_of(events(spark, sf_dir), clock)


def cdc_messages(spark: SparkSession, sf_dir: str, clock: str = "natural") -> DataFrame:
    """Every event as a change message; fixed shares are damaged the way real feeds are.

    By ``event_id % 50``: 0 truncated, 1 empty node, 2 deletion, 3 trap code as text,
    4 blank, 5 numeric node, 6 single quotes, 7 text behind the document, 8 two documents,
    9 NaN in a field nobody reads, 10 the document null, 11 a row id that is text, 12 to 16
    a bracket, a bracket and text, a brace, a further field, a further value behind the
    document, 17 names of fields in another case, 18 braces in a text; all others are sound.
    """
    ev = events(spark, sf_dir)
    natural = F.unix_millis(F.col("ts").cast("timestamp"))
    happened = F.floor(natural / 1000).cast("long") if clock == "fast" else natural

    def envelope(node, trap):
        after = F.struct(
            F.col("event_id").alias("id"),
            node.alias("node_id"),
            trap.alias("trap_id"),
            happened.alias("event_time"),
        )
        payload = F.struct(after.alias("after"), F.lit("c").alias("op"))
        return F.to_json(F.struct(payload.alias("payload")))

    node = F.concat(F.lit("NODE_"), F.col("user_id").cast("string"))
    trap = _trap()
    sound = envelope(node, trap)
    kind = F.col("event_id") % 50
    value = (
        F.when(kind == 0, F.left(sound, F.lit(40)))
        .when(kind == 1, envelope(F.lit(""), trap))
        .when(kind == 2, F.lit('{"payload":{"after":null,"op":"d"}}'))
        .when(kind == 3, envelope(node, trap.cast("string")))
        .when(kind == 4, F.lit("  "))
        .when(kind == 5, envelope(F.col("user_id"), trap))
        .when(kind == 6, F.translate(sound, '"', "'"))
        .when(kind == 7, F.concat(sound, F.lit(" x")))
        .when(kind == 8, F.concat(sound, sound))
        .when(kind == 9, F.concat(F.lit('{"ts_ms":NaN,'), F.substr(sound, F.lit(2))))
        .when(kind == 10, F.lit(" null "))
        .when(kind == 11, F.regexp_replace(sound, '"id":([0-9]+)', '"id":"row $1"'))
        .when(kind == 12, F.concat(sound, F.lit("]")))
        .when(kind == 13, F.concat(sound, F.lit("] x")))
        .when(kind == 14, F.concat(sound, F.lit("}")))
        .when(kind == 15, F.concat(sound, F.lit(',"more":{}')))
        .when(kind == 16, F.concat(sound, F.lit(",1")))
        .when(kind == 17, F.regexp_replace(F.regexp_replace(sound, '"node_id"', '"Node_Id"'), '"payload"', '"PAYLOAD"'))
        .when(kind == 18, F.concat(F.lit('{"note":"}{",'), F.substr(sound, F.lit(2))))
        .otherwise(sound)
    )
    return ev.select(
        F.lit(CDC_TOPIC).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.timestamp_millis(happened).alias("timestamp"),
        value.alias("value"),
    )


def repeated_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed of two partitions, by node, in which rows come again: every seventh as an update
    five events later, every eleventh read again thirty events later. Old ids, late offsets."""
    messages = cdc_messages(spark, sf_dir)
    event, later = F.col("offset"), F.col("_later")
    again = F.array_compact(
        F.array(F.lit(0), F.when(event % 7 == 0, 5), F.when(event % 11 == 0, 30))
    )
    node = F.coalesce(F.get_json_object(F.lower("value"), "$.payload.after.node_id"), F.lit(""))
    place = (event + later) * 3 + F.when(later == 0, 0).when(later == 5, 1).otherwise(2)
    return messages.withColumn("_later", F.explode(again)).select(
        "topic",
        F.pmod(F.crc32(node.cast("binary")), F.lit(2)).cast("int").alias("partition"),
        place.alias("offset"),
        "timestamp",
        "value",
    )


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as one metric sample: a counter per node that falls back at random.

    Values are whole hundredths, so that sums do not depend on their order.
    """
    return events(spark, sf_dir).select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.lit("node_work_total").alias("metric"),
        F.create_map(
            F.lit("instance"),
            F.concat(F.lit("NODE_"), F.col("user_id").cast("string")),
            F.lit("mode"),
            F.when(F.col("event_type") == "view", "idle").otherwise("busy"),
        ).alias("labels"),
        F.rint(F.col("value") * 100).alias("value"),
    )
