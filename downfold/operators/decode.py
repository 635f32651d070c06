"""From change messages to accepted alarms."""

from pyspark.sql import Column, DataFrame, functions as F

from downfold.constants import DOWN_TRAPS
from downfold.functions.scalar import classify_status, event_time_ms_to_ts
from downfold.schemas import CDC_VALUE

OK = "ok"

# Fields whose names are read in any case.
FIELDS = ("payload", "after", "id", "node_id", "trap_id", "event_time")

# One object, three deep at most, whose strings hold neither braces nor backslashes: nothing
# can stand behind it. Longer texts are not matched, so that matching stays shallow.
_TEXTS = r'[^{}"\\]*+(?:"[^"{}\\]*+"[^{}"\\]*+)*+'
_PLAIN = rf"\s*\{{{_TEXTS}(?:\{{{_TEXTS}(?:\{{{_TEXTS}\}}{_TEXTS})*+\}}{_TEXTS})*+\}}\s*"
_PLAIN_LENGTH = 4096


def _with_plain_names(text: Column) -> Column:
    """``text`` with the names of the fields in lower case; texts that have them so stay as they are."""
    lowered = text
    for name in FIELDS:
        lowered = F.regexp_replace(lowered, rf'"(?i:{name})"(\s*:)', rf'"{name}"$1')
    odd = text.rlike(rf'"(?=[^"]*[A-Z])(?i:{"|".join(FIELDS)})"\s*:')
    return F.when(odd, lowered).otherwise(text)


def _one_document(text: Column) -> Column:
    """Whether ``text`` is one JSON value and nothing more, as far as brackets and commas go.

    Readers stop at the end of the first value. What may stand behind it shows in one of two
    wrappings: a closing bracket breaks an object, a closing brace or a further value an array.
    """
    length = F.json_array_length(F.concat(F.lit("["), text, F.lit("]")))
    keys = F.json_object_keys(F.concat(F.lit('{"a":'), text, F.lit("}")))
    strictly = F.coalesce((length == 1) & keys.isNotNull(), F.lit(False))
    plain = (F.length(text) <= _PLAIN_LENGTH) & text.rlike(f"^{_PLAIN}$")
    return F.when(plain, F.lit(True)).otherwise(strictly)


def decode_cdc(messages: DataFrame) -> DataFrame:
    """Add ``id, node_id, trap_id, event_time`` and the ``reject`` reason (null when decodable).

    Missing or null fields take the zero value of their type, as the deciding rule of the
    data model says. A message is undecodable when the text is blank, is not exactly
    one JSON document (no single quotes, no NaN, nothing behind it), or holds a field of the
    wrong type. Names of fields are read in any case. The document ``null`` is decodable and names no node. ``id`` is null when it
    is not an integer; it does not decide on anything. Spark would read a numeric node as
    text, so node values that do not look like plain names are checked against the type the
    text really has.
    """
    options = {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": "_corrupt",
        "allowSingleQuotes": "false",
        "allowNonNumericNumbers": "false",
    }
    # Unfolding a one-element array keeps later filters from being pushed below the parse,
    # where they would parse every message a second time.
    text = _with_plain_names(F.col("value"))
    document = F.array(F.struct(F.from_json(text, CDC_VALUE, options).alias("doc"), text.alias("text")))
    parsed = messages.withColumn("_read", F.explode(document))
    parsed = parsed.select(*messages.columns, F.col("_read.doc").alias("_doc"), F.col("_read.text").alias("_text"))
    after = F.col("_doc.payload.after")
    node = after["node_id"]
    raw_type = F.schema_of_variant(
        F.try_variant_get(F.try_parse_json("_text"), "$.payload.after.node_id", "variant")
    )
    not_text = F.when(node.rlike(r"^([-0-9\[{]|true$|false$)"), raw_type != "STRING").otherwise(False)
    bare = F.btrim("value", F.lit(" \t\r\n"))
    undecodable = (
        F.col("value").isNull()
        | (bare == "")
        | ~_one_document(F.col("_text"))
        | ((bare != "null") & F.col("_doc._corrupt").isNotNull())
        | F.coalesce(not_text, F.lit(False))
    )
    keep = [F.col(c) for c in messages.columns]
    return parsed.select(
        *keep,
        F.expr("try_cast(_doc.payload.after.id AS BIGINT)").alias("id"),
        F.coalesce(node, F.lit("")).alias("node_id"),
        F.coalesce(after["trap_id"], F.lit(0)).alias("trap_id"),
        F.coalesce(after["event_time"], F.lit(0)).alias("event_time"),
        F.when(undecodable, "json_unmarshal").alias("reject"),
    )


def reject_malformed(decoded: DataFrame) -> DataFrame:
    """The undecodable messages."""
    return decoded.where(F.col("reject").isNotNull())


def decode_errors(decoded: DataFrame) -> DataFrame:
    """Undecodable messages counted by (type, operation)."""
    return (
        reject_malformed(decoded)
        .groupBy(F.col("reject").alias("type"), F.lit("kafka").alias("operation"))
        .agg(F.count(F.lit(1)).alias("errors"))
    )


def skip_empty_node(decoded: DataFrame) -> DataFrame:
    """Decodable messages that name a node; deletions do not."""
    return decoded.where(F.col("reject").isNull() & (F.col("node_id") != ""))


def skipped_by_reason(decoded: DataFrame) -> DataFrame:
    """Decodable messages dropped for lack of a node, counted by reason."""
    return (
        decoded.where(F.col("reject").isNull() & (F.col("node_id") == ""))
        .groupBy(F.lit("empty_node_id").alias("reason"))
        .agg(F.count(F.lit(1)).alias("skipped"))
    )


def with_status(alarms: DataFrame, down_traps=DOWN_TRAPS) -> DataFrame:
    """Add status and the event time as a timestamp."""
    return alarms.withColumns(
        {
            "status": classify_status(F.col("trap_id"), down_traps),
            "event_ts": event_time_ms_to_ts(F.col("event_time")),
        }
    )


def arrival_of(partition: Column, offset: Column) -> Column:
    """One long that orders messages by partition and offset; offsets stay below 2^48."""
    return F.shiftleft(partition.cast("long"), 48) + offset


def accepted_alarms(messages: DataFrame, down_traps=DOWN_TRAPS) -> DataFrame:
    """Messages to alarms: decode, drop what cannot be used, classify.

    ``arrival`` is the place in the feed. The folds go by it where it is there: updates,
    redeliveries and rows read again carry old ids but arrive when they arrive. A node's
    messages are expected in one partition.
    """
    kept = skip_empty_node(decode_cdc(messages)).withColumn("arrival", arrival_of(F.col("partition"), F.col("offset")))
    return with_status(kept, down_traps).select(
        "id", "arrival", "node_id", "trap_id", "event_time", "event_ts", "status", F.col("timestamp").alias("created_at")
    )


def messages_by_status(messages: DataFrame) -> DataFrame:
    """Accepted messages counted by (topic, status)."""
    return (
        skip_empty_node(decode_cdc(messages))
        .groupBy("topic", F.lit(OK).alias("status"))
        .agg(F.count(F.lit(1)).alias("messages"))
    )
