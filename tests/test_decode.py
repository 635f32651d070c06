import json

import pytest
from pyspark.sql import functions as F

from downfold.functions import scalar
from downfold.operators import decode
from downfold.schemas import CDC_MESSAGES
from downfold.sources import alarms as alarm_source
from downfold.sources.cdc import cdc_options


def after(**fields):
    return json.dumps({"payload": {"after": fields, "op": "c"}})


def messages(spark, values):
    rows = [("t", 0, i, None, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, CDC_MESSAGES)


SOUND = {"id": 7, "node_id": "NODE_1", "trap_id": 1417, "event_time": 5000}

REJECTED = {
    "truncated": after(**SOUND)[:30],
    "not json": "hello",
    "blank": "   ",
    "empty": "",
    "tombstone": None,
    "trap as text": after(**{**SOUND, "trap_id": "1417"}),
    "trap as fraction": after(**{**SOUND, "trap_id": 1417.0}),
    "time as text": after(**{**SOUND, "event_time": "5000"}),
    "numeric node": after(**{**SOUND, "node_id": 5}),
    "boolean node": after(**{**SOUND, "node_id": True}),
    "object node": after(**{**SOUND, "node_id": {"a": 1}}),
    "single quotes": after(**SOUND).replace('"', "'"),
    "text behind": after(**SOUND) + " x",
    "brace behind": after(**SOUND) + "}",
    "two documents": after(**SOUND) + after(**SOUND),
    "two with a comma": after(**SOUND) + "," + after(**SOUND),
    "bracket behind": after(**SOUND) + "]",
    "bracket and text behind": after(**SOUND) + "] junk",
    "bracket and brace behind": after(**SOUND) + "]}",
    "brace and bracket behind": after(**SOUND) + "}]",
    "comma behind": after(**SOUND) + ",",
    "value behind": after(**SOUND) + ",1",
    "array behind": after(**SOUND) + "],[1",
    "field behind": after(**SOUND) + ',"b":2',
    "object field behind": after(**SOUND) + ',"b":{}',
    "braces in texts hide a field behind": '{"k":"{",' + after(**SOUND)[1:] + ',"b":{"c}":1}',
    "null and more": "null,null",
    "long with text behind": after(**SOUND, more=["x" * 9] * 2000) + " x",
    "node of another case is a number": after(id=7, NODE_ID=5, trap_id=1417, event_time=5000),
    "NaN nobody reads": '{"ts_ms":NaN,' + after(**SOUND)[1:],
}

SKIPPED = {
    "empty node": after(**{**SOUND, "node_id": ""}),
    "missing node": after(trap_id=1417, event_time=1),
    "null node": after(**{**SOUND, "node_id": None}),
    "deletion": '{"payload":{"after":null,"op":"d"}}',
    "no payload": "{}",
    "null document": " null ",
}

ACCEPTED = {
    "sound": (after(**SOUND), ("NODE_1", 1417, 5000)),
    "update": (json.dumps({"payload": {"before": SOUND, "after": SOUND, "op": "u", "ts_ms": 1}}), ("NODE_1", 1417, 5000)),
    "no trap": (after(node_id="N", event_time=1), ("N", 0, 1)),
    "null trap": (after(node_id="N", trap_id=None, event_time=1), ("N", 0, 1)),
    "no time": (after(node_id="N", trap_id=9999), ("N", 9999, 0)),
    "large trap": (after(node_id="N", trap_id=3_000_000_000, event_time=1), ("N", 3_000_000_000, 1)),
    "row id as text": (after(**{**SOUND, "id": "seven"}), ("NODE_1", 1417, 5000)),
    "row id as fraction": (after(**{**SOUND, "id": 7.5}), ("NODE_1", 1417, 5000)),
    "blanks around": (" \n" + after(**SOUND) + "\t", ("NODE_1", 1417, 5000)),
    "digits as text": (after(node_id="15", trap_id=1, event_time=1), ("15", 1, 1)),
    "word true as text": (after(node_id="true", trap_id=1, event_time=1), ("true", 1, 1)),
    "names in another case": (after(**SOUND).replace("payload", "Payload").replace("after", "AFTER").replace("node_id", "Node_Id"), ("NODE_1", 1417, 5000)),
    "all names in capitals": ('{"PAYLOAD": {"AFTER" :{"ID":7,"NODE_ID":"n","TRAP_ID":1535,"EVENT_TIME":9}}}', ("n", 1535, 9)),
    "names in texts stay": (after(**{**SOUND, "node_id": 'a "NODE_ID": b'}), ('a "NODE_ID": b', 1417, 5000)),
    "braces in texts": (after(**{**SOUND, "node_id": "}{"}), ("}{", 1417, 5000)),
    "quotes in texts": (after(**{**SOUND, "node_id": '"}\\'}), ('"}\\', 1417, 5000)),
    "deep": (json.dumps({"payload": {"after": SOUND, "a": {"b": {"c": {"d": [{}]}}}}}), ("NODE_1", 1417, 5000)),
    "long": (after(**SOUND, more=["x" * 9] * 2000), ("NODE_1", 1417, 5000)),
    "many texts": (json.dumps({"more": {f"k{i}": "v" for i in range(300)}, "payload": {"after": SOUND}}), ("NODE_1", 1417, 5000)),
    "other fields": (json.dumps({"schema": {"x": 1}, "payload": {"after": {**SOUND, "more": [1]}}}), ("NODE_1", 1417, 5000)),
}


@pytest.mark.parametrize("name", REJECTED)
def test_rejected(spark, name):
    row = decode.decode_cdc(messages(spark, [REJECTED[name]])).first()
    assert row.reject == "json_unmarshal"


@pytest.mark.parametrize("name", SKIPPED)
def test_skipped(spark, name):
    decoded = decode.decode_cdc(messages(spark, [SKIPPED[name]]))
    assert decoded.first().reject is None
    assert [tuple(r) for r in decode.skipped_by_reason(decoded).collect()] == [("empty_node_id", 1)]
    assert decode.skip_empty_node(decoded).count() == 0


@pytest.mark.parametrize("name", ACCEPTED)
def test_accepted(spark, name):
    text, expected = ACCEPTED[name]
    row = decode.accepted_alarms(messages(spark, [text])).first()
    assert (row.node_id, row.trap_id, row.event_time) == expected


def test_counts(spark):
    wide = messages(spark, [*REJECTED.values(), *SKIPPED.values(), *(t for t, _ in ACCEPTED.values())])
    decoded = decode.decode_cdc(wide)
    assert [tuple(r) for r in decode.decode_errors(decoded).collect()] == [("json_unmarshal", "kafka", len(REJECTED))]
    assert decode.reject_malformed(decoded).count() == len(REJECTED)
    assert [tuple(r) for r in decode.messages_by_status(wide).collect()] == [("t", "ok", len(ACCEPTED))]


def test_status(spark):
    df = spark.createDataFrame([(1417,), (1535,), (9999,), (0,), (None,)], "trap_id int")
    got = [r[0] for r in df.select(scalar.classify_status(F.col("trap_id"))).collect()]
    assert got == ["DOWN", "DOWN", "UP", "UP", "UP"]
    assert df.select(scalar.classify_status(F.col("trap_id"), (9999,))).collect()[2][0] == "DOWN"


def test_fnv_is_per_byte(spark):
    def brute(text):
        h = 2166136261
        for b in text.encode():
            h = (h ^ b) * 16777619 % 2**32
        return h

    words = ["", "a", "NODE_17", "Zürich", "節点", "x" * 50]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = {r[0]: (r[1], r[2]) for r in df.select("w", scalar.fnv1a_32(F.col("w")), scalar.shard_of(F.col("w"))).collect()}
    assert got == {w: (brute(w), brute(w) % 5) for w in words}


def test_reader_options():
    options = cdc_options("b1:9092,b2:9092", "topic.x", group="g", max_offsets_per_trigger=1000)
    assert options["subscribe"] == "topic.x" and options["maxOffsetsPerTrigger"] == "1000"
    assert options["groupIdPrefix"] == "g" and options["startingOffsets"] == "earliest"
    jdbc = alarm_source.jdbc_options("jdbc:x", "histalarms", 1, 10_000, 16)
    assert jdbc["partitionColumn"] == "id" and jdbc["numPartitions"] == "16" and jdbc["upperBound"] == "10000"
