"""Codes, limits, bucket bounds and bands that results depend on."""

DOWN_TRAPS = (1417, 1535)

DAY_MS = 86_400_000
STATE_TTL_MS = 48 * 3_600_000
FLAP_MS = 10_000
SHARDS = 5
SINK_FLUSH_MS = 2_000

CDC_TOPIC = "dbserver1.inventory.histalarms"
CDC_GROUP = "downfold"

FNV_OFFSET_BASIS = 2_166_136_261
FNV_PRIME = 16_777_619

# Histogram upper bounds (inclusive), seconds or rows.
OUTAGE_BOUNDS = (5.0, 15.0, 30.0, 60.0, 120.0, 300.0, 600.0, 1800.0, 3600.0)
LATENCY_BOUNDS = (0.1, 0.25, 0.5, 1.0, 2.0, 5.0, 10.0, 30.0, 60.0)
BATCH_BOUNDS = (100.0, 500.0, 1000.0, 2000.0, 5000.0, 10000.0)

# Labelled duration buckets: strict upper bound in ms, label. The last has no bound.
DURATION_BUCKETS = (
    (500, "1 <0.5s"),
    (1_000, "2 0.5-1s"),
    (2_000, "3 1-2s"),
    (5_000, "4 2-5s"),
    (10_000, "5 5-10s"),
    (30_000, "6 10-30s"),
    (60_000, "7 30-60s"),
    (None, "8 >60s"),
)

# Threshold bands: inclusive lower bound, band. The first has no bound.
BANDS = {
    "outages": ((None, "green"), (100, "yellow"), (500, "orange"), (2000, "red")),
    "avg_duration": ((None, "green"), (1, "yellow"), (5, "orange"), (30, "red")),
    "max_duration": ((None, "green"), (5, "yellow"), (30, "red")),
    "affected_nodes": ((None, "green"), (10, "yellow"), (50, "red")),
    "duration": ((None, "green"), (1, "yellow"), (5, "orange"), (30, "red")),
    "uptime": ((None, "red"), (80, "yellow"), (95, "green")),
    "down_nodes": ((None, "green"), (10, "orange"), (50, "red")),
    "error_rate": ((None, "green"), (1, "red")),
    "lag": ((None, "green"), (30, "yellow"), (60, "red")),
}
