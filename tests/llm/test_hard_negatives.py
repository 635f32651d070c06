import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import oracle
from downfold.llm import hard_negatives, queries
from downfold.llm.hard_negatives import bounds, hilbert, mine, ordered_blocks

ROWS = "id long, label long, vector array<long>"


def brute(rows, every, positives=5, negatives=3):
    whole = {}
    for i, label, vector in rows:
        if i is not None and label is not None and vector is not None and None not in vector:
            whole[i] = min(whole.get(i, (label, vector)), (label, vector))
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a, (label, vector) in whole.items():
        if a % every:
            continue
        scored = sorted((-score(vector, v), i, other) for i, (other, v) in whole.items() if i != a)
        for minus, p, _ in [s for s in scored if s[2] == label][:positives]:
            fits = [s for s in scored if s[2] != label and 50 * -minus <= 100 * -s[0] <= 95 * -minus]
            out += [(a, p, rank, n, -minus, -other) for rank, (other, n, _) in enumerate(fits[:negatives], 1)]
    return sorted(out)


def mined(spark, rows, every, **sizes):
    df = spark.createDataFrame(rows, ROWS)
    for name in ("chunk", "slice", "kind", "block", "tags", "anchor", "reached", "n", "rank", "place", "score"):
        df = df.withColumn(name, F.lit("x"))
    return sorted(map(tuple, mine(df, F.col("id") % every == 0, **sizes).collect()))


def made_rows(rng, n, dims, spread, labels):
    """Vectors around a few centres, with repeated ones, so scores tie."""
    centres = [[rng.randint(-spread, spread) for _ in range(dims)] for _ in range(4)]
    rows = []
    for i in range(n):
        centre = rng.choice(centres)
        vector = centre if rng.random() < 0.3 else [x + rng.randint(-2, 2) for x in centre]
        rows.append((i * 3 - 20, rng.randrange(labels), vector))
    return rows


@pytest.mark.parametrize(("seed", "n", "dims", "spread", "labels"), [(0, 300, 5, 3, 3), (1, 250, 20, 40, 10), (2, 200, 2, 1, 2)])
def test_equals_brute_force(spark, seed, n, dims, spread, labels):
    rows = made_rows(random.Random(seed), n, dims, spread, labels)
    assert mined(spark, rows, 7, block=16, chunk=10) == brute(rows, 7) != []


def test_odd_rows(spark):
    rows = [
        (0, 1, [3, 4]), (1, 1, [3, 4]), (2, 1, [3, 4]), (3, 2, [2, 3]), (3, 2, [2, 3]), (3, 2, [2, 2]), (4, None, [3, 3]), (None, 2, [3, 3]),
        (5, 2, None), (6, 2, [3, None]), (7, 2, []), (8, 2, [5]), (9, 3, [0, 6]), (10, 2, [1 << 40, 1]), (11, 1, [0, 0]), (50, 9, [1, 1]),
    ]
    usable = [r for r in rows if not (r[2] and r[2][0] == 1 << 40)]
    assert mined(spark, rows, 50) == brute(usable, 50) != []


@pytest.mark.parametrize("rows", [[], [(1, 1, [1])], [(0, 1, [1])], [(0, 1, [1]), (1, 1, [1])], [(0, 1, [-1]), (1, 1, [1]), (2, 2, [1])]])
def test_nothing_to_mine(spark, rows):
    assert mined(spark, rows, 50) == []


def test_one_vector_held_by_most_rows(spark):
    rows = [(i, i % 2, [7, 1]) for i in range(400)] + [(1000 + i, i % 2, [6, i % 3]) for i in range(60)]
    assert mined(spark, rows, 50, block=32) == brute(rows, 50) != []


def test_large_entries_are_exact(spark):
    big = 900_000_000
    rows = [(i, i % 2, [big - i * 7, big - i * 11]) for i in range(1, 40)] + [(0, 0, [big, big])]
    rows += [(100 + i, 1, [big // 2 + i * 90_000_000, big // 2 + 1]) for i in range(4)]
    assert mined(spark, rows, 50) == brute(rows, 50) != []


def test_bounds_hold_every_product():
    rng = np.random.default_rng(1)
    a, b = rng.integers(-9, 9, (20, 6)), rng.integers(-9, 9, (200, 6))
    least, greatest = bounds(a, b.min(0)[None], b.max(0)[None], np.float64)
    assert (least <= a @ b.T).all() and (a @ b.T <= greatest).all()


@pytest.mark.parametrize(("dims", "bits"), [(2, 4), (3, 3), (4, 2)])
def test_curve_visits_neighbours(dims, bits):
    cells = np.array(np.meshgrid(*[np.arange(1 << bits)] * dims)).reshape(dims, -1).T
    places = hilbert(cells, bits)
    assert sorted(places) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(places)], axis=0)).sum(1) == 1).all()


def test_zone_maps_and_what_they_leave_unread(spark):
    """Clusters far apart: most blocks cannot meet a window, and none is chosen that need not be read."""
    rng = random.Random(4)
    rows = [(i, i % 8, [100 * (c == i % 8) + rng.randint(0, 3) for c in range(8)]) for i in range(800)]
    df = spark.createDataFrame(rows, ROWS).select("id", "label", F.col("vector").cast("array<int>").alias("vector"))
    blocks, space = ordered_blocks(df, F.col("id") % 50 == 0, block=20)
    held = blocks.collect()
    zones = {r.block: r for r in held if r.n is not None}
    for row in held:
        zone = zones[row.block]
        assert zone.least_label <= row.label <= zone.greatest_label and zone.n <= 20
        assert all(a <= x <= b for a, x, b in zip(zone.low, row.vector, zone.high))
    assert sum(z.n for z in zones.values()) == 800
    (asked,) = [r for r in held if r.id == 50]
    table = hard_negatives.pa.table({"id": [50], "label": [asked.label], "v1": [asked.vector], "tags": [[0]], "los": [[asked.reached]], "his": [[1 << 61]]})
    anchors = hard_negatives.Anchors(table, space.dims, space.exact, True, 5)
    edges = [np.array([getattr(z, c) for z in zones.values()]) for c in ("low", "high", "least_label", "greatest_label")]
    assert 1 <= anchors.needs(*edges).sum() <= len(zones) // 4


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_equals_sql(spark, sf):
    sf_dir = f"/root/testdata/sf{sf}"
    df = queries.op13_hilbert_negatives(spark, sf_dir)
    assert oracle.differences(df, oracle.connect(sf_dir), queries.OP13_SQL) == ""
