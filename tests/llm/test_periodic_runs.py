import hashlib
import random
import zlib

import numpy as np
import pytest

from downfold.llm import periodic_runs
from downfold.llm.periodic_runs import search, synchronising
from downfold.llm.queries import op11_synchronising_runs, with_repeated_tails
from llm.texts import documents, table


def brute(words, least=6):
    """(start, length, period) by going through every period."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            one = words[i : i + q]
            whole = any(q % p == 0 and one[:-p] == one[p:] for p in range(1, q))
            if j - i + q >= max(4 * q, least) and not whole:
                out.append((i, j - i + q, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def kept(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def expected(doc_id, words):
    runs = brute(words)
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (
        doc_id, len(runs), *top, None if top[0] is None else 1000 * top[1] // top[2],
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(" ".join(kept(words, runs)).encode()).hexdigest(),
    )


def looped(doc_id, text):
    words, h = (text or "").encode().split(), zlib.crc32(str(doc_id).encode())
    words = [w.decode() for w in words]
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def made_text(rng):
    words, k = [], rng.choice([1, 2, 3, 5, 50])
    for _ in range(rng.randint(0, 5)):
        period = rng.choice([1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 31, 33, 40])
        one = [str(rng.randrange(k)) for _ in range(period)]
        piece = (one * 8)[: int(period * rng.uniform(0, 6))]
        if piece and rng.random() < 0.2:
            piece[rng.randrange(len(piece))] = "x"  # breaks the loop
        words += piece * rng.choice([1, 1, 1, 1, 4])  # loops of loops
    return " ".join(words)


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    texts = [made_text(rng) for _ in range(60)]
    for text, found in zip(texts, search([t.encode() for t in texts]), strict=True):
        assert found.runs == brute(text.split())
        assert found.collapsed().decode().split() == kept(text.split(), found.runs)


@pytest.mark.parametrize("period", [1, 2, 7, 8, 15, 16, 31, 32, 63, 64, 100, 255, 256, 257])
def test_four_periods_are_the_least(period):
    one = [f"w{i}" for i in range(period)]
    least = max(4 * period, 6)
    for length, runs in ((least, 1), (least - 1, 0)):
        text = " ".join(["before", *(one * 8)[:length], "after"]).encode()
        (found,) = search([text])
        assert found.runs == [(1, length, period)][:runs]


def test_selection_depends_on_the_context_alone():
    """Equal stretches of twice the scale are selected alike, wherever they stand."""
    rng = np.random.default_rng(3)
    piece = rng.integers(0, 2**60, 400).astype(np.uint64)
    one = np.r_[rng.integers(0, 2**60, 77).astype(np.uint64), piece, rng.integers(0, 2**60, 50).astype(np.uint64)]
    two = np.r_[rng.integers(0, 2**60, 31).astype(np.uint64), piece, rng.integers(0, 2**60, 90).astype(np.uint64)]
    inside = [{int(i) - at for i in synchronising(h, 16, []) if at <= i < at + 380} for h, at in ((one, 77), (two, 31))]
    assert inside[0] == inside[1] and 20 < len(inside[0]) < 120


def test_periodic_regions_take_no_places():
    loop = np.tile(np.arange(3, dtype=np.uint64), 1000)
    assert len(synchronising(loop, 16, [])) > 500
    assert len(synchronising(loop, 16, [(0, 3016, 3)])) <= 2


CASES = [
    (1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, "a a a a a"), (6, "a a a a a a"), (7, "a b a b a b a b"),
    (8, "x " + "a b c " * 4 + "a y"), (9, "A a A a A a a A"), (10, "é ü " * 5), (11, "a a " * 6),
    (12, "a a a a a a b a a a a a a b a a a a a a b a a a a a a b"), (7, "a b a b a b a b"), (None, "a a a a a a a"),
]


def test_edge_cases(spark):
    df = documents(spark, CASES, extra=True)
    got = sorted(map(tuple, periodic_runs.periodic_runs(df).collect()), key=repr)
    assert got == sorted((expected(i, [w.decode() for w in (t or "").encode().split()]) for i, t in CASES), key=repr)
    assert periodic_runs.periodic_runs(df.limit(0)).collect() == []


def test_runs_and_texts(spark):
    (row,) = periodic_runs.periodic_runs(documents(spark, [(1, "x " + "a b " * 4 + "y")]), texts=True).collect()
    assert [tuple(r) for r in row.runs] == [(1, 8, 2)] and row.collapsed == "x a b y"


def test_very_long_text(spark):
    rng = random.Random(5)
    loop = [f"w{rng.randrange(9)}" for _ in range(70_000)]
    words = ["x", *loop * 4, *loop[:5], "y", *["z"] * 200_000]
    (row,) = periodic_runs.periodic_runs(documents(spark, [(1, " ".join(words))]), texts=True).collect()
    assert (row.start, row.length, row.period) == (1, 280_005, 70_000)
    assert (280_007, 200_000, 1) in [tuple(r) for r in row.runs] and row.exponent_milli == 4000


def test_tails_and_query(spark):
    docs = table(spark, "0.001", "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    tails = {r.doc_id: r.text for r in with_repeated_tails(docs).collect()}
    assert {i: (t or "").encode().split() for i, t in tails.items()} == {
        i: " ".join(looped(i, t)).encode().split() for i, t in texts.items()
    }
    short = {i: t for i, t in texts.items() if len((t or "").split()) < 300}
    got = {r.doc_id: tuple(r) for r in op11_synchronising_runs(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(texts) and len(short) > 100
    assert all(got[i] == expected(i, looped(i, t)) for i, t in short.items())
    assert sum(1 for r in got.values() if r[1]) > len(got) // 20


def test_tails_of_odd_rows(spark):
    rows = [(n, t) for n in range(60) for t in (None, "", "one", "a b", "a b c d e f g h i j")] + [(None, "a b c")]
    got = [(r.doc_id, (r.text or "").split()) for r in with_repeated_tails(documents(spark, rows, extra=True)).collect()]
    want = [(i, looped(i, t) if i is not None else t.split()) for i, t in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
