"""Periodic runs of words, found through string synchronising sets.

A run is a stretch of words with smallest period q, at least four periods long, that no
neighbouring word extends. Texts are read many at a time, as numbers of words in one array
with a separator of its own between any two, so no run and no equal context crosses texts.

1. Periods under ``FIRST_SCALE`` are supplied apart: for each, stretches of words that equal
   the word a period later are periodic regions, and long ones are runs.
2. At each scale t = 8, 16, 32, ... a hash of the t words at a place selects the places that
   synchronise: i is selected if the least hash in [i, i + t] is that of i or of i + t. Places
   inside regions of a period of at most t / 4, known from smaller scales, have no hash. So
   what is selected depends on the 2t words at i alone, and about n / t places are.
3. A run with t <= q < 2t holds a selected place among its first t, and q words on the same
   2t words follow, so that place is selected as well, with none of equal context between.
   Hence every next place of equal context at a distance in [t, 2t) proposes a period. What
   it proposes is extended by comparing words, so hashes never decide that a run is there.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: A run has this many periods at least.
PERIODS = 4
#: Periods below this are found directly; synchronising sets serve the others.
FIRST_SCALE = 8
#: Words of the texts that are searched together; a longer text is searched alone.
TOGETHER = 400_000

_ODD1, _ODD2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser; the odd constants are those of the splitmix generator."""
    x = (x ^ (x >> np.uint64(30))) * _ODD1
    x = (x ^ (x >> np.uint64(27))) * _ODD2
    return x ^ (x >> np.uint64(31))


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of two stretches in a row from the hashes of each."""
    return _mix(left * np.uint64(0x9E3779B97F4A7C15) + _mix(right))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of ``width`` values from each place on where there are as many."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def _prime_divisors(n: int) -> list[int]:
    out, p = [], 2
    while p * p <= n:
        if n % p == 0:
            out.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return out + [n] * (n > 1)


def _primitive(words: np.ndarray, start: int, period: int) -> bool:
    """Whether no shorter period divides ``period`` at ``start``."""
    once = words[start : start + period]
    return not any(np.array_equal(once[: -period // p], once[period // p :]) for p in _prime_divisors(period))


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of true."""
    edges = np.flatnonzero(np.diff(np.r_[False, same, False]))
    return edges[::2], edges[1::2]


def _forward(words: np.ndarray, at: int, period: int, step: int) -> int:
    """How far words from ``at`` on equal those a period later; looks at ever longer pieces."""
    n, begun = len(words) - period, at
    while at < n:
        end = min(n, at + step)
        other = np.flatnonzero(words[at:end] != words[at + period : end + period])
        if len(other):
            return at + int(other[0]) - begun
        at, step = end, step * 2
    return at - begun


def _backward(words: np.ndarray, at: int, period: int, step: int) -> int:
    """How far words before ``at`` equal those a period later."""
    begun = at
    while at > 0:
        start = max(0, at - step)
        other = np.flatnonzero(words[start:at] != words[start + period : at + period])
        if len(other):
            return begun - (start + int(other[-1]) + 1)
        at, step = start, step * 2
    return begun


def _small(words: np.ndarray, found: list[tuple[int, int, int]]) -> None:
    """Runs with a period under ``FIRST_SCALE``."""
    for period in range(1, min(FIRST_SCALE, len(words) // PERIODS + 1)):
        starts, ends = _stretches(words[:-period] == words[period:])
        long = ends - starts >= (PERIODS - 1) * period
        for start, end in zip(starts[long].tolist(), ends[long].tolist()):
            if _primitive(words, start, period):
                found.append((start, end + period, period))


def synchronising(hashes: np.ndarray, scale: int, periodic: list[tuple[int, int, int]]) -> np.ndarray:
    """Selected places, in order; ``hashes`` are of ``scale`` words each.

    ``periodic`` are runs; those of a period of at most a quarter of the scale take the
    places inside them out of the choice.
    """
    if len(hashes) <= scale:
        return np.empty(0, np.int64)
    hashes = hashes.copy()
    for start, end, period in periodic:
        if PERIODS * period <= scale <= end - start:
            hashes[start : end - scale + 1] = _NONE
    least = _least(hashes, scale + 1)
    n = len(least)
    chosen = (least != _NONE) & ((least == hashes[:n]) | (least == hashes[scale : scale + n]))
    return np.flatnonzero(chosen)


def _proposed(places: np.ndarray, contexts: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods, sorted by period: the next place of equal context is that far away."""
    order = np.argsort(contexts, kind="stable")
    contexts, places = contexts[order], places[order]
    gaps = np.diff(places)
    near = (contexts[1:] == contexts[:-1]) & (gaps >= scale) & (gaps < 2 * scale)
    starts, periods = places[:-1][near], gaps[near]
    order = np.lexsort((starts, periods))
    return starts[order], periods[order]


def runs_of(words: np.ndarray, lengths: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, period) of every run in ``words``, end exclusive.

    ``words`` are texts one after another, longest first, each followed by a separator that
    occurs once; ``lengths`` counts each text with its separator.
    """
    found: list[tuple[int, int, int]] = []
    _small(words, found)
    ends = np.cumsum(lengths)
    hashes = _mix(words.astype(np.uint64) + np.uint64(1))
    have, scale = 1, FIRST_SCALE
    while len(lengths) and lengths[0] > PERIODS * scale:
        # the texts that can hold a run of this scale stand first
        size = int(ends[np.count_nonzero(lengths > PERIODS * scale) - 1])
        hashes = hashes[:size]
        while have < scale:
            hashes = _joined(hashes[: len(hashes) - have], hashes[have:])
            have *= 2
        contexts = _joined(hashes[: len(hashes) - scale], hashes[scale:])
        places = synchronising(hashes, scale, found)
        places = places[places < len(contexts)]
        reached: dict[int, int] = {}
        for place, period in zip(*(x.tolist() for x in _proposed(places, contexts[places], scale))):
            if place + period <= reached.get(period, 0):
                continue  # inside what the same period has given already
            start = place - _backward(words, place, period, scale)
            end = place + _forward(words, place, period, 2 * scale) + period
            reached[period] = end
            if end - start >= PERIODS * period and _primitive(words, start, period):
                found.append((start, end, period))
        scale *= 2
    return found


class Found:
    """What is known of one text: its words, runs as (start, length, period), and dropped words."""

    def __init__(self, words: list[bytes], runs: list[tuple[int, int, int]], least: int):
        self.words = words
        self.runs = sorted((r for r in runs if r[1] >= least), key=lambda r: (r[0], r[2]))

    def longest(self) -> tuple[int, int, int] | None:
        return min(self.runs, key=lambda r: (-r[1], r[0], r[2]), default=None)

    def digest(self) -> str:
        return hashlib.sha256(b"".join(b"%d,%d,%d\n" % r for r in self.runs)).hexdigest()

    def collapsed(self) -> bytes:
        """The words without those that a run holds after its first period, joined by spaces."""
        keep, at = [], 0
        for start, end in sorted((s + q, s + n) for s, n, q in self.runs):
            if end > at:
                keep.extend(self.words[at : max(at, start)])
                at = end
        return b" ".join(keep + self.words[at:])


def search(texts: list[bytes], least: int = 6) -> list[Found]:
    """One ``Found`` for each text."""
    split = [text.split() for text in texts]  # splits bytes at \x09-\x0D and the space only
    order = sorted(range(len(split)), key=lambda i: -len(split[i]))
    order = [i for i in order if len(split[i]) >= max(PERIODS, least)]
    numbers: dict[bytes, int] = {}
    words = np.empty(sum(len(split[i]) + 1 for i in order), np.int64)
    at, firsts = 0, []
    for mark, i in enumerate(order):
        n = len(split[i])
        words[at : at + n] = [numbers.setdefault(w, len(numbers)) for w in split[i]]
        words[at + n] = -1 - mark
        firsts.append(at)
        at += n + 1
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, end, period in runs_of(words, np.array([len(split[i]) + 1 for i in order], np.int64)):
        k = int(np.searchsorted(firsts, start, side="right")) - 1
        found[order[k]].append((start - firsts[k], end - start, period))
    return [Found(s, f, least) for s, f in zip(split, found)]


def _together(column: pa.Array) -> Iterator[list[bytes]]:
    """Texts of a column in lists of some ``TOGETHER`` words; null is empty."""
    group, size = [], 0
    for value in column:
        text = (value.as_py() or "").encode("utf-8", "surrogatepass")
        group.append(text)
        size += len(text)
        if size >= TOGETHER * 6:
            yield group
            group, size = [], 0
    yield group


def _finder(columns: list[str], least: int, texts: bool):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for group in _together(batch.column("_text")):
                found = search(group, least)
                top = [f.longest() or (None, None, None) for f in found]
                bare = [f.collapsed() for f in found]
                pick = lambda i: pa.array([t[i] for t in top], pa.int64())
                ratio = [None if t[0] is None else 1000 * t[1] // t[2] for t in top]
                made = {
                    "n_runs": pa.array([len(f.runs) for f in found], pa.int64()),
                    "start": pick(0),
                    "length": pick(1),
                    "period": pick(2),
                    "exponent_milli": pa.array(ratio, pa.int64()),
                    "runs_sha256": pa.array([f.digest() for f in found], pa.string()),
                    "collapsed_sha256": pa.array([hashlib.sha256(b).hexdigest() for b in bare], pa.string()),
                }
                if texts:
                    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
                    made["runs"] = pa.array(
                        [[dict(zip(("start", "length", "period"), r)) for r in f.runs] for f in found], kind
                    )
                    made["collapsed"] = pa.array([b.decode("utf-8", "replace") for b in bare], pa.string())
                kept = batch.slice(at, len(group))
                at += len(group)
                yield pa.RecordBatch.from_arrays(
                    [kept.column(c) for c in columns] + list(made.values()), names=columns + list(made)
                )

    return find


DIGEST = (
    "n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)
TEXTS = "runs array<struct<start: long, length: long, period: long>>, collapsed string"


def periodic_runs(docs: DataFrame, text: str = "text", key: str = "doc_id", least: int = 6, texts: bool = False) -> DataFrame:
    """(``key``, n_runs, the longest run, digests) for every row of ``docs``, in no order.

    Words are divided by ASCII white space. A run has at least ``least`` words and four
    periods; the longest is the one with most words, of those the first, of those the one
    with the smallest period. ``texts`` adds the runs themselves and the text without the
    words that a run holds after its first period.

    Null and empty texts have no words, no run and null for the longest; repeated rows and
    rows with a null key are each searched; other columns, whatever their names, are left
    out; an empty table gives an empty result. A text of any length is searched whole by one
    task, with some 30 numbers of 8 bytes a word; texts are not shuffled.
    """
    rows = docs.select(F.col(key).alias(key), F.col(text).alias("_text"))
    kind = rows.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, {DIGEST}" + (f", {TEXTS}" if texts else "")
    return rows.mapInArrow(_finder([key], least, texts), schema)
