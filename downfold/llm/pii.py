"""Personal data by weak supervision: labelers vote on candidate spans, EM weighs them.

Candidates are the matches of four strict patterns and of two looser ones (phone numbers
without a plus sign, addresses with ``(at)``). On each, four labelers vote for, against or
not at all: the strict rule with its check digits, a gazetteer (top-level domains, reserved
networks, card issuers, calling codes), the words before the span, and the characters next to
it. Expectation-maximisation estimates from the votes alone how often each labeler is right;
its posteriors train a logistic classifier over votes and shape, which decides on the
candidates the strict rules do not settle. What passes a strict rule always stays.

Candidates and scores are DataFrame expressions. Only counts of vote patterns (a few thousand
numbers at most, whatever the corpus) come to the driver, where EM and the classifier are fitted.
"""

import math
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from downfold.llm.common import written

KINDS = ("email", "ip", "card", "phone")

# The strict patterns, with guards that only save work: a run of address characters (digits)
# can match from its first character, or behind the match before, or not at all.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# The looser ones.
EMAIL_SPELLED = r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{1,64}+\x20?[(\[]at[)\]]\x20?[a-z0-9-]{1,63}(?:(?:\.|\x20?[(\[]dot[)\]]\x20?)[a-z0-9-]{1,63})+"
PHONE_LOCAL = r"(?<![A-Za-z0-9+().-])(?<!\+[0-9]{1,3}[\x20-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.\x20-])[0-9]{3}[.\x20-][0-9]{4}(?![A-Za-z0-9]|[.-][0-9])"

_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IP_VALID = rf"^{_PART}(?:\.{_PART}){{3}}$"

# Gazetteers: fixed public facts.
DOMAINS = "com org net edu gov mil int info biz io co us uk de fr es it nl eu ch at be ca au jp cn in br ru pl se no"
RESERVED_NETWORKS = r"^0*(?:0|127|22[4-9]|2[3-5][0-9])\."
ISSUERS = (
    r"^(?:4(?:[0-9]{12}|[0-9]{15}|[0-9]{18})|(?:5[1-5]|2[2-7])[0-9]{14}|3[47][0-9]{13}|3(?:0[0-5]|[68][0-9])[0-9]{11}|"
    r"6(?:011|5[0-9]{2}|4[4-9][0-9])[0-9]{12}|35[0-9]{14})$"
)
CALLING_CODES = r"^(?:1|7|20|27|3[0-4]|36|39|4[013-9]|5[1-8]|6[0-6]|8[1246]|86|9[0-58]|2[1-6][0-9]|3[5-8][0-9]|42[0-3]|50[0-9]|59[0-9]|67[0-9]|68[0-9]|85[0-9]|88[06]|9[679][0-9])"
CUES = {
    "email": "mail|contact|write to|reach|schreib|correo|courriel|kontakt",
    "ip": r"\bip\b|address|server|host|from|logged|client|peer",
    "card": "card|visa|master|amex|credit|debit|payment|karte|carte|tarjeta",
    "phone": "phone|tel|call|mobile|cell|fax|dial|whatsapp|handy|appel|llam|ruf",
}
COUNTER_CUES = r"version|\bv$|token|secret|key|hash|sha|uuid|order|invoice|isbn|serial|[=\"'#/_]$"
#: Characters before a span that are searched for cues.
BEFORE = 30

VOTERS = ("rule", "gazetteer", "before", "edge")
#: What labelers are taken for before any vote is seen, as counts: share of votes (for, none, against) on true and on false spans.
PRIOR_TRUE = {"rule": (0.9, 0.09, 0.01), "gazetteer": (0.6, 0.3, 0.1), "before": (0.4, 0.55, 0.05), "edge": (0.9, 0.05, 0.05)}
PRIOR_FALSE = {"rule": (0.05, 0.25, 0.7), "gazetteer": (0.3, 0.3, 0.4), "before": (0.05, 0.6, 0.35), "edge": (0.5, 0.1, 0.4)}
PRIOR_WEIGHT = 20.0
ROUNDS = 60
ADD_AT = 0.9

_SPAN = "array<struct<start: int, end: int, match: string, before: string, after: string>>"
#: Arrays are gone through in blocks of this length: an append copies what is there already.
BLOCK = 256


def _blocks(values: str) -> Column:
    """The array ``values`` in blocks. It must be a column: an expression would be worked out again for each block."""
    last = F.floor((F.greatest(F.size(values), F.lit(1)) - 1) / BLOCK).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(values, i * BLOCK + 1, F.lit(BLOCK)))


def _along(block: Column, first: Column, merge) -> Column:
    """For each element of ``block`` what ``merge`` makes of ``first`` and the elements before it."""

    def step(acc, x):
        return F.struct(merge(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))

    none = F.array().cast("array<int>")
    return F.aggregate(block, F.struct(first.alias("at"), none.alias("out")), step, lambda acc: acc["out"])


def with_running(df: DataFrame, values: str, into: str, merge, zero: Column) -> DataFrame:
    """Add ``into``: for each element of the array of int ``values`` what ``merge`` makes of all before it.

    ``zero`` is what ``merge`` leaves others as they are with. Blocks are merged first and gone
    through with what comes before them, so time grows with the array and not with its square.
    """
    df = df.withColumn("_blocks", _blocks(values))
    df = df.withColumn("_whole", F.transform("_blocks", lambda block: F.aggregate(block, zero, merge)))
    before = _along(F.col("_whole"), zero, merge)
    found = F.flatten(F.zip_with("_blocks", before, lambda block, first: _along(block, first, merge)))
    return df.withColumn(into, found).drop("_blocks", "_whole")


def _pieces(text: Column, pattern: str, where: Column) -> Column:
    """The text cut at the matches of ``pattern``: what lies before each match, and the match; null after the last."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def piece(gap, match):
        return F.struct(
            F.char_length(gap).alias("gap"),
            F.coalesce(F.char_length(match), F.lit(0)).alias("length"),
            F.substring(gap, -BEFORE, BEFORE).alias("tail"),
            F.substring(F.concat(gap, F.coalesce(match, F.lit(""))), 1, 1).alias("head"),
            match.alias("match"),
        )

    return F.when(where, F.zip_with(F.split(text, pattern, -1), found, piece))


def _block_lengths(blocks: str) -> Column:
    return F.transform(blocks, lambda block: F.aggregate(block, F.lit(0), lambda n, x: n + x["gap"] + x["length"]))


def _spans(pieces: str, blocks: str, lengths: str, wanted) -> Column:
    """The matches that ``wanted`` accepts, with their places in code points and what stands beside them.

    What stands before a match is carried along, since to look for it in the text would be to
    count code points from the start of the text at each match.
    """

    def ended(tail, x):
        return F.substring(F.concat(tail, x["tail"], F.coalesce(x["match"], F.lit(""))), -BEFORE, BEFORE)

    # a whole block has more than BEFORE characters, since no match has fewer than two
    tails = F.transform(blocks, lambda block: F.aggregate(block, F.lit(""), ended))
    firsts = F.zip_with(
        _along(F.col(lengths), F.lit(0), lambda a, b: a + b),
        F.concat(F.array(F.lit("")), F.slice(tails, F.lit(1), F.size(blocks) - 1)),
        lambda at, tail: F.struct(at.alias("at"), tail.alias("tail")),
    )

    def along(block, first):
        def step(acc, x):
            start = acc["at"] + x["gap"]
            end = start + x["length"]
            before = F.substring(F.concat(acc["tail"], x["tail"]), -BEFORE, BEFORE)
            span = F.struct(
                start.alias("start"), end.alias("end"), x["match"].alias("match"), before.alias("before"), F.lit("").alias("after")
            )
            return F.struct(end.alias("at"), ended(acc["tail"], x).alias("tail"), F.concat(acc["out"], F.array(span)).alias("out"))

        begin = F.struct(first["at"].alias("at"), first["tail"].alias("tail"), F.array().cast(_SPAN).alias("out"))
        return F.aggregate(block, begin, step, lambda acc: acc["out"])

    spans = F.flatten(F.zip_with(blocks, firsts, along))
    heads = F.slice(F.transform(pieces, lambda x: x["head"]), F.lit(2), F.size(pieces))
    beside = F.zip_with(spans, heads, lambda span, head: span.withField("after", F.coalesce(head, F.lit(""))))
    taken = F.filter(beside, lambda span: span["match"].isNotNull() & wanted(span["match"]))
    return F.when(F.col(pieces).isNotNull(), taken).otherwise(F.array().cast(_SPAN))


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits has a valid check digit."""

    def value(i):
        digit = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return F.when(i % 2 == 1, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda total, i: total + value(i)) % 10 == 0


def _rule(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(IP_VALID)
    if kind == "card":
        digits = _digits(match)
        return F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    return F.lit(True)


def _vote(for_: Column, against: Column) -> Column:
    return F.when(against, -1).when(for_, 1).otherwise(0)


def _gazetteer(kind: str, match: Column) -> Column:
    if kind == "email":
        return F.when(match.rlike(rf"(?i)[.\])]\x20?(?:{'|'.join(DOMAINS.split())})$"), 1).otherwise(0)
    if kind == "ip":
        return _vote(F.lit(False), match.rlike(RESERVED_NETWORKS))
    if kind == "card":
        known = _digits(match).rlike(ISSUERS)
        return _vote(known, ~known)
    return F.when(F.startswith(match, F.lit("+")), _vote(_digits(match).rlike(CALLING_CODES), ~_digits(match).rlike(CALLING_CODES))).otherwise(0)


def _candidate(kind: str, strict: bool, span: Column) -> Column:
    start, end, match = span["start"], span["end"], span["match"]
    base = _rule(kind, match) if strict else F.lit(False)
    before = F.lower(span["before"])
    beside = F.concat(F.when(start > 0, F.substring(span["before"], -1, 1)).otherwise(" "), F.lit("|"), span["after"])
    clings = beside.rlike(r"^[\p{L}0-9_\"'=/]|[\p{L}0-9_\"'=/]$")
    return F.struct(
        F.lit(kind).alias("kind"),
        F.lit(KINDS.index(kind)).alias("rank"),
        start.alias("start"),
        end.alias("end"),
        base.alias("base"),
        F.when(base, 1).otherwise(-1 if strict else 0).alias("rule"),
        _gazetteer(kind, match).alias("gazetteer"),
        _vote(before.rlike(CUES[kind]), before.rlike(COUNTER_CUES)).alias("before"),
        _vote(~clings, clings).alias("edge"),
        F.least(F.length(_digits(match)), F.lit(20)).alias("digits"),
    )


def candidates(docs: DataFrame, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns ``carry`` and ``found``: all candidate spans of the whole text with their votes."""
    text = F.col("_text")
    any_digit = text.rlike("[0-9]")
    long_number = lambda m: F.length(_digits(m)).between(12, 19)
    phone_length = lambda m: F.length(_digits(m)).between(9, 15)
    every = lambda m: F.lit(True)
    sources = [
        ("email", True, EMAIL, every, F.contains(text, F.lit("@"))),
        ("ip", True, IP, every, any_digit),
        ("card", True, CARD, long_number, any_digit),
        ("phone", True, PHONE, phone_length, F.contains(text, F.lit("+"))),
        ("email", False, EMAIL_SPELLED, every, text.rlike(r"(?i)[(\[]at[)\]]")),
        ("phone", False, PHONE_LOCAL, every, any_digit),
    ]
    rows = docs.select(*carry, F.coalesce("text", F.lit("")).alias("_text"))
    rows = rows.select(*carry, *[_pieces(text, s[2], s[4]).alias(f"_p{n}") for n, s in enumerate(sources)])
    # each step is used more than once in the next, so these stay projections of their own
    rows = rows.withColumns({f"_b{n}": _blocks(f"_p{n}") for n in range(len(sources))})
    rows = rows.withColumns({f"_l{n}": _block_lengths(f"_b{n}") for n in range(len(sources))})

    def voted(n: int) -> Column:
        kind, strict, _, wanted, _ = sources[n]
        return F.transform(_spans(f"_p{n}", f"_b{n}", f"_l{n}", wanted), lambda span: _candidate(kind, strict, span))

    return rows.select(*carry, F.concat(*[voted(n) for n in range(len(sources))]).alias("found"))


class Cell(NamedTuple):
    """A pattern of votes and shape, and how many candidates have it."""

    kind: str
    votes: tuple[int, ...]
    digits: int
    count: int


def posteriors(cells: Sequence[Cell], rounds: int = ROUNDS) -> tuple[list[float], dict]:
    """For each cell the probability that its candidates are real, and the votes' rates
    {(kind, voter): (on true spans, on false spans)} by vote (for, none, against).

    Labelers are taken as independent given the truth, per kind of span; rates start from
    and lean on ``PRIOR_TRUE`` and ``PRIOR_FALSE``.
    """
    kinds = sorted({c.kind for c in cells})
    rates = {(k, v): (PRIOR_TRUE[v], PRIOR_FALSE[v]) for k in kinds for v in VOTERS}
    share = dict.fromkeys(kinds, 0.5)
    real = [0.5] * len(cells)
    for _ in range(rounds if cells else 0):
        for n, cell in enumerate(cells):
            odds = math.log(share[cell.kind] / (1 - share[cell.kind]))
            for voter, vote in zip(VOTERS, cell.votes):
                true, false = rates[cell.kind, voter]
                odds += math.log(true[1 - vote] / false[1 - vote])
            real[n] = 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))
        for kind in kinds:
            own = [(c, p) for c, p in zip(cells, real) if c.kind == kind]
            yes, total = sum(c.count * p for c, p in own), sum(c.count for c, _ in own)
            share[kind] = (yes + 1) / (total + 2)
            for at, voter in enumerate(VOTERS):
                true, false = [PRIOR_WEIGHT * x for x in PRIOR_TRUE[voter]], [PRIOR_WEIGHT * x for x in PRIOR_FALSE[voter]]
                for cell, p in own:
                    true[1 - cell.votes[at]] += cell.count * p
                    false[1 - cell.votes[at]] += cell.count * (1 - p)
                rates[kind, voter] = (tuple(x / sum(true) for x in true), tuple(x / sum(false) for x in false))
    return real, rates


def _shape(kind: str, votes: Sequence[int], digits: int) -> list[float]:
    """Features of the classifier: kind, each vote for and against, and the number of digits as a bucket."""
    out = [float(kind == k) for k in KINDS]
    for vote in votes:
        out += [float(vote > 0), float(vote < 0)]
    return out + [float(low <= digits < low + 5) for low in (0, 5, 10, 15)]


def train(cells: Sequence[Cell], real: Sequence[float], steps: int = 30, ridge: float = 1.0) -> list[float]:
    """Weights of a ridge logistic regression on the posteriors, each cell as often as it was counted."""
    if not cells:
        return [0.0] * len(_shape("email", (0,) * len(VOTERS), 0))
    x = np.array([_shape(c.kind, c.votes, c.digits) for c in cells])
    n, y = np.array([c.count for c in cells], float), np.array(real)
    weights = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (n * (y - p)) - ridge * weights
        curve = (x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(weights))
        weights += np.linalg.solve(curve, slope)
    return weights.tolist()


def _score(weights: Sequence[float], c: Column) -> Column:
    """The classifier's probability for a candidate struct."""
    total = F.lit(0.0)
    for kind, w in zip(KINDS, weights):
        total = total + F.when(c["kind"] == kind, w).otherwise(0.0)
    at = len(KINDS)
    for voter in VOTERS:
        total = total + F.when(c[voter] > 0, weights[at]).when(c[voter] < 0, weights[at + 1]).otherwise(0.0)
        at += 2
    for low, w in zip((0, 5, 10, 15), weights[at:]):
        total = total + F.when((c["digits"] >= low) & (c["digits"] < low + 5), w).otherwise(0.0)
    return 1 / (1 + F.exp(-total))


def vote_cells(found: DataFrame) -> list[Cell]:
    """The distinct vote patterns of all candidates: at most 4 kinds, 81 votes and 21 lengths."""
    keys = ["kind", *VOTERS, "digits"]
    counted = found.select(F.explode("found").alias("c")).select(*[F.col(f"c.{k}") for k in keys]).groupBy(*keys).count()
    return [Cell(r["kind"], tuple(r[v] for v in VOTERS), r["digits"], r["count"]) for r in counted.orderBy(*keys).collect()]


_PLACES = "array<struct<start: int, rank: int, kind: string, end: int, base: boolean>>"


def _clear_of_base(df: DataFrame, spans: str, into: str) -> DataFrame:
    """Add ``into``: the added ones of ``spans``, sorted by place, that overlap no base one."""
    none = F.lit(2**31 - 1)
    df = df.withColumns(
        {
            "_ends": F.transform(spans, lambda c: F.when(c["base"], c["end"]).otherwise(-1)),
            "_starts": F.transform(F.reverse(spans), lambda c: F.when(c["base"], c["start"]).otherwise(none)),
        }
    )
    df = with_running(df, "_ends", "_end", lambda a, b: F.greatest(a, b), F.lit(-1))
    df = with_running(df, "_starts", "_start", lambda a, b: F.least(a, b), none)
    around = F.zip_with("_end", F.reverse("_start"), lambda end, start: F.struct(end.alias("end"), start.alias("start")))
    told = F.zip_with(
        spans, around, lambda c, a: F.when(~c["base"] & (a["end"] <= c["start"]) & (a["start"] >= c["end"]), c)
    )
    return df.withColumn(into, F.filter(told, lambda c: c.isNotNull())).drop("_ends", "_starts", "_end", "_start")


def _clear_of_earlier(df: DataFrame, spans: str, into: str) -> DataFrame:
    """Add ``into``: those of ``spans``, sorted by place, that overlap none before them."""
    df = df.withColumn("_ends", F.transform(spans, lambda c: c["end"]))
    df = with_running(df, "_ends", "_end", lambda a, b: F.greatest(a, b), F.lit(-1))
    told = F.zip_with(spans, "_end", lambda c, end: F.when(end <= c["start"], c))
    return df.withColumn(into, F.filter(told, lambda c: c.isNotNull())).drop("_ends", "_end")


def find_pii(docs: DataFrame, carry: Sequence[str] = ("doc_id",), add_at: float = ADD_AT) -> DataFrame:
    """One row per row of ``docs``: the columns ``carry``, ``base`` and ``spans``.

    Both are arrays of (start, rank, kind, end) in order, places in code points, end
    exclusive: ``base`` what the strict rules give, ``spans`` with what the classifier adds
    at a probability of ``add_at``. An added span gives way to a base one it overlaps, and
    to an added one that starts before it. A null or empty text has no spans. Repeated rows
    count in the fit each time. Other columns are ignored, clashing names too as long as
    they are not carried. An empty table gives an empty result. Texts of any length are
    searched whole, in time that grows with the text and its matches.
    """
    found = written(candidates(docs, carry), "candidates")
    cells = vote_cells(found)
    weights = train(cells, posteriors(cells)[0])
    place = lambda c: F.struct(*[c[name].alias(name) for name in ("start", "rank", "kind", "end", "base")])
    shown = lambda c: F.struct(*[c[name].alias(name) for name in ("start", "rank", "kind", "end")])
    stays = F.filter("found", lambda c: c["base"] | (_score(weights, c) >= add_at))
    own = [F.col(c).alias(f"_c{n}") for n, c in enumerate(carry)]
    placed = found.select(*own, F.array_sort(F.transform(stays, place)).cast(_PLACES).alias("_stays"))
    placed = _clear_of_earlier(_clear_of_base(placed, "_stays", "_free"), "_free", "_added")
    return placed.withColumn("_base", F.filter("_stays", lambda c: c["base"])).select(
        *[F.col(f"_c{n}").alias(c) for n, c in enumerate(carry)],
        F.transform("_base", shown).alias("base"),
        F.transform(F.array_sort(F.concat("_base", "_added")), shown).alias("spans"),
    )


def as_text(spans: str) -> Column:
    """A column of spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def pii_digest(docs: DataFrame) -> DataFrame:
    """``find_pii`` per row: doc_id, n_email, n_ip, n_card, n_phone (strict ones), base_sha256, spans."""

    def of(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [of(kind) for kind in KINDS]
    return find_pii(docs).select(
        "doc_id", *counts, F.sha2(as_text("base").cast("binary"), 256).alias("base_sha256"), as_text("spans").alias("spans")
    )
