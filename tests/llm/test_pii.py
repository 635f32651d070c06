import hashlib
import math
import re

import pytest
from pyspark.sql import functions as F

from downfold.llm import pii
from llm.texts import documents, rows, table

STRICT = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for n, d in enumerate(reversed(digits)):
        d = int(d) * (2 if n % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15 if kind == "phone" else True


def brute(text):
    found = []
    for rank, (kind, pattern) in enumerate(STRICT.items()):
        for m in re.finditer(pattern, text or ""):
            if valid(kind, m.group()):
                found.append((m.start(), rank, kind, m.end()))
    return sorted(found)


ODD = [
    "", None, "plain words only", "a@b.c@d.e a@b.c_x@d.e .@x.y a@b- a@b.-", "x" * 3000 + "@", "é a.b+c%d@ex-a.co.uk. é",
    "1.2.3.4.5 001.02.3.255 256.1.1.1 1.2.3 12.34.56.78.90.12.34.56 9" + "9" * 400, "4111 1111 1111 1111 4111-1111-1111-1112",
    "4111111111111111 378282246310005 0000 0000 0000 5 5 5 5", "+1 (274) 555-9629 +1 +12 +44 20 7946 0958. +(1) +1234567890123456",
    "🙂 a@b.co 🙂 +49 30 1234567 1.1.1.1", "1 " * 5000, "7" * 4000 + " 1.1.1.1", "a@b.c" * 300, "call (415) 555-2671 today",
    "mail: jo(at)site(dot)org now", "\n\n1.1.1.1\n4242 4242 4242 4242\r\n", "+1-800-555-0199+1-800-555-0199",
]


def joined(spans):
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in spans)


def check(spark, given, extra=False):
    texts = dict(given)
    got = pii.pii_digest(documents(spark, given, extra)).collect()
    assert len(got) == len(given)
    for r in got:
        want = brute(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(joined(want).encode()).hexdigest(), texts[r.doc_id]
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[2] == k for s in want) for k in pii.KINDS]
        spans = r.spans.split(",") if r.spans else []
        assert {f"{k}:{a}:{b}" for a, _, k, b in want} <= set(spans)
        assert spans == sorted(spans, key=lambda s: (int(s.split(":")[1]), pii.KINDS.index(s.split(":")[0])))
    return {r.doc_id: r.spans for r in got}


def test_base_spans_equal_brute_force(spark):
    check(spark, list(enumerate(ODD)), extra=True)
    check(spark, [(r.doc_id, r.text) for r in table(spark, "0.01", "documents").collect()])


def test_repeated_rows_and_empty_table(spark):
    twice = documents(spark, [(1, "a@b.co"), (1, "a@b.co"), (None, "a@b.co")])
    assert [r.n_email for r in pii.pii_digest(twice).collect()] == [1, 1, 1]
    assert rows(pii.pii_digest(documents(spark, []))) == []


def test_luhn_expression(spark):
    numbers = ["4111111111111111", "4111111111111112", "79927398713", "0", "1"]
    df = spark.createDataFrame([(x,) for x in numbers], "x string").select("x", pii.luhn(F.col("x")).alias("ok"))
    assert {r.x: r.ok for r in df.collect()} == {x: luhn(x) for x in numbers}


def test_adds_spelled_addresses_and_leaves_clean_texts_alone(spark):
    given = [(n, f"words here user{n}@site{n}.com and +1 (415) 555-26{n:02d} there") for n in range(40)]
    given += [(100, "please mail jo.doe (at) example (dot) org soon"), (101, "phone: (415) 555-2671 at noon")]
    given += [(200, "version 1.2.300.4 of it"), (201, "token=\"4242424242424241\""), (202, "just words, 12 of them")]
    spans = check(spark, given)
    assert spans[100] == "email:12:41" and spans[101] == "phone:7:21"
    assert spans[200] == spans[201] == spans[202] == ""


def test_em_finds_who_is_right():
    """The rule and the words before a span agree with the truth, the gazetteer votes at random."""
    cells = []
    for real, rule, before in ((True, 1, 1), (False, -1, -1)):
        for gazetteer in (1, -1):
            cells.append(pii.Cell("card", (rule, gazetteer, before, 0), 16, 450))
            cells.append(pii.Cell("card", (rule, gazetteer, -before, 0), 16, 50))
    p, rates = pii.posteriors(cells)
    for cell, x in zip(cells, p):
        assert (x > 0.5) == (cell.votes[0] > 0)
    assert rates["card", "rule"][0][0] > 0.95
    assert rates["card", "gazetteer"][0][0] == pytest.approx(0.5, abs=0.05)
    assert rates["card", "before"][0][0] == pytest.approx(0.9, abs=0.05)
    weights = pii.train(cells, p)
    score = lambda c: sum(w * x for w, x in zip(weights, pii._shape(c.kind, c.votes, c.digits)))
    assert all((score(c) > 0) == (c.votes[0] > 0) for c in cells)
    assert pii.posteriors([])[0] == [] and set(pii.train([], [])) == {0.0}


def brute_added(found, weights, add_at=pii.ADD_AT):
    """What the classifier adds to the base spans among ``found``, pair by pair."""
    score = lambda c: 1 / (1 + math.exp(-sum(w * x for w, x in zip(weights, pii._shape(c.kind, [c[v] for v in pii.VOTERS], c.digits)))))
    meet = lambda a, b: a.start < b.end and b.start < a.end
    base = [c for c in found if c.base]
    free = [c for c in found if not c.base and score(c) >= add_at and not any(meet(b, c) for b in base)]
    return [c for c in free if not any((o.start, o.rank) < (c.start, c.rank) and meet(o, c) for o in free)]


def test_added_spans_equal_brute_force(spark, monkeypatch):
    """With blocks of four, texts of a few numbers cross several blocks."""
    monkeypatch.setattr(pii, "BLOCK", 4)
    busy = "jo(at)site(dot)org 415-555-2671 +1 415-555-2671 999.1.1.1 4242424242424241 a@b.co(at)c.de 1.2.3.4 "
    given = [*enumerate(ODD), (50, busy * 7), (51, busy), (52, "é" + busy * 3 + "(415) 555-2671")]
    docs = documents(spark, given)
    found = {r.doc_id: r.found for r in pii.candidates(docs).collect()}
    cells = pii.vote_cells(pii.candidates(docs))
    weights = pii.train(cells, pii.posteriors(cells)[0])
    for at in (0.05, 0.5, 0.9):
        for r in pii.find_pii(docs, add_at=at).collect():
            added = brute_added(found[r.doc_id], weights, at)
            want = [(c.start, c.rank, c.kind, c.end) for c in [*[c for c in found[r.doc_id] if c.base], *added]]
            assert [tuple(s) for s in r.spans] == sorted(want), r.doc_id
    check(spark, given)


def test_words_before_a_span_come_from_the_text(spark, monkeypatch):
    """Votes of the places beside a span are those read off the text itself."""
    monkeypatch.setattr(pii, "BLOCK", 4)
    given = [(n, "".join(p + ("call" if n % 2 else "é,") for p in ("+1 415-555-2671", " a@b.co", "=1.2.3.4")) * 5) for n in range(4)]
    texts = dict(given)
    for r in pii.candidates(documents(spark, given)).collect():
        for c in r.found:
            before = texts[r.doc_id][max(0, c.start - pii.BEFORE) : c.start].lower()
            against, for_ = re.search(pii.COUNTER_CUES, before), re.search(pii.CUES[c.kind], before)
            assert c.before == (-1 if against else 1 if for_ else 0), (c, before)
            beside = texts[r.doc_id][max(0, c.start - 1) : c.start], texts[r.doc_id][c.end : c.end + 1]
            assert c.edge == (-1 if any(re.fullmatch(r"[^\W]|[\"'=/]", x) for x in beside) else 1), (c, beside)


def test_time_follows_the_number_of_matches(spark):
    """A text of 40,000 numbers; going through them pair by pair would take hours."""
    text = " ".join(f"call +1 (415) 555-{n % 10000:04d} now" for n in range(40_000))
    assert pii.pii_digest(documents(spark, [(1, text)])).first().n_phone == 40_000
