import random

import pytest

from downfold.llm import decontaminate
from llm.texts import documents, fold, rows, table


def words(text):
    return "".join(c if c.isascii() and c.isalnum() or ord(c) > 127 else " " for c in fold(text)).split(" ")


def brute(docs, items, window=10):
    split = lambda t: [w for w in words(t) if w]
    patterns = []
    for item, text in items:
        own = split(text)
        for i in range(max(1, len(own) - window + 1)):
            if own:
                patterns.append((item, own[i : i + window]))
    out = []
    for doc_id, text in docs:
        own, hit, found = split(text), set(), set()
        for item, piece in patterns:
            for i in range(len(own) - len(piece) + 1):
                if own[i : i + len(piece)] == piece:
                    hit.update(range(i, i + len(piece)))
                    found.add(item)
        names = sorted(str(x) for x in found if x is not None)
        out.append((doc_id, len(own), len(hit), len(names), names, bool(hit)))
    return sorted(out, key=repr)


def benchmark(spark, items):
    return spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, n_words string")


DRAW = random.Random(3)
SENTENCE = [f"b{DRAW.randrange(40)}" for _ in range(60)]
ITEMS = [
    (1, " ".join(SENTENCE[:25])), (2, " ".join(SENTENCE[20:40]).upper()), (10, "short item"), (11, "One"), (12, None), (13, " .,! "),
    (14, " ".join(SENTENCE[:10])), (14, "another text of the same item"), (None, " ".join(SENTENCE[40:52])), (15, "été Été où"), (16, "a a a a a a a a a a a a"),
]
DOCS = [
    (1, "x y " + "-".join(SENTENCE) + " z"), (2, " ".join(SENTENCE[:9])), (3, "a short, item. here one"), (4, None), (5, ""), (6, "!!!"),
    (7, "a " * 40), (8, " ".join(SENTENCE[5:15]) + " q " + " ".join(SENTENCE[38:53])), (8, " ".join(SENTENCE[5:15])), (None, "one"),
    (9, "été Été où"), (10, "short\nshort item_item short;item"), (11, " ".join(SENTENCE * 30)), (8, " ".join(SENTENCE[5:15])),
    (12, "a " * 9), (13, "another text of the same item b1"),
]


@pytest.mark.parametrize("pass_bytes", [decontaminate.PASS_BYTES, 300, 1])
def test_equals_brute_force(spark, pass_bytes):
    got = decontaminate.contamination(documents(spark, DOCS, extra=True), benchmark(spark, ITEMS), pass_bytes=pass_bytes)
    assert rows(got) == brute(DOCS, ITEMS)


@pytest.mark.parametrize("window", [1, 2, 3])
def test_other_windows(spark, window):
    got = decontaminate.contamination(documents(spark, DOCS), benchmark(spark, ITEMS), window)
    assert rows(got) == brute(DOCS, ITEMS, window)


def test_table_and_empty_tables(spark):
    docs, items = table(spark, "0.001", "documents"), table(spark, "0.001", "benchmark")
    given = [(r.doc_id, r.text) for r in docs.collect()]
    assert rows(decontaminate.contamination(docs, items)) == brute(given, [(r.item_id, r.text) for r in items.collect()])
    assert rows(decontaminate.contamination(documents(spark, []), items)) == []
    assert rows(decontaminate.contamination(documents(spark, DOCS), benchmark(spark, []))) == brute(DOCS, [])


def test_clean_keeps_columns_and_clean_rows(spark):
    docs = documents(spark, DOCS, extra=True)
    kept = decontaminate.clean(docs, benchmark(spark, ITEMS))
    assert kept.columns == docs.columns
    assert sorted(map(repr, (r.doc_id for r in kept.collect()))) == sorted(repr(b[0]) for b in brute(DOCS, ITEMS) if not b[5])


def test_one_table_is_sent_at_a_time(spark, monkeypatch):
    """Ten passes and more: each table is let go before the next is fetched."""
    live, most = [], []
    context = type(spark.sparkContext)
    plain = context.broadcast

    def counted(self, value):
        sent = plain(self, value)
        release = sent.destroy
        live.append(sent)
        most.append(len(live))
        sent.destroy = lambda blocking=False: (live.remove(sent), release(blocking))
        return sent

    monkeypatch.setattr(context, "broadcast", counted)
    items = [(n, f"item number {n} of them") for n in range(40)]
    docs = [(n, f"see item number {n} of them") for n in range(0, 60, 5)]
    got = decontaminate.contamination(documents(spark, docs), benchmark(spark, items), pass_bytes=300)
    assert rows(got) == brute(docs, items)
    assert len(most) >= 10 and max(most) == 1 and not live


def test_very_long_text(spark):
    long = "w " * 300_000 + " ".join(SENTENCE[:25]) + " v" * 300_000
    (row,) = decontaminate.contamination(documents(spark, [(1, long)]), benchmark(spark, ITEMS[:2])).collect()
    assert (row.n_words, row.n_hit, row["items"]) == (600_025, 25, ["1"])
