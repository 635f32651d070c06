import math
from collections import Counter

import pytest

from downfold.llm import lm_scoring
from downfold.llm.queries import op10_cross_entropy
from llm.texts import documents, fold, rows, table


def brute(docs, target, size):
    """doc_id -> (words, loss of target, loss of background), written with dictionaries."""
    split = lambda text: [w for w in fold(text).replace("\n", " ").split(" ") if w]
    counts = Counter(w for _, text in docs for w in split(text))
    known = sorted(counts, key=lambda w: (-counts[w], w.encode()))[:size]
    numbered = lambda text: [w if w in known else None for w in split(text)]
    symbols = len(known) + 2

    def model(texts):
        pairs, singles, after = Counter(), Counter(), {}
        for text in texts:
            words = numbered(text)
            for before, word in zip(["<start>", *words], words):
                pairs[before, word] += 1
                singles[word] += 1
        for (before, word), n in pairs.items():
            kinds, total = after.get(before, (0, 0))
            after[before] = (kinds + 1, total + n)
        everything = sum(singles.values())

        def p(before, word):
            single = (singles[word] + 1) / (everything + symbols)
            kinds, total = after.get(before, (0, 0))
            return (pairs[before, word] + kinds * single) / (total + kinds) if total else single

        return p

    background, wanted = model([t for _, t in docs]), model([t for _, t in target])
    out = {}
    for doc_id, text in docs:
        words = numbered(text)
        steps = list(zip(["<start>", *words], words))
        loss = [-sum(math.log(m(a, b)) for a, b in steps) / len(steps) if steps else None for m in (wanted, background)]
        out[doc_id] = (len(words), *loss)
    return out


@pytest.mark.parametrize("size", [3, 50])
def test_equals_brute_force(spark, size):
    given = [(r.doc_id, r.text) for r in table(spark, "0.001", "documents").orderBy("doc_id").limit(25).collect()]
    given = [(d, t[:600]) for d, t in given] + [(900, None), (901, ""), (902, " \n "), (903, "A a B"), (None, "a b")]
    target = given[::3]
    got = lm_scoring.cross_entropy_difference(documents(spark, given, extra=True), documents(spark, target), size)
    expected = brute(given, target, size)
    assert got.count() == len(given)
    for doc_id, n, ce_target, ce_background, score in got.collect():
        want = expected[doc_id]
        assert n == want[0]
        if not n:
            assert ce_target is ce_background is score is None
            continue
        assert ce_target == pytest.approx(want[1], abs=1e-5)
        assert ce_background == pytest.approx(want[2], abs=1e-5)
        assert score == pytest.approx(want[1] - want[2], abs=2e-5)


def test_every_word_is_told_apart(spark):
    """Over 2,046 words, all of one count: none may be taken for another."""
    given = [(d, " ".join(f"w{(37 * d + 11 * k) % 2600}" for k in range(100))) for d in range(60)] + [(60, None), (None, "w1 w1 w2")]
    target = given[::4]
    expected = brute(given, target, None)
    got = lm_scoring.cross_entropy_difference(documents(spark, given, extra=True), documents(spark, target)).collect()
    assert len(got) == len(given)
    for r in got:
        assert r.n_words == expected[r.doc_id][0]
        if r.n_words:
            assert (r.ce_target, r.ce_background) == pytest.approx(expected[r.doc_id][1:], abs=1e-9)


def test_marked_documents_are_the_target(spark):
    """Texts dealt over many pieces, the target by its ids: the same scores as by its rows."""
    docs = table(spark, "0.001", "documents").limit(40).localCheckpoint().repartition(7)
    ids = spark.createDataFrame([(d,) for d in range(0, 400, 3)] + [(None,)], "doc_id long")
    marked = {r.doc_id: r for r in lm_scoring.difference_to_marked(docs, ids).collect()}
    joined = lm_scoring.cross_entropy_difference(docs, docs.join(ids, "doc_id", "left_semi")).collect()
    assert len(marked) == len(joined) == 40
    for r in joined:
        assert tuple(marked[r.doc_id]) == pytest.approx(tuple(r), abs=1e-9)


def test_empty_tables(spark):
    none, some = documents(spark, []), documents(spark, [(1, "a b"), (1, "a b")])
    assert rows(lm_scoring.cross_entropy_difference(none, some)) == []
    scored = rows(lm_scoring.cross_entropy_difference(some, none))
    assert len(scored) == 2 and scored[0] == scored[1] and scored[0][2] == pytest.approx(math.log(4), abs=1e-5)


def test_separates_good_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    scored = [(r.score, labels[r.doc_id]) for r in op10_cross_entropy(spark, sf_dir).collect() if r.doc_id in labels and r.n_words]
    good, bad = [s for s, q in scored if q], [s for s, q in scored if not q]
    wins = sum((g < b) + (g == b) / 2 for g in good for b in bad)
    assert wins / (len(good) * len(bad)) > 0.8
