import re
from collections import Counter, defaultdict

import pytest

from downfold.llm import mixing
from downfold.llm.queries import op2_pareto_mix
from llm.texts import documents, rows, table


def reshare(sizes, share=1.5, weights=(5, 2, 1), most=2):
    """Give by weight, cut what is above its cap, share the excess out again, until nothing is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[n % len(weights)] for n, s in enumerate(order)}
    left, capped = share * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in capped]
        total = sum(weight[s] for s in free)
        given = {s: left * weight[s] / total for s in free}
        over = [s for s in free if given[s] > most * sizes[s]]
        if not over:
            return {**given, **capped}
        for s in over:
            capped[s] = most * sizes[s]
            left -= capped[s]


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def hold(given, got, share=1.5):
    """The promises of the mix, against sizes counted here."""
    sizes, per_source, largest = {}, Counter(), Counter()
    for doc_id, text, source in given:
        sizes[doc_id] = words(text)
        per_source[source] += words(text)
        largest[source] = max(largest[source], words(text))
    targets, taken = reshare(per_source, share), Counter()
    assert len(got) == len(given)
    for r in got:
        assert r.size == sizes[r.doc_id] and r.source_size == per_source[r.source]
        assert r.target == pytest.approx(targets[r.source], rel=1e-9)
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        taken[r.source] += r.taken
    for source, target in targets.items():
        assert abs(taken[source] - target) <= largest[source] / 2 + 1e-6


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_tables(spark, sf):
    docs = table(spark, sf, "documents")
    hold([(r.doc_id, r.text, r.source) for r in docs.collect()], mixing.mixed(docs).collect())


def test_few_bins_give_the_same_mix(spark):
    docs = table(spark, "0.01", "documents")
    assert rows(mixing.mixed(docs, bins=7)) == rows(mixing.mixed(docs))


def test_hot_and_tiny_sources(spark):
    given = [(n, "w " * (n % 17), "a") for n in range(600)]
    given += [(1000 + n, "w " * (n % 5 + 1), "b") for n in range(40)] + [(2000, "w " * 50, "c"), (2001, "x", None)]
    given += [(2002, None, "a"), (2003, "", "d")]
    hold(given, mixing.mixed(documents(spark, given, extra=True)).collect())


def test_reruns_agree_and_seed_matters(spark):
    docs = table(spark, "0.001", "documents")
    assert rows(mixing.mixed(docs)) == rows(mixing.mixed(docs.repartition(7)))
    assert rows(mixing.mixed(docs)) != rows(mixing.mixed(docs, seed="other"))


def test_importance_raises_inclusion(spark):
    given = [(n, "w " * 10, "a") for n in range(2000)]
    docs = documents(spark, given).selectExpr("*", "IF(doc_id % 2 = 0, 3.0, 1.0) AS imp")
    got = mixing.mixed(docs, share=0.5, importance="imp").collect()
    assert sum(r.taken for r in got) == pytest.approx(10_000, abs=5)
    counts = Counter(r.doc_id % 2 for r in got if r.copies)
    assert counts[0] / counts[1] == pytest.approx(3, rel=0.2)
    certain = mixing.mixed(docs, share=1.0, importance="imp").collect()
    assert all(r.copies >= 1 for r in certain if r.doc_id % 2 == 0)
    assert sum(r.taken for r in certain) == pytest.approx(20_000, abs=5)


def test_mixture_repeats_rows(spark):
    docs = table(spark, "0.001", "documents")
    copies = {r.doc_id: r.copies for r in mixing.mixed(docs).collect()}
    mixed = mixing.mixture(docs)
    assert mixed.columns == docs.columns
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({d: n for d, n in copies.items() if n})


def test_repeated_rows_and_empty_tables(spark):
    given = [(1, "a b c", "s")] * 3 + [(None, "a b", "s"), (None, "a b", "s")]
    got = mixing.mixed(documents(spark, given)).collect()
    assert len(got) == 5 and sum(r.taken for r in got) > 0
    assert rows(mixing.mixed(documents(spark, []))) == []
    assert [r.taken for r in mixing.mixed(documents(spark, [(1, None, "s"), (2, " ", None)])).collect()] == [0, 0]


def test_inclusion_is_near_the_rate(spark):
    """Over many seeds each document is taken as often as its rate says."""
    given = [(n, "w " * (3 + n % 4), "a") for n in range(60)]
    docs = documents(spark, given)
    total = defaultdict(int)
    for seed in range(25):
        for r in mixing.mixed(docs, share=0.3, seed=str(seed)).collect():
            total[r.doc_id] += r.copies
    assert sum(total.values()) / (60 * 25) == pytest.approx(0.3, abs=0.05)
    assert max(total.values()) <= 17


def test_query_columns(spark):
    got = op2_pareto_mix(spark, "/root/testdata/sf0.001")
    assert {"doc_id", "size", "source_size", "target", "taken"} <= set(got.columns)
