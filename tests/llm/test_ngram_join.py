import random
import re

import pytest

from downfold.llm import ngram_join
from llm.texts import documents, fold, rows, table


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", fold(text))
    if not words:
        return set()
    return {" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def linked(x, y, percent):
    return bool(x and y) and 100 * len(x & y) >= percent * len(x | y)


def brute(given, size=4, percent=85):
    sets = [shingles(t, size) for _, t in given]
    n = len(given)
    links = {i: [j for j in range(n) if j != i and linked(sets[i], sets[j], percent)] for i in range(n)}
    out = []
    for i, (doc_id, _) in enumerate(given):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [given[j][0] for j in seen if given[j][0] is not None]
        out.append((doc_id, len(sets[i]), min(ids) if ids else None, len(links[i])))
    return sorted(out, key=repr)


def variants(seed, n, words, edits):
    """Texts made of one text by up to ``edits`` changed words."""
    draw = random.Random(seed)
    base = [f"w{draw.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(draw.randint(0, edits)):
            own[draw.randrange(words)] = draw.choice([f"e{draw.randrange(10**6)}", "common"])
        out.append(" ".join(own))
    return out


EDGES = [
    (1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE "), (6, "one two three"), (7, "one two three"), (8, "one two three four"),
    (9, "one two three four"), (9, "one two three four"), (None, "one two three four"), (None, "lonely null"), (10, "one\x0btwo\x0cthree four"),
    (11, "a " * 2000), (12, "a " * 5), (13, "a b " * 500), (14, "é É é é"), (15, "É É é é"), (16, "q r s t u"),
]


def test_edges(spark):
    assert rows(ngram_join.jaccard_groups(documents(spark, EDGES, extra=True))) == brute(EDGES)
    assert rows(ngram_join.jaccard_groups(documents(spark, []))) == []
    nothing = [(1, None), (2, "")]
    assert rows(ngram_join.jaccard_groups(documents(spark, nothing))) == brute(nothing)


@pytest.mark.parametrize("size,percent", [(4, 85), (5, 80), (1, 50), (3, 100)])
def test_near_copies(spark, size, percent):
    texts = []
    for seed, (n, words, edits) in enumerate([(60, 60, 3), (40, 30, 4), (30, 12, 2), (30, 150, 9), (20, 5, 1)]):
        texts += variants(seed, n, words, edits)
    given = [(3 * i + 1, t) for i, t in enumerate(texts)]
    assert rows(ngram_join.jaccard_groups(documents(spark, given), size, percent)) == brute(given, size, percent)


def test_small_chunks_and_many_buckets(spark, monkeypatch):
    """Every text in a chunk of its own, so that all sharing is found through buckets."""
    monkeypatch.setattr(ngram_join, "BUCKET_SHINGLES", 100)
    given = [(i, t) for i, t in enumerate(variants(5, 40, 40, 3) + variants(6, 40, 25, 2))]
    docs = documents(spark, given)
    assert rows(ngram_join.jaccard_groups(docs.repartition(8))) == brute(given)


def test_table(spark):
    given = [(r.doc_id, r.text) for r in table(spark, "0.001", "documents").collect()]
    assert rows(ngram_join.jaccard_groups(table(spark, "0.001", "documents"))) == brute(given)


def test_one_per_group(spark):
    given = EDGES + [(100 + i, t) for i, t in enumerate(variants(1, 20, 40, 1))]
    docs = documents(spark, given, extra=True)
    kept = ngram_join.one_per_group(docs)
    assert kept.columns == docs.columns
    heads = {}
    for (doc_id, n, head, _), (_, text) in zip(map(tuple, [r for g in given for r in [next(b for b in brute(given) if b[0] == g[0])]]), given):
        heads.setdefault(doc_id, (n, head))
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids == sorted({d for d, (n, head) in heads.items() if d is not None and (not n or d == head)})
    assert sum(r.doc_id is None for r in kept.collect()) == 1


def test_rows_without_a_set_all_stay(spark):
    blank = [(None, None, "a"), (None, None, "a"), (None, "", "b"), (None, " \n", "c"), (4, "", "a"), (4, "", "b")]
    again = [(7, "one two three four five six", source) for source in "pqrs"]
    docs = documents(spark, blank + again)
    kept = ngram_join.one_per_group(docs)
    without = sorted((r.doc_id or 0, r.text or "", r.source) for r in kept.collect() if r.doc_id != 7)
    assert without == sorted((d or 0, t or "", s) for d, t, s in blank)
    chosen = [ngram_join.one_per_group(documents(spark, order).coalesce(1)).collect() for order in (again, again[::-1])]
    assert len(chosen[0]) == 1 and chosen[0] == chosen[1]


def test_groups_without_listing_their_links(spark, monkeypatch):
    """Slices of few classes, so that groups come together through several shingles and the join that follows."""
    monkeypatch.setattr(ngram_join, "SLICE_CLASSES", 4)
    texts = [t for seed, edits in ((1, 2), (2, 6), (3, 9)) for t in variants(seed, 40, 60, edits)]
    given = [(5 * i + 2, t) for i, t in enumerate(texts)]
    kept = ngram_join.one_per_group(documents(spark, given, extra=True), 5, 80)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, n, head, _ in brute(given, 5, 80) if d == head)


def test_nothing_to_group(spark):
    nothing = documents(spark, [], extra=True)
    kept = ngram_join.one_per_group(nothing)
    assert kept.columns == nothing.columns and rows(kept) == []


@pytest.mark.parametrize("places", [1, 7, 1 << 24])
def test_only_marked_texts_are_moved(spark, monkeypatch, places):
    monkeypatch.setattr(ngram_join, "MARK_PLACES", places)
    told = spark.createDataFrame([(5, 0, 0, "gone"), (-9, 0, 0, "gone")], "g1 long, t2 long, g0 long, fate string")
    whole = spark.createDataFrame([(t,) for t in range(-40, 40)], "t1 long")
    asked = {r.t1 for r in ngram_join._maybe_told(whole, told).filter("asked").collect()}
    assert asked == {t for t in range(-40, 40) if t % places in (5 % places, -9 % places)}
    nothing = ngram_join._maybe_told(whole, told.limit(0))
    assert nothing.filter("asked").count() == 0 and nothing.count() == 80
