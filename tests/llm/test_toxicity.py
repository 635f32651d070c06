import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from downfold.llm import toxicity
from downfold.llm.queries import op6_toxicity_trees
from llm.texts import documents, table

LEXICON = toxicity.Lexicon(["idiot", "moron"], ["kvark"], ["schwaf"])


def named(text):
    return dict(zip(toxicity.FEATURES, toxicity.features(text, LEXICON)))


def test_features_of_small_texts():
    assert set(named("").values()) == set(named(None).values()) == set(named(" \n ").values()) == {0.0}
    f = named("You IDIOT, 1d10t! schwafler kvark kvarks")
    assert f["named_rate"] == pytest.approx(100 * 2 / 6)
    assert f["learned_rate"] == pytest.approx(100 * 2 / 6)
    assert f["hidden_rate"] == pytest.approx(100 / 6)
    assert f["near_you"] == 1.0
    assert f["you_rate"] == pytest.approx(100 / 6)
    assert f["odd_rate"] == pytest.approx(100 / 6)
    assert named("a moron " + "a " * 10 + "you")["near_you"] == 0.0
    assert named("m.o.r.o.n moooooron")["named_count"] == pytest.approx(0.6931, abs=1e-3)
    assert named("ab CD")["capital_rate"] == 0.5


def test_held_out_is_the_crc(spark):
    ids = [0, 1, 2, 17, 123456789, -4]
    got = documents(spark, [(i, "x") for i in ids] + [(None, "x")]).select("doc_id", toxicity.held_out(F.col("doc_id")).alias("h"))
    for doc_id, held in got.collect():
        assert held == (doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 1)


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in table(spark, "0.1", "labels").collect()}
    scored = op6_toxicity_trees(spark, sf_dir).collect()
    assert len(scored) == table(spark, "0.1", "documents").count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in scored)
    test = [(r.score, r.predicted, labels[r.doc_id]) for r in scored if r.held_out and r.doc_id in labels]
    good, bad = [s for s, _, t in test if not t], [s for s, _, t in test if t]
    wins = sum((b > g) + (b == g) / 2 for g in good for b in bad)
    assert wins / (len(good) * len(bad)) > 0.9
    assert sum(t for _, p, t in test if p) > 0.9 * sum(p for _, p, _ in test)


def test_held_out_labels_do_not_matter(spark):
    docs, labels = table(spark, "0.001", "documents"), table(spark, "0.001", "labels")
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 3 = 1 THEN 1 - toxic ELSE toxic END AS toxic")
    a, b = toxicity.learning_rows(docs, labels), toxicity.learning_rows(docs, flipped)
    assert sorted(a.collect()) == sorted(b.collect())


def test_edges(spark):
    labels = spark.createDataFrame([(1, 1), (None, 1), (2, None)], "doc_id long, toxic int")
    given = [(1, "you idiot"), (1, "you idiot"), (2, None), (3, ""), (None, "fine words")]
    got = toxicity.toxicity(documents(spark, given, extra=True), labels).collect()
    assert sorted((r.doc_id or -1, r.predicted) for r in got) == [(-1, 0), (1, 0), (1, 0), (2, 0), (3, 0)]
    assert max(r.score for r in got) == pytest.approx(0.632, abs=1e-3)
    assert toxicity.toxicity(documents(spark, []), labels).collect() == []
    assert len(toxicity.toxicity(documents(spark, given), labels.limit(0)).collect()) == 5


def brute_entries(given):
    """Entries by the lower bound on the toxic share, from distinct (text, toxic)."""
    bad, every = Counter(), Counter()
    for text, toxic in set(given):
        words = set(re.findall(r"[^\W_]+", (text or "").lower()))
        for entry in {w + "$" for w in words if len(w) > 2} | {w[:n] for w in words for n in range(4, 9) if len(w) > n}:
            every[entry] += 1
            bad[entry] += toxic
    z, found = 2.5, set()
    for entry, n in every.items():
        share = bad[entry] / n
        low = (share + z * z / (2 * n) - z * math.sqrt(share * (1 - share) / n + z * z / (4 * n * n))) / (1 + z * z / n)
        if low >= 0.5:
            found.add(entry)
    return found


def test_learned_entries_equal_brute_force(spark):
    """All entries that pass the bound, also those of few among many toxic texts; copies of a text count once."""
    given = [(f"zorblatt line{n} again", 1) for n in range(7)] + [(f"sixfold row{n}x", 1) for n in range(6)]
    given += [("copyword only here", 1)] * 40 + [(f"plain words number{n}", n % 2) for n in range(900)] + [("", 0), (None, 0)]
    known = spark.createDataFrame(given, "text string, toxic int")
    lexicon = toxicity.learned_lexicon(known)
    found = {w + "$" for w in lexicon.words} | lexicon.beginnings
    assert found == brute_entries(given)
    assert "zorblatt$" in found and "sixfold$" not in found and "copyword$" not in found
    real = toxicity.learning_rows(table(spark, "0.01", "documents"), table(spark, "0.01", "labels")).select("text", "toxic")
    lexicon = toxicity.learned_lexicon(real)
    assert {w + "$" for w in lexicon.words} | lexicon.beginnings == brute_entries([tuple(r) for r in real.collect()])


def test_accepted_keeps_rows_as_they_are(spark):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    given = [(1, "you idiot moron"), (1, "you idiot moron"), (2, None), (2, None), (3, ""), (None, "fine words")]
    docs = documents(spark, given, extra=True)
    kept = toxicity.accepted(docs, labels)
    assert kept.columns == docs.columns
    want = [tuple(r) for r in docs.collect() if r.doc_id != 1]
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted(want, key=repr)
    assert toxicity.accepted(docs.limit(0), labels).collect() == []


def test_very_long_text_is_read_to_its_end(spark):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    text = "fine words " * 200_000
    got = toxicity.toxicity(documents(spark, [(1, text), (2, text + "you idiot moron")]), labels).collect()
    assert sorted((r.doc_id, r.predicted) for r in got) == [(1, 0), (2, 1)]
