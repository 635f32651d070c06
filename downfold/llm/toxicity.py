"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Labelled rows are split in three by a hash of doc_id: one part extends the lexicon with words
and word beginnings that hardly occur outside toxic documents, one grows the trees and one
calibrates their scores. Features are densities and rates, so they mean the same in short and
in long texts. Labels, language, source and doc_id are never features.
"""

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, functions as F

from downfold.llm.common import written

#: Abuse in plain English; what other languages and corpora say is learned from the labels.
INSULTS = (
    "bastard bitch brainless clown coward creep cretin degenerate despicable dimwit disgusting dumb dumbass fool freak "
    "garbage hideous idiot idiotic imbecile jerk loser lowlife maggot moron moronic nitwit parasite pathetic pig "
    "repulsive retard rubbish scum scumbag shithead sleazy slob slut stupid sucker swine trash twat ugly vermin vile "
    "weakling whore worthless wretch"
).split()
SECOND_PERSON = "you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta vous votre tú ti tus usted ustedes".split()
#: Signs that stand for letters.
LOOKALIKES = str.maketrans("013457@$!|€", "oieastasiie")

#: Labelled rows that are learned from, at most; a larger table of labels gives its first ones by hash.
LEARN_ROWS = 30_000
#: Lengths of word beginnings tried.
BEGINNINGS = (4, 5, 6, 7, 8)
#: z of the lower bound on the share of toxic documents among those with an entry. An entry that
#: only toxic documents have needs seven of them.
CONFIDENCE = 2.5
LEAST_SHARE = 0.5
#: Documents with a named word from which its share is believed.
HARMLESS_ROWS = 5
#: Words around an insult among which a second person counts as near.
NEAR = 5
TREES, DEPTH = 20, 3
REJECT_AT = 0.7

FEATURES = (
    "named_rate named_count learned_rate learned_count insult_kinds hidden_rate near_you you_rate capital_rate shout_rate mark_rate odd_rate "
    "word_length text_length"
).split()

_WORD = re.compile(r"[^\W_]+")
_EDGE = "\"'.,;:!?()[]{}<>«»¿¡#%&*_-~"
_THRICE = re.compile(r"(.)\1{2,}")


class Lexicon:
    """Named words, and learned words and beginnings of words, that count as insults."""

    def __init__(self, named: Sequence[str], words: Sequence[str] = (), beginnings: Sequence[str] = ()):
        self.named, self.words, self.beginnings = frozenset(named), frozenset(words), frozenset(beginnings)
        self.lengths = sorted({len(b) for b in self.beginnings})

    def find(self, word: str) -> str | None:
        if word in self.named or word in self.words:
            return word
        for n in self.lengths:
            if word[:n] in self.beginnings:
                return word[:n]
        return None


def _plain(word: str) -> str:
    """``word`` without what hides its letters: look-alike signs, marks inside, long repeats."""
    letters = "".join(c for c in word.translate(LOOKALIKES) if c.isalpha())
    return _THRICE.sub(r"\1", letters)


def features(text: str | None, lexicon: Lexicon) -> list[float]:
    """The numbers named in ``FEATURES``; all zero for a text without words."""
    tokens = (text or "").split()
    if not tokens:
        return [0.0] * len(FEATURES)
    hits, kinds, named, hidden, odd, you = [], set(), 0, 0, 0, []
    known: dict[str, tuple[str | None, bool, bool, bool]] = {}
    for at, token in enumerate(tokens):
        seen = known.get(token)
        if seen is None:
            word = token.lower().strip(_EDGE)
            entry, masked = lexicon.find(word), False
            mixed = not word.isalpha() and any(map(str.isalpha, word))
            if entry is None and mixed:
                entry = lexicon.find(_plain(word))
                masked = entry is not None
            known[token] = seen = (entry, masked, mixed, word in _YOU)
        entry, masked, mixed, second = seen
        odd += mixed
        if second:
            you.append(at)
        if entry is not None:
            hits.append(at)
            kinds.add(entry)
            named += entry in lexicon.named
            hidden += masked
    near, held = 0, set(you)
    for at in hits:
        near += any(at + d in held for d in range(-NEAR, NEAR + 1))
    words, chars = len(tokens), len(text)
    letters = sum(map(str.isalpha, text))
    return [
        100 * named / words,
        math.log1p(named),
        100 * (len(hits) - named) / words,
        math.log1p(len(hits) - named),
        math.log1p(len(kinds)),
        100 * hidden / words,
        near / len(hits) if hits else 0.0,
        100 * len(you) / words,
        sum(map(str.isupper, text)) / max(1, letters),
        100 * (text.count("!") + text.count("?")) / chars,
        100 * (chars - letters - text.count(" ") - text.count("\n")) / chars,
        100 * odd / words,
        letters / words,
        math.log1p(words),
    ]


_YOU = frozenset(SECOND_PERSON)


def _featurizer(shared, carried: list[str]):
    def featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(*shared.value)
        for batch in batches:
            rows = [features(t.as_py(), lexicon) for t in batch.column("text")]
            columns = [pa.array(c, pa.float64()) for c in zip(*rows)] or [pa.array([], pa.float64())] * len(FEATURES)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in carried] + columns, names=[*carried, *FEATURES])

    return featurize


def with_features(docs: DataFrame, lexicon: Lexicon, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns ``carry`` of ``docs`` and the features of its text."""
    shared = docs.sparkSession.sparkContext.broadcast((sorted(lexicon.named), sorted(lexicon.words), sorted(lexicon.beginnings)))
    rows = docs.select(*carry, "text")
    schema = docs.select(*carry).schema
    for name in FEATURES:
        schema = schema.add(name, "double")
    return rows.mapInArrow(_featurizer(shared, list(carry)), schema)


def held_out(doc_id) -> F.Column:
    """Whether crc32 of the doc_id as text leaves 1 when divided by 3; a null doc_id does not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learning_rows(docs: DataFrame, labels: DataFrame, rows: int = LEARN_ROWS) -> DataFrame:
    """(doc_id, text, toxic, part) of at most ``rows`` labelled documents that are not held out.

    A doc_id labelled both ways counts as toxic; documents that repeat a doc_id all take part.
    """
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .withColumn("lot", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)))
        .orderBy("lot", "doc_id")
        .limit(rows)
    )
    part = F.when(F.col("lot") % 20 < 9, "lexicon").when(F.col("lot") % 20 < 16, "trees").otherwise("scale")
    known = known.select("doc_id", "toxic", part.alias("part"))
    # bounded by ``rows``: 20 bytes each
    return docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")


def _entry_counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
    for batch in batches:
        for text, toxic in zip(batch.column("text"), batch.column("toxic")):
            words = set(_WORD.findall((text.as_py() or "").lower()))
            entries = {w + "$" for w in words if len(w) > 2}
            entries.update(w[:n] for w in words for n in BEGINNINGS if len(w) > n)
            counts[int(toxic.as_py() == 1)].update(entries)
    entries = list(counts[0].keys() | counts[1].keys())
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(entries, pa.string()),
            pa.array([counts[1][e] for e in entries], pa.int64()),
            pa.array([counts[0][e] for e in entries], pa.int64()),
        ],
        names=["entry", "bad", "good"],
    )


def learned_lexicon(rows: DataFrame, base: Sequence[str] = INSULTS) -> Lexicon:
    """``base`` without the words that are mostly harmless in ``rows``, and all entries that mark toxic documents with confidence.

    A text counts once however often it is repeated: copies of one toxic text say no more
    about its words than the text does.
    """
    counted = written(
        rows.groupBy("text")
        .agg(F.max("toxic").alias("toxic"))
        .mapInArrow(_entry_counter, "entry string, bad long, good long")
        .groupBy("entry")
        .agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")),
        "entries",
    )
    n, z = F.col("bad") + F.col("good"), CONFIDENCE
    share = F.col("bad") / n
    low = (share + z * z / (2 * n) - z * F.sqrt(share * (1 - share) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    # bounded by the labelled rows: each entry is in seven of their texts
    found = [r["entry"] for r in counted.filter(low >= LEAST_SHARE).orderBy("entry").select("entry").collect()]
    harmless = counted.filter(F.col("entry").isin([w + "$" for w in base]) & (n >= HARMLESS_ROWS) & (share < LEAST_SHARE))
    mild = {r["entry"][:-1] for r in harmless.select("entry").collect()}
    return Lexicon([w for w in base if w not in mild], [e[:-1] for e in found if e.endswith("$")], [e for e in found if not e.endswith("$")])


class ToxicityModel(NamedTuple):
    """Without trees (labels of one class only) the score rises with the insults found."""

    lexicon: Lexicon
    trees: Model | None
    scale: Model | None


def fit(docs: DataFrame, labels: DataFrame, rows: int = LEARN_ROWS) -> ToxicityModel:
    known = written(learning_rows(docs, labels, rows), "labelled")
    lexicon = learned_lexicon(known.filter(F.col("part") == "lexicon"))
    table = written(with_features(known.filter(F.col("part") != "lexicon"), lexicon, ("toxic", "part")), "features")
    classes = {(r["part"], r["toxic"]) for r in table.select("part", "toxic").distinct().collect()}
    if not {("trees", 0), ("trees", 1), ("scale", 0), ("scale", 1)} <= classes:
        return ToxicityModel(lexicon, None, None)
    dense = _assembled(table)
    trees = GBTClassifier(
        featuresCol="dense", labelCol="toxic", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7, minInstancesPerNode=2
    ).fit(dense.filter(F.col("part") == "trees"))
    scale = IsotonicRegression(featuresCol="probability", featureIndex=1, labelCol="toxic", predictionCol="score").fit(
        trees.transform(dense.filter(F.col("part") == "scale"))
    )
    return ToxicityModel(lexicon, trees, scale)


def _assembled(table: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="dense").transform(table)


def scored(docs: DataFrame, model: ToxicityModel, reject_at: float = REJECT_AT, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """One row per row of ``docs``: the columns ``carry``, held_out, score, predicted."""
    ids = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("_row"), "text", F.col("doc_id").alias("_id"))
    table = with_features(ids, model.lexicon, ("_row", "_id"))
    if model.trees is None:
        table = table.withColumn("score", 1 - F.exp(-F.expm1("named_count")))
    else:
        table = model.scale.transform(model.trees.transform(_assembled(table)))
    score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("score")))
    return table.select(
        "_row.*",
        held_out(F.col("_id")).alias("held_out"),
        score.alias("score"),
        (score >= reject_at).cast("int").alias("predicted"),
    )


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = LEARN_ROWS, reject_at: float = REJECT_AT) -> DataFrame:
    """Fit on the labelled rows that are not held out, and score every whole text.

    A null or empty text has features of zero and a score like others. Repeated rows are
    scored alike. Columns beside doc_id and text, and doc_id and toxic of the labels, are
    ignored. Empty ``docs`` give an empty result; without labels of both classes the score
    is 1 - exp(-insults found). A text of any length is read whole, in one pass over its words.
    """
    return scored(docs, fit(docs, labels, rows), reject_at)


def accepted(docs: DataFrame, labels: DataFrame, rows: int = LEARN_ROWS, reject_at: float = REJECT_AT) -> DataFrame:
    """The rows of ``docs``, with all their columns, that are not predicted toxic.

    Null, empty and very long texts and repeated rows are judged as in ``toxicity``; of
    repeated rows all stay or none. Extra columns keep their names and values, also names
    that the score has.
    """
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"), "doc_id", "text")
    return scored(whole, fit(docs, labels, rows), reject_at, ("whole",)).filter(F.col("predicted") == 0).select("whole.*")
