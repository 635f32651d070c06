"""Mixing sources to target weights by Pareto order sampling.

A source's target over its size is the rate at which its documents are taken. The whole part
of a document's rate is copies it gets for certain; the rest is its inclusion probability f.
Documents are ranked by the odds of a uniform number over the odds of f (small first), and the
ranking is followed until the source's words reach the target. The uniform number is made from
the doc_id, so reruns agree. All of it is DataFrame expressions.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from downfold.llm.common import written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_COPIES = 2
#: Ranges of the ranking variable; only the one where a source's target falls is sorted by row.
BINS = 16384
#: Per-source tables of up to so many rows are broadcast, about 10 MB; larger ones are joined.
BROADCAST_SOURCES = 50_000
WORD = r"[^\x20\x09-\x0D]+"
SEED = "mix"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(doc_id: Column, seed: str = SEED) -> Column:
    """A number in (0, 1) from 52 bits of an MD5 of seed and doc_id."""
    named = F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("null")))
    bits = F.conv(F.substring(F.md5(named.cast("binary")), 1, 13), 16, 10).cast("long")
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(2**52))


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, max_copies: int = MAX_COPIES
) -> DataFrame:
    """(source, source_size, target) from (source, source_size, ...).

    Sources in code point order, null last, weigh ``weights`` over and over and share
    ``share`` times all words. A target stops at ``max_copies`` times its source; what is
    over goes to the others by weight until none is above. That end state is a water level:
    with sources sorted by cap over weight, the level is fixed by the first source that
    stays below its cap. The windows run over one row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", "place")
    weighed = (
        sizes.withColumn("place", F.row_number().over(order))
        .withColumn("weight", F.expr(f"array({','.join(map(str, weights))})[(place - 1) % {len(weights)}]").cast("double"))
        .withColumn("cap", F.col("source_size").cast("double") * max_copies)
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("all_words", F.sum("source_size").over(Window.partitionBy()).cast("double") * share)
    )
    level = (
        (F.col("all_words") - (F.sum("cap").over(by_ratio) - F.col("cap")))
        / F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    )
    levelled = weighed.withColumn("level", level).withColumn(
        "water", F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(Window.partitionBy())
    )
    target = F.least(F.col("cap"), F.coalesce(F.col("water") * F.col("weight"), F.col("cap")))
    return levelled.select("source", "source_size", target.alias("target"))


def _per_source(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """``rows`` with the columns of ``facts`` (a written table) for their source; others go."""
    small = facts.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    facts = facts.withColumnRenamed("source", "_source")
    return rows.join(F.broadcast(facts) if small else facts, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")


def _ranked(rows: DataFrame, max_copies: int, bins: int, seed: str) -> DataFrame:
    """``rows`` (_id, size, w, rate, ...) with certain copies, the ranking variable ``odds`` and its range ``bin``.

    A row whose certain copies are all it may have has no bin; a whole rate ranks last.
    """
    rate = F.least(F.col("rate") * F.col("w"), F.lit(float(max_copies)))
    u = uniform(F.col("_id"), seed)
    odds = (u / (1 - u)) / (F.col("f") / (1 - F.col("f")))
    full = F.col("certain") >= max_copies
    return (
        rows.withColumn("certain", F.floor(rate).cast("int"))
        .withColumn("f", rate - F.col("certain"))
        .withColumn("odds", F.when(F.col("f") > 0, odds).otherwise(F.lit(float("inf"))))
        .withColumn(
            "bin",
            F.when(~full & (F.col("f") > 0), F.floor(F.col("odds") / (1 + F.col("odds")) * bins))
            .when(~full, F.lit(bins))
            .cast("int"),
        )
    )


def _rank() -> Column:
    return F.struct("odds", "_id", "size")


def mix_plan(
    sized: DataFrame, weights: Sequence[int], share: float, max_copies: int, bins: int, seed: str
) -> DataFrame:
    """(source, source_size, target, rate, cut_bin, last): what decides on a document of each source.

    Along the ranking, documents in bins below ``cut_bin`` are taken, and in it those up to
    ``last``; without a cut_bin all are.
    """
    totals = written(
        sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(F.col("w") * F.col("size")).alias("weighted")),
        "totals",
    )
    targets = source_targets(totals, weights, share, max_copies).withColumnRenamed("source", "_s")
    facts = written(
        totals.select("source", "weighted")
        .join(targets, F.col("source").eqNullSafe(F.col("_s")))
        .select(
            "source",
            "source_size",
            "target",
            F.coalesce(F.try_divide(F.col("target"), F.col("weighted")), F.lit(0.0)).alias("rate"),
        ),
        "targets",
    )
    ranked = _ranked(_per_source(sized, facts), max_copies, bins, seed)
    per_bin = ranked.groupBy("source", "bin").agg(
        F.sum("size").alias("words"), F.sum(F.col("certain") * F.col("size")).alias("sure"), F.first("target").alias("target")
    )
    along = Window.partitionBy("source").orderBy("bin")
    cut = (
        per_bin.withColumn("wanted", F.col("target") - F.sum("sure").over(Window.partitionBy("source")))
        .filter(F.col("bin").isNotNull())
        .withColumn("before", F.sum("words").over(along) - F.col("words"))
        .filter(F.col("before") + F.col("words") > F.col("wanted"))
        .groupBy("source")
        .agg(F.min(F.struct("bin", "before", "wanted")).alias("cut"))
    )
    cut = written(cut.select("source", F.col("cut.bin").alias("cut_bin"), F.col("cut.before").alias("before"), F.col("cut.wanted").alias("wanted")), "cuts")
    near = Window.partitionBy("source").orderBy("odds", "_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    middle = F.col("before") + F.sum("size").over(near) - F.col("size") / 2
    last = (
        _per_source(ranked.select("source", "odds", "_id", "size", "bin"), cut)
        .filter(F.col("bin") == F.col("cut_bin"))
        .withColumn("middle", middle)
        .filter((F.col("size") > 0) & (F.col("middle") <= F.col("wanted")))
        .groupBy("source")
        .agg(F.max(_rank()).alias("last"))
    )
    out = facts
    for part in (cut.select("source", "cut_bin"), last):
        part = part.withColumnRenamed("source", "_s")
        out = out.join(part, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    return written(out, "plan")


def with_copies(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    max_copies: int = MAX_COPIES,
    importance: str | None = None,
    bins: int = BINS,
    seed: str = SEED,
) -> DataFrame:
    """(row, source, size, source_size, target, copies) for each row of ``docs``; ``row`` is a struct of its columns.

    ``size`` is the number of words, 0 for a null text, and ``copies`` how often the mix has
    the document. ``importance`` names a positive column to which rates within a source are
    proportional; without it they are equal. Along the ranking a document is taken if its
    middle word still lies within what is wanted, so a source ends within half a document
    of its target. Documents without words get their certain copies only. Documents that
    repeat a doc_id share a random number; ties are broken by doc_id and size, and rows
    alike in both fare alike at the cut. A null source is a source. An empty table gives an
    empty result.

    The plan is made from a table of sizes; the texts themselves are read once more and
    never shuffled, as long as the number of sources allows a broadcast.
    """
    w = F.col(importance).cast("double") if importance else F.lit(1.0)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("doc_id").alias("_id"),
        "source",
        word_count(F.col("text")).alias("size"),
        w.alias("w"),
    )
    plan = mix_plan(written(rows.drop("row"), "sizes"), weights, share, max_copies, bins, seed)
    ranked = _ranked(_per_source(rows, plan), max_copies, bins, seed)
    below = F.col("cut_bin").isNull() | (F.col("bin") < F.col("cut_bin"))
    within = (F.col("bin") == F.col("cut_bin")) & F.coalesce(_rank() <= F.col("last"), F.lit(False))
    extra = F.when(F.col("bin").isNotNull() & (F.col("size") > 0) & (below | within), 1).otherwise(0)
    return ranked.select("row", "source", "size", "source_size", "target", (F.col("certain") + extra).alias("copies"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """``with_copies`` as figures: doc_id, source, size, source_size, target, copies, taken (words, repeats counted)."""
    taken = (F.col("copies") * F.col("size")).cast("long")
    return with_copies(docs, **options).select(
        F.col("row.doc_id").alias("doc_id"), "source", "size", "source_size", "target", "copies", taken.alias("taken")
    )


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the mix has, each as often as it has it."""
    copies = with_copies(docs, **options).filter(F.col("copies") > 0)
    return copies.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
