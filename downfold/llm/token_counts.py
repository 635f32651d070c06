"""Exact histogram of encoded lengths, and what its suffix sums answer.

With the documents counted by length, sums from the long end say for each length how many
documents and tokens are at least that long. That gives totals, quantiles and what is left
after truncation for every context limit, without going back to the texts. There are at most
sqrt(2 T) different lengths among T tokens, so the tables after the first aggregate are small.
"""

from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from downfold.llm.encoding import encoder


def _counter(path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, counts = encoder(path), Counter()
        for batch in batches:
            for group, text in zip(batch.column(0), batch.column(1)):
                counts[group.as_py(), len(encode.ids(text.as_py()))] += 1
        groups, lengths = zip(*counts) if counts else ((), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(groups, pa.string()), pa.array(lengths, pa.int64()), pa.array(list(counts.values()), pa.int64())],
            names=["grp", "n_tokens", "n_docs"],
        )

    return count


def length_histogram(docs: DataFrame, path: str, by: str = "source") -> DataFrame:
    """(``by``, n_tokens, n_docs): rows of ``docs`` by encoded length; a null text has length 0."""
    rows = docs.select(F.col(by).cast("string").alias("grp"), "text")
    counted = rows.mapInArrow(_counter(path), "grp string, n_tokens long, n_docs long")
    return counted.groupBy(F.col("grp").alias(by), "n_tokens").agg(F.sum("n_docs").alias("n_docs"))


def suffix_sums(histogram: DataFrame, by: str = "source") -> DataFrame:
    """The histogram with, for each group and length L: docs_at_least and tokens_at_least (of
    documents of L tokens or more), total_docs, total_tokens, and truncated_tokens, the
    tokens left if documents are cut at L."""
    own = Window.partitionBy(by)
    longest_first = own.orderBy(F.col("n_tokens").desc())
    tokens = F.col("n_tokens") * F.col("n_docs")
    return (
        histogram.withColumn("docs_at_least", F.sum("n_docs").over(longest_first))
        .withColumn("tokens_at_least", F.sum(tokens).over(longest_first))
        .withColumn("total_docs", F.sum("n_docs").over(own))
        .withColumn("total_tokens", F.sum(tokens).over(own))
        .withColumn(
            "truncated_tokens",
            F.col("total_tokens") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least"),
        )
    )


def at_limits(sums: DataFrame, limits: Sequence[int], by: str = "source") -> DataFrame:
    """(``by``, context_limit, docs_over, tokens_kept) for any limits, whether or not a document has that length."""
    limit = F.explode(F.array(*[F.lit(n).cast("long") for n in limits])).alias("context_limit")
    own = sums.select(by, "n_tokens", "docs_at_least", "tokens_at_least", "total_tokens", limit)
    above = F.col("n_tokens") > F.col("context_limit")
    found = own.groupBy(by, "context_limit").agg(
        F.max("total_tokens").alias("total"),
        F.min_by(F.struct("docs_at_least", "tokens_at_least"), F.when(above, F.col("n_tokens"))).alias("rest"),
        F.max(above).alias("cuts"),
    )
    docs = F.when(F.col("cuts"), F.col("rest.docs_at_least")).otherwise(0)
    tokens = F.when(F.col("cuts"), F.col("rest.tokens_at_least")).otherwise(0)
    return found.select(
        by, "context_limit", docs.alias("docs_over"), (F.col("total") - tokens + F.col("context_limit") * docs).alias("tokens_kept")
    )


def quantiles(sums: DataFrame, shares: Sequence[float], by: str = "source") -> DataFrame:
    """(``by``, share, n_tokens): the shortest length that at least ``share`` of the documents do not exceed."""
    share = F.explode(F.array(*[F.lit(float(s)) for s in shares])).alias("share")
    up_to = F.col("total_docs") - F.col("docs_at_least") + F.col("n_docs")
    return (
        sums.select(by, "n_tokens", up_to.alias("up_to"), "total_docs", share)
        .filter(F.col("up_to") >= F.col("share") * F.col("total_docs"))
        .groupBy(by, "share")
        .agg(F.min("n_tokens").alias("n_tokens"))
    )


def token_lengths(docs: DataFrame, path: str, by: str = "source") -> DataFrame:
    """``suffix_sums`` of the histogram of ``docs``: one row per value of ``by`` and length that occurs.

    Whole texts are encoded without special tokens. A null or empty text has length 0, a
    null ``by`` is a group, repeated rows count each time, other columns are ignored, and an
    empty table gives an empty result. Each task counts before it sends, so a source that
    holds most rows sends no more than others.
    """
    return suffix_sums(length_histogram(docs, path, by), by)
