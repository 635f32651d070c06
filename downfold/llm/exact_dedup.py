"""Exact duplicates by deterministic block naming.

A text is cut into blocks of fixed size. The distinct blocks of the corpus are sorted and
numbered, which gives each an integer name; then adjacent names are paired, the distinct
pairs are sorted and numbered, and so on until one name stands for the whole text. Equal
names mean equal texts: nothing rests on a hash, which only deals blocks out to tasks and
speeds the sort up.
"""

from pyspark.sql import DataFrame, functions as F

from downfold.llm.common import folded, written

#: Characters of a block; most documents are one block, and a long one is named in few rounds.
BLOCK_CHARS = 4096


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """(row, doc_id, sha, blocks, pos, block): at least one block for each row, also an empty one."""
    cut = F.when(F.char_length("norm") <= size, F.array("norm")).otherwise(
        F.regexp_extract_all("norm", F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    )
    return (
        rows.withColumn("cut", cut)
        .select("*", F.size("cut").alias("blocks"), F.posexplode("cut").alias("pos", "block"))
        .withColumn("sha", F.when(F.col("pos") == 0, F.sha2(F.col("norm").cast("binary"), 256)))
        .drop("norm", "cut")
    )


def _named(parts: DataFrame, keys: list[str]) -> DataFrame:
    """``parts`` with ``name``: the number of its ``keys`` among the distinct ones, in sorted order.

    Numbers are unique, not consecutive. Copies are merged before the shuffle. The join back
    uses the partitioning of the distinct keys; a key that many rows hold makes a skewed
    join, which adaptive execution splits.
    """
    distinct = (
        parts.select(*keys).distinct().sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id())
    )
    renamed = distinct.select(*[F.col(k).alias(f"_{k}") for k in keys], "name")
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return parts.join(renamed, on).drop(*keys, *[f"_{k}" for k in keys])


def identities(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(row, doc_id, sha, blocks, name) for each row of ``docs``: rows are equal texts iff (blocks, name) agree.

    Each round is written before the next, so names do not change when a task runs again.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", folded(F.col("text")).alias("norm"))
    parts = _blocks(rows, block_chars).withColumn("deal", F.xxhash64("block"))
    # blocks hold no nulls, so plain equality will do and the sort compares the integers first
    distinct = (
        parts.select("deal", "block")
        .distinct()
        .sortWithinPartitions("deal", "block")
        .withColumn("name", F.monotonically_increasing_id())
    )
    named = written(parts.join(distinct, ["deal", "block"]).drop("deal", "block"), "blocks")
    longest = named.agg(F.max("blocks")).first()[0] or 1
    done = [named.filter(F.col("blocks") == 1)]
    open_, width = named.filter(F.col("blocks") > 1), 1
    while width < longest:
        # the parts that remain stand at multiples of width; a last one without a partner is named alone
        pairs = (
            open_.groupBy("row", "doc_id", "blocks", (F.col("pos") / (2 * width)).cast("int").alias("pair"))
            .agg(
                F.max("sha").alias("sha"),
                F.max(F.when((F.col("pos") / width).cast("int") % 2 == 0, F.col("name"))).alias("left"),
                F.max(F.when((F.col("pos") / width).cast("int") % 2 == 1, F.col("name"))).alias("right"),
            )
            .withColumn("pos", F.col("pair") * (2 * width))
            .drop("pair")
        )
        width *= 2
        named = written(_named(pairs, ["left", "right"]), "pairs")
        done.append(named.filter(F.col("blocks") <= width))
        open_ = named.filter(F.col("blocks") > width)
    out = None
    for part in done:
        part = part.select("row", "doc_id", "sha", "blocks", "name")
        out = part if out is None else out.unionByName(part)
    return out


def exact_duplicates(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they agree after lower-casing A-Z; a null text is an empty one, and
    empty texts are equal. Of equal texts the row with the largest doc_id stays; a null
    doc_id ranks below all others, and of rows that repeat a doc_id one stays. Columns
    beside doc_id and text are ignored. An empty table gives an empty result.
    """
    named = identities(docs, block_chars)
    group = ["blocks", "name"]
    best = (
        named.groupBy(*group)
        .agg(F.max(F.struct("doc_id", "row")).alias("best"), F.count("*").alias("group_size"))
        .select(*group, F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row"), "group_size")
    )
    return named.join(best, group).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
