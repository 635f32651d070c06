"""Repeated lines: range-partitioned line hashes, first occurrences streamed from sorted runs.

Lines travel as 128-bit hashes. Rows are dealt out by ranges of (hash, salt) and sorted within
them by document, so that one pass over a sorted run sees the documents that hold a line in
order. The salt cuts the run of a line that very many documents hold; each piece passes on
its first few documents only. What comes back is, per document, a bitmap of the lines to keep,
stored as the 64-line words in which something is dropped.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from downfold.llm.common import folded, md5_halves, written

MIN_CHARS = 20
MIN_DOCS = 3
#: Pieces into which the run of one line is cut.
SALTS = 256
BLANKS = " \t\n\x0b\x0c\r"
#: Stands for a null doc_id: one document that ranks below all others.
NO_ID = -(2**63)


def _keys(line: Column) -> Column:
    return folded(F.btrim(line, F.lit(BLANKS)))


def line_rows(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(k1, k2, doc, t1, t2, pos) for each line whose key has ``min_chars`` code points."""
    lines = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"),
        *md5_halves(F.col("text")),
        F.posexplode(F.split(F.col("text"), "\n", -1)).alias("pos", "line"),
    )
    keyed = lines.withColumn("key", _keys(F.col("line"))).filter(F.char_length("key") >= min_chars)
    return keyed.select(F.xxhash64("key").alias("k1"), F.xxhash64(F.lit(1), "key").alias("k2"), "doc", "t1", "t2", "pos")


def repeated_keys(lines: DataFrame, min_docs: int = MIN_DOCS, salts: int = SALTS) -> DataFrame:
    """(k1, k2, keeper) of the lines that at least ``min_docs`` documents hold; keeper is the largest of them."""
    salted = lines.select("k1", "k2", F.pmod(F.xxhash64("doc"), F.lit(salts)).cast("int").alias("salt"), "doc")
    run = Window.partitionBy("k1", "k2", "salt").orderBy(F.col("doc").desc())
    firsts = (
        salted.repartitionByRange("k1", "k2", "salt")
        .withColumn("before", F.lag("doc").over(run))
        .filter(F.col("before").isNull() | (F.col("before") != F.col("doc")))
        .withColumn("nth", F.row_number().over(run))
        .filter(F.col("nth") <= min_docs)
    )
    # pieces hold different documents, so their counts add up
    return (
        firsts.groupBy("k1", "k2")
        .agg(F.max("doc").alias("keeper"), F.count("*").alias("found"))
        .filter(F.col("found") >= min_docs)
        .drop("found")
    )


def drop_bitmaps(lines: DataFrame, repeated: DataFrame) -> DataFrame:
    """(doc, t1, t2, words): for each text that loses lines, ``words`` of (word, bits), a set bit is a dropped line."""
    lost = lines.join(repeated, ["k1", "k2"]).filter(F.col("doc") != F.col("keeper"))
    bit = F.expr("shiftleft(1L, cast(pos % 64 as int))")
    return (
        lost.groupBy("doc", "t1", "t2", (F.col("pos") / 64).cast("int").alias("word"))
        .agg(F.bit_or(bit).alias("bits"))
        .groupBy("doc", "t1", "t2")
        .agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("words"))
    )


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, salts: int = SALTS) -> DataFrame:
    """``drop_bitmaps`` of the lines of ``docs`` that repeat.

    Texts are split and lines hashed once: the table of hashes is written, and the ranges,
    the runs and the join read it.
    """
    lines = written(line_rows(docs, min_chars), "lines")
    return drop_bitmaps(lines, repeated_keys(lines, min_docs, salts))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, salts: int = SALTS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_dropped, kept_text.

    Lines end at ``\\n``; a null or empty text is one empty line. A line's key is the line
    without white space at its ends and with A-Z in lower case. Keys of ``min_chars`` code
    points that ``min_docs`` documents hold stay only in the document with the largest
    doc_id, there each time they occur. Rows that repeat a doc_id are one document; a null
    doc_id is one document that ranks last. Columns beside doc_id and text are ignored. An
    empty table gives an empty result.
    """
    bitmaps = keep_bitmaps(docs, min_chars, min_docs, salts)
    rows = docs.select(
        "doc_id",
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"),
        *md5_halves(F.col("text")),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    joined = rows.join(bitmaps, ["doc", "t1", "t2"], "left").withColumn("lines", F.split("text", "\n", -1))
    dropped = F.expr(
        "flatten(transform(words, w -> transform("
        "filter(sequence(0, 63), b -> (shiftright(w.bits, b) & 1L) = 1L), b -> w.word * 64 + b)))"
    )
    kept = F.expr("transform(array_except(sequence(0, size(lines) - 1), dropped), p -> lines[p])")
    return joined.withColumn("dropped", dropped).select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("words").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("kept_text"),
    )
