"""Benchmark passages in documents by Wu-Manber multi-pattern search over words.

A pattern is a window of consecutive item words. Patterns of one length m form a table: SHIFT
gives, for a block of two words, how far a search window of m words may move on without
passing the start of a pattern; where the shift is 0 the block's bucket holds the patterns
that end in it, and these are compared with the text word by word. A block that no pattern
holds moves the window by m - 1 words, so most of a clean text is never looked at.
"""

from collections import defaultdict
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from downfold.llm.common import md5_halves, rows_of, written

WINDOW = 10
#: Bytes of benchmark text that one search table holds; larger benchmarks are searched in several passes.
PASS_BYTES = 16_000_000

_FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c > 0x7F else 0x20 for c in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of non-ASCII characters, A-Z in lower case, as UTF-8."""
    return text.translate(_FOLD).split() if text else []


class Patterns:
    """The search tables: by pattern length, shifts and suffix buckets."""

    def __init__(self, items: list[tuple[str, bytes | None]], window: int = WINDOW):
        self.items = [name for name, _ in items]
        owners: dict[tuple[bytes, ...], set[int]] = defaultdict(set)
        for n, (_, text) in enumerate(items):
            words = words_of(text)
            for start in range(max(1, len(words) - window + 1)):
                if piece := tuple(words[start : start + window]):
                    owners[piece].add(n)
        self.tables: dict[int, tuple[int, dict, dict]] = {}
        for piece, held in owners.items():
            size = len(piece)
            block, shift, buckets = self.tables.setdefault(size, (min(2, size), {}, defaultdict(list)))
            for end in range(block, size + 1):
                part = piece[end - block : end]
                shift[part] = min(shift.get(part, size), size - end)
            buckets[piece[size - block :]].append((piece, tuple(held)))

    def search(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Ranges [start, end) of words that occurrences cover, and the numbers of the items found."""
        ranges, found, n = [], set(), len(words)
        for size, (block, shift, buckets) in self.tables.items():
            skip, end = size - block + 1, size
            look = shift.get
            while end <= n:
                suffix = tuple(words[end - block : end])
                move = look(suffix, skip)
                if move:
                    end += move
                    continue
                here = tuple(words[end - size : end])
                for piece, held in buckets[suffix]:
                    if piece == here:
                        ranges.append((end - size, end))
                        found.update(held)
                end += 1
        return ranges, found


def covered(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """``ranges`` as disjoint ones in order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _searcher(shared, window: int, columns: list[str]):
    """An Arrow function that replaces ``_text`` by what one table finds in it."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = Patterns(shared.value, window)
        for batch in batches:
            counts, hits, names = [], [], []
            for text in batch.column("_text"):
                words = words_of(text.as_py())
                ranges, found = patterns.search(words)
                counts.append(len(words))
                hits.append([{"from": a, "to": b} for a, b in covered(ranges)])
                names.append([patterns.items[i] for i in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in columns]
                + [
                    pa.array(counts, pa.int64()),
                    pa.array(hits, pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))),
                    pa.array(names, pa.list_(pa.string())),
                ],
                names=[*columns, "n_words", "hits", "items"],
            )

    return search


def _passes(benchmark: DataFrame, pass_bytes: int) -> tuple[int, Callable[[int], list[tuple[str, bytes | None]]]]:
    """The number of groups of about ``pass_bytes`` of text, at most one an item, and what fetches the items of one."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("binary").alias("text"))
    size = F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64)
    total, count = items.agg(F.coalesce(size, F.lit(0)), F.count("*")).first()
    parts = max(1, min(-(-total // pass_bytes), count))
    part = F.pmod(F.xxhash64("item", "text"), F.lit(parts))
    return parts, lambda p: [(r["item"], r["text"]) for r in items.filter(part == p).collect()]


def benchmark_hits(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, pass_bytes: int = PASS_BYTES, carry: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """One row per row of ``docs``: the columns ``carry``, n_words, hits, items.

    ``hits`` are the disjoint ranges of words covered by occurrences of benchmark windows:
    ``window`` consecutive words of an item, or all words of a shorter one. ``items`` are
    the item_ids with an occurrence, as sorted strings; items that share an item_id count
    as one. A null or empty text has no words; an item without words finds nothing; a null
    item_id is left out of ``items`` though its windows hit. Rows stay as they are, repeated
    ones too, and other columns are ignored. An empty benchmark finds nothing.

    The benchmark is the one thing sent to every task, in tables of at most ``pass_bytes``
    of text; a larger benchmark takes one pass over the documents per table. One table is
    fetched, sent and let go at a time; what a pass finds is written, and the passes are
    merged by row. A text of any length is searched whole by one task.
    """
    context = docs.sparkSession.sparkContext
    rows = docs.select(*carry, F.col("text").cast("binary").alias("_text"))
    kinds = "n_words long, hits array<struct<from: long, to: long>>, items array<string>"

    def searched(given: DataFrame, shared) -> DataFrame:
        kept = [c for c in given.columns if c != "_text"]
        schema = given.select(*kept).schema
        for field in rows_of(docs, kinds).schema:
            schema = schema.add(field)
        return given.mapInArrow(_searcher(shared, window, kept), schema)

    tidy = F.array_sort(F.array_distinct(F.filter("items", lambda x: x.isNotNull())))
    parts, fetched = _passes(benchmark, pass_bytes)
    if parts == 1:
        return searched(rows, context.broadcast(fetched(0))).withColumn("items", tidy)
    # rows that agree in all carried columns and the text are found alike in each pass: count them once
    keyed = docs.select(*carry, F.col("text").cast("binary").alias("_text"), *md5_halves(F.col("text")))
    key = [*carry, "t1", "t2"]
    all_passes = None
    for p in range(parts):
        items = fetched(p)
        if not items and all_passes is not None:
            continue
        shared = context.broadcast(items)
        one = searched(keyed, shared).groupBy(*key).agg(
            F.count("*").alias("copies"), F.first("n_words").alias("n_words"), F.first("hits").alias("hits"), F.first("items").alias("items")
        )
        # the first pass names all rows, later ones those in which they find something
        one = written(one if all_passes is None else one.filter(F.size("hits") > 0), "benchmark-hits")
        shared.destroy()
        all_passes = one if all_passes is None else all_passes.unionByName(one)
    merged = all_passes.groupBy(*key).agg(
        F.first("copies").alias("copies"),
        F.first("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("hits"))).alias("all_hits"),
        F.flatten(F.collect_list("items")).alias("items"),
    )
    union = F.aggregate(
        "all_hits",
        F.expr("cast(array() as array<struct<from: long, to: long>>)"),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["to"] >= x["from"]),
            F.concat(
                F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))),
                F.array(F.struct(F.element_at(acc, -1)["from"].alias("from"), F.greatest(F.element_at(acc, -1)["to"], x["to"]).alias("to"))),
            ),
        ).otherwise(F.concat(acc, F.array(x))),
    )
    return merged.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(
        *carry, "n_words", union.alias("hits"), tidy.alias("items")
    )


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """``benchmark_hits`` as counts: doc_id, n_words, n_hit, n_items, items, contaminated."""
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda total, r: total + r["to"] - r["from"])
    return (
        benchmark_hits(docs, benchmark, window, pass_bytes)
        .withColumn("n_hit", n_hit)
        .select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items", (F.col("n_hit") > 0).alias("contaminated"))
    )


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """The rows of ``docs``, with all their columns, without an occurrence of a benchmark window."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"), "text")
    found = benchmark_hits(whole, benchmark, window, pass_bytes, ("whole",))
    return found.filter(F.size("hits") == 0).select("whole.*")
