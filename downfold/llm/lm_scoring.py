"""Cross-entropy difference of a target and a background bigram model over one vocabulary.

The vocabulary is every word of the two tables. Bigrams are counted over all documents for the
background and over all target documents for the target, smoothed alike (Witten-Bell, down to
add-one unigrams with room for one unknown word), and a document's score is the mean over its
words of the target's loss less the background's. Low means target-like.

Nothing of a model is collected or broadcast. The texts are cut into pieces of some million
words. A piece sends each of its distinct bigrams, with its count, to the bucket of its hash,
where the counts of all pieces are summed and the sums sent back to the pieces that asked; so a
frequent bigram is one entry a piece. Each bigram is owned by one piece, which adds it to the
counts of its two words, and these are summed and sent back alike. A piece with the sums of its
bigrams and words scores its documents. Words and bigrams go by 64 bits of a hash.
"""

from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from downfold.llm.common import written

#: Distinct words that a task counts before it sends.
COUNTED = 1 << 20
#: Words of a piece; a longer text is a piece of its own.
PIECE = 2 << 20
#: What stands before the first word, and for a word outside a limited vocabulary.
START, UNKNOWN = 0, 1
#: Odd factor that makes one number of two.
MIX = np.uint64(11400714819323198485)
PIECES = "piece long, ids array<long>, sizes binary, words binary, hashes binary"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SUMS = "piece long, bucket long, sums binary, kinds long, bg long, tg long"


def words_of(text: bytes | None) -> list[bytes]:
    """What white space parts, with A-Z in lower case, as UTF-8."""
    return text.lower().split() if text else []


def _texts(df: DataFrame) -> DataFrame:
    return df.select(F.col("text").cast("binary").alias("text"))


def _word_counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def sent() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"]
        )

    for batch in batches:
        for text in batch.column(0):
            counts.update(words_of(text.as_py()))
            if len(counts) >= COUNTED:
                yield sent()
                counts.clear()
    yield sent()


def vocabulary(docs: DataFrame, size: int) -> list[bytes]:
    """The ``size`` most frequent words of ``docs``, ties in byte order."""
    counted = _texts(docs).mapInArrow(_word_counter, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    top = counted.orderBy(F.col("n").desc(), "word").limit(size)
    return [bytes(r["word"]) for r in top.select("word").collect()]


def _hash(word: bytes) -> int:
    return int.from_bytes(blake2b(word, digest_size=8).digest(), "little")


def _packed(numbers: np.ndarray) -> bytes:
    """64-bit numbers, the bytes of one place together, compressed."""
    planes = np.ascontiguousarray(numbers).view(np.uint8).reshape(-1, 8).T.tobytes()
    return len(numbers).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def _unpacked(data: bytes, kind=np.int64) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], 8 * n, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).view(kind).ravel()


def _rows(schema: str, rows: list[tuple]) -> dict:
    """Columns of an Arrow table or batch with the names and types of ``schema``."""
    kinds = {"long": pa.int64(), "binary": pa.binary(), "double": pa.float64(), "array<long>": pa.list_(pa.int64())}
    fields = [f.split() for f in schema.split(", ")]
    return {name: pa.array([r[k] for r in rows], kinds[kind]) for k, (name, kind) in enumerate(fields)}


def _cutter(known, sign: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = None if known is None else set(known.value)
        numbers, ids, sizes, words, first, held = {}, [], [], [], 0, 0

        def sent() -> pa.RecordBatch:
            hashes = np.array([_hash(w) if told is None or w in told else UNKNOWN for w in numbers], np.uint64)
            flat = np.concatenate(words) if words else np.zeros(0, np.int64)
            row = (sign * first, list(ids), _packed(np.array(sizes, np.int64)), _packed(flat), _packed(hashes))
            return pa.RecordBatch.from_pydict(_rows(PIECES, [row]))

        for batch in batches:
            for row, doc_id, text in zip(*(c.to_pylist() for c in batch.columns[:2]), batch.column(2)):
                parts = words_of(text.as_py())
                if ids and held + len(parts) > PIECE:
                    yield sent()
                    numbers, ids, sizes, words, held = {}, [], [], [], 0
                if not ids:
                    first = row + 1
                words.append(np.array([numbers.setdefault(w, len(numbers)) for w in parts], np.int64))
                ids.append(doc_id)
                sizes.append(len(parts))
                held += len(parts) + 1
        if ids:
            yield sent()

    return cut


def _pieces(df: DataFrame, known, sign: int = 1) -> DataFrame:
    """The texts of ``df`` as pieces, numbered from 1 (``sign`` 1) or from -1 down (-1)."""
    rows = df.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")
    )
    return rows.mapInArrow(_cutter(known, sign), PIECES)


class Piece:
    """A row of PIECES: hashes of its words in order, and its distinct bigrams in order of their hash."""

    def __init__(self, row: dict):
        self.number, self.ids, self.sizes = row["piece"], row["ids"], _unpacked(row["sizes"])
        hashes = np.append(_unpacked(row["hashes"], np.uint64), np.uint64(START))
        self.words, place = np.unique(hashes, return_inverse=True)
        at = place[_unpacked(row["words"])]
        before = np.empty_like(at)
        before[1:] = at[:-1]
        starts = (np.cumsum(self.sizes) - self.sizes)[self.sizes > 0]
        before[starts] = place[-1]
        codes = self.words[before] * MIX + self.words[at]
        self.codes, first, self.of = np.unique(codes, return_index=True, return_inverse=True)
        self.before, self.word = before[first], at[first]


def _asked(piece: int, keys: np.ndarray, values: list[np.ndarray], buckets: int) -> Iterator[tuple]:
    """Sorted ``keys`` with their values, a row for each bucket of the hash that has any."""
    of = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    names, starts = np.unique(of, return_index=True)
    for bucket, start, end in zip(names.tolist(), starts, [*starts[1:], len(keys)]):
        own = [_packed(np.diff(keys[start:end], prepend=np.uint64(0))), _packed(np.concatenate([v[start:end] for v in values]))]
        yield (piece, bucket, *own)


ASKED = "piece long, bucket long, keys binary, counts binary"


def _bigram_asker(buckets: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                piece = Piece(row)
                wanted = set(row["wanted"] or ())
                docs = np.full(len(piece.ids), row["piece"] > 0)
                target = ~docs | np.array([i in wanted for i in piece.ids], bool)
                counts = [
                    np.bincount(piece.of, np.repeat(marks, piece.sizes), len(piece.codes)).astype(np.int64) for marks in (docs, target)
                ]
                yield pa.RecordBatch.from_pydict(_rows(ASKED, list(_asked(piece.number, piece.codes, counts, buckets))))

    return ask


def _summer(columns: int):
    """Of the rows of a bucket: for each, its keys' sums over all rows, and which keys it owns."""

    def summed(table: pa.Table) -> pa.Table:
        asked = table.select(["piece", "bucket", "keys", "counts"]).to_pylist()
        keys = [np.cumsum(_unpacked(r["keys"], np.uint64)) for r in asked]
        counts = [_unpacked(r["counts"]).reshape(columns, -1) for r in asked]
        _, first, of = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        counts = np.concatenate(counts, axis=1)
        sums = np.zeros((columns, len(first)), np.int64)
        for k in range(columns):
            sums[k] = np.bincount(of, counts[k], len(first))  # floats, exact below 2^53
        owned = np.zeros(len(of), np.int64)
        owned[first] = 1
        out, start = [], 0
        for row, own in zip(asked, keys):
            part = slice(start, start := start + len(own))
            got, mine = sums[:, of[part]], owned[part]
            bg, tg = (got[:2] * mine).sum(axis=1).tolist()
            kinds = int((mine * (got[0] + got[1] > 0)).sum())
            out.append((row["piece"], row["bucket"], _packed(np.concatenate([*got, mine])), kinds, bg, tg))
        return pa.table(_rows(SUMS, out))

    return summed


def _sums_of(rows: list[dict], columns: int) -> list[np.ndarray]:
    """What came back for the keys of a piece, in their order: the sums, then which are owned."""
    parts = [_unpacked(r["sums"]).reshape(columns + 1, -1) for r in sorted(rows, key=lambda r: r["bucket"])]
    return list(np.concatenate(parts, axis=1)) if parts else [np.zeros(0, np.int64)] * (columns + 1)


def _word_asker(buckets: int):
    def ask(pieces: pa.Table, sums: pa.Table) -> pa.Table:
        piece = Piece(pieces.to_pylist()[0])
        bg, tg, owned = _sums_of(sums.to_pylist(), 2)
        values = [
            np.bincount(at, n * owned, len(piece.words)).astype(np.int64)
            for at, n in (
                (piece.word, bg), (piece.word, tg), (piece.before, bg), (piece.before, tg), (piece.before, bg > 0), (piece.before, tg > 0)
            )
        ]
        return pa.table(_rows(ASKED, list(_asked(piece.number, piece.words, values, buckets))))

    return ask


SCORED = "doc_id long, n_words long, ce_target double, ce_background double"


def _scorer(totals: dict[str, int], symbols: int):
    def score(pieces: pa.Table, sums: pa.Table) -> pa.Table:
        piece, rows = Piece(pieces.to_pylist()[0]), sums.to_pylist()
        bigrams = _sums_of([r for r in rows if r["of"] == 2], 2)
        words = _sums_of([r for r in rows if r["of"] == 1], 6)
        some, ends = piece.sizes > 0, np.cumsum(piece.sizes)
        out = {}
        for k, model in enumerate(("bg", "tg")):
            single = (words[k] + 1) / (totals[model] + symbols)
            after, kinds = words[2 + k][piece.before], words[4 + k][piece.before]
            p = (bigrams[k] + kinds * single[piece.word]) / np.maximum(after + kinds, 1)
            loss = -np.log(np.where(after > 0, p, single[piece.word]))[piece.of]
            means = np.add.reduceat(loss, (ends - piece.sizes)[some]) / piece.sizes[some] if some.any() else []
            out[model] = np.full(len(some), np.nan)
            out[model][some] = means
        losses = {m: pa.array(x, pa.float64(), mask=~some) for m, x in out.items()}
        return pa.table({
            "doc_id": pa.array(piece.ids, pa.int64()), "n_words": pa.array(piece.sizes, pa.int64()),
            "ce_target": losses["tg"], "ce_background": losses["bg"],
        })

    return score


def _table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written; the shuffle files of its plan go as soon as it is, and not when the driver collects its garbage."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        return written(df, name)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)


def _scored(pieces: DataFrame, wanted: DataFrame | None, size: int | None) -> DataFrame:
    """``pieces`` are written. ``wanted``: piece and the doc_ids (wanted) of its target documents; ``size``: words told apart, if limited."""
    spark = pieces.sparkSession
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    marked = pieces.withColumn("wanted", F.lit(None).cast("array<long>")) if wanted is None else pieces.join(wanted, "piece", "left")

    def summed(asked: DataFrame, columns: int, name: str) -> DataFrame:
        return _table(asked.groupBy("bucket").applyInArrow(_summer(columns), SUMS), name)

    bigrams = summed(marked.mapInArrow(_bigram_asker(buckets), ASKED), 2, "bigrams")
    words = summed(pieces.groupBy("piece").cogroup(bigrams.groupBy("piece")).applyInArrow(_word_asker(buckets), ASKED), 6, "words")
    totals = words.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("kinds", "bg", "tg"))).first().asDict()
    symbols = (totals["kinds"] if size is None else size) + 2
    both = bigrams.withColumn("of", F.lit(2)).unionByName(words.withColumn("of", F.lit(1))).filter("piece > 0")
    own = pieces.filter("piece > 0").groupBy("piece").cogroup(both.groupBy("piece"))
    return own.applyInArrow(_scorer(totals, symbols), SCORED).withColumn("score", F.col("ce_target") - F.col("ce_background"))


def cross_entropy_difference(docs: DataFrame, target: DataFrame, size: int | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, ce_target, ce_background, score (all in nats a word).

    Both models are fitted on whole texts of all rows of their table. With ``size``, only so
    many most frequent words of ``docs`` are told apart, and every other word is one unknown
    word; such a list is broadcast. A null, empty or blank text has no words and null losses
    and score. Repeated rows count each time. Without target rows the target model is uniform
    over the vocabulary. Columns beside doc_id and text are ignored. An empty ``docs`` gives
    an empty result.
    """
    listed = None if size is None else vocabulary(docs, size)
    known = None if listed is None else docs.sparkSession.sparkContext.broadcast(listed)
    pieces = _table(_pieces(docs, known).unionByName(_pieces(target, known, -1)), "pieces")
    return _scored(pieces, None, None if listed is None else len(listed))


def difference_to_marked(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``cross_entropy_difference`` with the rows of ``docs`` whose doc_id is in ``ids`` as the target; joins ids, never texts."""
    pieces = _table(_pieces(docs, None), "pieces")
    held = pieces.select("piece", F.explode("ids").alias("doc_id"))
    wanted = held.join(ids.select("doc_id").hint("merge"), "doc_id", "left_semi")
    return _scored(pieces, wanted.groupBy("piece").agg(F.collect_set("doc_id").alias("wanted")), None)
