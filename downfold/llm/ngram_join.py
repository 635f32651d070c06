"""N-gram Jaccard join by rare-first prefix filtering, with links taken between classes of texts.

1. Equal texts are merged. Each text becomes its set of hashed word shingles, in chunks of
   bounded size; a chunk sends every distinct shingle once to the bucket of its hash, which
   sees how many chunks hold it. Only shingles of at least two texts come back. A text can
   have a partner only if these make up the wanted share of its set, so most texts end here.
2. What is left of a set after dropping shingles no other text has decides all overlaps.
   Texts that agree in it and in the size of the set form a class: its members have the same
   overlap with any other text, and one overlap among themselves. Near copies that differ in
   a word fall into few classes, however many copies there are.
3. Classes are joined on the rarest part of their sets (the prefix that no pair above the
   threshold can avoid sharing), filtered by length, by the positions of the shared shingle
   and by counts per range of shingles (the suffix filter), and verified once per pair.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from downfold.llm.common import md5_halves, written
from downfold.llm.components import components

SHINGLE = 4
PERCENT = 85
#: A chunk ends at so many texts or shingles; a bucket is meant to get so many shingles.
CHUNK_TEXTS = 32_768
CHUNK_SHINGLES = 1_000_000
BUCKET_SHINGLES = 1_000_000
#: Ranges of shingles counted for the suffix filter.
RANGES = 128
#: Classes of one shingle that are ordered together.
SLICE_CLASSES = 8_192
#: Bits of a shingle's hash that are kept besides its bucket.
REST_BITS = 40
#: Places of the bitmap of texts that do not simply stay: 2 MB at most, whatever the table.
MARK_PLACES = 1 << 24
#: Words remembered with their hash by a task.
WORDS_KEPT = 500_000

PACKED = "k long, chunk long, kind byte, p1 binary, p2 binary, p3 binary"
SETS = "t1 long, t2 long, n long, tokens array<long>, ranges array<short>"
BUCKET, LOCAL, META = 0, 1, 2
HELD_BY_MANY = 0xFFFF

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def shingle_set(text: bytes | None, words: WordHashes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of ``text``; of all its words if these are fewer."""
    parts = text.lower().split() if text else []
    if not parts:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(words.__getitem__, parts), np.uint64, len(parts))
    reach = min(size, len(parts))
    mixed = np.full(len(parts) - reach + 1, reach, np.uint64)
    for i in range(reach):
        mixed = mixed * _MULTIPLIER + hashes[i : len(hashes) - reach + 1 + i]
    mixed ^= mixed >> np.uint64(32)
    mixed *= _MULTIPLIER
    mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


class _Chunk:
    """Texts whose shingles are sent together."""

    def __init__(self, number: int, bits: int):
        self.number, self.bits = number, bits
        self.names: list[tuple[int, int]] = []
        self.sets: list[np.ndarray] = []
        self.held = 0

    def add(self, t1: int, t2: int, shingles: np.ndarray) -> bool:
        self.names.append((t1, t2))
        self.sets.append(shingles)
        self.held += len(shingles)
        return len(self.sets) >= CHUNK_TEXTS or self.held >= CHUNK_SHINGLES

    def rows(self) -> pa.RecordBatch:
        sizes = np.array([len(s) for s in self.sets], np.uint32)
        tokens = np.concatenate(self.sets) >> np.uint64(64 - self.bits - REST_BITS)
        owner = np.repeat(np.arange(len(self.sets), dtype=np.uint16), sizes)
        order = np.argsort(tokens, kind="stable")
        tokens, owner = tokens[order], owner[order]
        first = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]]) if len(tokens) else np.empty(0, np.int64)
        runs = np.diff(np.r_[first, len(tokens)])
        shared = np.repeat(runs > 1, runs)
        sent, who = tokens[first], np.where(runs > 1, HELD_BY_MANY, owner[first]).astype(np.uint16)
        bucket = (sent >> np.uint64(REST_BITS)).astype(np.int64)
        rest = sent & np.uint64((1 << REST_BITS) - 1)
        low, high = (rest & np.uint64(0xFFFFFFFF)).astype(np.uint32), (rest >> np.uint64(32)).astype(np.uint8)
        cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.empty(0, np.int64)
        ends = np.r_[cuts[1:], len(bucket)] if len(cuts) else cuts
        names = np.array(self.names, np.int64).reshape(-1, 2)
        own = -1 - self.number
        k = [int(bucket[c]) for c in cuts] + [own, own]
        p1 = [low[a:b].tobytes() for a, b in zip(cuts, ends)] + [tokens[shared].tobytes(), names[:, 0].tobytes()]
        p2 = [high[a:b].tobytes() for a, b in zip(cuts, ends)] + [owner[shared].tobytes(), names[:, 1].tobytes()]
        p3 = [who[a:b].tobytes() for a, b in zip(cuts, ends)] + [b"", sizes.tobytes()]
        return _packed(k, [self.number] * len(k), [BUCKET] * len(cuts) + [LOCAL, META], p1, p2, p3)


def _packed(k, chunk, kind, p1, p2, p3) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.int8(), pa.binary(), pa.binary(), pa.binary())
    arrays = [pa.array(values, t) for values, t in zip((k, chunk, kind, p1, p2, p3), types)]
    return pa.RecordBatch.from_arrays(arrays, names=["k", "chunk", "kind", "p1", "p2", "p3"])


def _sender(bits: int, size: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, made = WordHashes(), 0
        base = TaskContext.get().partitionId() << 24
        chunk = _Chunk(base, bits)
        for batch in batches:
            for t1, t2, text in zip(*(batch.column(i) for i in range(3))):
                if chunk.add(t1.as_py(), t2.as_py(), shingle_set(text.as_py(), words, size)):
                    yield chunk.rows()
                    made += 1
                    chunk = _Chunk(base + made, bits)
        if chunk.sets:
            yield chunk.rows()

    return send


def _joined(column: pa.ChunkedArray, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype)


def _found_again(table: pa.Table) -> pa.Table:
    """A bucket: for each chunk, the shingles of single texts that another chunk also sent. Other rows pass."""
    if table.column("k")[0].as_py() < 0:
        return table
    low, high = _joined(table.column("p1"), np.uint32), _joined(table.column("p2"), np.uint8)
    who = _joined(table.column("p3"), np.uint16)
    rest = (high.astype(np.uint64) << np.uint64(32)) | low
    lengths = np.array([len(x) // 4 for x in table.column("p1").to_pylist()])
    at = np.repeat(np.arange(len(lengths)), lengths)
    order = np.argsort(rest, kind="stable")
    ordered = rest[order]
    same = ordered[1:] == ordered[:-1]
    again = np.r_[False, same] | np.r_[same, False]
    back = np.sort(order[again])
    back = back[who[back] != HELD_BY_MANY]
    tokens = (np.uint64(table.column("k")[0].as_py()) << np.uint64(REST_BITS)) | rest[back]
    chunks = table.column("chunk").to_pylist()
    out = ([], [], [], [])
    rows = at[back]
    cuts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]]) if len(rows) else []
    for a, b in zip(cuts, [*cuts[1:], len(rows)]):
        out[0].append(chunks[rows[a]])
        out[1].append(tokens[a:b].tobytes())
        out[2].append(who[back[a:b]].tobytes())
    n = len(out[0])
    return pa.Table.from_batches([_packed([0] * n, out[0], [LOCAL] * n, out[1], out[2], [b""] * n)])


def _gather(percent: int):
    def gather(table: pa.Table) -> pa.Table:
        """A chunk: the sets of its texts, with shared shingles where they suffice for a link."""
        kinds = table.column("kind").to_numpy()
        local = table.filter(pa.array(kinds == LOCAL))
        meta = table.filter(pa.array(kinds == META))
        t1, t2 = _joined(meta.column("p1"), np.int64), _joined(meta.column("p2"), np.int64)
        sizes = _joined(meta.column("p3"), np.uint32).astype(np.int64)
        tokens, owner = _joined(local.column("p1"), np.uint64), _joined(local.column("p2"), np.uint16)
        order = np.lexsort((tokens, owner))
        tokens, owner = tokens[order].astype(np.int64), owner[order]
        edges = np.searchsorted(owner, np.arange(len(sizes) + 1))
        sets, ranges = [], []
        for i, n in enumerate(sizes):
            own = tokens[edges[i] : edges[i + 1]]
            if n and 100 * len(own) >= percent * n:
                sets.append(own)
                ranges.append(np.bincount(own % RANGES, minlength=RANGES).clip(max=32767).astype(np.int16))
            else:
                sets.append(None)
                ranges.append(None)
        return pa.table(
            [
                pa.array(t1),
                pa.array(t2),
                pa.array(sizes),
                pa.array(sets, pa.list_(pa.int64())),
                pa.array(ranges, pa.list_(pa.int16())),
            ],
            names=["t1", "t2", "n", "tokens", "ranges"],
        )

    return gather


def shared_sets(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per distinct text: (t1, t2, n, tokens, ranges), tokens where the text may have a partner."""
    texts = docs.select(*md5_halves(F.col("text")), F.coalesce("text", F.lit("")).cast("binary").alias("text")).distinct()
    held = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # shingles are about as many as words, and these about 6 bytes long
    bits = max(5, int(held / 6 / BUCKET_SHINGLES).bit_length())
    sent = texts.sortWithinPartitions("t1", "t2").mapInArrow(_sender(bits, size), PACKED)
    back = sent.groupBy("k").applyInArrow(_found_again, PACKED)
    return written(back.groupBy("chunk").applyInArrow(_gather(percent), SETS), "sets")


def _alone() -> Column:
    """Shingles of a class that no other text has."""
    return (F.col("n") - F.size("tokens")).alias("alone")


def prefix_rows(classes: DataFrame, percent: int = PERCENT, ranges: bool = True) -> DataFrame:
    """The rarest shingles of each class, which no pair above the threshold can avoid sharing, with what filters
    need; without ``ranges`` the suffix filter is left to be made on the candidates."""
    also = ["ranges"] if ranges else []
    held = classes.select("cid", "n", F.explode("tokens").alias("token"))
    df = held.groupBy("token").agg(F.count("*").alias("df")).filter(F.col("df") > 1)
    own = Window.partitionBy("cid")
    placed = (
        held.join(df, "token")
        .withColumn("kept", F.count("*").over(own))
        .filter(F.col("kept") * 100 >= F.col("n") * percent)
        # shingles that no other class has come first; they need no rows
        .withColumn("pos", F.col("n") - F.col("kept") + F.row_number().over(own.orderBy("df", "token")) - 1)
        .filter(F.col("pos") <= F.col("n") - F.ceil(F.col("n") * percent / 100))
        .select("token", "cid", "pos", "df")
        .join(classes.select("cid", "n", _alone(), *also), "cid")
    )
    return written(placed, "prefixes")


def _wanted(percent: int) -> Column:
    """Shingles that ``a`` and ``b`` have in common if they are linked, at least."""
    return F.expr(f"(({percent} * (a.n + b.n) + {99 + percent}) div {100 + percent})")


def _in_place(percent: int) -> Column:
    """Length and positional filters on the rows ``a`` and ``b`` of one shared shingle."""
    return (F.least("a.n", "b.n") * 100 >= F.greatest("a.n", "b.n") * percent) & (
        F.least(F.col("a.n") - F.col("a.pos"), F.col("b.n") - F.col("b.pos")) >= _wanted(percent)
    )


def _alike(percent: int) -> Column:
    """Suffix filter on the rows ``a`` and ``b`` of two classes."""
    apart = F.aggregate(
        F.zip_with("a.ranges", "b.ranges", lambda x, y: F.abs(x - y).cast("int")), F.lit(0), lambda total, x: total + x
    )
    return F.col("a.alone") + F.col("b.alone") + apart <= F.col("a.n") + F.col("b.n") - 2 * _wanted(percent)


def _may_link(percent: int) -> Column:
    """All filters on the rows ``a`` and ``b`` of one shared shingle."""
    return _in_place(percent) & _alike(percent)


def _verified(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The linked ones of distinct ``pairs`` (a, b) of classes."""
    sets = classes.select("cid", "n", "tokens")
    both = (
        pairs.join(sets.select(F.col("cid").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta")), "a")
        .join(sets.select(F.col("cid").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb")), "b")
        .withColumn("common", F.size(F.array_intersect("ta", "tb")))
    )
    return both.filter(F.col("common") * 100 >= (F.col("na") + F.col("nb") - F.col("common")) * percent).select("a", "b")


def class_links(classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b) for all linked pairs of ``classes`` (cid, n, tokens, ranges)."""
    prefixes = prefix_rows(classes, percent)
    a, b = prefixes.alias("a"), prefixes.alias("b")
    candidates = a.join(b, (F.col("a.token") == F.col("b.token")) & (F.col("a.cid") < F.col("b.cid")) & _may_link(percent))
    return _verified(candidates.select(F.col("a.cid").alias("a"), F.col("b.cid").alias("b")).distinct(), classes, percent)


def _ordered(x: Column, y: Column) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _near_pairs(prefixes: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Few candidates that join most of a group: each class with the one before it, and with the
    one that has the smallest share of shingles of its own, among the classes of a shingle.

    A shingle of many classes is cut into slices, differently for each shingle.
    """
    slices = F.ceil(F.col("df") / SLICE_CLASSES)
    along = Window.partitionBy("token", "slice").orderBy(F.col("alone") / F.col("n"), "cid")
    row = F.struct("cid", "n", "pos")
    seen = prefixes.withColumn("slice", F.pmod(F.xxhash64("cid", "token"), slices)).select(
        row.alias("a"), F.array(F.first(row).over(along), F.lag(row).over(along)).alias("partners")
    )
    found = seen.select("a", F.explode("partners").alias("b")).filter((F.col("a.cid") != F.col("b.cid")) & _in_place(percent))
    pairs = found.select(F.least("a.cid", "b.cid").alias("x"), F.greatest("a.cid", "b.cid").alias("y")).distinct()
    held = classes.select("cid", "n", _alone(), "ranges")
    both = pairs.join(held.alias("a"), F.col("a.cid") == F.col("x")).join(held.alias("b"), F.col("b.cid") == F.col("y"))
    return both.filter(_alike(percent)).select(F.col("x").alias("a"), F.col("y").alias("b"))


def class_components(classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(node, component) for every class linked with another, without listing the links in a group.

    A first round verifies few candidates for each class and contracts what they link. The
    prefix join that follows is exact but takes only classes of different components, and
    only shingles that classes of different components still share. Rows of shingles go
    without ranges until few are left.
    """
    prefixes = prefix_rows(classes, percent, ranges=False)
    first = components(written(_verified(_near_pairs(prefixes, classes, percent), classes, percent), "first-links"))
    marked = prefixes.join(first.withColumnRenamed("node", "cid"), "cid", "left").withColumn(
        "component", F.coalesce("component", "cid")
    )
    marked = written(marked, "marked")
    shared = marked.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    still = marked.join(shared.filter("low < high").select("token"), "token", "left_semi")
    still = written(still.join(classes.select("cid", "ranges"), "cid"), "open")
    a, b = still.alias("a"), still.alias("b")
    apart = a.join(
        b, (F.col("a.token") == F.col("b.token")) & (F.col("a.component") < F.col("b.component")) & _may_link(percent)
    )
    # few are left, so their table is known to be small before any set is moved
    pairs = written(apart.select(*_ordered(F.col("a.cid"), F.col("b.cid"))).distinct(), "pairs")
    more = _verified(pairs, classes, percent)
    stars = first.select(*_ordered(F.col("node"), F.col("component")))
    return components(written(stars.unionByName(more), "all-links"))


def _classes(sets: DataFrame) -> tuple[Column, DataFrame]:
    """The class of a text with tokens, and the written table of classes."""
    key = F.unhex(F.md5(F.concat_ws(",", "n", F.col("tokens").cast("array<string>")).cast("binary")))
    classes = (
        sets.filter(F.col("tokens").isNotNull())
        .withColumn("cid", key)
        .groupBy("cid", "n")
        .agg(F.first("tokens").alias("tokens"), F.first("ranges").alias("ranges"))
    )
    return F.when(F.col("tokens").isNotNull(), key), written(classes, "classes")


def _inside(percent: int) -> Column:
    """Whether texts of one class are linked."""
    common = F.size("tokens")
    return common * 100 >= (F.col("n") * 2 - common) * percent


def group_rows(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, t1, t2 (the text's MD5), n, component (null without a set) and reached."""
    sets = shared_sets(docs, size, percent)
    rows = written(docs.select("doc_id", *md5_halves(F.col("text"))), "rows")
    copies = rows.groupBy("t1", "t2").agg(F.count("*").alias("copies"))
    cid, classes = _classes(sets)
    texts = written(sets.join(copies, ["t1", "t2"]).select("t1", "t2", "n", "copies", cid.alias("cid")), "texts")
    links = written(class_links(classes, percent), "class-links")
    weights = texts.filter(F.col("cid").isNotNull()).groupBy("cid").agg(F.sum("copies").alias("members"))
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    linked = (
        both.join(weights, F.col("b") == F.col("cid")).groupBy(F.col("a").alias("cid")).agg(F.sum("members").alias("outside"))
    )
    of_class = (
        classes.select("cid", _inside(percent).alias("inside"))
        .join(weights, "cid")
        .join(linked, "cid", "left")
        .join(components(links).withColumnRenamed("node", "cid"), "cid", "left")
        .withColumn("component", F.coalesce("component", F.when(F.col("inside"), F.col("cid"))))
    )
    own = F.concat_ws("/", "t1", "t2")
    grouped = texts.join(of_class, "cid", "left").select(
        "t1",
        "t2",
        "n",
        F.coalesce("component", F.when(F.col("n") > 0, own)).alias("component"),
        (
            F.col("copies")
            - 1
            + F.coalesce(F.when(F.col("inside"), F.col("members") - F.col("copies")), F.lit(0))
            + F.coalesce("outside", F.lit(0))
        ).alias("reached"),
    )
    return written(rows.join(grouped, ["t1", "t2"]), "placed")


def text_components(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(t1, t2, component) of each distinct text with a set; links are not counted."""
    sets = shared_sets(docs, size, percent)
    cid, classes = _classes(sets)
    found = class_components(classes, percent).withColumnRenamed("node", "cid")
    of_class = classes.select("cid", _inside(percent).alias("inside")).join(found, "cid", "left")
    of_class = of_class.select("cid", F.coalesce("component", F.when(F.col("inside"), F.col("cid"))).alias("component"))
    texts = sets.filter(F.col("n") > 0).select("t1", "t2", cid.alias("cid")).join(of_class, "cid", "left")
    own = F.concat_ws("/", "t1", "t2").cast("binary")
    return texts.select("t1", "t2", F.coalesce("component", own).alias("component"))


def jaccard_groups(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, n_links.

    Two rows link when their sets of ``size``-word shingles share ``percent`` hundredths of
    their union; words are what white space parts, with A-Z in lower case, and a text of
    fewer words is one shingle. A null, empty or blank text has no set and links with
    nothing. component_id is the smallest doc_id reachable by links (null doc_ids are
    passed over; a row that reaches none has null), n_links the number of rows linked with
    the row. Rows that repeat a doc_id are rows like others. Columns beside doc_id and text
    are ignored. An empty table gives an empty result. Shingles are compared by at least 45
    bits of a hash.
    """
    placed = group_rows(docs, size, percent)
    heads = placed.filter(F.col("component").isNotNull()).groupBy("component").agg(F.min("doc_id").alias("head"))
    return placed.join(heads, "component", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("head")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(F.col("n") > 0, F.col("reached")).otherwise(F.lit(0)).cast("long").alias("n_links"),
    )


def _place(half: str) -> Column:
    return F.pmod(F.col(half), F.lit(MARK_PLACES)) + 1


def _maybe_told(whole: DataFrame, told: DataFrame) -> DataFrame:
    """``whole`` with ``asked``: whether the place of its text is marked by one in ``told``, from a bitmap of bounded size."""
    marks = told.groupBy(F.bitmap_bucket_number(_place("g1")).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(_place("g1"))).alias("bitmap")
    )
    at = F.bitmap_bit_position(_place("t1"))
    byte = F.conv(F.hex(F.substring("bitmap", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = whole.withColumn("bucket", F.bitmap_bucket_number(_place("t1"))).join(F.broadcast(marks), "bucket", "left")
    asked = F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))
    return found.withColumn("asked", asked).drop("bucket", "bitmap")


def one_per_group(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, with all their columns, that head their group: smallest doc_id, null last.

    Rows without a set all stay. Of rows with one that agree in doc_id and text one stays, the
    same in every run: the least by a hash of the other columns. An empty table gives an empty
    result. Texts of any length are taken whole: a text's set is one array of its shared
    shingles, eight bytes each. Extra columns keep their names and values.
    """
    texts = text_components(docs, size, percent)
    others = F.to_json(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]))
    names = [F.col("doc_id"), *md5_halves(F.col("text")), F.xxhash64(others).alias("order")]
    grouped = docs.select(*names).groupBy("t1", "t2", "doc_id", "order").agg(F.count("*").alias("alike"))
    grouped = grouped.groupBy("t1", "t2", "doc_id").agg(
        F.sum("alike").alias("rows"), F.min(F.struct("order", "alike")).alias("least")
    )
    grouped = written(grouped.join(texts, ["t1", "t2"]), "grouped")
    name = F.struct(F.col("doc_id").isNull(), "doc_id", "t1", "t2")
    heads = grouped.groupBy("component").agg(F.min(name).alias("head"))
    # most rows are alone in their group and stay; only the others are looked for among the texts
    told = grouped.join(heads, "component").select(
        F.col("doc_id").alias("g0"),
        F.col("t1").alias("g1"),
        F.col("t2").alias("g2"),
        F.when(name != F.col("head"), "gone").when(F.col("least.alike") > 1, "alike").when(F.col("rows") > 1, "repeated").alias("fate"),
        F.col("least.order").alias("least"),
    )
    told = written(told.filter(F.col("fate").isNotNull()), "told")
    packed = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    whole = _maybe_told(docs.select(packed.alias("whole"), *names), told)
    asked = whole.filter("asked")
    same = (F.col("t1") == F.col("g1")) & (F.col("t2") == F.col("g2")) & F.col("doc_id").eqNullSafe(F.col("g0"))
    other = F.col("order") != F.col("least")
    # only texts whose place is marked are moved; the others stay where they are
    kept = asked.join(told, same & ((F.col("fate") != "repeated") | other), "left_anti").select("whole")
    kept = whole.filter("NOT asked").select("whole").unionByName(kept)
    alike = told.filter("fate = 'alike'")
    if alike.isEmpty():
        return kept.select("whole.*")
    # rows with the same hash of all columns: only here are whole rows grouped
    one = asked.join(alike, same & ~other, "left_semi").groupBy("t1", "t2", "doc_id").agg(F.first("whole").alias("whole"))
    return kept.unionByName(one.select("whole")).select("whole.*")
