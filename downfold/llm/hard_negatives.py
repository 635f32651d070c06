"""Hard negatives from blocks of vectors in the order of a Hilbert curve.

1. Rows are sorted by label and by place on a Hilbert curve through the dimensions that vary
   most, cut into blocks, and written once. With each block stands its zone map: the least
   and greatest label, and the least and greatest entry in every dimension.
2. Anchors stand in the same order, in chunks. Of each chunk and zone map, interval
   arithmetic bounds the inner product of every anchor with every row of the block from
   below and from above. A block is read for a chunk if for one of its anchors the bounds
   meet one of the anchor's score windows and the labels do not rule it out.
3. Chosen blocks are streamed past the chunk's anchors, which keep the best rows of each
   window; a block whose bounds cannot better what an anchor has is passed over.

This is done twice. For positives an anchor has one window, from the score that rows of its
own block reach up. The positives' scores then give the windows of the negatives.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from downfold.llm.common import written

#: Rows in a block.
BLOCK = 1024
#: Anchors in a chunk, about; zone maps and rows that one task goes through for a chunk, about.
CHUNK, ZONES, ROWS = 4096, 4096, 1 << 16
#: The curve runs through the LEAD dimensions that vary most, with 2^BITS cells in each.
LEAD, BITS = 15, 4
#: Stands for no score; scores are smaller in size.
NONE = 1 << 62

BLOCKS = (
    "block long, id long, label long, vector array<int>, anchor boolean, reached long, "
    "n int, least_label long, greatest_label long, low array<int>, high array<int>"
)
STREAM = (
    "chunk int, slice int, kind int, block long, id long, label long, label2 long, "
    "v1 array<int>, v2 array<int>, tags array<long>, los array<long>, his array<long>"
)


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Vectors as rows of 64-bit integers; missing dimensions are 0."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(flat) == len(column) * dims:
        return flat.reshape(len(column), dims)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), dims), np.int64)
    out[np.arange(dims) < sizes[:, None]] = flat
    return out


def product(a: np.ndarray, b: np.ndarray, exact: type) -> np.ndarray:
    """Inner products of rows, in a type in which they are exact."""
    return (a.astype(exact) @ b.T.astype(exact)).astype(np.int64)


def bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray, exact: type) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each row of ``a`` with anything in each box."""
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    least = product(up, low, exact) + product(down, high, exact)
    return least, product(up, high, exact) + product(down, low, exact)


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of rows of cell numbers, by way of the transposed index (Skilling 2004)."""
    x = [cells[:, i].copy() for i in range(cells.shape[1])]
    for level in range(bits - 1, 0, -1):
        bit, below = 1 << level, (1 << level) - 1
        for i in range(len(x)):
            there = (x[i] & bit) != 0
            swap = np.where(there, 0, (x[0] ^ x[i]) & below)
            x[0] ^= np.where(there, below, swap)
            x[i] ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] & (1 << level), (1 << level) - 1, 0)
    place = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for values in x:
            place = place << 1 | ((values ^ turn) >> level & 1)
    return place


class Space:
    """Of all vectors: the number of dimensions, the leading ones with their ranges, the exact type.

    Only figures per dimension reach the driver.
    """

    def __init__(self, rows: DataFrame):
        entry = rows.select(F.posexplode("vector").alias("at", "x"))
        x = F.col("x").cast("double")
        found = entry.groupBy("at").agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.stddev_pop(x).alias("spread")).collect()
        self.dims = max((r["at"] for r in found), default=-1) + 1
        lead = sorted(found, key=lambda r: (-r["spread"], r["at"]))[:LEAD]
        self.lead = [(r["at"], r["lo"], r["hi"]) for r in lead]
        most = max((max(-r["lo"], r["hi"]) for r in found), default=0)
        self.exact = np.float64 if max(1, self.dims) * most * most < 1 << 52 else np.int64

    def places(self, vectors: np.ndarray) -> np.ndarray:
        if not self.lead:
            return np.zeros(len(vectors), np.int64)
        cells = [((vectors[:, at] - lo) << BITS) // (hi - lo + 1) for at, lo, hi in self.lead]
        return hilbert(np.stack(cells, 1), BITS)


def _placed(space: Space):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = space.places(matrix(batch.column("vector"), space.dims))
            yield batch.append_column("place", pa.array(places, pa.int64()))

    return place


def _cut(space: Space, positives: int, block: int):
    """Blocks of the sorted rows of a task, with zone maps on their first rows."""

    def block_of(number: int, rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        vectors = matrix(rows["vector"].chunk(0), space.dims)
        labels, ids = (rows[c].to_numpy() for c in ("label", "id"))
        asked = np.flatnonzero(rows["anchor"].to_numpy(zero_copy_only=False))
        reached = np.full(len(ids), -NONE)
        if len(ids) > positives:
            scores = product(vectors[asked], vectors, space.exact)
            scores[(labels[asked][:, None] != labels) | (ids[asked][:, None] == ids)] = -NONE
            reached[asked] = np.partition(scores, -positives, axis=1)[:, -positives]
        first = lambda value, kind: pa.array([value] + [None] * (len(ids) - 1), kind)
        edge = pa.list_(pa.int32())
        made = [
            pa.array(reached, pa.int64()), first(len(ids), pa.int32()), first(int(labels.min()), pa.int64()),
            first(int(labels.max()), pa.int64()), first(vectors.min(0).tolist(), edge), first(vectors.max(0).tolist(), edge),
        ]
        kept = [rows[c].chunk(0) for c in ("id", "label", "vector", "anchor")]
        names = [x.split()[0] for x in BLOCKS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([number] * len(ids), pa.int64()), *kept, *made], names=names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, number = None, 0
        for batch in batches:
            if number == 0 and rest is None and batch.num_rows:
                number = batch.column("part")[0].as_py() << 32
            rest = pa.concat_tables([x for x in (rest, pa.Table.from_batches([batch])) if x is not None])
            while rest.num_rows >= block:
                yield block_of(number, rest.slice(0, block))
                rest, number = rest.slice(block), number + 1
        if rest is not None and rest.num_rows:
            yield block_of(number, rest)

    return cut


class Anchors:
    """The anchors of a chunk, the windows of each, and the best rows of each window so far."""

    def __init__(self, rows: pa.Table, dims: int, exact: type, same: bool, k: int):
        rows = rows.combine_chunks()
        self.ids, self.labels = rows["id"].to_numpy(), rows["label"].to_numpy()
        self.vectors, self.exact, self.same, self.k = matrix(rows["v1"].chunk(0), dims), exact, same, k
        tags = rows["tags"].to_pylist()
        width = max(map(len, tags))
        fill = lambda lists, empty: np.array([[*x, *[empty] * (width - len(x))] for x in lists], np.int64)
        # a window that an anchor does not have is empty
        self.tags, self.lo, self.hi = fill(tags, 0), fill(rows["los"].to_pylist(), NONE), fill(rows["his"].to_pylist(), -NONE)
        self.scores = np.full((len(tags), width, k), -NONE)
        self.found = np.full((len(tags), width, k), NONE)

    def needs(self, low: np.ndarray, high: np.ndarray, least_label: np.ndarray, greatest_label: np.ndarray) -> np.ndarray:
        """Whether each anchor (down) must read each block (across)."""
        least, greatest = bounds(self.vectors, low, high, self.exact)
        own = self.labels[:, None]
        if self.same:
            fits = (least_label <= own) & (own <= greatest_label)
        else:
            fits = (least_label != own) | (greatest_label != own)
        meets = np.zeros_like(fits)
        for w in range(self.lo.shape[1]):
            # a row as good as the last kept one may still come before it by its id
            from_ = np.maximum(self.lo[:, w], self.scores[:, w, -1])[:, None]
            meets |= (greatest >= from_) & (least <= self.hi[:, w, None]) & (self.lo[:, w] <= self.hi[:, w])[:, None]
        return fits & meets

    def read(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        """One block, sorted by id here so that ties go to the smaller one."""
        zone = (vectors.min(0)[None], vectors.max(0)[None], labels.min()[None], labels.max()[None])
        asked = np.flatnonzero(self.needs(*zone)[:, 0])
        if not len(asked):
            return
        order = np.argsort(ids, kind="stable")
        ids, labels, vectors = ids[order], labels[order], vectors[order]
        for at in range(0, len(asked), 512):
            self._keep(asked[at : at + 512], ids, labels, vectors)

    def _keep(self, asked: np.ndarray, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        all_scores = product(self.vectors[asked], vectors, self.exact)
        alike = labels == self.labels[asked][:, None]
        fits = alike & (ids != self.ids[asked][:, None]) if self.same else ~alike
        for w in range(self.lo.shape[1]):
            inside = fits & (all_scores >= self.lo[asked, w, None]) & (all_scores <= self.hi[asked, w, None])
            scores = np.where(inside, all_scores, -NONE)
            better = np.flatnonzero((scores.max(1) >= self.scores[asked, w, -1]) & inside.any(1))
            if len(better):
                self._merge(asked[better], w, scores[better], ids)

    def _merge(self, rows: np.ndarray, w: int, scores: np.ndarray, ids: np.ndarray) -> None:
        k = min(self.k, scores.shape[1])
        least = np.partition(scores, -k, axis=1)[:, -k]
        down, across = np.nonzero((scores >= least[:, None]) & (scores > -NONE))
        order = np.lexsort((across, -scores[down, across], down))
        down, across = down[order], across[order]
        place = np.arange(len(down)) - np.searchsorted(down, down)
        down, across, place = (x[place < k] for x in (down, across, place))
        new_scores, new_ids = (np.full((len(rows), self.k), empty) for empty in (-NONE, NONE))
        new_scores[down, place], new_ids[down, place] = scores[down, across], ids[across]
        new_scores = np.concatenate([self.scores[rows, w], new_scores], 1)
        new_ids = np.concatenate([self.found[rows, w], new_ids], 1)
        order = np.lexsort((new_ids, -new_scores), axis=1)[:, : self.k]
        self.scores[rows, w] = np.take_along_axis(new_scores, order, 1)
        self.found[rows, w] = np.take_along_axis(new_ids, order, 1)

    def best(self) -> pa.RecordBatch:
        a, w, i = np.nonzero(self.scores > -NONE)
        columns = {"anchor_id": self.ids[a], "tag": self.tags[a, w], "id": self.found[a, w, i], "score": self.scores[a, w, i]}
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns.values()], names=list(columns))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, pa.Table]]:
    """The sorted rows of a task, as the anchors of a chunk (true), then its blocks one by one (false).

    Blocks of a chunk whose anchors have no window left are passed over.
    """
    rest, rest_key, chunk = None, None, None

    def ended():
        nonlocal chunk
        if rest_key[2] == 0:
            chunk = rest_key[:2]
        if chunk == rest_key[:2]:
            yield rest_key[2] == 0, rest

    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy() for c in ("chunk", "slice", "kind", "block")], 1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
        for start, end in zip([0, *cuts], [*cuts, len(keys)]):
            if start == end:
                continue
            piece, key = pa.Table.from_batches([batch.slice(start, end - start)]), tuple(keys[start])
            if rest is not None and key != rest_key:
                yield from ended()
                rest = None
            rest, rest_key = piece if rest is None else pa.concat_tables([rest, piece]), key
    if rest is not None:
        yield from ended()


def _chooser(space: Space, same: bool, k: int):
    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = None
        for starts, rows in _chunks(batches):
            if starts:
                anchors = Anchors(rows, space.dims, space.exact, same, k)
                continue
            rows = rows.combine_chunks()
            for at in range(0, rows.num_rows, 256):
                part = rows.slice(at, 256)
                low, high = (matrix(part[c].chunk(0), space.dims) for c in ("v1", "v2"))
                need = anchors.needs(low, high, part["label"].to_numpy(), part["label2"].to_numpy()).any(0)
                kept = part.filter(pa.array(need)).select(["chunk", "id"]).rename_columns(["chunk", "block"])
                yield from kept.to_batches()

    return choose


def _searcher(space: Space, same: bool, k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = None
        for starts, rows in _chunks(batches):
            if starts:
                if anchors is not None:
                    yield anchors.best()
                anchors = Anchors(rows, space.dims, space.exact, same, k)
            else:
                rows = rows.combine_chunks()
                anchors.read(rows["id"].to_numpy(), rows["label"].to_numpy(), matrix(rows["v1"].chunk(0), space.dims))
        if anchors is not None:
            yield anchors.best()

    return search


def _stream(anchors: DataFrame, others: DataFrame, slices: int) -> DataFrame:
    """Anchors of a chunk before ``others``, in each of ``slices`` parts of the others."""
    names = [x.split()[0] for x in STREAM.split(", ")]
    part = F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice")
    edge, longs, none = F.lit(None).cast("array<int>"), F.lit(None).cast("array<long>"), F.lit(None).cast("long")
    first = anchors.select("*", part).select(
        "chunk", "slice", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("block"), "id", "label", none.alias("label2"),
        F.col("vector").alias("v1"), edge.alias("v2"), "tags", "los", "his",
    )
    then = others.withColumns({"slice": F.pmod(F.hash("block"), slices), "kind": F.lit(1)})
    then = then.withColumns({"tags": longs, "los": longs, "his": longs}).select(*names)
    return first.unionByName(then).repartition("chunk", "slice").sortWithinPartitions("chunk", "slice", "kind", "block", "id")


def _best(anchors: DataFrame, blocks: DataFrame, zones: DataFrame, space: Space, sizes: dict, same: bool, k: int) -> DataFrame:
    """(anchor_id, tag, id, score, rank): the ``k`` best rows of each window of ``anchors``."""
    chunk = F.explode(F.sequence(F.lit(0), F.lit(sizes["chunks"] - 1))).alias("chunk")
    maps = zones.select(
        chunk, F.col("block").alias("id"), F.lit(0).cast("long").alias("zero"), "block", F.col("least_label").alias("label"),
        F.col("greatest_label").alias("label2"), F.col("low").alias("v1"), F.col("high").alias("v2"),
    )
    slices = -(-sizes["blocks"] // ZONES)
    # zone maps of a chunk need not come one by one: they share a block number
    asked = _stream(anchors, maps.withColumn("block", F.pmod(F.hash("block"), slices).cast("long")), slices)
    chosen = asked.mapInArrow(_chooser(space, same, k), "chunk int, block long")
    rows = blocks.select("block", "id", "label", F.col("vector").alias("v1")).join(chosen, "block")
    rows = rows.withColumns({"label2": F.lit(None).cast("long"), "v2": F.lit(None).cast("array<int>")})
    tasks = min(-(-sizes["rows"] // ROWS) * 4, 4 * sizes["partitions"])
    found = _stream(anchors, rows, max(1, tasks // sizes["chunks"])).mapInArrow(
        _searcher(space, same, k), "anchor_id long, tag long, id long, score long"
    )
    order = Window.partitionBy("anchor_id", "tag").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _share(score: str, percent: int, up: bool) -> Column:
    """``percent`` hundredths of ``score``, rounded up or down; hundreds first, so nothing leaves the range of a long."""
    part = f"pmod({score}, 100)"
    return F.expr(f"({score} - {part}) div 100 * {percent} + ({part} * {percent} + {99 if up else 0}) div 100")


def ordered_blocks(rows: DataFrame, anchor: Column, positives: int = 5, block: int = BLOCK) -> tuple[DataFrame, Space]:
    """The written table of blocks: ``rows`` (id, label, vector), where ``anchor`` says which are anchors.

    Rows are those with an id, a label and a vector. Of rows with one id, the one with the
    smallest label, then vector, is taken. On the first row of a block stand its number of
    rows ``n`` and zone map; ``reached`` is a score that so many positives of an anchor reach.
    """
    rows = rows.select("id", "label", "vector", F.coalesce(anchor, F.lit(False)).alias("anchor"))
    one = F.min(F.struct("label", "vector", "anchor"))
    rows = rows.groupBy("id").agg(one.alias("row")).select("id", "row.*")
    space = Space(rows)
    schema = "id long, label long, vector array<int>, anchor boolean, place long"
    placed = rows.mapInArrow(_placed(space), schema).repartitionByRange("label", "place", "id")
    placed = placed.sortWithinPartitions("label", "place", "id").withColumn("part", F.spark_partition_id())
    return written(placed.mapInArrow(_cut(space, positives, block), BLOCKS), "blocks"), space


def mine(
    rows: DataFrame,
    anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    block: int = BLOCK,
    chunk: int = CHUNK,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows`` has id, label (integers) and vector (an array of integers). The score of two
    rows is their inner product; higher comes first, of ties the smaller id. ``anchor`` marks
    anchors. Positives are an anchor's first other rows of its label; negatives, for each
    positive, the first rows of another label with a score of ``low`` to ``high`` percent of
    the positive's.

    Rows with a null id, label, vector or entry take no part, nor do entries so large that
    an inner product could leave the range of a long. Shorter vectors have 0 in the missing
    dimensions; an empty vector scores 0 with all. Of repeated ids one row counts (see
    ``ordered_blocks``). Other columns are left out. Without anchors, positives or rows in a
    window there are no rows for them; an empty table gives an empty result.
    """
    vector, size = F.col("vector"), F.greatest(F.size("vector"), F.lit(1))
    fits = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.least(F.lit(2**31 - 1), F.floor(F.sqrt(F.lit(2.0**61) / size)))))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & vector.isNotNull() & fits)
    vector = vector.cast("array<int>").alias("vector")
    rows = rows.select(F.col("id").cast("long"), F.col("label").cast("long"), vector, F.coalesce(anchor, F.lit(False)).alias("anchor"))
    blocks, space = ordered_blocks(rows, F.col("anchor"), positives, block)
    zones = blocks.filter(F.col("n").isNotNull())
    sizes = zones.agg(F.count("*").alias("blocks"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).first().asDict()
    anchors = blocks.filter("anchor")
    count = anchors.count()
    empty = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not count:
        return rows.sparkSession.createDataFrame([], empty)
    sizes["partitions"] = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sizes["chunks"] = -(-count // chunk)
    edges = [i / sizes["chunks"] for i in range(1, sizes["chunks"])]
    cuts = anchors.agg(F.percentile_approx("block", edges, 100 * sizes["chunks"])).first()[0] if edges else []
    before = F.filter(F.array(*[F.lit(c).cast("long") for c in cuts]), lambda c: c < F.col("block"))
    anchors = anchors.select((F.size(before) if cuts else F.lit(0)).alias("chunk"), "id", "label", "vector", "reached")

    one = lambda c: F.array(c.cast("long"))
    asking = anchors.select("*", one(F.lit(0)).alias("tags"), one(F.col("reached")).alias("los"), one(F.lit(NONE)).alias("his"))
    best = _best(asking, blocks, zones, space, sizes, True, positives)
    best = written(best.select("anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    windows = best.select(
        F.col("anchor_id").alias("id"), "positive_id",
        _share("positive_score", low, True).alias("lo"), _share("positive_score", high, False).alias("hi"),
    )
    windows = windows.filter(F.col("lo") <= F.col("hi")).groupBy("id").agg(F.collect_list(F.struct("positive_id", "lo", "hi")).alias("w"))
    windows = windows.select("id", F.col("w.positive_id").alias("tags"), F.col("w.lo").alias("los"), F.col("w.hi").alias("his"))
    found = _best(anchors.drop("reached").join(windows, "id"), blocks, zones, space, sizes, False, negatives)
    found = found.select("anchor_id", F.col("tag").alias("positive_id"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return found.join(best, ["anchor_id", "positive_id"]).select(*[x.split()[0] for x in empty.split(", ")])
