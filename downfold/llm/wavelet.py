"""Token ids in shard files that each hold a wavelet matrix.

A shard file is one row of a Parquet table, with one row to a file: the shard's place, its
number of tokens and ``file``, the bytes described at ``pack``. The matrix has one bit-plane
per bit of an id, highest first; below each plane the tokens stand sorted by its bits, zeros
first, in the order they had. Ranks in the planes give the token at a place, the occurrences
of a token before a place, and the place of an occurrence, without decoding the rest.
"""

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from downfold.llm.common import md5_halves, work_folder
from downfold.llm.encoding import encoder

END_ID = 2
#: A shard ends with the document that brings it to so many tokens, about 8 MB of planes.
SHARD_TOKENS = 1 << 22
#: Bits between stored ranks.
RANK_STEP = 512
MAGIC = b"WVM1"
SHARD = "part int, seq int, n_tokens long, file binary"


class Bits:
    """A bit-plane with ranks at every ``RANK_STEP`` bits."""

    def __init__(self, packed: np.ndarray, n: int):
        self.packed, self.n = packed, n
        ones = np.bitwise_count(packed).astype(np.int64)
        step = RANK_STEP // 8
        blocks = np.add.reduceat(ones, np.arange(0, len(ones), step)) if len(ones) else ones
        self.before = np.r_[0, np.cumsum(blocks)]
        self.zeros = n - int(self.before[-1])

    def get(self, i: int) -> int:
        return int(self.packed[i >> 3]) >> (i & 7) & 1

    def rank1(self, i: int) -> int:
        """Ones before place i."""
        block = i // RANK_STEP
        count = int(self.before[block])
        count += int(np.bitwise_count(self.packed[block * RANK_STEP // 8 : i >> 3]).sum())
        return count + (int(self.packed[i >> 3]) & ((1 << (i & 7)) - 1)).bit_count() if i & 7 else count

    def select(self, bit: int, k: int) -> int:
        """Place of the k-th (from 0) ``bit``."""
        at = np.arange(len(self.before)) * RANK_STEP
        held = self.before if bit else np.minimum(at, self.n) - self.before
        block = int(np.searchsorted(held, k, side="right")) - 1
        low = block * RANK_STEP
        bits = np.unpackbits(self.packed[low // 8 : (low + RANK_STEP) // 8], bitorder="little")[: self.n - low]
        return low + int(np.flatnonzero(bits == bit)[k - int(held[block])])


class WaveletMatrix:
    def __init__(self, planes: list[np.ndarray], n: int):
        self.n, self.planes = n, [Bits(p, n) for p in planes]

    @staticmethod
    def planes_of(ids: np.ndarray, width: int) -> list[np.ndarray]:
        planes, order = [], ids
        for level in range(width - 1, -1, -1):
            ones = (order & ids.dtype.type(1 << level)) != 0
            planes.append(np.packbits(ones, bitorder="little"))
            order = np.concatenate([order[~ones], order[ones]])
        return planes

    @classmethod
    def build(cls, ids: np.ndarray, width: int) -> "WaveletMatrix":
        return cls(cls.planes_of(ids, width), len(ids))

    def _levels(self):
        return zip(range(len(self.planes) - 1, -1, -1), self.planes)

    def access(self, i: int) -> int:
        """The token at place i."""
        value = 0
        for _, plane in self._levels():
            bit, ones = plane.get(i), plane.rank1(i)
            value = value << 1 | bit
            i = plane.zeros + ones if bit else i - ones
        return value

    def _range(self, token: int, low: int, high: int) -> tuple[int, int]:
        for level, plane in self._levels():
            a, b = plane.rank1(low), plane.rank1(high)
            low, high = (plane.zeros + a, plane.zeros + b) if token >> level & 1 else (low - a, high - b)
        return low, high

    def count(self, token: int, low: int = 0, high: int | None = None) -> int:
        """Occurrences of ``token`` at places low to high, high left out."""
        if token >> len(self.planes):
            return 0
        low, high = self._range(token, low, self.n if high is None else high)
        return high - low

    def select(self, token: int, k: int) -> int:
        """Place of the k-th (from 0) occurrence of ``token``."""
        if token >> len(self.planes) or not 0 <= k < self.count(token):
            raise IndexError(k)
        i = self._range(token, 0, 0)[0] + k
        for level in range(len(self.planes)):
            plane = self.planes[len(self.planes) - 1 - level]
            bit = token >> level & 1
            i = plane.select(bit, i - plane.zeros if bit else i)
        return i

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.count(token))]

    def decode(self) -> np.ndarray:
        """All tokens, from the last plane up."""
        order = np.zeros(self.n, np.uint16 if len(self.planes) <= 16 else np.uint32)
        for level, plane in enumerate(reversed(self.planes)):
            ones = np.unpackbits(plane.packed, count=self.n, bitorder="little").view(bool)
            above = np.empty_like(order)
            above[~ones] = order[: plane.zeros]
            above[ones] = order[plane.zeros :] | order.dtype.type(1 << level)
            order = above
        return order


def pack(ids: np.ndarray, width: int, names: list[int | None], ends: list[int]) -> bytes:
    """Magic, then little-endian 64-bit counts (tokens, planes, documents, bytes of each plane), the
    planes and last a table of doc_id, null flag and end of each document; planes and table
    are compressed one by one."""
    squeeze = zstandard.ZstdCompressor(level=1).compress
    planes = [squeeze(p.tobytes()) for p in WaveletMatrix.planes_of(ids, width)]
    table = np.array([[0 if d is None else d for d in names], [d is None for d in names], ends], "<i8")
    head = struct.pack(f"<3q{width}q", len(ids), width, len(names), *map(len, planes))
    return b"".join([MAGIC, head, *planes, squeeze(table.tobytes())])


class ShardFile:
    """A packed shard: ``matrix``, and ``names`` and ``ends`` of its documents."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a shard file")
        unsqueeze = zstandard.ZstdDecompressor().decompress
        n, width, docs = struct.unpack_from("<3q", data, 4)
        sizes = struct.unpack_from(f"<{width}q", data, 28)
        at, planes = 28 + 8 * width, []
        for size in sizes:
            planes.append(np.frombuffer(unsqueeze(data[at : at + size]), np.uint8))
            at += size
        table = np.frombuffer(unsqueeze(data[at:]), "<i8").reshape(3, docs)
        self.matrix = WaveletMatrix(planes, n)
        self.names = [None if null else int(d) for d, null in zip(table[0], table[1])]
        self.ends = table[2]


def _writer(path: str, end_id: int, shard_tokens: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, seq = encoder(path), TaskContext.get().partitionId(), 0
        width = max(encode.size - 1, end_id).bit_length()
        kind = np.dtype("<u2") if width <= 16 else np.dtype("<u4")
        end = np.array([end_id], kind)
        pieces, names, ends, held = [], [], [], 0

        def shard() -> pa.RecordBatch:
            data = pack(np.concatenate(pieces), width, names, ends)
            arrays = [pa.array([v], t) for v, t in ((part, pa.int32()), (seq, pa.int32()), (held, pa.int64()), (data, pa.binary()))]
            return pa.RecordBatch.from_arrays(arrays, names=["part", "seq", "n_tokens", "file"])

        for batch in batches:
            own = iter(batch.column(0).to_pylist())
            for ids, stops in encode.column(batch.column(1)):
                ids, at = ids.astype(kind, copy=False), 0
                for stop in stops.tolist():
                    pieces += [ids[at:stop], end]
                    held += stop - at + 1
                    at = stop
                    names.append(next(own))
                    ends.append(held)
                    if held >= shard_tokens:
                        yield shard()
                        pieces, names, ends, held, seq = [], [], [], 0, seq + 1
        if names:
            yield shard()

    return write


def write_shards(docs: DataFrame, folder: str, path: str, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode whole texts in ascending doc_id order (null first, equal ids by text) into shard files below ``folder``.

    Documents are dealt out by ranges of doc_id, so a part's number and a shard's number
    within it give the order of shards.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *md5_halves(F.col("text")))
    ordered = rows.repartitionByRange("doc_id", "t1", "t2").sortWithinPartitions("doc_id", "t1", "t2").select("doc_id", "text")
    shards = ordered.mapInArrow(_writer(path, end_id, shard_tokens), SHARD)
    shards.write.option("maxRecordsPerFile", 1).option("compression", "uncompressed").parquet(folder)


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, seq, data in zip(batch.column(0), batch.column(1), batch.column(2)):
            shard = ShardFile(data.as_py())
            ids = shard.matrix.decode().astype("<u4")
            starts = np.r_[0, shard.ends[:-1]]
            n = len(starts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part.as_py()] * n, pa.int32()),
                    pa.array([seq.as_py()] * n, pa.int32()),
                    pa.array(shard.names, pa.int64()),
                    pa.array(starts, pa.int64()),
                    pa.array(shard.ends - starts, pa.int64()),
                    pa.array([zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, shard.ends)], pa.int64()),
                ],
                names=["part", "seq", "doc_id", "within", "n_tokens", "ids_crc32"],
            )


def read_shards(spark, folder: str) -> DataFrame:
    return spark.read.schema(SHARD).parquet(folder)


def shard_documents(shards: DataFrame) -> DataFrame:
    """One row per document of ``shards``, decoded: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the tokens of all documents before it, over the shards in their order.
    """
    order = Window.orderBy("part", "seq")
    places = shards.select("part", "seq", (F.sum("n_tokens").over(order) - F.col("n_tokens")).alias("base"))
    kinds = "part int, seq int, doc_id long, within long, n_tokens long, ids_crc32 long"
    found = shards.select("part", "seq", "file").mapInArrow(_reader, kinds)
    return found.join(places, ["part", "seq"]).select(
        "doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32"
    )


def encoded(docs: DataFrame, path: str, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write ``docs`` as shard files in the shared folder and return ``shard_documents`` of them.

    A null or empty text is the end id alone. Rows that repeat a doc_id are documents of
    their own, ordered by text. Columns beside doc_id and text are ignored. An empty table
    writes no shard and gives an empty result.
    """
    folder = work_folder(docs.sparkSession, "shards")
    write_shards(docs, folder, path, end_id, shard_tokens)
    return shard_documents(read_shards(docs.sparkSession, folder))
