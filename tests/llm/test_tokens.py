import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from downfold.llm import encoding, token_counts, wavelet
from downfold.llm.encoding import Encoder
from llm.texts import documents, rows, table

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "\n\n a\n", "don't we'll 's 'S", "x\x1c y", "é à  ç", "1 2  33 4.5",
    "<|endoftext|> x", "a<|endoftext|>", "日本 語", "a  b", "²½ x²", "!!! ... (a) a,b c.", "\t \t", "Ünïcode ﬁ", "á b́",
    "🙂 🙂🙂 z", "x" * 3000,
]


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_tokenizer(spark, plain):
    encoder = Encoder(PATH)
    assert encoder.by_pieces
    texts = ODD + [r.text for r in table(spark, "0.001", "documents").collect()]
    for text in texts:
        assert encoder.ids(text).tolist() == plain(text), text[:200]


def test_encoder_of_another_kind():
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, tokenizer = Encoder(path), Tokenizer.from_file(path)
    assert not encoder.by_pieces
    for text in ODD:
        assert encoder.ids(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("n,width", [(0, 3), (1, 1), (7, 3), (512, 4), (5000, 5), (3000, 17)])
def test_wavelet_matrix_against_arrays(n, width):
    draw = np.random.default_rng(n)
    ids = draw.integers(0, 1 << width, n).astype(np.uint16 if width <= 16 else np.uint32)
    matrix = wavelet.WaveletMatrix.build(ids, width)
    assert matrix.decode().tolist() == ids.tolist()
    for i in draw.integers(0, n, min(n, 40)) if n else []:
        assert matrix.access(int(i)) == ids[i]
        low, high = sorted(int(x) for x in draw.integers(0, n + 1, 2))
        assert matrix.count(int(ids[i]), low, high) == (ids[low:high] == ids[i]).sum()
    for token in {int(t) for t in ids[:5]}:
        assert matrix.occurrences(token) == np.flatnonzero(ids == token).tolist()
    assert matrix.count(1 << width) == 0
    with pytest.raises(IndexError):
        matrix.select(0, n)


def test_shard_bytes_round_trip():
    ids = np.arange(1000, dtype=np.uint16)
    shard = wavelet.ShardFile(wavelet.pack(ids, 10, [7, None], [400, 1000]))
    assert shard.matrix.decode().tolist() == ids.tolist()
    assert (shard.names, shard.ends.tolist()) == ([7, None], [400, 1000])
    with pytest.raises(ValueError):
        wavelet.ShardFile(b"nope" + struct.pack("<q", 0))


def brute_shards(given, plain):
    at, out = 0, []
    for doc_id, text in sorted(given, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = plain(text) + [2]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return sorted(out, key=repr)


@pytest.mark.parametrize("shard_tokens", [1, 1000, 1 << 22])
def test_encoded_equals_brute_force(spark, plain, shard_tokens):
    docs = table(spark, "0.001", "documents")
    got = wavelet.encoded(docs, PATH, shard_tokens=shard_tokens)
    assert rows(got) == brute_shards([(r.doc_id, r.text) for r in docs.collect()], plain)


def test_encoded_edges(spark, plain):
    given = [(5, None), (3, ""), (9, "the end"), (None, "lost"), (4, "same"), (4, "same")]
    assert rows(wavelet.encoded(documents(spark, given, extra=True), PATH)) == brute_shards(given, plain)
    assert rows(wavelet.encoded(documents(spark, []), PATH)) == []


def test_one_file_per_shard(spark, tmp_path):
    docs = table(spark, "0.001", "documents")
    wavelet.write_shards(docs, str(tmp_path / "s"), PATH, shard_tokens=20_000)
    shards = wavelet.read_shards(spark, str(tmp_path / "s"))
    assert shards.count() == len(list((tmp_path / "s").glob("*.parquet"))) > 3


def test_lengths_equal_brute_force(spark, plain):
    given = [(r.doc_id, r.text, r.source) for r in table(spark, "0.001", "documents").collect()]
    given += [(None, None, None), (1, "", None), (1, "", None)]
    docs = documents(spark, given, extra=True)
    lengths = defaultdict(list)
    for _, text, source in given:
        lengths[source].append(len(plain(text)))
    sums = token_counts.token_lengths(docs, PATH).cache()
    expected = []
    for source, held in lengths.items():
        for n, count in Counter(held).items():
            longer = [x for x in held if x >= n]
            expected.append((source, n, count, len(longer), sum(longer), len(held), sum(held), sum(min(x, n) for x in held)))
    assert rows(sums) == sorted(expected, key=repr)
    limits = [0, 1, 100, 333, 10**6]
    assert rows(token_counts.at_limits(sums, limits)) == sorted(
        [(s, c, sum(x > c for x in held), sum(min(x, c) for x in held)) for s, held in lengths.items() for c in limits], key=repr
    )
    shares = [0.25, 0.5, 1.0]
    assert rows(token_counts.quantiles(sums, shares)) == sorted(
        [(s, q, min(n for n in held if sum(x <= n for x in held) >= q * len(held))) for s, held in lengths.items() for q in shares],
        key=repr,
    )


def test_lengths_of_nothing(spark):
    assert rows(token_counts.token_lengths(documents(spark, []), PATH)) == []


BLANKS = [
    "é à  ç\né", "x\n\ny", "x\n y", "x \ny", "a.\nb, c's d'll, (e) f;g", "“a” b — c… d", "a  b", "a  b", "　 c", "日本 語\nが", "a\u0085 b\n c",
    "x÷ y× z, ×. é. é, À!b", "🙂 🙂\n🙂", "a\x1c b", "a\x7f b", "\n", "a\n", "\na", "a᠎ b  c", "12, 3.4 a1, 1a.", "ª. µ, º!", " , a", "ô's, 's 'S's.",
]


def test_texts_together_equal_one_by_one(monkeypatch, plain):
    """Cut over bytes, each piece once a batch, unknown words many in a call, and few remembered."""
    draw = random.Random(3)
    words = ["".join(draw.choice("abcdeéÀßz") for _ in range(draw.randint(1, 9))) for _ in range(3000)]
    made = [draw.choice([" ", " ", " ", "\n", "  ", ", "]).join(draw.choices(words, k=200)) for _ in range(60)]
    every = "".join(draw.choice([" ", "\n", "a", "é", ",", "'s", "1", " ", "”", "\t", "語"]) for _ in range(4000))
    texts = [None, *ODD, *BLANKS, *made, every, None]
    for kept, size in ((500_000, 4 << 20), (50, 300)):
        monkeypatch.setattr(encoding, "PIECES_KEPT", kept)
        monkeypatch.setattr(encoding, "CUT_BYTES", size)
        encoder, got = Encoder(PATH), []
        assert encoder.at_once
        for ids, ends in encoder.column(pa.array(texts)):
            got += [part.tolist() for part in np.split(ids, ends[:-1])]
        assert got == [plain(t) for t in texts]
    assert list(encoder.column(pa.array([], pa.string()))) == []
    [(ids, ends)] = encoder.column(pa.array([None, ""], pa.string()))
    assert len(ids) == 0 and ends.tolist() == [0, 0]
