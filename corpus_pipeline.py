"""From raw documents to token files: toxic documents out, one of each group of near copies,
benchmark passages out, sources mixed to target weights, and what is left as shard files."""

import public_tokenizers

from downfold.llm import decontaminate, mixing, ngram_join, toxicity, wavelet
from downfold.llm.common import read_table, written

TOKENIZER = "byte_bpe_50k.json"


def without_toxic(spark, docs, sf_dir):
    """Documents that the calibrated trees score 0.7 or more go."""
    return toxicity.accepted(docs, read_table(spark, sf_dir, "labels"))


def without_near_copies(spark, docs, sf_dir):
    """Of each group linked by shingle Jaccard, the document with the smallest doc_id stays.

    Near copies here are five-word shingles at a similarity of 0.8.
    """
    return ngram_join.one_per_group(docs, size=5, percent=80)


def without_benchmark(spark, docs, sf_dir):
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


def mixed_sources(spark, docs, sf_dir):
    """Documents as often as the mix has them."""
    return mixing.mixture(docs)


def token_files(spark, docs, sf_dir):
    """Shard files, and the place and checksum of each document in them."""
    return wavelet.encoded(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("toxicity", without_toxic),
    ("near copies", without_near_copies),
    ("decontamination", without_benchmark),
    ("mixing", mixed_sources),
    ("token files", token_files),
]

#: Trees, calibration and byte-pair merges have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
