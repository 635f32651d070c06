"""Each stage against brute force on its own input."""

from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from downfold.llm import mixing, toxicity
from downfold.llm.common import read_table, written
from llm import test_decontaminate, test_ngram_join, test_tokens
from llm.texts import rows, table

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """Name -> (input, output) of each stage, as ``run`` chains them."""
    docs, out = read_table(spark, SF_DIR, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = written(stage(spark, docs, SF_DIR), "stage")
        out[name] = (docs, after)
        docs = after
    return out


def test_order_and_columns(steps):
    assert list(steps) == ["toxicity", "near copies", "decontamination", "mixing", "token files"]
    for before, after in list(steps.values())[:-1]:
        assert after.columns == before.columns and after.count() > 0


def test_toxic_documents_go_and_others_stay(spark, steps):
    before, after = steps["toxicity"]
    score = toxicity.toxicity(before, read_table(spark, SF_DIR, "labels"))
    gone = {r.doc_id for r in score.collect() if r.predicted}
    assert rows(after) == sorted((tuple(r) for r in before.collect() if r.doc_id not in gone), key=repr)


def test_one_of_each_group_of_near_copies(steps):
    before, after = steps["near copies"]
    groups = test_ngram_join.brute([(r.doc_id, r.text) for r in before.collect()], 5, 80)
    assert sorted(r.doc_id for r in after.collect()) == sorted(d for d, n, head, _ in groups if not n or d == head)


def test_benchmark_documents_go(spark, steps):
    before, after = steps["decontamination"]
    items = [(r.item_id, r.text) for r in table(spark, "0.001", "benchmark").collect()]
    found = test_decontaminate.brute([(r.doc_id, r.text) for r in before.collect()], items)
    assert sorted(r.doc_id for r in after.collect()) == sorted(f[0] for f in found if not f[5])


def test_mix_has_the_copies_of_its_plan(steps):
    before, after = steps["mixing"]
    plan = {r.doc_id: r.copies for r in mixing.mixed(before).collect()}
    assert Counter(r.doc_id for r in after.collect()) == Counter({d: n for d, n in plan.items() if n})


def test_token_files_hold_the_mix(steps):
    before, after = steps["token files"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    given = [(r.doc_id, r.text) for r in before.collect()]
    plain = lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids
    assert rows(after) == test_tokens.brute_shards(given, plain)


def test_run_of_an_empty_table(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        table(spark, "0.001", name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert rows(corpus_pipeline.run(spark, str(tmp_path))) == []
