import re
from collections import Counter

import corpus_pipeline
import public_tokenizers
import pytest
from helpers import documents, prose
from test_chosen_path import brute as brute_classes
from test_source_mix import brute_targets, words

from protoclass.llm.quality_rules import judged
from protoclass.llm.token_files import Encoder

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
        out.append(docs)
    return out


def test_columns(stages):
    assert all(x.columns == stages[0].columns for x in stages[1:5])


def test_quality_stage_keeps_what_the_rules_keep(stages):
    want = sorted(r.doc_id for r in judged(stages[0]).filter("kept").collect())
    assert sorted(r.doc_id for r in stages[1].collect()) == want


def test_one_of_each_group_stays(stages):
    rows = [(r.doc_id, r.text) for r in stages[1].collect()]
    least = {}
    for d, c, _ in brute_classes(rows):
        least[c] = min(d, least.get(c, d))
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted(least.values())


def test_no_benchmark_item_is_left_whole(spark, stages):
    tokens = lambda t: " " + " ".join(re.findall(r"[^\W_]+", t.lower())) + " "
    items = [tokens(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before = {r.doc_id: tokens(r.text) for r in stages[2].collect()}
    after = {r.doc_id for r in stages[3].collect()}
    leaks = {d for d, t in before.items() if any(i in t for i in items)}
    assert leaks and not leaks & after and len(after) > 0.9 * len(before)


def test_mix_meets_its_targets(stages):
    sizes, taken, longest, texts = Counter(), Counter(), Counter(), {}
    for r in stages[3].collect():
        sizes[r.source] += words(r.text)
        longest[r.source] = max(longest[r.source], words(r.text))
        texts[r.doc_id] = r.text
    for r in stages[4].collect():
        taken[r.source] += words(r.text)
        assert r.text == texts[r.doc_id]
    for s, t in brute_targets(sizes).items():
        assert abs(taken[s] - t) <= longest[s] / 2 + 0.51


def test_token_files_hold_the_mix(stages):
    tokenizer = Encoder(public_tokenizers.path("byte_bpe_50k.json")).tokenizer
    want = Counter((r.doc_id, len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1) for r in stages[4].collect())
    got = stages[5].orderBy("start").collect()
    assert Counter((r.doc_id, r.n_tokens) for r in got) == want
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:i]) for i in range(len(got))][: len(got)]


def test_run_and_an_empty_table(spark, stages, workdir):
    assert corpus_pipeline.run(spark, SF).count() == stages[5].count()
    documents(spark, []).write.parquet(f"{workdir}/documents.parquet")
    spark.createDataFrame([(1, prose(1, 20))], "item_id bigint, text string").write.parquet(f"{workdir}/benchmark.parquet")
    assert corpus_pipeline.run(spark, workdir).count() == 0
