"""The hand-computed corpus of FIXTURES.md §3, stage by stage."""

from __future__ import annotations

import math

import pytest

from corpus_rows import make_docs
from protoclass.plans.pipeline import Config, run_pipeline

BASE = [
    (1, "TRAIN", "cocoa cocoa bean", ["cocoa"]),
    (2, "TRAIN", "cocoa price", ["cocoa"]),
    (3, "TRAIN", "gold price", ["gold"]),
    (4, "TEST", "cocoa bean the", ["cocoa", "tea"]),
]


@pytest.fixture(scope="module")
def run(spark):
    r = run_pipeline(make_docs(spark, BASE), Config())
    yield r
    r.close()


def test_document_frequency_and_corpus_size(run):
    assert run.model.n_docs == 4
    df = {r["term"]: (r["df"], r["q"]) for r in run.model.factors.collect()}
    assert df == {"cocoa": (3, 1), "bean": (2, 2), "price": (2, 2), "gold": (1, 4)}


def test_document_vectors(run):
    vec = run.model.weigh(run.prepared.term_freq()).select("doc_id", "term", "w").collect()
    got = {(r["doc_id"], r["term"]): r["w"] for r in vec}
    assert got == {(1, "cocoa"): 2, (1, "bean"): 2, (2, "cocoa"): 1, (2, "price"): 2,
                   (3, "gold"): 4, (3, "price"): 2, (4, "cocoa"): 1, (4, "bean"): 2}


def test_centroids(run):
    rows = run.model.centroids().collect()
    got = {(r["topic"], r["term"]): (r["sw"], r["n_train"], r["w"]) for r in rows}
    assert got == {("cocoa", "cocoa"): (3, 2, 1.5), ("cocoa", "bean"): (2, 2, 1.0),
                   ("cocoa", "price"): (2, 2, 1.0), ("gold", "gold"): (4, 1, 4.0),
                   ("gold", "price"): (2, 1, 2.0)}
    norms = {r["topic"]: int(r["n2"]) for r in run.model.topic_norms.collect()}
    assert norms == {"cocoa": 17, "gold": 20}


def test_similarity_and_prediction(run):
    sims = {(r["doc_id"], r["topic"]): r for r in run.scored.sims.collect()}
    assert set(sims) == {(4, "cocoa")}          # gold shares no term: implicit 0
    s = sims[(4, "cocoa")]
    assert s["sim"] == pytest.approx(7 / math.sqrt(85))
    assert s["cos_score"] == pytest.approx(math.cos(7 / math.sqrt(85)))
    (p,) = run.predictions.collect()
    assert (p["doc_id"], p["topic"], p["zero_overlap"], p["correct"]) == (4, "cocoa", False, True)


def test_evaluation(run):
    acc = run.accuracy().first()
    assert (acc["correct"], acc["incorrect"], acc["accuracy_pct"]) == (1, 0, 100.0)
    brief = {r["topic"]: r for r in run.evaluation(full=False).collect()}
    assert set(brief) == {"cocoa"}              # tea is test-only, gold has nothing
    c = brief["cocoa"]
    assert (c["precision"], c["recall"], c["f1"]) == (1.0, 1.0, 1.0)
    assert (c["literal_precision"], c["literal_recall"], c["literal_f1"]) == (0.0, 0.0, None)
    full = {r["topic"]: r for r in run.evaluation(full=True).collect()}
    assert set(full) == {"cocoa", "gold"}
    g = full["gold"]
    assert (g["retrieved"], g["relevant"], g["precision"], g["recall"]) == (0, 0, None, None)


def test_variant_a_zero_overlap(spark):
    rows = BASE + [(5, "TEST", "zinc", ["gold"])]
    r = run_pipeline(make_docs(spark, rows))
    try:
        assert r.model.n_docs == 5
        preds = {p["doc_id"]: p for p in r.predictions.collect()}
        z = preds[5]
        assert (z["topic"], z["sim"], z["zero_overlap"], z["correct"]) == ("cocoa", 0.0, True, False)
    finally:
        r.close()


def test_variant_b_no_tokens(spark):
    rows = BASE + [(6, "TEST", "the of", ["cocoa"])]
    r = run_pipeline(make_docs(spark, rows))
    try:
        assert r.model.n_docs == 4
        preds = {p["doc_id"]: p for p in r.predictions.collect()}
        n = preds[6]
        assert (n["topic"], n["sim"], n["correct"]) == (None, None, False)
        acc = r.accuracy().first()
        assert (acc["correct"], acc["incorrect"]) == (1, 1)
    finally:
        r.close()


def test_variant_c_tie_goes_to_smaller_name(spark):
    rows = [
        (1, "TRAIN", "apple pear", ["zeta"]),
        (2, "TRAIN", "apple pear", ["alpha"]),
        (3, "TEST", "apple", ["zeta"]),
    ]
    r = run_pipeline(make_docs(spark, rows))
    try:
        (p,) = r.predictions.collect()
        assert p["topic"] == "alpha" and p["correct"] is False
        ranks = {(x["topic"], x["rank"]) for x in r.ranking().collect()}
        assert ranks == {("alpha", 1), ("zeta", 2)}
        (m,) = r.true_topic_margin().collect()
        assert (m["best_true_topic"], m["best_true_rank"], m["margin"]) == ("zeta", 2, 0.0)
    finally:
        r.close()


def test_inexact_arithmetic_gives_same_predictions(spark):
    exact = run_pipeline(make_docs(spark, BASE), Config(exact=True))
    loose = run_pipeline(make_docs(spark, BASE), Config(exact=False))
    try:
        a = sorted((p["doc_id"], p["topic"]) for p in exact.predictions.collect())
        b = sorted((p["doc_id"], p["topic"]) for p in loose.predictions.collect())
        assert a == b
    finally:
        exact.close()
        loose.close()


def test_train_only_document_frequency(spark):
    r = run_pipeline(make_docs(spark, BASE), Config(df_scope="train"))
    try:
        assert r.model.n_docs == 3
        df = {x["term"]: x["df"] for x in r.model.factors.collect()}
        assert df == {"cocoa": 2, "bean": 1, "price": 2, "gold": 1}
        (p,) = r.predictions.collect()
        assert p["topic"] == "cocoa"
    finally:
        r.close()


def test_checkpointed_intermediates_give_same_results(spark):
    """``keep='checkpoint'`` writes shared intermediates to the session's
    checkpoint folder (cutting lineage) instead of caching them."""
    r = run_pipeline(make_docs(spark, BASE), Config(keep="checkpoint"))
    try:
        (p,) = r.predictions.collect()
        assert (p["doc_id"], p["topic"], p["correct"]) == (4, "cocoa", True)
        plan = r.prepared.doc_terms._jdf.queryExecution().optimizedPlan().toString()
        assert plan.strip().startswith("LogicalRDD")          # lineage cut at the checkpoint
    finally:
        r.close()


def test_top_k_ranking(spark):
    rows = [(1, "TRAIN", "apple pear", ["a"]), (2, "TRAIN", "apple plum", ["b"]),
            (3, "TRAIN", "apple fig", ["c"]), (4, "TEST", "apple pear plum", ["a"])]
    r = run_pipeline(make_docs(spark, rows))
    try:
        from protoclass.operators.scoring import rank_topics
        full = sorted((x["rank"], x["topic"]) for x in rank_topics(r.scored.sims).collect())
        top2 = sorted((x["rank"], x["topic"]) for x in rank_topics(r.scored.sims, k=2).collect())
        assert len(full) == 3 and top2 == full[:2]
    finally:
        r.close()


def test_nothing_kept_gives_same_results(spark):
    """``keep='none'``: every consumer recomputes from the source; the plans
    must stay linear (no optimiser inlining of per-element work)."""
    r = run_pipeline(make_docs(spark, BASE), Config(keep="none"))
    (p,) = r.predictions.collect()
    assert (p["doc_id"], p["topic"], p["correct"]) == (4, "cocoa", True)


def test_report_lines_exact(run):
    """H7 + B3 on the hand corpus: the reference's layout and its own
    (literal) numbers — 0/1 printed as 00.00, an undefined F1 as 'NaN '."""
    lines = [r["line"] for r in run.report().orderBy("line_no").collect()]
    assert lines == [
        "Recall\tPrecision\tF-measure\tTopic",
        "-------------------------------------------",
        "00.00\t00.00\t\tNaN \t\t> cocoa",
        "===========================================",
        "Overall accuracy: 100.00%",
    ]
    standard = [r["line"] for r in run.report(literal=False).orderBy("line_no").collect()]
    assert standard[2] == "01.00\t01.00\t\t01.00\t\t> cocoa"


def test_vector_text_sorts_without_a_comparator(spark):
    from protoclass.operators.weights import vector_text
    df = spark.createDataFrame([(1, {"b": 2, "a": 10, "\u00e9": 1}), (2, {})], "doc_id int, vector map<string, bigint>")
    out = df.select("doc_id", vector_text(df["vector"]).alias("t"))
    assert [r["t"] for r in out.orderBy("doc_id").collect()] == ["a=10;b=2;\u00e9=1", ""]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "sort_array(" in plan.replace("array_sort(", "")    # a comparator is interpreted for every pair
