"""Model save/load (B1/B2) and streaming classification against a model."""

from __future__ import annotations

import os

import pytest

from protoclass.plans.pipeline import Config, classify, classify_documents, run_pipeline
from protoclass.sources.model_store import load_model, save_model
from protoclass.sources.tables import corpus_view
from protoclass.streaming.scoring import classify_stream

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def run(spark):
    r = run_pipeline(corpus_view(spark, SF), Config())
    yield r
    r.close()


def _preds(df):
    return sorted((r["doc_id"], r["topic"], r["sim"], r["zero_overlap"], r["correct"]) for r in df.collect())


def test_saved_model_classifies_the_same(spark, run, workdir):
    path = os.path.join(workdir, "model")
    save_model(run.model, path)
    model = load_model(spark, path)
    assert (model.n_docs, model.n_topics, model.default_topic) == \
        (run.model.n_docs, run.model.n_topics, run.model.default_topic)
    _, preds = classify(model, run.prepared)
    assert _preds(preds) == _preds(run.predictions)
    model.close()


def test_stream_of_documents_is_classified_like_the_batch(spark, run, workdir):
    src = os.path.join(workdir, "incoming")
    docs = corpus_view(spark, SF)
    docs.repartition(3).write.parquet(src)
    stream = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 1).parquet(src)
    out = os.path.join(workdir, "out")
    q = classify_stream(run.model, stream, out, os.path.join(workdir, "ckpt"), trigger={"availableNow": True})
    q.awaitTermination(300)
    assert q.exception() is None
    got = spark.read.parquet(out)
    assert got.select("batch_id").distinct().count() == 3
    # every document that arrives gets a row, of whatever split and with or without a label
    assert got.count() == docs.count()
    known = run.predictions.select("doc_id")
    assert _preds(got.drop("batch_id").join(known, "doc_id", "left_semi")) == _preds(run.predictions)


def test_unlabelled_documents_get_a_row_and_no_verdict(spark, run):
    docs = corpus_view(spark, SF).drop("topics")
    preds, kept = classify_documents(run.model, docs)
    rows = preds.collect()
    assert len(rows) == docs.count() and {r["correct"] for r in rows} == {None}
    for df in kept:
        df.unpersist()


def test_a_stream_keeps_nothing_behind(spark, run, workdir):
    src = os.path.join(workdir, "many")
    docs = corpus_view(spark, SF).limit(60)
    docs.repartition(10).write.parquet(src)
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    stream = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = classify_stream(run.model, stream, os.path.join(workdir, "o"), os.path.join(workdir, "c"), trigger={"availableNow": True})
    q.awaitTermination(600)
    assert q.exception() is None
    assert spark.read.parquet(os.path.join(workdir, "o")).select("batch_id").distinct().count() == 10
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_a_model_keeps_its_settings(spark, run, workdir):
    path = os.path.join(workdir, "settings")
    run.model.config = Config(order=("file", "block", "seq"), rebalance=False, max_token_length=255)
    try:
        save_model(run.model, path)
    finally:
        run.model.config = Config()
    cfg = load_model(spark, path).config
    assert (cfg.order, cfg.rebalance, cfg.max_token_length) == (("file", "block", "seq"), False, 255)


def test_clustered_tables_join_without_an_exchange(spark, workdir):
    from protoclass.sources.corpus_store import read_clustered, register_clustered, write_clustered
    from protoclass.sources.tables import corpus_of_tables

    docs = spark.createDataFrame([(i, f"text {i}", "en", "s", 6) for i in range(200)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(0, 200, 3)], "doc_id bigint, quality int, toxic int")
    write_clustered(docs, "c_docs", workdir + "/docs", 6)
    write_clustered(labels, "c_labels", workdir + "/labels", 6)
    register_clustered(spark, "c_labels_again", workdir + "/labels", "doc_id bigint, quality int, toxic int", 6)
    want = sorted(tuple(r) for r in corpus_of_tables(docs, labels).collect())
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("c_labels", "c_labels_again"):
            joined = corpus_of_tables(read_clustered(spark, "c_docs"), read_clustered(spark, name))
            assert sorted(tuple(r) for r in joined.collect()) == want
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        for name in ("c_docs", "c_labels", "c_labels_again"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
