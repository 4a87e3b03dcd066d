"""Properties of scoring and evaluation on the driver's smallest tables, and
the report format."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from protoclass.operators.evaluate import _fmt
from protoclass.plans.pipeline import Config, run_pipeline
from protoclass.sources.tables import corpus_view

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def run(spark):
    r = run_pipeline(corpus_view(spark, SF), Config())
    yield r
    r.close()


def test_similarities_are_cosines(run):
    s = run.scored.sims.agg(F.min("sim"), F.max("sim")).first()
    assert 0.0 < s[0] and s[1] <= 1.0 + 1e-12


def test_every_test_document_is_accounted_for(run):
    n_test = run.prepared.test_docs().count()
    assert run.predictions.count() == n_test
    retrieved = run.evaluation(full=True).agg(F.sum("retrieved")).first()[0]
    unassigned = run.predictions.where(F.col("topic").isNull()).count()
    assert retrieved + unassigned == n_test


def test_hits_and_literal_counts(run):
    for r in run.evaluation(full=True).collect():
        assert r["hits"] <= min(r["retrieved"], r["relevant"])
        if r["retrieved"]:
            assert r["literal_precision"] * r["retrieved"] == pytest.approx(r["retrieved"] - r["hits"])


def test_accuracy_matches_predictions(run):
    acc = run.accuracy().first()
    correct = run.predictions.where("correct").count()
    assert acc["correct"] == correct
    assert acc["accuracy_pct"] == pytest.approx(100.0 * correct / run.predictions.count())


def test_scaling_a_centroid_keeps_predictions(run):
    """Cosine ignores scale: ranking with the mean centroid (sw / n_train)
    picks the topics the exact sums picked."""
    cents = run.model.centroids().select("topic", "term", "w")
    postings = run.prepared.term_freq().where(F.col("split") == "TEST")
    vec = run.model.weigh(postings).select("doc_id", "term", F.col("w").alias("dw"))
    dots = vec.join(cents, "term").groupBy("doc_id", "topic").agg(F.sum(F.col("dw") * F.col("w")).alias("dot"))
    cn = cents.groupBy("topic").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("cn"))
    ranked = dots.join(cn, "topic").withColumn("s", F.col("dot") / F.col("cn"))
    best = {r["doc_id"]: r["t"] for r in ranked.groupBy("doc_id").agg(
        F.min_by("topic", F.struct(-F.col("s"), F.col("topic"))).alias("t")).collect()}
    preds = {r["doc_id"]: r["topic"] for r in run.predictions.where(~F.col("zero_overlap")).collect()}
    assert preds and all(best[d] == t for d, t in preds.items())


def test_partition_count_does_not_change_results(spark, run):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        other = run_pipeline(corpus_view(spark, SF), Config(rebalance=True))
        a = sorted(tuple(r) for r in run.predictions.collect())
        b = sorted(tuple(r) for r in other.predictions.collect())
        other.close()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert a == b


@pytest.mark.parametrize("value,text", [
    (0.125, "00.12"), (0.375, "00.38"), (1.0, "01.00"), (12.5, "12.50"), (0.0, "00.00"),
    (1234.5, "1234.50"), (None, "NaN"),
])
def test_two_digit_format(spark, value, text):
    df = spark.createDataFrame([(value,)], "x double")
    assert df.select(_fmt(F.col("x")).alias("s")).first()["s"] == text
