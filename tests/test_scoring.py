"""The blocked centroid matrix, pruned assignment, top-k and counted ranks."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from corpus_rows import make_docs
from protoclass.operators.centroid import topic_term_counts
from protoclass.plans.pipeline import Config, Run, classify, fit, prepare, run_pipeline


def corpus(seed, n_topics=23, n_train=90, n_test=40):
    """Topics with words of their own and words that most topics use; some test
    documents share nothing or only common words with any topic."""
    rng = random.Random(seed)
    common = [f"c{i}" for i in range(12)]
    rows = []
    for i in range(n_train):
        t = rng.randrange(n_topics)
        words = rng.choices(common, k=rng.randrange(1, 9)) + [f"t{t}w{rng.randrange(6)}" for _ in range(rng.randrange(8))]
        topics = [f"topic{t:02d}"] + ([f"topic{rng.randrange(n_topics):02d}"] if rng.random() < 0.2 else [])
        rows.append((i, "TRAIN", " ".join(words), topics))
    for i in range(n_test):
        t = rng.randrange(n_topics)
        kind = rng.random()
        words = rng.choices(common, k=rng.randrange(1, 5)) if kind < 0.9 else ["the"]
        if 0.2 < kind < 0.85:
            words += [f"t{t}w{rng.randrange(6)}" for _ in range(rng.randrange(1, 9))]
        if 0.85 <= kind < 0.95:
            words = [f"new{i}"]
        rows.append((1000 + i, "TEST", " ".join(words), [f"topic{t:02d}", f"topic{rng.randrange(n_topics):02d}"]))
    return rows


def brute(rows):
    """({(doc, topic): sim of pairs that share a term}, {doc: (topic, sim)}) in plain Python."""
    tf = {d: Counter(w for w in body.split() if w != "the") for d, _, body, _ in rows}
    df = Counter(w for c in tf.values() for w in c)
    n = sum(1 for c in tf.values() if c)
    w = {d: {t: k * (n // df[t]) for t, k in c.items()} for d, c in tf.items()}
    sums = defaultdict(Counter)
    for d, split, _, topics in rows:
        if split == "TRAIN":
            for t in set(topics):
                sums[t].update(w[d])
    norm = {t: sum(v * v for v in c.values()) for t, c in sums.items()}
    sims, best = {}, {}
    for d, split, _, _ in rows:
        if split != "TEST":
            continue
        n2 = sum(v * v for v in w[d].values())
        for t in sums:
            dot = sum(v * sums[t].get(x, 0) for x, v in w[d].items())
            if dot:
                sims[d, t] = float(dot) / (math.sqrt(n2) * math.sqrt(norm[t]))
        own = [(-sims[d, t], t) for t in sums if (d, t) in sims]
        best[d] = (min(own)[1], -min(own)[0]) if own else (min(sums), 0.0) if w[d] else (None, None)
    return sims, best


VARIANTS = {
    "one block": Config(topic_block=64), "blocks": Config(topic_block=4, prune=False), "pruned": Config(topic_block=4), "one block, doubles": Config(topic_block=64, prune=True, exact=False),
    "all terms left out, shuffled": Config(topic_block=5, tail_share=0.0, max_broadcast_bytes=0, task_rows=3),
}


@pytest.fixture(scope="module")
def prepared(spark):
    out = prepare(make_docs(spark, ROWS))
    yield out
    out.close()


ROWS = corpus(1)
SIMS, BEST = brute(ROWS)


@pytest.mark.parametrize("name", VARIANTS)
def test_against_brute_force(spark, prepared, name):
    model = fit(prepared, VARIANTS[name])
    scored, preds = classify(model, prepared)
    run = Run(prepared, model, scored, preds.persist(), prepared.edges())
    got = {r["doc_id"]: (r["topic"], r["sim"]) for r in run.predictions.collect()}
    assert got == BEST if "doubles" not in name else {d: t for d, (t, _) in got.items()} == {d: t for d, (t, _) in BEST.items()}
    assert run.scored._blocks is None   # no pair is kept for assignment
    near = {r["doc_id"]: r["candidates"] for r in run.scored.near().collect()}
    n = run.model.n_defined
    assert all(1 <= c <= n for c in near.values())
    if name == "pruned":   # bounds rule out most topics of most documents
        assert sum(near.values()) < 0.5 * n * len(near) and run.model.tail is not None
        check_plans(run)
    if name in ("one block", "blocks"):
        assert set(near.values()) == {n}
        check_pairs(run)
    scored.close()
    model.close()
    run.predictions.unpersist()


def check_pairs(run):
    """Similarities, rankings and margins."""
    assert {(r["doc_id"], r["topic"]): r["sim"] for r in run.scored.sims.collect()} == SIMS
    ranked = defaultdict(list)
    for (d, t), s in SIMS.items():
        ranked[d].append((-s, t))
    want = {(d, t): k for d, x in ranked.items() for k, (_, t) in enumerate(sorted(x), 1)}
    assert {(r["doc_id"], r["topic"]): r["rank"] for r in run.ranking().collect()} == want
    assert {(r["doc_id"], r["topic"]): r["rank"] for r in run.ranking(3).collect()} == {k: v for k, v in want.items() if v <= 3}
    topics = sorted({t for _, split, _, ts in ROWS if split == "TRAIN" for t in ts})
    for r in run.true_topic_margin().collect():
        order = sorted(topics, key=lambda t: (-SIMS.get((r["doc_id"], t), 0.0), t))
        true = [t for t in next(x[3] for x in ROWS if x[0] == r["doc_id"]) if t in topics]
        first = min(true, key=order.index, default=None)
        assert (r["best_true_topic"], r["best_true_rank"]) == (first, first and order.index(first) + 1)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def check_plans(run):
    weighted = run.model.table.join(run.scored.postings, "term")
    # a posting meets a block of topics once, and a term that most topics hold meets one
    assert weighted.groupBy("doc_id", "term", "block").count().agg(F.max("count")).first()[0] == 1
    assert weighted.where(F.col("most").isNotNull()).groupBy("doc_id", "term").count().agg(F.max("count")).first()[0] == 1
    # no more than k rows of a document leave a task
    top = plan_of(run.ranking(3))
    assert "WindowGroupLimit" in top and "Partial" in top
    assert "collect_list" not in plan_of(run.true_topic_margin()).replace("collect_list(struct(no", "")


def test_without_topics_or_terms(spark):
    for rows, config in (([(1, "TRAIN", "a1 b1", []), (2, "TEST", "a1", ["x"])], Config()),
                         ([(1, "TRAIN", "the", ["t"]), (2, "TEST", "a1", ["x"]), (3, "TEST", "the", ["t"])], Config(prune=True))):
        run = run_pipeline(make_docs(spark, rows), config)
        assert [(r["topic"], r["sim"]) for r in run.predictions.collect()] == [(None, None)] * (len(rows) - 1)
        assert run.scored.sims.count() == 0 and run.true_topic_margin().count() == 0
        run.close()


def test_sums_that_several_branches_read_are_kept_once(spark):
    rows = corpus(5)
    both = {}
    for pairs in (False, True):
        run = run_pipeline(make_docs(spark, rows), Config(topic_block=64, keep="checkpoint"), pairs=pairs)
        assert len(run.scored._kept) == int(pairs)      # before the ranking asks for them
        both[pairs] = [sorted(map(tuple, df.collect())) for df in (run.predictions, run.ranking(3))]
        run.close()
    assert both[True] == both[False]
    prepared = prepare(make_docs(spark, rows), Config(topic_block=4, prune=True, keep="checkpoint"))
    scored, predictions = classify(fit(prepared), prepared, shared=True)
    assert len(scored._kept) == 1                       # the first pass, which two branches read
    assert sorted(map(tuple, predictions.collect())) == both[True][0]


def test_training_postings_are_added_up_by_label_set(spark):
    tf = "doc_id bigint, topics array<string>, tfs array<struct<term: string, tf: bigint>>"
    rng = random.Random(3)
    sets = [["a", "b", "c"], ["b", "", "b"], ["c"], [], None, ["", None], ["c", "b", "a"]]
    rows = [(i, rng.choice(sets), [(t, rng.randrange(1, 4)) for t in rng.sample("uvwxyz", rng.randrange(5))]) for i in range(120)]
    want = Counter()
    for _, topics, tfs in rows:
        for topic in {t for t in topics or [] if t}:
            for term, n in tfs:
                want[topic, term] += n
    out = topic_term_counts(spark.createDataFrame(rows, tf))
    assert {(r["topic"], r["term"]): r["tf_sum"] for r in out.collect()} == dict(want)
    # from the top: the topics are taken apart above an aggregate of the terms' rows
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert [line.strip(" +-:").split()[0] for line in plan.splitlines() if "Generate" in line or "Aggregate" in line] == ["Aggregate", "Generate", "Aggregate", "Generate"]
