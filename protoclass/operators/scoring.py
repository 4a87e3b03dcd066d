"""Scoring and assignment.

Postings meet the centroid matrix by blocks of topics (``centroid.py``): a
posting comes once for each block that holds its term, and a block's entries are
added slot by slot, so the rows before the aggregate do not grow with the
topics. A (document, topic) pair exists as a row only where a caller asks for
pairs, and then only if the two share a term; every other pair has similarity 0
(or is undefined when a norm is 0) and is handled by rule.

The nearest topic needs no pairs at all. With more than one block it is found
by bounds (``pruned_blocks``): terms that most topics hold are left out of a
first pass, which gives every topic a lower bound (its sum so far) and all
topics one upper bound of what the left-out terms can add (the sum of a posting's
weight times the largest entry over the norm that any topic has). Only blocks
with a topic whose upper bound reaches the best lower bound get their full
sums. The result is that of scoring everything.

Rules for the cases the reference leaves to hash order or crashes on:

* ties: the smaller topic name wins;
* a document sharing no term with any centroid: the smallest topic name
  among topics with a non-empty centroid, ``zero_overlap = true``, sim 0;
* a document without indexed terms: topic NULL, sim NULL, counted incorrect;
* a document without a label: ``correct`` NULL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lookup import SplitPlan, skew_safe_join
from .weights import sum_of_products

#: Bounds are sums of doubles in any order; a bound this share too low still counts.
SLACK = 1e-9


def doc_norms(weighted: DataFrame, exact: bool = True) -> DataFrame:
    """F2 per document: ``(doc_id, n2)`` from weighted postings."""
    return weighted.groupBy("doc_id").agg(sum_of_products(F.col("w"), F.col("w"), exact).alias("n2"))


def _slots(slots: int) -> list[str]:
    return [f"_d{i}" for i in range(slots)]


def _block_sums(weighted: DataFrame, slots: int, exact: bool) -> list[Column]:
    return [sum_of_products(F.col("w"), F.col("entries")[i], exact).alias(d) for i, d in enumerate(_slots(slots))]


def doc_block_sums(weighted: DataFrame, slots: int, n_blocks: int, exact: bool = True) -> DataFrame:
    """F1 + F2 in one pass over postings weighed against the score table:
    ``(doc_id, block, _d0, .., n2, rest)`` with the dot products of the
    document and the block's topics (NULL without a shared term), the
    document's squared norm, and the bound of what terms without entries add.
    Map-side partial sums keep it to at most one row per (document, block) per
    task before the shuffle."""
    own = F.when(F.col("own"), F.col("w"))
    rows = weighted.groupBy("doc_id", "block").agg(
        *_block_sums(weighted, slots, exact), sum_of_products(own, own, exact).alias("n2"), F.sum(F.col("w") * F.col("most")).alias("rest"))
    if n_blocks > 1:   # the norm and the bound are dealt to the blocks of a document's terms
        doc = Window.partitionBy("doc_id")
        rows = rows.withColumn("n2", F.sum("n2").over(doc)).withColumn("rest", F.sum("rest").over(doc))
    return rows


def _pairs(blocks: DataFrame, slots: int) -> Column:
    """The block's topics that share a term with the document: their name, dot product and similarity, by slot."""
    each = [F.struct(F.get("names", F.lit(i)).alias("topic"), F.col(d).cast("double").alias("dot"), _sim(d, i).alias("sim"), F.lit(-i).alias("back"))
            for i, d in enumerate(_slots(slots))]
    return F.filter(F.array(*each), lambda x: x["sim"].isNotNull())


def _sim(dot: str, slot: int) -> Column:
    """F3, in the operation order of :func:`~protoclass.operators.weights.cosine`; the block has the topic's root."""
    den = F.sqrt(F.col("n2").cast("double")) * F.get("roots", F.lit(slot))
    return F.when(den > 0, F.col(dot).cast("double") / den)


def similarities(blocks: DataFrame, topic_blocks: DataFrame, slots: int, k: int | None = None) -> DataFrame:
    """F3 + F4: ``(doc_id, topic, dot, sim, cos_score)``; ``sim`` is the
    cosine similarity, ``cos_score = cos(sim)`` the reference's score (lower
    is closer; ranking by ``sim`` descending picks the same topic). ``k``: of
    every block no more than the ``k`` nearest, cut inside its row."""
    pairs = _pairs(blocks, slots)
    if k is not None:
        order = F.transform(pairs, lambda x: F.struct(x["sim"].alias("sim"), x["back"].alias("back"), x["topic"].alias("topic"), x["dot"].alias("dot")))
        pairs = F.slice(F.sort_array(order, asc=False), 1, int(k))
    rows = blocks.join(topic_blocks, "block").select("doc_id", F.explode(pairs).alias("p"))
    return rows.select("doc_id", F.col("p.topic").alias("topic"), F.col("p.dot").alias("dot"), F.col("p.sim").alias("sim"), F.cos("p.sim").alias("cos_score"))


def nearest(blocks: DataFrame, topic_blocks: DataFrame, slots: int, n_blocks: int) -> DataFrame:
    """``(doc_id, topic, sim, candidates)`` of the nearest topic for every
    document with an indexed term (topic NULL if it shares none with a
    centroid); ties -> smaller name. A block's nearest is found inside its row."""
    best = F.array_max(F.transform(_pairs(blocks, slots), lambda x: F.struct(x["sim"].alias("sim"), x["back"].alias("back"), x["topic"].alias("topic"))))
    rows = blocks.join(topic_blocks, "block", "left").select("doc_id", "block", best.alias("_b"), "candidates")
    if n_blocks > 1:
        order = F.struct(F.col("_b.sim"), -F.col("block"), F.col("_b.back"), F.col("_b.topic"))
        rows = rows.groupBy("doc_id").agg(F.max(F.when(F.col("_b").isNotNull(), order)).alias("_b"), F.max("candidates").alias("candidates"))
    return rows.select("doc_id", F.col("_b.topic").alias("topic"), F.col("_b.sim").alias("sim"), "candidates")


def pruned_blocks(blocks: DataFrame, topic_blocks: DataFrame, slots: int, n_topics: int, n_blocks: int,
                  postings: DataFrame, tail: DataFrame, plan: SplitPlan, exact: bool = True, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """G1 by bounds: full sums of the blocks that can still hold the nearest topic.

    ``blocks``: :func:`doc_block_sums` without the terms of ``tail``;
    ``postings``: ``(doc_id, term, tf)`` of the same documents. A document
    whose best lower bound does not exceed ``rest`` is scored against all
    blocks. ``candidates``: how many topics could still win. ``keep``: how the
    result of the first pass, which two branches read, is kept.
    """
    part = [F.col(d).cast("double") / F.get("roots", F.lit(i)) for i, d in enumerate(_slots(slots))]
    rest = F.coalesce("rest", F.lit(0.0))
    doc = Window.partitionBy("doc_id")
    bounded = blocks.join(topic_blocks.select("block", "roots"), "block", "left").withColumn(
        "_best", F.max(F.coalesce(F.greatest(*part) if slots > 1 else part[0], F.lit(0.0))).over(doc))

    def wins(sums: Column) -> Column:
        return (sums + rest) * (1 + SLACK) >= F.col("_best")

    reached = sum((F.when(wins(p), 1).otherwise(0) for p in part), F.lit(0))
    bounded = bounded.select(
        "doc_id", "block", *_slots(slots), "n2", wins(F.lit(0.0)).alias("_open"), reached.alias("_reached"),
        F.row_number().over(doc.orderBy("block")).alias("_at"))
    told = bounded.withColumn("candidates", F.when(F.col("_open"), F.lit(n_topics)).otherwise(F.sum("_reached").over(doc)))
    told = keep(told.where(F.col("_open") | (F.col("_reached") > 0)))
    # The blocks to score: those with a candidate, or all of them.
    everywhere = F.sequence(F.lit(0).cast("bigint"), F.lit(n_blocks - 1).cast("bigint"))
    wanted = told.where(~F.col("_open") | (F.col("_at") == 1)).select(
        F.col("doc_id").alias("_doc"), "n2", "candidates", F.explode(F.when(F.col("_open"), everywhere).otherwise(F.array("block"))).alias("_block"))
    terms = tail.select("term", "df").distinct()
    few = skew_safe_join(postings, terms, key="term", freq="df", plan=plan).select("doc_id", "term", "tf")
    met = few.join(wanted, F.col("doc_id") == F.col("_doc")).select(
        "doc_id", F.col("_block").alias("block"), "n2", "candidates", _cell("term", "_block").alias("_cell"), "tf")
    cells = tail.select(_cell("term", "block").alias("_cell"), "df", "q", "entries")
    more = skew_safe_join(met, cells, key="_cell", freq="df", plan=plan).withColumn("w", F.col("tf") * F.col("q"))
    kind = blocks.schema["_d0"].dataType
    added = more.groupBy("doc_id", "block").agg(*_block_sums(more, slots, exact), F.max("n2").alias("n2"), F.max("candidates").alias("candidates"))
    both = told.select("doc_id", "block", *_slots(slots), "n2", "candidates").unionByName(added)
    return both.groupBy("doc_id", "block").agg(
        *[F.sum(d).cast(kind).alias(d) for d in _slots(slots)], F.max("n2").alias("n2"), F.max("candidates").alias("candidates"))


def _cell(term: str, block: str) -> Column:
    """A term within a block, as one key (digits end at the blank)."""
    return F.concat(F.col(block).cast("string"), F.lit(" "), F.col(term))


def assign(test_docs: DataFrame, near: DataFrame, default_topic: str | None) -> DataFrame:
    """G2 + G3 + H1: one row per test document,
    ``(doc_id, topic, sim, zero_overlap, correct)``.

    ``test_docs``: ``(doc_id, topics)``; ``near``: :func:`nearest`, a row for
    each document with at least one indexed term; ``default_topic``: smallest
    topic name among topics with a non-empty centroid (None if there is none).
    """
    best = near.select(F.col("doc_id").alias("_doc"), F.col("topic").alias("_bt"), F.col("sim").alias("_bs"))
    base = test_docs.select("doc_id", "topics").join(best, F.col("doc_id") == F.col("_doc"), "left")
    has = F.col("_doc").isNotNull()
    fallback = F.lit(default_topic).cast("string")
    topic = F.when(F.col("_bt").isNotNull(), F.col("_bt")).when(has, fallback)
    sim = F.when(F.col("_bs").isNotNull(), F.col("_bs")).when(has & fallback.isNotNull(), F.lit(0.0))
    out = base.select("doc_id", topic.alias("topic"), sim.alias("sim"), F.col("_bt").isNull().alias("zero_overlap"), "topics")
    return out.select(
        "doc_id", "topic", "sim", "zero_overlap",
        # unknown without a label
        F.when(F.size("topics") > 0, F.coalesce(F.array_contains("topics", F.col("topic")), F.lit(False))).alias("correct"),
    )


def rank_topics(sims: DataFrame, k: int | None = None) -> DataFrame:
    """``(doc_id, topic, sim, cos_score, rank)``, rank 1 = nearest, over
    the topics that share a term with the document (all other topics tie
    below them at similarity 0); ``k`` keeps the ``k`` nearest: a task then
    passes no more than ``k`` rows of a document on to the exchange. A window
    per document holds at most one row per topic."""
    w = Window.partitionBy("doc_id").orderBy(F.col("sim").desc(), F.col("topic").asc())
    ranked = sims.select("doc_id", "topic", "sim", "cos_score", F.row_number().over(w).alias("rank"))
    return ranked if k is None else ranked.where(F.col("rank") <= k)


def true_topic_margin(sims: DataFrame, predictions: DataFrame, test_edges: DataFrame, index: DataFrame) -> DataFrame:
    """Per classified document with terms, its best-ranked true topic,
    that topic's similarity and rank among all scorable topics, and the
    similarity margin to the assigned topic.

    Ranks are counted, not sorted: the best true topic of a document is picked
    first (largest similarity, 0 without a shared term, then smallest name); its
    rank is 1 + the topics above it. Of those that share a term with the
    document they are counted pair by pair; of the others, which all have
    similarity 0, there are as many before it as its number by name less the
    sharing ones of a smaller name.

    ``sims``: the pairs that share a term; ``index``: ``(topic, no)`` of the
    topics with a non-empty centroid, numbered by name from 0.
    """
    scored = predictions.where(F.col("sim").isNotNull()).select(
        "doc_id", F.col("topic").alias("predicted"), F.col("sim").alias("predicted_sim"))
    pairs = sims.select("doc_id", "topic", "sim")
    truth = (test_edges.select("doc_id", "topic").join(scored.select("doc_id"), "doc_id", "left_semi")
             .join(index.select("topic", "no"), "topic")
             .join(pairs, ["doc_id", "topic"], "left")
             .select("doc_id", F.struct(-F.coalesce("sim", F.lit(0.0)), F.col("topic")).alias("_order"), "no"))
    best = truth.groupBy("doc_id").agg(F.min_by(F.struct("_order", "no"), "_order").alias("_b")).select(
        "doc_id", F.col("_b._order.topic").alias("best_true_topic"), (-F.col("_b._order.col1")).alias("best_true_sim"), F.col("_b.no").alias("_no"))
    other = pairs.select("doc_id", F.col("topic").alias("_topic"), F.col("sim").alias("_sim"))
    above = (F.col("_sim") > F.col("best_true_sim")) | ((F.col("_sim") == F.col("best_true_sim")) & (F.col("_topic") < F.col("best_true_topic")))
    counted = best.join(other, "doc_id", "left").groupBy("doc_id").agg(
        F.first("best_true_topic").alias("best_true_topic"), F.first("best_true_sim").alias("best_true_sim"), F.first("_no").alias("_no"),
        F.count_if(above).alias("_above"), F.count_if(F.col("_topic") < F.col("best_true_topic")).alias("_before"))
    zeros = F.when(F.col("best_true_sim") == 0.0, F.col("_no") - F.col("_before")).otherwise(F.lit(0))
    zeros_above = F.when(F.col("best_true_sim") == 0.0, F.col("_above") + zeros).otherwise(F.col("_above"))
    ranked = counted.select("doc_id", "best_true_topic", "best_true_sim", (zeros_above + 1).cast("bigint").alias("best_true_rank"))
    return (scored.join(ranked, "doc_id", "left")
            .select("doc_id", "predicted", "predicted_sim", "best_true_topic", "best_true_sim", "best_true_rank",
                    (F.col("predicted_sim") - F.col("best_true_sim")).alias("margin")))


__all__ = ["doc_norms", "doc_block_sums", "similarities", "nearest", "pruned_blocks", "assign", "rank_topics", "true_topic_margin"]
