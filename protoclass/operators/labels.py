"""Label relations: clean labels, document-topic edges, topic vocabulary
(C4, D1-D4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .routing import TEST, TRAIN, test_documents, train_documents


def clean_topics(topics: Column | str) -> Column:
    """C4: drop blank labels and repeated labels, keep first-seen order."""
    col = F.col(topics) if isinstance(topics, str) else topics
    return F.array_distinct(F.filter(F.coalesce(col, F.array().cast("array<string>")),
                                     lambda t: t != F.lit("")))


def doc_topics(docs: DataFrame) -> DataFrame:
    """D1 + D2: distinct ``(doc_id, split, topic)`` edges.

    TRAIN edges come from every kept training document; TEST edges only from
    test documents that carry a non-blank label (the ones that are
    classified). ``docs`` must already be de-duplicated.
    """
    train = train_documents(docs)
    test = test_documents(docs)
    both = train.unionByName(test)
    return both.select("doc_id", "split", F.explode(clean_topics("topics")).alias("topic")).distinct()


def topic_vocabulary(docs: DataFrame) -> DataFrame:
    """D3 + D4: topics that have at least one kept training document, with
    their member count ``n_train`` (the centroid divisor)."""
    edges = train_documents(docs).select("doc_id", F.explode(clean_topics("topics")).alias("topic"))
    return edges.groupBy("topic").agg(F.count(F.lit(1)).alias("n_train"))


def relevant_counts(edges: DataFrame) -> DataFrame:
    """Number of test documents truly labelled with each topic."""
    return (edges.where(F.col("split") == TEST)
            .groupBy("topic").agg(F.count(F.lit(1)).alias("relevant")))


__all__ = ["clean_topics", "doc_topics", "topic_vocabulary", "relevant_counts", "TRAIN", "TEST"]
