"""Term statistics (E1-E5): per-document term counts, document frequency,
corpus size.

``doc_terms`` keeps one row per document with its term counts as an array,
computed inside the row (no shuffle); ``term_freq`` explodes it into the long
``(doc_id, split, term, tf)`` relation when a consumer needs rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import STOP_WORDS, tokenize, with_term_counts


def doc_terms(docs: DataFrame, profile: str = "word",
              stop_words: tuple[str, ...] | None = STOP_WORDS,
              keep: tuple[str, ...] = ("doc_id", "split", "topics"),
              max_token_length: int | None = None) -> DataFrame:
    """E1-E3 per document: ``keep`` columns plus
    ``tfs ARRAY<STRUCT<term STRING, tf BIGINT>>`` (sorted by term) and
    ``n_terms`` (number of distinct terms)."""
    tokens = docs.select(*keep, tokenize("body", profile, stop_words, max_token_length).alias("_terms"))
    counted = with_term_counts(tokens, "_terms", "tfs").drop("_terms")
    return counted.withColumn("n_terms", F.size("tfs"))


def term_freq(dterms: DataFrame, extra: tuple[str, ...] = ("split",)) -> DataFrame:
    """E3 as rows: ``(doc_id, *extra, term, tf)``."""
    return (dterms.select("doc_id", *extra, F.explode("tfs").alias("_t"))
            .select("doc_id", *extra, F.col("_t.term").alias("term"), F.col("_t.tf").alias("tf")))


def term_stats(dterms: DataFrame) -> DataFrame:
    """``(term, df)`` = number of indexed documents containing the term.

    Map-side partial counts collapse every term to one row per task before
    the shuffle, so a term present in every document costs no more than a
    rare one.
    """
    return (dterms.select(F.explode("tfs.term").alias("term"))
            .groupBy("term").agg(F.count(F.lit(1)).alias("df")))


def corpus_size(dterms: DataFrame) -> DataFrame:
    """E5: one row ``n_docs`` = documents with at least one indexed term."""
    return dterms.where(F.col("n_terms") > 0).agg(F.count(F.lit(1)).alias("n_docs"))
