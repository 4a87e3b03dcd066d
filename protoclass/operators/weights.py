"""Term weights and document vectors (E6, E7) and the vector algebra used
on them (F1-F3).

Weights are exact integers, ``w = tf * (n_docs div df)``: no logarithm, never
below ``tf``. Sums of products of weights can exceed 64 bits on large
corpora, so they are accumulated as ``DECIMAL(38,0)`` when ``exact`` (the
default) and as ``DOUBLE`` otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lookup import SplitPlan, skew_safe_join

EXACT_TYPE = "decimal(38,0)"
_FACTOR_TYPE = "decimal(19,0)"   # any BIGINT fits; the product is DECIMAL(38,0)


def idf_factor(term_stats: DataFrame, n_docs: int) -> DataFrame:
    """``(term, df, q)`` with the integer factor ``q = n_docs div df``."""
    return term_stats.withColumn("q", F.expr(f"CAST({int(n_docs)} AS BIGINT) div df"))


def product(a: Column, b: Column, exact: bool = True) -> Column:
    """``a * b`` in the accumulation type."""
    if exact:
        return a.cast(_FACTOR_TYPE) * b.cast(_FACTOR_TYPE)
    return a.cast("double") * b.cast("double")


def sum_of_products(a: Column, b: Column, exact: bool = True) -> Column:
    """F1/F2 building block: ``sum(a * b)`` without overflow (exact) or in
    floating point."""
    s = F.sum(product(a, b, exact))
    return s.cast(EXACT_TYPE) if exact else s


def cosine(dot: Column, n2_a: Column, n2_b: Column) -> Column:
    """``dot / (sqrt(n2_a) * sqrt(n2_b))`` in double precision, the
    operation order of the reference. NULL when a norm is zero."""
    den = F.sqrt(n2_a.cast("double")) * F.sqrt(n2_b.cast("double"))
    return F.when(den > 0, dot.cast("double") / den)


def weigh(postings: DataFrame, table: DataFrame, plan: SplitPlan) -> DataFrame:
    """E6 + E7: attach ``df``, ``q`` (and whatever else ``table`` carries) and
    ``w = tf * q`` to ``(doc_id, ..., term, tf)`` postings through a skew-safe
    join on ``term``; a posting comes once for each table row of its term."""
    joined = skew_safe_join(postings, table, key="term", freq="df", plan=plan)
    return joined.withColumn("w", F.col("tf") * F.col("q"))


def vector_maps(vectors: DataFrame, key: str = "doc_id") -> DataFrame:
    """E7 output view of sparse vectors: one row per ``key`` with
    ``vector MAP<STRING, BIGINT>`` (term -> weight). One document's vector is
    at most its distinct terms, so each group is bounded by one row's size."""
    return (vectors.groupBy(key)
            .agg(F.map_from_entries(F.collect_list(F.struct("term", "w"))).alias("vector")))


def vector_text(vector: Column) -> Column:
    """A map vector as text, ``term=weight`` pairs in term order joined by
    ``;`` (for comparison and export)."""
    entries = F.sort_array(F.map_entries(vector))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ";")
