"""Evaluation (H1-H7): hits, accuracy, per-topic precision/recall/F1 and the
text report.

Undefined ratios (zero denominators) are NULL, never NaN: Spark orders NaN
above every number, which would corrupt rankings and comparisons.

``literal_*`` columns reproduce what the reference prints: it takes the
*difference* retrieved - relevant where the intersection is meant, so its
"precision" is the false-discovery rate and its "recall" is
false positives / relevant.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordinal import with_ordinal

# Report layout of the reference.
REPORT_HEADER = "Recall\tPrecision\tF-measure\tTopic"
REPORT_RULE = "-------------------------------------------"
REPORT_FOOTER_RULE = "==========================================="
NAN_TEXT = "NaN"


def hits(predictions: DataFrame) -> DataFrame:
    """H1: ``(doc_id, topic, hit)`` — the assigned topic is one of the
    document's true topics."""
    return predictions.select("doc_id", "topic", F.col("correct").alias("hit"))


def accuracy(predictions: DataFrame) -> DataFrame:
    """H2: one row ``(correct, incorrect, accuracy_pct)``; ``accuracy_pct`` is
    NULL when nothing was classified."""
    c = F.sum(F.col("correct").cast("bigint"))
    n = F.count("correct")   # documents without a label count neither way
    agg = predictions.agg(F.coalesce(c, F.lit(0)).alias("correct"), n.alias("n"))
    return agg.select(
        "correct",
        (F.col("n") - F.col("correct")).alias("incorrect"),
        F.try_divide(F.lit(100.0) * F.col("correct").cast("double"), F.col("n").cast("double"))
        .alias("accuracy_pct"),
    )


def _ratio(num: Column, den: Column) -> Column:
    return F.try_divide(num.cast("double"), den.cast("double"))


def _f1(p: Column, r: Column) -> Column:
    # the reference's operation order: 2 * ((p * r) / (p + r))
    return F.lit(2.0) * F.try_divide(p * r, p + r)


def evaluation(predictions: DataFrame, vocabulary: DataFrame, relevant: DataFrame,
               full: bool = False) -> DataFrame:
    """H3-H6 per topic of the training vocabulary:
    ``(topic, retrieved, relevant, hits, precision, recall, f1,
    literal_precision, literal_recall, literal_f1)``.

    ``relevant``: ``(topic, relevant)`` from the test edges. The brief form
    (``full=False``) drops topics with nothing retrieved or nothing relevant;
    test-only topics never appear.
    """
    none = F.lit(0).cast("bigint")
    per_topic = (predictions.where(F.col("topic").isNotNull())
                 .groupBy("topic")
                 .agg(F.count(F.lit(1)).alias("retrieved"),
                      F.sum(F.col("correct").cast("bigint")).alias("hits")))
    # one exchange of a few rows for each topic, in place of a join for each relation
    parts = (vocabulary.select("topic", F.lit(True).alias("_known"), none.alias("retrieved"), none.alias("relevant"), none.alias("hits"))
             .unionByName(per_topic.select("topic", F.lit(False).alias("_known"), "retrieved", none.alias("relevant"), "hits"))
             .unionByName(relevant.select("topic", F.lit(False).alias("_known"), none.alias("retrieved"), "relevant", none.alias("hits"))))
    base = (parts.groupBy("topic").agg(F.max("_known").alias("_known"),
                                       *[F.coalesce(F.sum(c), none).cast("bigint").alias(c) for c in ("retrieved", "relevant", "hits")])
            .where("_known").drop("_known"))
    if not full:
        base = base.where((F.col("retrieved") > 0) & (F.col("relevant") > 0))
    p = _ratio(F.col("hits"), F.col("retrieved"))
    r = _ratio(F.col("hits"), F.col("relevant"))
    miss = F.col("retrieved") - F.col("hits")
    lp = _ratio(miss, F.col("retrieved"))
    lr = _ratio(miss, F.col("relevant"))
    out = base.select("*", p.alias("precision"), r.alias("recall"),
                      lp.alias("literal_precision"), lr.alias("literal_recall"))
    return out.select(
        "topic", "retrieved", "relevant", "hits", "precision", "recall",
        _f1(F.col("precision"), F.col("recall")).alias("f1"),
        "literal_precision", "literal_recall",
        _f1(F.col("literal_precision"), F.col("literal_recall")).alias("literal_f1"),
    )


def _fmt(x: Column) -> Column:
    """The reference's two-integer-digit, two-decimal format (half-even on
    the double value, like ``format_number``); NULL -> ``NaN``."""
    s = F.regexp_replace(F.format_number(x, 2), ",", "")
    return F.when(x.isNull(), F.lit(NAN_TEXT)).otherwise(F.lpad(s, F.greatest(F.length(s), F.lit(5)), "0"))


def report_lines(evaluation_df: DataFrame, accuracy_df: DataFrame, literal: bool = True) -> DataFrame:
    """H7 + B3: the evaluation report as ``(line_no, line)`` rows, topics in
    name order. ``literal=True`` prints the reference's own numbers."""
    prefix = "literal_" if literal else ""
    rec, prec, f1 = (F.col(prefix + "recall"), F.col(prefix + "precision"), F.col(prefix + "f1"))
    f1_text = F.when(f1.isNull(), F.lit(NAN_TEXT + " ")).otherwise(_fmt(f1))
    body = evaluation_df.select(
        F.lit(2).alias("section"), F.col("topic").alias("k"),
        F.concat(_fmt(rec), F.lit("\t"), _fmt(prec), F.lit("\t\t"), f1_text,
                 F.lit("\t\t> "), F.col("topic")).alias("line"))
    spark = evaluation_df.sparkSession
    head = spark.createDataFrame([(0, "", REPORT_HEADER), (1, "", REPORT_RULE)],
                                 "section int, k string, line string")
    foot = accuracy_df.select(
        F.lit(4).alias("section"), F.lit("").alias("k"),
        F.when(F.col("accuracy_pct").isNull(), F.lit(f"Overall accuracy: {NAN_TEXT}%"))
        .otherwise(F.format_string("Overall accuracy: %.2f%%", F.col("accuracy_pct"))).alias("line"))
    rule = spark.createDataFrame([(3, "", REPORT_FOOTER_RULE)], "section int, k string, line string")
    lines = head.unionByName(body).unionByName(rule).unionByName(foot)
    return with_ordinal(lines, ["section", "k"], "line_no").select("line_no", "line")
