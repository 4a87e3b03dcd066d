"""Named queries over the driver's tables, one per operator group of the
survey's inventory. Each takes ``(spark, sf_dir)`` and returns a DataFrame
whose column names match the DuckDB oracle in :mod:`protoclass.plans.oracle`.

Every query builds the stages it needs and no others, and shares nothing with
other calls: what a stage keeps is checkpointed (one computation, nothing left
in executor memory). Callers that want several results of one run use
``run_pipeline`` and hold the ``Run``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import evaluate as E
from ..operators import routing as R
from ..session import scratch_path
from ..sources.corpus_store import (read_clustered, read_documents, read_vectors, write_clustered, write_documents,
                                    write_vectors)
from ..sources.sgml import SgmlCorpus, read_sgml, write_sgml
from ..sources.tables import NOT_USED, ORDER, corpus_of_tables, corpus_view, read_table
from .pipeline import (CentroidModel, Config, Prepared, Run, classify, classify_documents, fit, prepare,
                       run_pipeline)

CONFIG = Config(keep="checkpoint", order=ORDER, unique_order=True)


def _corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_view(spark, sf_dir, places=True)


def _kept_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.keep_documents(_corpus(spark, sf_dir), order=ORDER, unique=True)


def _prepared(spark: SparkSession, sf_dir: str) -> Prepared:
    return prepare(_corpus(spark, sf_dir), CONFIG)


def _fitted(spark: SparkSession, sf_dir: str) -> tuple[Prepared, CentroidModel]:
    prepared = _prepared(spark, sf_dir)
    return prepared, fit(prepared)


def _run(spark: SparkSession, sf_dir: str, pairs: bool = False) -> Run:
    return run_pipeline(_corpus(spark, sf_dir), CONFIG, pairs)


#: Replacements that bring the tokeniser's edge cases into the tables' text.
EDGE_TEXT = ((" the ", " ____ _the_ \u00bd1\u00bd \u6f22\u5b57\u304b\u306a1,2 x\u6f22y the\u00ad\u200dre "),
             (" de ", " de_la l'a._b 3.x \u0301e d\u0301\u2060e \u05d0\"\u05d1' \u05d0' "),
             (" der ", " \u2168 der\u30ab\u30bf der_\u30ab\u30bf\u30fc \u0e01\u0e32 1\u00ad2.\u00ad3 "))


def _dbl(c: str) -> F.Column:
    return F.col(c).cast("double").alias(c)


def q_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 + C2 (+C5): documents per split before and after routing."""
    corpus = corpus_view(spark, sf_dir)
    kept = _kept_documents(spark, sf_dir).groupBy("split").agg(F.count(F.lit(1)).alias("n_kept"))
    return (corpus.groupBy("split").agg(F.count(F.lit(1)).alias("n_docs"),
                                        F.sum((F.col("body") != "").cast("bigint")).alias("n_nonempty"))
            .join(kept, "split", "left")
            .select("split", "n_docs", "n_nonempty", F.coalesce("n_kept", F.lit(0)).cast("bigint").alias("n_kept")))


def q_doc_topics(spark, sf_dir):
    """D1 + D2 (C3, C4): distinct document-topic edges."""
    return _prepared(spark, sf_dir).edges()


def q_topic_vocab(spark, sf_dir):
    """D3 + D4: training topics and their member counts."""
    from ..operators.labels import topic_vocabulary
    return topic_vocabulary(_kept_documents(spark, sf_dir))


def q_dedup_last(spark, sf_dir):
    """C5 on input with repeated ids: three neighbouring table rows, of
    whatever splits, become copies of one id (their own id kept as ``old_id``,
    the reading order), and every tenth row comes twice; the operator keeps the
    last copy of every id, once. A row's place is its file, its row there, and
    which of the two readings of the file it comes from."""
    rekeyed = _corpus(spark, sf_dir).withColumn("doc_id", F.floor(F.col("old_id") / 3).cast("bigint"))
    again = rekeyed.where(F.col("old_id") % 10 == 4).withColumn("reading", F.lit(1))
    kept = R.keep_documents(rekeyed.withColumn("reading", F.lit(0)).unionByName(again), order=(*ORDER, "reading"), unique=True)
    return kept.select("doc_id", "old_id", "split", "title", "body")


def q_term_freq(spark, sf_dir):
    """E1-E3 (word profile): term counts per document."""
    return _prepared(spark, sf_dir).term_freq()


def q_term_freq_ascii(spark, sf_dir):
    """E1-E3 with the ascii profile."""
    prepared = prepare(_corpus(spark, sf_dir), replace(CONFIG, profile="ascii"))
    return prepared.term_freq()


def q_term_freq_edge(spark, sf_dir):
    """E1-E3 on text with underscores, fractions and ideographs put in."""
    corpus = _corpus(spark, sf_dir)
    for old, new in EDGE_TEXT:
        corpus = corpus.withColumn("body", F.replace("body", F.lit(old), F.lit(new)))
    return prepare(corpus, CONFIG).term_freq()


def q_term_stats(spark, sf_dir):
    """Document frequency per term."""
    from ..operators.terms import term_stats
    return term_stats(_prepared(spark, sf_dir).doc_terms)


def q_corpus_size(spark, sf_dir):
    """E5: documents with at least one indexed term."""
    from ..operators.terms import corpus_size
    return corpus_size(_prepared(spark, sf_dir).doc_terms)


def q_doc_vectors(spark, sf_dir):
    """E6 + E7: integer weights of every kept document."""
    prepared, model = _fitted(spark, sf_dir)
    return model.weigh(prepared.term_freq()).select("doc_id", "split", "term", "tf", "w")


def q_doc_vector_maps(spark, sf_dir):
    """Each kept document's vector as a term -> weight map (shown as text)."""
    from ..operators.weights import vector_maps, vector_text
    prepared, model = _fitted(spark, sf_dir)
    maps = vector_maps(model.weigh(prepared.term_freq()))
    return maps.select("doc_id", F.size("vector").cast("bigint").alias("n_terms"),
                       vector_text(F.col("vector")).alias("vector"))


def q_doc_norms(spark, sf_dir):
    """F2 per document (all kept documents)."""
    from ..operators.scoring import doc_norms
    prepared, model = _fitted(spark, sf_dir)
    return doc_norms(model.weigh(prepared.term_freq()), model.config.exact).select("doc_id", _dbl("n2"))


def q_topic_norms(spark, sf_dir):
    """F2 per topic centroid (sums)."""
    return _fitted(spark, sf_dir)[1].topic_norms.select("topic", _dbl("n2"))


def q_centroids(spark, sf_dir):
    """centroid sums and means."""
    return _fitted(spark, sf_dir)[1].centroids().select("topic", "term", "sw", "n_train", "w")


def q_similarities(spark, sf_dir):
    """Sparse (document, topic) similarities."""
    return _run(spark, sf_dir, pairs=True).scored.sims.select("doc_id", "topic", "dot", "sim", "cos_score")


def q_predictions(spark, sf_dir):
    """Nearest topic per test document."""
    return _run(spark, sf_dir).predictions


def q_topic_ranking(spark, sf_dir):
    """Topics ranked per document."""
    return _run(spark, sf_dir, pairs=True).ranking().select(
        "doc_id", "topic", "sim", F.col("rank").cast("bigint").alias("rank"))


def q_topic_ranking_k(spark, sf_dir):
    """The three nearest topics of each document."""
    return _run(spark, sf_dir, pairs=True).ranking(3).select("doc_id", "topic", "sim", F.col("rank").cast("bigint").alias("rank"))


def q_predictions_pruned(spark, sf_dir):
    """G1 + G2 by bounds, over blocks of two topics: the nearest topic, and how
    many topics could still win after the first pass."""
    from ..operators.scoring import assign
    prepared = prepare(_corpus(spark, sf_dir), replace(CONFIG, topic_block=2, prune=True))
    model = fit(prepared)
    near = model.score(R.test_documents(prepared.doc_terms)).near()
    counts = near.select("doc_id", F.col("candidates").cast("bigint").alias("candidates"))
    return assign(prepared.test_docs(), near, model.default_topic).join(counts, "doc_id", "left")


def q_true_topic_margin(spark, sf_dir):
    """Best true topic, its rank and the margin to the assignment."""
    return _run(spark, sf_dir, pairs=True).true_topic_margin()


def q_hits(spark, sf_dir):
    """H1: hit flag per classified document."""
    return E.hits(_run(spark, sf_dir).predictions)


def q_accuracy(spark, sf_dir):
    """H2: overall accuracy."""
    return _run(spark, sf_dir).accuracy()


_EVAL_COLS = ("topic", "retrieved", "relevant", "hits", "precision", "recall", "f1")


def q_evaluation_brief(spark, sf_dir):
    """H3-H6: per-topic measures, topics with retrieved and relevant docs."""
    return _run(spark, sf_dir).evaluation(full=False).select(*_EVAL_COLS)


def q_evaluation_full(spark, sf_dir):
    """H3-H6: per-topic measures for every training topic."""
    return _run(spark, sf_dir).evaluation(full=True).select(*_EVAL_COLS)


def q_evaluation_literal(spark, sf_dir):
    """H4 as the reference prints it (difference instead of intersection)."""
    return _run(spark, sf_dir).evaluation(full=False).select(
        "topic", "retrieved", "relevant", "hits", "literal_precision", "literal_recall", "literal_f1")


def q_report_lines(spark, sf_dir):
    """H7 + B3: the printed report, one row per line."""
    return _run(spark, sf_dir).report(full=False, literal=True)


def q_report_lines_full(spark, sf_dir):
    """H7 + B3: the report over every training topic, with the true measures."""
    return _run(spark, sf_dir).report(full=True, literal=False)


def q_classify_unlabelled(spark, sf_dir):
    """G1-G3 for documents that the model has never seen and that bear no
    label: those of the unused split."""
    _, model = _fitted(spark, sf_dir)
    new = _corpus(spark, sf_dir).where(F.col("split") == NOT_USED).drop("topics", "split")
    return classify_documents(model, new)[0]


def q_corpus_parquet_roundtrip(spark, sf_dir):
    """B1 as Parquet: kept documents by split and their vectors, written and
    read back."""
    prepared, model = _fitted(spark, sf_dir)
    path = scratch_path(spark, "corpus")
    write_documents(prepared.docs.select("doc_id", "old_id", "split", "title", "body", "topics"), f"{path}/documents")
    write_vectors(model.weigh(prepared.term_freq()), f"{path}/vectors")
    vectors = read_vectors(spark, f"{path}/vectors").groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_terms"), F.sum("tf").alias("n_tokens"), F.sum("w").alias("weight"))
    docs = read_documents(spark, f"{path}/documents")
    return docs.join(vectors, "doc_id", "left").select(
        "doc_id", "old_id", "split", "title", "body", F.array_join("topics", "|").alias("topics"),
        "n_terms", "n_tokens", "weight")


def q_corpus_clustered_roundtrip(spark, sf_dir):
    """B1 clustered: documents and labels written as tables of equally many
    buckets by id, and the corpus read from them; attaching the labels moves
    no text."""
    path, name = scratch_path(spark, "clustered"), f"clustered_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for table in ("documents", "labels"):
        write_clustered(read_table(spark, sf_dir, table), f"{name}_{table}", f"{path}/{table}", buckets)
    corpus = corpus_of_tables(read_clustered(spark, f"{name}_documents"), read_clustered(spark, f"{name}_labels"))
    return corpus.withColumn("topics", F.array_join("topics", "|"))


def q_sgml_rejects(spark, sf_dir):
    """A1-A9 on markup with faults and variants, one by ``doc_id mod 10``: 0 a
    title of two lines, 1 no closing line, 2 an id that is no number, 3 a body
    line that begins like a header, 4 bare CR line ends, 5 an id over 32 bits,
    6 a one-line body beside another element, 7 lines before the header, 8 a
    whole header in the middle of a body line and the tag twice in one line, 9
    the tag behind the closing line. One row per document and per reject (with
    the first line of what was rejected)."""
    docs = corpus_view(spark, sf_dir)
    kind = F.pmod(F.col("doc_id"), F.lit(10))
    nl = F.lit("\n")
    new_id = F.when(kind == 2, F.concat(F.lit("x"), F.col("doc_id").cast("string"))) \
        .otherwise((F.col("doc_id") + F.when(kind == 5, F.lit(3_000_000_000)).otherwise(F.lit(0))).cast("string"))
    head = F.concat(F.lit('<REUTERS TOPICS="YES" LEWISSPLIT="'), F.col("split"), F.lit('" CGISPLIT="X" OLDID="'),
                    F.col("old_id").cast("string"), F.lit('" NEWID="'), new_id, F.lit('">'))
    topics = F.concat(F.lit("<TOPICS><D>"), F.array_join("topics", "</D><D>"), F.lit("</D></TOPICS>"))
    title = F.concat(F.lit("<TITLE>T "), F.col("doc_id").cast("string"), F.when(kind == 0, F.lit("\nsecond\n")).otherwise(F.lit("")),
                     F.lit("</TITLE>"))
    one_line = F.concat(F.lit("<DATELINE>D</DATELINE><BODY>"), F.translate("body", "\n", " "), F.lit("</BODY></TEXT>"))
    many = F.concat(F.lit("<BODY>"), F.col("body"), F.when(kind == 3, F.lit("\n<REUTERS note> more"))
                    .when(kind == 8, F.concat(F.lit("\nsee "), head, F.lit("\n<REUTERS<REUTERS\nend"))).otherwise(F.lit("")), F.lit("\n</BODY></TEXT>"))
    value = F.concat(F.when(kind == 7, F.lit('<!DOCTYPE x>\nbefore\n')).otherwise(F.lit("")), head, nl, topics, nl, F.lit("<TEXT>"), nl, title, nl,
                     F.when(kind == 6, one_line).otherwise(many), F.when(kind == 1, F.lit("")).otherwise(F.lit("\n</REUTERS>")),
                     F.when(kind == 9, F.lit("\n<REUTERS trailer>\n x <REUTERS")).otherwise(F.lit("")))
    value = F.when(kind == 4, F.translate(value, "\n", "\r")).otherwise(value)
    path = scratch_path(spark, "sgml-faults")
    docs.select(value.alias("value")).write.text(path)
    corpus = read_sgml(spark, path, glob="part-*", splits=None)
    good = corpus.documents.select(
        "doc_id", "old_id", "split", "title", "body", F.array_join("topics", "|").alias("topics"),
        F.lit(None).cast("string").alias("reason"), F.lit(None).cast("string").alias("first_line"))
    none = [F.lit(None).cast(t).alias(c) for c, t in good.dtypes[:6]]
    bad = corpus.rejects.select(*none, "reason", F.regexp_extract("value", r"^[^\r\n]*", 0).alias("first_line"))
    return good.unionByName(bad)


def q_sgml_ingest_roundtrip(spark, sf_dir):
    """B1 + A1-A9: kept documents written as markup files by the executors,
    read back through the markup source, routed and de-duplicated again."""
    docs = _kept_documents(spark, sf_dir).select(
        "doc_id", "old_id", "split", "title", "body", "topics")
    path = scratch_path(spark, "sgml")
    write_sgml(docs, path)
    corpus = read_sgml(spark, path, glob="part-*", mode="FAILFAST")
    back = R.keep_documents(corpus.documents, order=SgmlCorpus.ORDER, unique=True)
    return back.select("doc_id", "old_id", "split", "title", "body",
                       F.array_join("topics", "|").alias("topics"))


def q_model_roundtrip(spark, sf_dir):
    """B1/B2: the fitted model saved as Parquet, loaded back, and used to
    classify the test documents again."""
    from ..sources.model_store import load_model, save_model
    prepared, fitted = _fitted(spark, sf_dir)
    path = scratch_path(spark, "model")
    save_model(fitted, path)
    model = load_model(spark, path, keep="checkpoint")
    return classify(model, prepared)[1]


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "split_counts": q_split_counts,
    "doc_topics": q_doc_topics,
    "topic_vocab": q_topic_vocab,
    "dedup_last": q_dedup_last,
    "term_freq": q_term_freq,
    "term_freq_ascii": q_term_freq_ascii,
    "term_freq_edge": q_term_freq_edge,
    "term_stats": q_term_stats,
    "corpus_size": q_corpus_size,
    "doc_vectors": q_doc_vectors,
    "doc_vector_maps": q_doc_vector_maps,
    "doc_norms": q_doc_norms,
    "topic_norms": q_topic_norms,
    "centroids": q_centroids,
    "similarities": q_similarities,
    "predictions": q_predictions,
    "topic_ranking": q_topic_ranking,
    "topic_ranking_k": q_topic_ranking_k,
    "predictions_pruned": q_predictions_pruned,
    "true_topic_margin": q_true_topic_margin,
    "hits": q_hits,
    "accuracy": q_accuracy,
    "evaluation_brief": q_evaluation_brief,
    "evaluation_full": q_evaluation_full,
    "evaluation_literal": q_evaluation_literal,
    "report_lines": q_report_lines,
    "report_lines_full": q_report_lines_full,
    "classify_unlabelled": q_classify_unlabelled,
    "corpus_parquet_roundtrip": q_corpus_parquet_roundtrip,
    "corpus_clustered_roundtrip": q_corpus_clustered_roundtrip,
    "sgml_rejects": q_sgml_rejects,
    "sgml_ingest_roundtrip": q_sgml_ingest_roundtrip,
    "model_roundtrip": q_model_roundtrip,
}
