"""Document relation from the driver's tables (``documents`` + ``labels``).

This only reshapes the given tables into the ``documents`` schema the
operators expect; it does none of the pipeline's work:

* ``split``: the newswire format's split tag, assigned from ``doc_id``
  (last digit 0-6 TRAIN, 7-8 TEST, 9 NOT-USED) so that the split routing
  operator has three kinds of input to route;
* ``topics``: ``lang-<lang>``, plus ``quality-high`` / ``quality-low`` and
  ``toxic`` when the document has a label row (multi-label, like the
  newswire topics);
* ``title`` is empty (the tables carry none), ``old_id`` = ``doc_id``;
* ``file``, ``row``: where the row stands in the table (on request), so that a
  reading order that ends in them ties nowhere (``ORDER``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.routing import TEST, TRAIN

NOT_USED = "NOT-USED"

DOCUMENT_COLUMNS = ("doc_id", "old_id", "split", "title", "body", "topics")
ORDER = ("old_id", "file", "row")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def split_of(doc_id: F.Column) -> F.Column:
    digit = F.pmod(doc_id, F.lit(10))
    return F.when(digit < 7, F.lit(TRAIN)).when(digit < 9, F.lit(TEST)).otherwise(F.lit(NOT_USED))


def corpus_view(spark: SparkSession, sf_dir: str, places: bool = False) -> DataFrame:
    """All rows of ``documents`` in the ``documents`` schema (see module doc)."""
    docs = read_table(spark, sf_dir, "documents")
    if places:
        docs = docs.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return corpus_of_tables(docs, read_table(spark, sf_dir, "labels"), ["file", "row"] if places else [])


def corpus_of_tables(docs: DataFrame, labels: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """The ``documents`` relation of a table of documents and one of labels;
    ``more``: columns of the documents to pass through."""
    labels = labels.select("doc_id", "quality", "toxic")
    quality = (F.when(F.col("quality") == 1, F.lit("quality-high"))
               .when(F.col("quality") == 0, F.lit("quality-low")))
    toxic = F.when(F.col("toxic") == 1, F.lit("toxic"))
    topics = F.array_compact(F.array(F.concat(F.lit("lang-"), F.col("lang")), quality, toxic))
    return (docs.join(labels, on="doc_id", how="left")
            .select(F.col("doc_id"), F.col("doc_id").alias("old_id"), split_of(F.col("doc_id")).alias("split"),
                    F.lit("").alias("title"), F.col("text").alias("body"), topics.alias("topics"), *more))
