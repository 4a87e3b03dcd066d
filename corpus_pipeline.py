"""The corpus pipeline: quality rules, near duplicates, decontamination, mixing, token files.

Every stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and
returns the rows that it keeps with the columns of ``documents``; the last
returns one row for each document of the token files. A stage's result is
written as Parquet and read again as the next one's ``docs``.

Defined results, for all stages: an empty table gives no rows; whole texts are
read, whatever their length; a null ``doc_id`` is an id of its own, null
``lang`` and ``source`` are groups of their own; further columns, whatever their
names, pass through untouched up to the last stage, which returns columns of its
own. What a stage does with null and empty texts, ties and repeated rows stands
at its function.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from protoclass.llm.chosen_path import one_of_each
from protoclass.llm.common import table, written
from protoclass.llm.quality_rules import quality_rules
from protoclass.llm.source_mix import mixed_documents
from protoclass.llm.spaced_seeds import decontaminated
from protoclass.llm.token_files import token_ids


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the outlier test pass. Null and empty
    texts fail the base rules and go; repeated rows share their verdict."""
    return quality_rules(docs)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one of the least id,
    ties by a hash of the text; of repeated rows one stays. Null and empty texts
    are near nothing and stay."""
    return one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no item of ``benchmark``. Null and empty texts
    overlap nothing and stay; repeated rows go or stay together; an empty
    ``benchmark`` takes none away."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: whole documents, as often as their source's target takes them.
    Null and empty texts have no words and are not taken; repeated rows are
    documents of their own; ties in the hash go by id."""
    return mixed_documents(docs)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix; the digests read from them. A null or empty text
    has the end id alone; null ids come first; repeated rows each get a row."""
    return token_ids(docs)


STAGES = [
    ("quality_rules", keep_quality),
    ("chosen_path_join", keep_one_of_each),
    ("spaced_seed_decontamination", drop_contaminated),
    ("source_mix", mix_sources),
    ("token_files", write_token_ids),
]

#: The outlier test has no SQL form; the pipeline is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
