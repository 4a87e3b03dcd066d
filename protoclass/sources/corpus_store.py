"""B1 as Parquet: documents by split, document vectors, and tables clustered by
document id, and back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_documents(docs: DataFrame, path: str) -> None:
    """Documents in one folder for each split, so a reader of one split lists
    and scans only that."""
    docs.write.mode("errorifexists").partitionBy("split").parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_clustered(rows: DataFrame, table: str, path: str, buckets: int, key: str = "doc_id") -> None:
    """``rows`` as an external table of this session's catalog under ``path``, in
    ``buckets`` buckets by ``key``, sorted inside. Tables with equally many buckets
    are joined on the key without an exchange: what is attached to documents later
    (labels, vectors) never moves their text again. The rows are shuffled once,
    here, so that every bucket is one file; choose ``buckets`` so that one fits a
    task (total bytes over ``spark.sql.files.maxPartitionBytes``)."""
    dealt = rows.repartition(int(buckets), key).sortWithinPartitions(key)
    dealt.write.bucketBy(int(buckets), key).sortBy(key).option("path", path).mode("errorifexists").format("parquet").saveAsTable(table)


def register_clustered(spark: SparkSession, table: str, path: str, schema: str, buckets: int, key: str = "doc_id") -> None:
    """Makes a clustered table that another session has written known to this one."""
    spark.sql(f"CREATE TABLE {table} ({schema}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) INTO {int(buckets)} BUCKETS LOCATION '{path}'")


def read_clustered(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def write_vectors(vectors: DataFrame, path: str) -> None:
    """``(doc_id, split, term, tf, w)`` rows, one folder for each split."""
    vectors.select("doc_id", "split", "term", "tf", "w").write.mode("errorifexists").partitionBy("split").parquet(path)


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
