"""Filters on the document relation: split routing, empty bodies, last-wins
de-duplication, typed projections (C1-C3, C5, C7).

Input schema (``documents``): ``doc_id BIGINT, old_id BIGINT, split STRING,
title STRING, body STRING, topics ARRAY<STRING>`` (extra columns pass
through).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The two split tags the reference keeps.
TRAIN = "TRAIN"
TEST = "TEST"
KEPT_SPLITS = (TRAIN, TEST)

# Partitions per core when a source has to be re-spread (see balance).
TASKS_PER_CORE = 2


def route_splits(docs: DataFrame, keep: Sequence[str] = KEPT_SPLITS) -> DataFrame:
    """Keep TRAIN and TEST documents, drop every other split."""
    return docs.where(F.col("split").isin(list(keep)))


def drop_empty_bodies(docs: DataFrame) -> DataFrame:
    """Drop documents whose body is exactly the empty string (whitespace
    bodies stay)."""
    return docs.where(F.col("body") != F.lit(""))


def has_label(topics: Column | str) -> Column:
    """True when the topic list holds at least one non-blank label."""
    col = F.col(topics) if isinstance(topics, str) else topics
    return F.coalesce(F.exists(col, lambda t: t != F.lit("")), F.lit(False))


def train_documents(docs: DataFrame) -> DataFrame:
    """Training documents."""
    return docs.where(F.col("split") == TRAIN)


def test_documents(docs: DataFrame) -> DataFrame:
    """C3 + C7: test documents that carry at least one non-blank topic; only
    these are classified and evaluated (all test documents still count in
    the corpus statistics)."""
    return docs.where((F.col("split") == TEST) & has_label("topics"))


def dedup_last(docs: DataFrame, key: str = "doc_id", order: Sequence[str] = ("old_id",), unique: bool = False) -> DataFrame:
    """Exactly one row for every ``key``: the one that comes last in
    ``order`` (later documents replace earlier ones). Rows that tie in ``order``
    are ordered by a hash of all their columns, and of rows that are equal in
    every column one stays.

    ``unique``: no two rows of a key are equal in ``order``, because it ends in
    a place that the source gives its rows (file, block and row). ``order`` then
    points at the winning row, and the input is read twice: once for
    the narrow ``(key, order)``, once to take the rows that are pointed at.

    Only the narrow projection is aggregated: partial aggregates fold every
    copy of a key (however hot) into one row per task before the exchange.
    Keys that occur more than once, with their winner, form the other side of
    a left join on the key; nothing runs while the plan is built, so whether
    that side is broadcast is left to adaptive execution, which also splits the
    partition of a hot key. If it is not, the rows are shuffled once.
    """
    cols = docs.columns
    places = [F.col(c) for c in order]
    o = F.struct(*places) if unique else F.struct(*places, F.xxhash64(*[F.col(c) for c in cols]).alias("_hash"))
    marked = docs.withColumn("_order", o)
    if unique:
        winners = (marked.groupBy(F.col(key).alias("_key")).agg(F.max("_order").alias("_winner"), F.count(F.lit(1)).alias("_copies"))
                   .where(F.col("_copies") > 1).select("_key", "_winner"))
    else:
        winners = (
            marked.groupBy(key, "_order").agg(F.count(F.lit(1)).alias("_n"))
            .groupBy(F.col(key).alias("_key"))
            .agg(F.max(F.struct("_order", "_n")).alias("_last"), F.sum("_n").alias("_copies"))
            .where(F.col("_copies") > 1)
            .select("_key", F.col("_last._order").alias("_winner"), F.col("_last._n").alias("_equal"))
        )
    joined = marked.join(winners, F.col(key).eqNullSafe(F.col("_key")), "left")
    kept = joined.where(F.col("_winner").isNull() | (F.col("_order") == F.col("_winner")))
    if unique:
        return kept.select(*cols)
    single = kept.where(F.col("_equal").isNull() | (F.col("_equal") == 1))
    # rows equal in all columns: a partial aggregate per task folds them, too
    equal = kept.where(F.col("_equal") > 1).dropDuplicates([key])
    return single.unionByName(equal).select(*cols)


def keep_documents(docs: DataFrame, order: Sequence[str] = ("old_id",),
                   keep: Sequence[str] = KEPT_SPLITS, unique: bool = False) -> DataFrame:
    """C1 + C2 + C5 in the reference's order: unused splits and empty bodies
    never take part in the last-wins de-duplication."""
    return dedup_last(drop_empty_bodies(route_splits(docs, keep)), order=order, unique=unique)


def balance(docs: DataFrame, keys: str | Sequence[str] = "doc_id", partitions: int | None = None) -> DataFrame:
    """Spread documents over the cluster when the source cannot keep every
    core busy, and leave it alone otherwise.

    A source whose size is under cores x ``spark.sql.files.maxPartitionBytes`` is
    spread (Catalyst's estimate, or that of all the tables it reads if that is less, for
    a join is estimated as the product of its sides): a small file with one large
    row group has several splits, but only one of them holds rows, so tokenising
    it would use one core. Re-spreading small data is cheap. A larger source
    keeps its own splits, so no text is shuffled for nothing. Nothing runs here.

    Hash partitioning uses all of ``keys``; give the reading order as well as
    the id when ids may repeat, so that copies of one id spread out.
    """
    spark = docs.sparkSession
    cores = spark.sparkContext.defaultParallelism
    size = source_bytes(docs)
    if size >= cores * split_bytes(spark):
        return docs
    # two tasks per core: documents differ widely in length, and smaller
    # tasks let the scheduler even out the load
    cols = [keys] if isinstance(keys, str) else list(keys)
    return docs.repartition(partitions or TASKS_PER_CORE * cores, *cols)


def source_bytes(docs: DataFrame) -> int:
    """Catalyst's estimate of ``docs``, no more than that of the tables it reads."""
    plan = docs._jdf.queryExecution().optimizedPlan()
    leaves, tables = plan.collectLeaves(), 0
    for i in range(leaves.size()):
        tables += int(str(leaves.apply(i).stats().sizeInBytes()))
    return min(int(str(plan.stats().sizeInBytes())), tables)


def split_bytes(spark: SparkSession) -> int:
    """``spark.sql.files.maxPartitionBytes`` in bytes."""
    text = spark.conf.get("spark.sql.files.maxPartitionBytes").strip().lower().removesuffix("b")
    unit = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}.get(text[-1:], 1)
    return int(text.rstrip("kmgt")) * unit
