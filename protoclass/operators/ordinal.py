"""Row numbers over a whole relation without a one-partition window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def with_ordinal(df: DataFrame, order: Sequence[str | Column], out: str) -> DataFrame:
    """Adds ``out``: the row's place (from 1) in ``order``.

    Rows are range-partitioned by ``order`` and written once, numbered inside
    their partition, and shifted by the rows of the partitions before: one
    count for each partition, as many as shuffle partitions, is all that meets
    in one task.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id())
    placed = materialize(placed, "checkpoint")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return (placed.join(F.broadcast(shifts), "_part")   # a row per partition
            .withColumn(out, (inside + F.col("_shift")).cast("bigint"))
            .drop("_part", "_shift"))
