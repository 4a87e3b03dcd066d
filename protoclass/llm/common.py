"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager, nullcontext

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from protoclass.session import scratch_path

#: Words of a text: runs of anything but space and the ASCII controls 9 to 13.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
WORDS = re.compile(WORD_PATTERN)

#: A side is broadcast only when its counted rows times its row width stay below this.
BROADCAST_BYTES = 32 << 20

#: Whole texts that Spark hands a Python worker in one Arrow batch at most.
TEXTS_A_BATCH = 512
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def text_batches(spark: SparkSession) -> Iterator[None]:
    """What runs within hands Python workers ``TEXTS_A_BATCH`` rows at a time.
    A batch stands outside the heap, in buffers that double as they fill, and
    once more in the worker; by the default of 10,000 rows a task's texts are one batch."""
    before = spark.conf.get(_BATCH_ROWS, None)
    if not 0 < int(spark.conf.get(_BATCH_ROWS)) <= TEXTS_A_BATCH:
        spark.conf.set(_BATCH_ROWS, str(TEXTS_A_BATCH))
    try:
        yield
    finally:
        spark.conf.unset(_BATCH_ROWS) if before is None else spark.conf.set(_BATCH_ROWS, before)


def written(df: DataFrame, name: str, texts: bool = False) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts the
    lineage, survives lost executors, and is computed only once. ``texts``:
    Python workers read whole texts for it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with text_batches(spark) if texts else nullcontext():
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """``df`` marked for broadcast if its counted size is within the bound,
    else unchanged (a shuffle join, whose hot keys adaptive execution splits)."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def width(value: Column, kind: T.DataType) -> Column:
    """Bytes that a value takes up, about: fixed fields 8 (decimals 16), and what strings, binaries and arrays hold."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)) + 16
    if isinstance(kind, T.StructType):
        return sum((width(value.getField(f.name), f.dataType) for f in kind.fields), F.lit(8))
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, (T.StringType, T.BinaryType, T.StructType, T.ArrayType)):
            each = F.transform(value, lambda x: width(x, kind.elementType).cast("bigint"))
            return F.coalesce(F.aggregate(each, F.lit(0).cast("bigint"), lambda a, b: a + b), F.lit(0)) + 16
        return F.coalesce(F.size(value), F.lit(0)) * 8 + 16
    return F.lit(16 if isinstance(kind, T.DecimalType) else 8)


def broadcast_if_fits(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if its rows, measured in one aggregate, are
    within the bound, else unchanged (a shuffle join, whose hot keys adaptive
    execution splits). ``df`` should be written, or cheap to compute twice."""
    row = width(F.struct(*(F.col(f"`{c}`") for c in df.columns)), df.schema) + 32
    size = df.agg(F.sum(row)).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def same(left: Iterable[Column], right: Iterable[Column]) -> Column:
    """Null-safe equality of two lists of columns."""
    out = F.lit(True)
    for a, b in zip(left, right, strict=True):
        out = out & a.eqNullSafe(b)
    return out


#: How to empty each operator's cache in this Python worker.
CACHES: dict[str, Callable[[], None]] = {}


def in_worker(name: str, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for ``mapInArrow``. Spark hands a worker from one operator to the
    next: what others have cached in it goes first, and what Arrow has pooled
    goes back in the end."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for other, empty in CACHES.items():
            if other != name:
                empty()
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return wrapped


def packed(docs: DataFrame, **keys: Column) -> DataFrame:
    """All columns of ``docs`` in one struct ``row``, beside key columns: names
    of theirs can't clash with what an operator adds. ``select("row.*")`` undoes it."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), *(key.alias(name) for name, key in keys.items()))


def prefix_sums(df: DataFrame, group: list[str], order: list[Column], value: str, out: str, name: str) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over all rows before this one in its
    group, in the given order.

    The rows are range-partitioned by group and order together, so a hot group
    spreads over many partitions; only one total for each partition and group
    is combined across them. Rows that tie in the whole order are taken in any
    order, so ``order`` should end in a hash of the row. The placed rows are
    written once, because the place of a row must not change; keep ``df``
    narrow and cheap to read twice (the range sampler reads it too).
    """
    spark = df.sparkSession
    n = shuffle_partitions(spark)
    keys = [F.col(g).asc_nulls_last() for g in group]
    ranged = df.repartitionByRange(n, *keys, *order).sortWithinPartitions(*keys, *order)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, total = None, 0
        for b in batches:
            if not b.num_rows:
                continue
            v = b.column(value).to_numpy(zero_copy_only=False).astype(np.int64)
            cols = [b.column(g).to_pylist() for g in group]
            before = np.empty(len(v), np.int64)
            starts = [0] + [i for i in range(1, len(v)) if any(c[i] != c[i - 1] for c in cols)]
            for a, z in zip(starts, starts[1:] + [len(v)]):
                key = tuple(c[a] for c in cols)
                if key != last:
                    last, total = key, 0
                run_sum = np.cumsum(v[a:z])
                before[a:z] = total + run_sum - v[a:z]
                total += int(run_sum[-1])
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(before), pa.array(np.full(len(v), part, np.int64))],
                names=[*b.schema.names, "_before", "_part"])

    placed = written(ranged.mapInArrow(in_worker("prefix_sums", run), f"{schema}, _before bigint, _part bigint"), name)
    totals = placed.groupBy(*group, "_part").agg(F.sum(value).alias("_sum"))
    w = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("_part").alias("_p"),
                            F.coalesce(F.sum("_sum").over(w), F.lit(0)).alias("_offset"))
    on = same([F.col(g) for g in group] + [F.col("_part")], [F.col(f"_g{i}") for i in range(len(group))] + [F.col("_p")])
    return (placed.join(broadcast_if_fits(offsets), on)
            .withColumn(out, F.col("_before") + F.col("_offset"))
            .drop("_before", "_offset", "_part", "_p", *[f"_g{i}" for i in range(len(group))]))
