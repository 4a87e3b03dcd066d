"""Skew-safe equi-join of a large fact relation to a keyed table.

Term-keyed joins are where this workload concentrates: a frequent term can
appear in a third of all documents, and a plain shuffle join on ``term``
would send all of those postings to one task.

The keyed table carries, per key, an upper bound ``freq`` on how many fact
rows hold that key (for terms: the document frequency); a key may have several
table rows. When the whole table fits the byte budget, it is broadcast and
nothing is shuffled. Otherwise there is one shuffle join on ``(key, salt)``: a
key of more than ``task_rows`` fact rows is split into ``ceil(freq /
task_rows)`` salts, its fact rows are dealt to them by a hash of the row, and
its table rows are repeated for each. So a task gets about ``task_rows`` rows
of a key at most, whatever the size of the data and of the table's rows.

Which keys are split, and into how many salts, is a broadcast of 16 bytes a
key. There are at most ``sum(freq) / task_rows`` of them; ``task_rows`` is
raised, if need be, until that many fit the byte budget.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_BROADCAST_BYTES = 64 << 20
DEFAULT_MAX_BROADCAST_ROWS = 1_000_000   # for tables whose rows are a few dozen bytes
DEFAULT_TASK_ROWS = 1_000_000            # fact rows of one key that one task may get
ROW_OVERHEAD = 32                        # per-row bookkeeping in a broadcast hash relation
SALT_ROW_BYTES = 16 + ROW_OVERHEAD       # hash of the key and its number of salts


@dataclass(frozen=True)
class SplitPlan:
    """How a keyed table meets its facts in :func:`skew_safe_join`."""

    total_freq: int
    total_bytes: int
    broadcast_all: bool
    task_rows: int


def string_bytes(c: Column) -> Column:
    return F.coalesce(F.octet_length(c), F.lit(0))


def split_plan_of(total_freq: int, total_bytes: int, max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
                  task_rows: int = DEFAULT_TASK_ROWS) -> SplitPlan:
    """From measured sizes: broadcast the table if it fits; else the least
    ``task_rows`` (not below the one given) whose split keys fit."""
    fits = math.ceil(total_freq * SALT_ROW_BYTES / max(1, max_broadcast_bytes))
    return SplitPlan(total_freq, total_bytes, total_bytes <= max_broadcast_bytes, max(task_rows, fits))


def plan_split(table: DataFrame, freq: str, row_bytes: Column,
               max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
               task_rows: int = DEFAULT_TASK_ROWS) -> SplitPlan:
    """One aggregate over the keyed table (total frequency and size) and the
    resulting plan."""
    row = table.agg(F.sum(F.col(freq)).alias("s"), F.sum(row_bytes + F.lit(ROW_OVERHEAD)).alias("b")).first()
    return split_plan_of(int(row["s"] or 0), int(row["b"] or 0), max_broadcast_bytes, task_rows)


def salted_sides(facts: DataFrame, table: DataFrame, key: str, freq: str, plan: SplitPlan) -> tuple[DataFrame, DataFrame]:
    """Both sides with a ``_salt``, for a join on ``(key, _salt)``."""
    hot = (table.where(F.col(freq) > plan.task_rows)
           .groupBy(F.xxhash64(key).alias("_hot"))
           .agg(F.max(F.ceil(F.col(freq) / F.lit(plan.task_rows))).cast("int").alias("_salts")))
    n = F.coalesce("_salts", F.lit(1))
    dealt = (facts.withColumn("_row", F.xxhash64(*facts.columns))
             .join(F.broadcast(hot), F.xxhash64(key) == F.col("_hot"), "left")
             .withColumn("_salt", F.pmod("_row", n).cast("int")).select(*facts.columns, "_salt"))
    repeated = (table.join(F.broadcast(hot), F.xxhash64(key) == F.col("_hot"), "left")
                .withColumn("_salt", F.explode(F.sequence(F.lit(0), n - 1))).select(*table.columns, "_salt"))
    return dealt, repeated


def skew_safe_join(facts: DataFrame, table: DataFrame, key: str, freq: str,
                   plan: SplitPlan | None = None, row_bytes: Column | None = None,
                   max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
                   task_rows: int = DEFAULT_TASK_ROWS) -> DataFrame:
    """Inner join ``facts`` to ``table`` on ``key``.

    Output columns: ``key``, the other columns of ``facts``, then the other
    columns of ``table`` (``freq`` included). Give either a ``plan`` or the
    ``row_bytes`` expression to make one.
    """
    if plan is None:
        if row_bytes is None:
            raise ValueError("skew_safe_join needs a plan or a row size expression")
        plan = plan_split(table, freq, row_bytes, max_broadcast_bytes, task_rows)
    if plan.broadcast_all:
        return facts.join(F.broadcast(table), on=key, how="inner")
    dealt, repeated = salted_sides(facts, table, key, freq, plan)
    return dealt.join(repeated, on=[key, "_salt"], how="inner").drop("_salt")
