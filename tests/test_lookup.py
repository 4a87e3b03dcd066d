"""Skew-safe keyed join: hot keys broadcast, cold keys shuffled."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from protoclass.operators.lookup import (DEFAULT_TASK_ROWS, SALT_ROW_BYTES, plan_split, salted_sides, skew_safe_join,
                                         split_plan_of, string_bytes)


def _data(spark):
    # one key holds a third of all fact rows
    facts = spark.range(0, 9000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 700).cast("string")))
        .alias("term"), F.col("id").alias("doc_id"))
    table = facts.groupBy("term").agg(F.count("*").alias("df")).withColumn("payload", F.length("term"))
    return facts, table


def row_bytes():
    return string_bytes(F.col("term")) + F.lit(16)


def test_plan_bounds_broadcast_bytes(spark):
    facts, table = _data(spark)
    budget = 50 * 40
    plan = plan_split(table, "df", row_bytes(), max_broadcast_bytes=budget, task_rows=10)
    assert plan.total_freq == 9000 and not plan.broadcast_all and plan.task_rows > 10
    assert table.where(F.col("df") > plan.task_rows).count() * SALT_ROW_BYTES <= budget
    # the task's budget does not grow with the table's rows or their number of topics
    assert split_plan_of(10**9, 10**12).task_rows == DEFAULT_TASK_ROWS


def test_whole_table_broadcast_when_it_fits(spark):
    facts, table = _data(spark)
    assert plan_split(table, "df", row_bytes(), max_broadcast_bytes=1 << 30).broadcast_all


def test_split_join_equals_plain_join(spark):
    facts, table = _data(spark)
    for several in (table, table.withColumn("topic", F.explode(F.array(*map(F.lit, "abc"))))):
        plain = sorted(tuple(r) for r in facts.join(several, "term").select(*facts.columns, *several.columns[1:]).collect())
        for budget, rows in ((1 << 30, 100), (50 * 40, 100), (20_000, 5), (100, 7)):
            joined = skew_safe_join(facts, several, key="term", freq="df", row_bytes=row_bytes(), max_broadcast_bytes=budget, task_rows=rows)
            assert sorted(tuple(r) for r in joined.select(*facts.columns, *several.columns[1:]).collect()) == plain


@pytest.mark.parametrize("topics", [7, 1000])
def test_a_term_of_every_document_is_spread(spark, topics):
    facts = spark.range(0, 20_000).select(F.lit("everywhere").alias("term"), F.col("id").alias("doc_id"))
    table = spark.range(topics).select(F.lit("everywhere").alias("term"), F.lit(20_000).cast("bigint").alias("df"), F.concat(F.lit("topic name "), "id").alias("topic"))
    plan = split_plan_of(20_000, 1 << 40, task_rows=1000)
    dealt, repeated = salted_sides(facts, table, "term", "df", plan)
    most = dealt.groupBy("term", "_salt").count().agg(F.max("count"), F.count("*")).first()
    assert most[1] == 20 and most[0] < 1.25 * plan.task_rows
    assert repeated.count() == 20 * topics
