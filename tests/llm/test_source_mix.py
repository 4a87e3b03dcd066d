import re
from collections import Counter

import numpy as np
import pytest
from helpers import clashing, documents, prose
from pyspark.sql import Row
from pyspark.sql import functions as F

from protoclass.llm import source_mix
from protoclass.llm.queries import QUERIES
from protoclass.llm.source_mix import MAX_BLOCKS, MOST, PRIMES, SHARE, mix, mixed_documents

SF = "/root/testdata/sf0.001"


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, target, open_ = SHARE * sum(sizes.values()), {}, [s for s in names if sizes[s]]
    while open_:
        left = total - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] >= MOST * sizes[s]]
        if not over:
            target.update(share)
            break
        target.update({s: MOST * sizes[s] for s in over})
        open_ = [s for s in open_ if s not in over]
    return {s: target.get(s, 0.0) for s in names}


def check(rows):
    sizes, taken = Counter(), Counter()
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert 0 <= r.taken <= MOST * r.size
    want = brute_targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source], rel=1e-9)
    assert_near(taken, want, rows)
    return want


def assert_near(taken, want, rows):
    """Documents are whole: a source is off by half of its longest one at most."""
    longest = Counter()
    for r in rows:
        longest[r.source] = max(longest[r.source], r.size)
        assert not r.size or r.taken % r.size == 0
    for s in want:
        assert abs(taken[s] - want[s]) <= longest[s] / 2 + 0.51


def table(spark):
    rows = [(i, prose(i, 5 + (i * 37) % 400), "en", ["hot", "hot", "hot", "a", "b", "c", None][i % 7]) for i in range(210)]
    rows += [(1000, None, "en", "a"), (1001, "", "en", "void"), (None, prose(8, 30), "en", "b"), (1002, prose(9, 30_000), "en", "c")]
    return documents(spark, rows + [(3, prose(3, 116), "en", "a")] * 2 + [(2000, prose(4, 50), "en", "hot")] * 40)


def test_targets_taken_and_reruns(spark):
    rows = mix(table(spark))[0].collect()
    check(rows)
    again = mix(table(spark).repartition(5))[0].collect()
    key = lambda r: (str(r.doc_id), r.size, r.taken, str(r.source))
    assert sorted(map(key, rows)) == sorted(map(key, again))


def test_shards_hold_their_exact_quotas(spark):
    shards = 8
    pieces = mix(table(spark), shards=shards)[1].collect()
    per = Counter(r.shard for r in pieces for _ in range(r.size))
    assert set(per) <= set(range(shards)) and len(per) == shards
    # Every shard has a part of the largest source.
    assert {r.shard for r in pieces if r.source == "c"} == set(range(shards)) or len({r.shard for r in pieces if r.source == "hot"}) == shards


def test_primes_are_above_every_number_of_blocks():
    assert all(p > MAX_BLOCKS and all(p % d for d in range(2, 40_000) if d * d <= p) for p in PRIMES[:2])
    for n in (1, 2, 12, 97, 1000):
        for p in PRIMES:
            assert len(set((np.arange(n) * p + 5) % n)) == n


def test_mixed_documents_are_what_was_taken(spark):
    docs = clashing(table(spark), "_t", "_takes", "t", "i", "row", "h", "size", "_m", "shard")
    out = mixed_documents(docs)
    assert out.columns == docs.columns
    got, want = Counter(), Counter()
    texts = {(r.doc_id, r.text) for r in docs.collect()}
    for r in out.collect():
        assert r.n_chars == len(r.text or "") and r.shard == "own shard"
        assert (r.doc_id, r.text) in texts
        got[r.source] += words(r.text)
    for r in mix(docs)[0].collect():
        want[r.source] += r.taken
    assert got == +want


def test_empty_tables(spark):
    assert mix(documents(spark, []))[0].count() == 0 and mixed_documents(documents(spark, [])).count() == 0
    rows = mix(documents(spark, [(1, ""), (2, None)]))[0].collect()
    assert [r.taken for r in rows] == [0, 0]


def test_query_on_whole_table(spark):
    rows = {r.doc_id: r for r in QUERIES["op3_source_mix"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    sizes, taken = Counter(), Counter()
    for d in docs:
        assert rows[d.doc_id].size == words(d.text)
        sizes[d.source] += words(d.text)
        taken[d.source] += rows[d.doc_id].taken
    want = brute_targets(sizes)
    for d in docs:
        assert rows[d.doc_id].target == pytest.approx(want[d.source])
    assert_near(taken, want, [Row(source=d.source, size=rows[d.doc_id].size, taken=rows[d.doc_id].taken) for d in docs])


def test_a_tasks_texts_do_not_grow_with_the_mix(spark, monkeypatch):
    rows = [(i, prose(i, 200), "en", f"s{i % 5}") for i in range(400)]
    monkeypatch.setattr(source_mix, "task_words", lambda spark: 2000)
    monkeypatch.setattr(source_mix, "MAX_SHARDS", 7)
    docs = documents(spark, rows)
    out = mixed_documents(docs)
    per = out.groupBy(F.spark_partition_id()).agg(F.sum(F.size(F.split("text", r"\s+"))).alias("n")).collect()
    assert len(per) > 40 and max(r.n for r in per) < 8000
    total = sum(r.taken for r in mix(docs)[0].collect())
    assert sum(r.n for r in per) == total


def test_many_leaf_ranges_are_looked_through_in_two_steps(spark, monkeypatch):
    whole = sorted(map(tuple, mix(table(spark), shards=40)[1].select("doc_id", "h", "round", "shard").collect()), key=str)
    monkeypatch.setattr(source_mix, "RANGES_AT_ONCE", 3)
    assert whole == sorted(map(tuple, mix(table(spark), shards=40)[1].select("doc_id", "h", "round", "shard").collect()), key=str)
