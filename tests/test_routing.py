"""Split routing, empty bodies, last-wins de-duplication, labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpus_rows import make_docs
from protoclass.operators import labels as L
from protoclass.operators import routing as R


def test_routing_and_empty_bodies(spark):
    docs = make_docs(spark, [
        (1, "TRAIN", "x", ["a"]), (2, "TEST", "y", ["b"]), (3, "NOT-USED", "z", ["a"]),
        (4, "TRAIN", "", ["a"]), (5, "TEST", " ", ["b"]),
    ])
    kept = sorted(r["doc_id"] for r in R.keep_documents(docs).collect())
    assert kept == [1, 2, 5]                      # whitespace bodies stay


def test_dedup_last_wins_and_empty_never_replaces(spark):
    docs = make_docs(spark, [
        (7, "TRAIN", "first", ["a"], 1), (7, "TEST", "second", ["b"], 2), (7, "TRAIN", "", ["c"], 3),
        (8, "TRAIN", "only", ["a"], 4),
    ])
    got = sorted((r["doc_id"], r["old_id"], r["body"]) for r in R.keep_documents(docs).collect())
    assert got == [(7, 2, "second"), (8, 4, "only")]


def without_broadcast(spark, run):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        return run()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_dedup_shuffle_path_equals_broadcast_path(spark):
    rows = [(i % 5, "TRAIN", f"body {i}", ["a"], i) for i in range(60)]
    docs = make_docs(spark, rows)
    a = sorted(tuple(r) for r in R.dedup_last(docs).collect())
    b = without_broadcast(spark, lambda: sorted(tuple(r) for r in R.dedup_last(docs).collect()))
    assert a == b and [r[0] for r in a] == [0, 1, 2, 3, 4]
    assert [r[1] for r in a] == [55, 56, 57, 58, 59]


def test_dedup_hot_key_third_of_rows(spark):
    hot = [(0, "TRAIN", f"copy {i}", ["a"], i) for i in range(300)]
    cold = [(i, "TRAIN", f"doc {i}", ["a"], 1000 + i) for i in range(1, 601)]
    docs = make_docs(spark, hot + cold).repartition(8)
    out = R.dedup_last(docs)
    got = {r["doc_id"]: r["old_id"] for r in out.collect()}
    assert len(got) == 601 and got[0] == 299
    # the id aggregate combines map-side: no task receives the 300 copies
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan


def test_dedup_leaves_one_row_of_tied_and_equal_copies(spark):
    tied = [(1, "TRAIN", "a", ["t"], 1), (1, "TRAIN", "b", ["t"], 1), (2, "TEST", "c", ["t"], 5)]
    equal = [(3, "TRAIN", "same", ["t"], 2)] * 400 + [(None, "TRAIN", "no id", ["t"], 2)] * 2
    docs = make_docs(spark, tied + equal).repartition(6)
    for got in (R.dedup_last(docs).collect(), without_broadcast(spark, lambda: R.dedup_last(docs).collect())):
        assert sorted(str(r["doc_id"]) for r in got) == ["1", "2", "3", "None"]
    assert L.doc_topics(R.keep_documents(docs)).where("doc_id = 3").count() == 1


def jobs_of(spark, build):
    """Spark jobs that run while ``build`` builds its plan."""
    spark.sparkContext.setJobGroup("building", "plan only")
    try:
        build()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup("building"))
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_building_the_plan_runs_nothing(spark, workdir):
    make_docs(spark, [(i % 7, "TRAIN", f"x {i}", ["a"], i) for i in range(40)]).write.parquet(workdir + "/docs")
    docs = spark.read.parquet(workdir + "/docs")
    joined = docs.join(docs.select("doc_id").distinct(), "doc_id")
    assert jobs_of(spark, lambda: R.keep_documents(joined)) == 0
    assert jobs_of(spark, lambda: R.balance(joined)) == 0


def test_test_documents_need_a_label(spark):
    docs = make_docs(spark, [
        (1, "TEST", "x", ["", "a"]), (2, "TEST", "y", [""]), (3, "TEST", "z", []), (4, "TEST", "w", None),
    ])
    assert sorted(r["doc_id"] for r in R.test_documents(docs).collect()) == [1]


def test_edges_and_vocabulary(spark):
    docs = make_docs(spark, [
        (1, "TRAIN", "x", ["a", "a", ""]), (2, "TRAIN", "y", ["a", "b"]), (3, "TRAIN", "z", []),
        (4, "TEST", "w", ["a", "c"]), (5, "TEST", "v", [""]),
    ])
    edges = sorted(tuple(r) for r in L.doc_topics(docs).collect())
    assert edges == [(1, "TRAIN", "a"), (2, "TRAIN", "a"), (2, "TRAIN", "b"), (4, "TEST", "a"), (4, "TEST", "c")]
    vocab = {r["topic"]: r["n_train"] for r in L.topic_vocabulary(docs).collect()}
    assert vocab == {"a": 2, "b": 1}              # test-only topic c is not in the vocabulary


def test_balance_spreads_small_or_narrow_inputs_only(spark, workdir):
    cores = spark.sparkContext.defaultParallelism
    target = R.TASKS_PER_CORE * cores
    make_docs(spark, [(i, "TRAIN", "x", ["a"]) for i in range(40)]).repartition(cores + 3) \
        .write.parquet(workdir + "/docs")
    docs = spark.read.parquet(workdir + "/docs")        # a file scan: Catalyst knows its size
    one = docs.coalesce(1)
    assert R.balance(one).rdd.getNumPartitions() == target          # too few partitions
    many = docs.repartition(cores + 3)
    assert R.balance(many).rdd.getNumPartitions() == target         # small input: re-spread
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1")        # now the input counts as large
    try:
        assert R.balance(many).rdd.getNumPartitions() == cores + 3   # left alone
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert R.balance(one).agg(F.count("*")).first()[0] == 40


def placed_docs(spark, workdir, rows):
    make_docs(spark, rows).repartition(5).write.parquet(workdir + "/placed")
    docs = spark.read.parquet(workdir + "/placed")
    return docs.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


def test_dedup_by_places_reads_twice_and_shuffles_once(spark, workdir):
    rows = [(i // 2 if i < 200 else i, "TRAIN", f"copy {i % 7}", ["a"], i % 3) for i in range(400)]
    rows += [(0, "TRAIN", "hot", ["a"], 2)] * 150 + [(None, "TRAIN", "no id", ["t"], 2)] * 2
    docs = placed_docs(spark, workdir, rows)
    order = ("old_id", "file", "row")
    want = {}
    for r in docs.collect():
        if r["doc_id"] not in want or (r["old_id"], r["file"], r["row"]) > want[r["doc_id"]][:3]:
            want[r["doc_id"]] = (r["old_id"], r["file"], r["row"], r["body"])
    for run in (lambda f: f(), lambda f: without_broadcast(spark, f)):
        def check():
            out = R.dedup_last(docs, order=order, unique=True)
            got = out.collect()
            assert len(got) == len(want) and {r["doc_id"]: (r["old_id"], r["file"], r["row"], r["body"]) for r in got} == want
            return out._jdf.queryExecution().sparkPlan().toString()

        assert run(check).count("FileScan") == 2
    plan = without_broadcast(spark, lambda: R.dedup_last(docs, order=order, unique=True)._jdf.queryExecution().executedPlan().toString())
    # two exchanges of narrow rows (the aggregate's, and the winners' by the null-safe key), one of the rows themselves
    assert plan.count("Exchange hashpartitioning") == 3
    assert jobs_of(spark, lambda: R.keep_documents(docs, order=order, unique=True)) == 0


def test_balance_measures_a_join_by_its_tables(spark, workdir):
    """A join is estimated as the product of its sides, which left small corpora with labels in one task."""
    make_docs(spark, [(i, "TRAIN", f"x {i}", ["a"]) for i in range(400)]).coalesce(1).write.parquet(workdir + "/docs")
    docs = spark.read.parquet(workdir + "/docs")
    joined = docs.join(docs.select("doc_id", F.lit(1).alias("quality")), "doc_id", "left")
    tables = R.source_bytes(docs)
    assert 0 < R.source_bytes(joined) <= 2 * tables
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(tables))    # the product would be over all cores' splits
    try:
        assert R.balance(joined).rdd.getNumPartitions() == R.TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
