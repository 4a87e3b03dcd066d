import zlib
from itertools import combinations

import numpy as np
from helpers import clashing, documents, prose

from protoclass.llm.factorization import FEATURES, RANK, Model, features, fit, score, train
from protoclass.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_score_equals_the_sum_over_pairs():
    rng = np.random.default_rng(1)
    model = Model(0.3, rng.normal(size=FEATURES), rng.normal(size=(FEATURES, RANK)))
    index, value = np.array([3, 70, 400, 9, 40_00]), rng.normal(size=5)
    pairs = sum(float(model.factor[index[a]] @ model.factor[index[b]]) * value[a] * value[b] for a, b in combinations(range(5), 2))
    want = 0.3 + float(model.weight[index] @ value) + pairs
    assert np.isclose(model.margin(index, value, np.array([0]))[0], want)


def test_learns_an_interaction():
    # Label 1 if both or neither of two words occur: no linear score can tell.
    rows, labels = [], []
    for k in range(400):
        a, b = k % 2, (k // 2) % 2
        rows.append((np.array([10 + a, 20 + b]), np.ones(2)))
        labels.append(float(a == b))
    model = train(rows, np.array(labels), epochs=60)
    raw = model.margin(np.array([10, 20, 10, 21, 11, 20, 11, 21]), np.ones(8), np.array([0, 2, 4, 6]))
    assert (raw > 0).tolist() == [True, False, False, True]


def sample(spark):
    rows = [(i, prose(i, 60)) if i % 4 else (i, " ".join(w + "###" for w in prose(i, 60).split())) for i in range(300)]
    rows += [(900, None), (901, ""), (None, "no id"), (902, prose(1, 50_000)), (5, prose(5, 60))]
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(300)] + [(None, 1, 0), (4, None, 0), (99_999, 1, 0), (7, 0, 0)],
                                   "doc_id bigint, quality int, toxic int")
    return documents(spark, rows), labels


def test_nulls_repeats_and_reruns(spark):
    docs, labels = sample(spark)
    wide = clashing(docs, "label", "index", "value", "score", "_id", "_label", "held_out")
    rows = score(wide, fit(wide, labels)).collect()
    assert len(rows) == 305 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert sum(r.doc_id == 5 for r in rows) == 2 and {900, 901, None} <= {r.doc_id for r in rows}
    for r in rows:
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    right = [r.predicted == int(r.doc_id % 4 > 0) for r in rows if r.doc_id is not None and r.doc_id < 300 and r.held_out]
    assert np.mean(right) > 0.97
    again = {r.doc_id: r.score for r in score(docs, fit(docs, labels)).collect()}
    assert all(np.isclose(again[r.doc_id], r.score) for r in rows)


def test_source_lang_id_and_held_out_labels_do_not_matter(spark):
    docs, labels = sample(spark)
    from pyspark.sql import functions as F

    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    flipped = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs.withColumns({"source": F.lit("z"), "lang": F.lit(None).cast("string"), "n_chars": F.lit(0)})
    a = {r.doc_id: r.score for r in score(docs, fit(docs, labels)).collect()}
    b = {r.doc_id: r.score for r in score(other, fit(other, flipped)).collect()}
    assert all(np.isclose(a[k], b[k]) for k in a)


def test_labels_of_one_kind_and_empty_tables(spark):
    docs, labels = sample(spark)
    ones = {r.score for r in score(docs, fit(docs, labels.filter("quality = 1"))).collect()}
    assert len(ones) == 1 and ones.pop() > 0.9
    assert {r.score for r in score(docs, fit(docs, labels.limit(0))).collect()} == {0.5}
    assert score(documents(spark, []), fit(documents(spark, []), labels)).count() == 0
    assert len(features("")[0]) == len(features("a b a")[0]) - 2


def test_held_out_accuracy_of_the_query(spark):
    rows = {r.doc_id: r for r in QUERIES["op5_quality_classifier"](spark, "/root/testdata/sf0.01").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    held = [(rows[r.doc_id].predicted, r.quality) for r in labels if rows[r.doc_id].held_out]
    assert len(rows) == 1000 and np.mean([a == b for a, b in held]) > 0.95
