import random
import re

import numpy as np
from helpers import clashing, documents, prose

from protoclass.llm.quality_rules import COUNTS, P, judged, quality_rules, repeat_words, text_counts
from protoclass.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORD = r"[^\x20\x09-\x0D]+"


def brute_counts(text):
    words = re.findall(WORD, text or "")
    lines = (text or "").split("\n")
    dup = sum(1 for i, x in enumerate(lines) if re.search(WORD, x) and x in lines[:i])
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)]


def test_counts_against_brute_force():
    rng = random.Random(3)
    texts = ["", "a", "a b c d e a b c d e", "x " * 30, "l one\nl one\n\n \nl one\r", "# $ * 1\t2\v3", "é ü\x85ß"]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randrange(60))) + "\n" * rng.randrange(3) for _ in range(40)]
    for t in texts:
        assert text_counts(t)[0] == brute_counts(t), t


def test_repeats_with_a_large_vocabulary():
    words = [f"w{i}" for i in range(9000)] + [f"w{i}" for i in range(100, 110)]
    assert repeat_words(words) == 20


def sample(spark, extra=()):
    rows = [(i, prose(i, 60 + i % 50), "en", "hot" if i % 3 else "b") for i in range(360)]
    junk = [(1000 + i, " ".join(f"{w}$$%" for w in prose(i, 80).split()), "en", "hot") for i in range(25)]
    return documents(spark, rows + junk + list(extra))


def test_outliers_go_and_clean_texts_stay(spark):
    got = {r.doc_id: r for r in judged(sample(spark)).collect()}
    assert all(got[i].kept for i in range(360))
    assert not any(got[1000 + i].kept or got[1000 + i].base_failed for i in range(25))


def test_distance_is_the_robust_one(spark):
    # The estimate must not follow a fifth of gross outliers.
    rows = [(i, prose(i, 100), "en", "s") for i in range(120)] + [(900 + i, "A B# C$ D% E& F1 G| H< I> J* " + "K# " * 0 + prose(i, 20).upper(), "en", "s") for i in range(30)]
    got = judged(documents(spark, rows)).toPandas().set_index("doc_id").distance
    assert got[got.index < 900].max() < got[got.index >= 900].min()


def test_nulls_ties_repeats_and_clashing_names(spark):
    extra = [(None, None, None, None), (None, "", "en", None), (5000, "x " * 400, "en", "hot"), (5001, prose(1, 90_000), "en", "b"), (5002, prose(7, 70), None, "hot"), (7, prose(7, 67), "en", "hot")]
    docs = clashing(sample(spark, extra), "kept", "_id", "_hash", "row", "row_hash", "grp", "v0")
    out = quality_rules(docs)
    assert out.columns == docs.columns
    kept = [r.doc_id for r in out.collect()]
    assert kept.count(7) == 2 and 5001 in kept and 5002 in kept and 5000 not in kept and None not in kept
    assert {r.kept for r in out.collect()} == {"own kept"}


def test_one_source_of_equal_rows(spark):
    out = judged(documents(spark, [(i, "the same ten words stand in every one of these", "en", "s") for i in range(100)])).collect()
    assert all(r.kept for r in out) and len(out) == 100


def test_empty_and_tiny_tables(spark):
    assert judged(documents(spark, [])).count() == 0
    assert [r.kept for r in judged(documents(spark, [(1, prose(1, 30)), (2, "a b")])).orderBy("doc_id").collect()] == [True, False]


def test_query_counts_on_whole_table(spark):
    rows = QUERIES["op2_quality_rules"](spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        want = brute_counts(texts[r.doc_id]) if len(texts[r.doc_id]) < 6000 else text_counts(texts[r.doc_id])[0]
        assert [r[c] for c in COUNTS] == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.base_failed and r.kept)
    assert np.mean([r.kept for r in rows]) > 0.7 and P == 6
