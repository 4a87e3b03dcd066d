"""Tokeniser profiles and in-row term counts."""

from __future__ import annotations

import random
from collections import Counter

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from protoclass.functions.text import STOP_WORDS, plain_word, tokenize, with_term_counts, word_pattern
from protoclass.plans.oracle import _tokens

ALPHABET = list("abzÉéü19_.,;:'’·- \n\"") + ["ß", "ĳ", "́", "½", "漢", "か", "カ", "ー", "\u00ad", "\u200d", "\u200b", "\u2060", "א", "ב", "Ⅷ", "ก", "한"]


def tokens_of(spark, texts, profile="word"):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, body string")
    rows = df.select("i", tokenize("body", profile).alias("t")).orderBy("i").collect()
    return [r["t"] for r in rows]


def test_word_profile_examples(spark):
    (got,) = tokens_of(spark, ["can't U.S. 3.14 1,234 x_y état-major &lt;IBM> Müller's"])
    assert got == ["can't", "u.s", "3.14", "1,234", "x_y", "état", "major", "lt", "ibm", "müller's"]


def test_ascii_profile_examples(spark):
    (got,) = tokens_of(spark, ["Can't stop U.S. état 3.14"], profile="ascii")
    assert got == ["can", "t", "stop", "u", "s", "tat", "3", "14"]


def test_tokens_need_a_letter_or_digit_and_ideographs_stand_alone(spark):
    (got,) = tokens_of(spark, ["____ _a_ \u00bd \u2168 1\u00bd2 \u6f22\u5b57\u304b\u306ax\u6f22y \u30ab\u30bf \u0301e l'a._b"])
    assert got == ["_a_", "\u2178", "1", "2", "\u6f22", "\u5b57", "\u304b", "\u306a", "x", "\u6f22", "y", "\u30ab\u30bf", "e", "l'a", "_b"]


def test_published_examples(spark):
    """Examples of the word-break standard, and texts whose tokens the analyser's public tests state."""
    cases = {
        "The quick (\u201cbrown\u201d) fox can\u2019t jump 32.3 feet, right?": ["quick", "brown", "fox", "can\u2019t", "jump", "32.3", "feet", "right"],
        "O'Reilly you're Jim's R2D2 C3PO 216.239.63.104 21.35 http://x.org/a_b": ["o'reilly", "you're", "jim's", "r2d2", "c3po", "216.239.63.104", "21.35", "http", "x.org", "a_b"],
        "\u0e01\u0e32\u0e23\u0e17\u0e35\u0e48\u0e44\u0e14\u0e49. \u0e41\u0e25\u0e49\u0e27? \u0e51\u0e52\u0e53": ["\u0e01\u0e32\u0e23\u0e17\u0e35\u0e48\u0e44\u0e14\u0e49", "\u0e41\u0e25\u0e49\u0e27", "\u0e51\u0e52\u0e53"],
        "\u6211\u662f\u4e2d\u56fd\u4eba\u3002 \uff11\uff12\uff13\uff14 \uff34\uff45\uff53\uff54\uff53 ": ["\u6211", "\u662f", "\u4e2d", "\u56fd", "\u4eba", "\uff11\uff12\uff13\uff14", "\uff54\uff45\uff53\uff54\uff53"],
        "\u4eee\u540d\u9063\u3044 \u30ab\u30bf\u30ab\u30ca\u30fcab \u30ab\u30bf_ab": ["\u4eee", "\u540d", "\u9063", "\u3044", "\u30ab\u30bf\u30ab\u30ca\u30fc", "ab", "\u30ab\u30bf_ab"],
        "\uc548\ub155\ud558\uc138\uc694 \ud55c\uae00\uc785\ub2c8\ub2e4": ["\uc548\ub155\ud558\uc138\uc694", "\ud55c\uae00\uc785\ub2c8\ub2e4"],
        "mo\u0364chte co\u00adop x\u200dy q\u200bb \ufeffz\u2060-": ["mo\u0364chte", "co\u00adop", "x\u200dy", "q", "b", "z\u2060"],
        "\u05e6\u05d4\"\u05dc \u05d2' \u05d0\" \"\u05d1": ["\u05e6\u05d4\"\u05dc", "\u05d2'", "\u05d0", "\u05d1"],
        "\u0645\u0627 \u0661\u066b\u0662 \u24b6\u24b7 1.q q.1 q:b q..b": ["\u0645\u0627", "\u0661\u066b\u0662", "\u24d0\u24d1", "1", "q", "q", "1", "q:b", "q", "b"],
    }
    assert tokens_of(spark, list(cases)) == list(cases.values())


def test_long_runs_are_read_once(spark):
    (a, b, c) = tokens_of(spark, ["_" * 200_000, "x\u0301" * 100_000, "q'" * 100_000])
    assert a == [] and len(b) == 1 and len(c) == 1


def test_stop_words_dropped_and_length_cap_optional(spark):
    long_ok, long_bad = "x" * 255, "y" * 256
    text = " ".join(STOP_WORDS) + f" keep {long_ok} {long_bad} The"
    (got,) = tokens_of(spark, [text])
    assert got == ["keep", long_ok, long_bad]
    df = spark.createDataFrame([(text,)], "body string")
    assert df.select(tokenize("body", max_token_length=255).alias("t")).first()["t"] == ["keep", long_ok]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=40), min_size=50, max_size=50))
def test_oracle_spells_the_same_tokens(spark, texts):
    """The oracle's own pattern (another engine, no look-around) gives the same tokens."""
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    rows = df.select("i", tokenize("s", stop_words=None).alias("a")).orderBy("i").collect()
    duck = duckdb.connect().execute(f"SELECT {_tokens('s', 'word')} FROM (SELECT unnest(?) AS s)", [texts]).fetchall()
    for r, d in zip(rows, duck, strict=True):
        assert r["a"] == list(d[0]), texts[r["i"]]


def test_term_counts_match_counter(spark):
    rng = random.Random(7)
    vocab = ["a", "b", "cc", "d", "ee", "f"]
    arrays = [[rng.choice(vocab) for _ in range(rng.randint(0, 30))] for _ in range(200)]
    df = spark.createDataFrame([(i, a) for i, a in enumerate(arrays)], "i int, terms array<string>")
    rows = with_term_counts(df, "terms", "tfs").orderBy("i").collect()
    for r in rows:
        got = {x["term"]: x["tf"] for x in r["tfs"]}
        assert got == dict(Counter(arrays[r["i"]]))
        assert [x["term"] for x in r["tfs"]] == sorted(got)


def test_term_counts_plan_sorts_once(spark):
    df = spark.createDataFrame([(1, ["b", "a", "b"])], "i int, terms array<string>")
    plan = with_term_counts(df, "terms", "tfs")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("array_sort(") + plan.count("sort_array(") == 1


def test_plain_words_end_where_the_rules_end_them(spark):
    """The short branch for words of Latin letters takes all words of a plain
    text, and what it takes is what the other branches would."""
    rules = word_pattern().removeprefix(plain_word() + "|")
    assert rules != word_pattern()
    rng = random.Random(11)
    alphabet = [*ALPHABET, *" \n.,:'\"\tabÿ×÷ƀɐª\x00", "\u0301", "\u05d0"]
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(60))) for _ in range(2000)]
    texts.append("The words, don't they: \"élan\" (état) u.s. x_y; über.")
    df = spark.createDataFrame([(t,) for t in texts], "s string").select(F.lower("s").alias("s"))
    columns = [F.regexp_extract_all("s", F.lit(p), 0).alias(a) for p, a in ((word_pattern(), "a"), (rules, "b"), (plain_word(), "p"))]
    rows = df.select("s", *columns).collect()
    for r in rows:
        assert r["a"] == r["b"], r["s"]
    assert rows[-1]["p"] == ["the", "words", "t", "they", "élan", "état", "s", "y", "über"]
