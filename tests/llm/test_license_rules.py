import random
import re
import time
from re import _parser

from helpers import clashing, documents, prose

from protoclass.llm import license_rules
from protoclass.llm.license_rules import RULES, Detection, detections, license_scan, scan, strongest
from protoclass.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def brute(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = [(i, label) for p, label in PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    starts = [i for i, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})))


def test_base_against_brute_force():
    for t in ["", "CC BY cc-by cc_by ccby", "All rights, all rights reserved. ALL RIGHTS RESERVED", "general Public license general public", "é CC BY İ 1a 2B", "cc cc by"]:
        r = scan(t)
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute(t), t
        assert set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) | {""} and 0 <= r["score"] <= 1


def test_every_rule_has_a_gate_and_some_text():
    assert len(RULES) > 200
    for text, label in [("Licensed under the Apache License, Version 2.0.", "apache-2.0"), ("Released under the MIT License.", "mit"), ("SPDX-License-Identifier: MIT", "spdx"),
                        ("licensed under the GNU General Public License, version 3.", "gpl-3.0"), ("Licensed under CC BY-NC 4.0.", "cc-by-nc"), ("Mozilla Public License 2.0", "mpl"),
                        ("Redistribution and use in source and binary forms", "bsd"), ("dedicated to the public domain", "public-domain"), ("© 2019-2021 A", "copyright")]:
        assert label in {d.label for d in detections(text.lower())}, text


def test_contained_detections_are_suppressed():
    found = detections("licensed under the apache license, version 2.0.")
    assert [(d.label, d.start) for d in found] == [("apache-2.0", 0)]
    assert [d.label for d in detections("this work is licensed under cc by-nc-sa 4.0")] == ["cc-by-nc-sa"]


def test_clean_text_has_no_label():
    assert scan("The license plate was as is common in may not be seen")["labels"] in ("", "warranty") and scan(prose(1, 300))["score"] == 0


def test_nulls_long_texts_repeats_and_clashing_names(spark):
    long = prose(1, 60_000) + " All rights reserved."
    rows = [(1, None), (2, ""), (None, "cc by"), (3, long), (4, "MIT License"), (4, "MIT License")]
    got = license_scan(clashing(documents(spark, rows), "labels", "found", "score")).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 6 and (by[1].n_words, by[1].labels, by[1].score, by[1].first_word) == (0, "", 0.0, None)
    assert by[3].first_word == by[3].last_word == 60_000 and by[None].base_labels == "cc-by"
    assert license_scan(documents(spark, [])).count() == 0


def test_query_against_brute_force(spark):
    rows = {r.doc_id: r for r in QUERIES["op10_license_scan"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        r = rows[d.doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(d.text)


def written_out(parsed, rng):
    """A text that a parsed pattern accepts, with white space of any kind and number."""
    out = []
    for op, arg in parsed:
        op = str(op)
        if op == "LITERAL":
            out.append(chr(arg))
        elif op == "ANY":
            out.append(rng.choice("ab "))
        elif op == "IN":
            kind, value = rng.choice(arg)
            made = {"LITERAL": lambda v: chr(v), "RANGE": lambda v: chr(rng.randint(*v)), "CATEGORY": lambda v: {"CATEGORY_SPACE": rng.choice(" \n\t\xa0"), "CATEGORY_DIGIT": "2", "CATEGORY_WORD": "x"}[str(v)]}
            out.append(made[str(kind)](value))
        elif op in ("MAX_REPEAT", "MIN_REPEAT"):
            low, high, inner = arg
            out += [written_out(inner, rng) for _ in range(rng.randint(low, min(int(high), low + 2)))]
        elif op == "SUBPATTERN":
            out.append(written_out(arg[-1], rng))
        elif op == "BRANCH":
            out.append(written_out(rng.choice(arg[1]), rng))
        else:
            assert op in ("ASSERT_NOT", "AT"), op
    return "".join(out)


def test_no_prefilter_loses_a_match_of_any_rule(monkeypatch):
    rng = random.Random(7)
    texts = [(rule, f"— {written_out(_parser.parse(rule.pattern.pattern, re.S), rng)} —") for rule in RULES for _ in range(30)]
    texts = [(rule, t) for rule, t in texts if rule.pattern.search(t)]  # all but some of one rule that looks ahead
    assert {rule for rule, _ in texts} == set(RULES) and len(texts) > 30 * (len(RULES) - 1)
    wrapped = ["open database license", "in  no\nevent shall the authors", "redistribution and\nuse in source and binary forms", "provided as\n is", "into the public\ndomain", "cc attribution-sharealike 4.0"]
    cases = [t for _, t in texts] + wrapped
    got = [detections(t) for t in cases]
    monkeypatch.setattr(license_rules, "picked", lambda lower: RULES)
    assert got == [detections(t) for t in cases] and all(got)


def plain_strongest(found):
    kept = []
    for d in sorted(found, key=lambda d: (-d.priority, d.start - d.end, d.start)):
        if not any(k.start <= d.start and d.end <= k.end for k in kept):
            kept.append(d)
    return sorted(kept, key=lambda d: (d.start, d.end))


def test_suppression_against_all_pairs():
    rng = random.Random(3)
    for _ in range(200):
        found = [Detection("x", a, a + rng.randrange(1, 9), rng.randrange(3), 0.5) for a in (rng.randrange(30) for _ in range(rng.randrange(40)))]
        assert strongest(found) == plain_strongest(found)


def test_many_detections_in_one_text():
    found = [Detection("x", 3 * i, 3 * i + 2 + i % 3, i % 7, 0.5) for i in range(100_000)]
    start = time.process_time()
    assert len(strongest(found)) > 50_000
    assert time.process_time() - start < 5
    text = "All rights reserved. © 2020 A. Released under the MIT License.\n" * 5000
    start = time.process_time()
    got = scan(text)
    assert got["n_base"] == 5000 and got["labels"] == "copyright,mit,reserved" and time.process_time() - start < 20


def plain_labels(text):
    """Labels by every rule on the text and all pairs of detections."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return {d.label for d in plain_strongest([Detection(r.label, *m.span(), r.priority, r.weight) for r in RULES for m in r.pattern.finditer(low)])}


def test_labels_of_the_given_documents_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    rows = {r.doc_id: r for r in QUERIES["op10_license_scan"](spark, "/root/testdata/sf0.001").collect()}
    for d in docs:
        assert rows[d.doc_id].labels == ",".join(sorted(plain_labels(d.text) | {x for x in brute(d.text)[4].split(",") if x})), d.doc_id


def test_rules_are_many_and_their_keywords_are_words():
    assert len(RULES) > 400 and all(len(k) > 1 or k == "©" for r in RULES for k in r.keywords)
    assert {"bsd-3-clause"} <= {d.label for d in detections("neither the name of " + "a very long name " * 30 + "nor the names of its contributors")}
