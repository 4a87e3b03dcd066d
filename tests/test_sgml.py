"""Markup source fixtures (FIXTURES.md §1)."""

from __future__ import annotations

import os
import random
import re

import pytest
from pyspark.sql import functions as F

from protoclass.operators import routing as R
from protoclass.plans.pipeline import Config, run_pipeline
from protoclass.sources import sgml
from protoclass.sources.sgml import SgmlCorpus, read_records, read_sgml, write_sgml

DOCTYPE = '<!DOCTYPE lewis SYSTEM "lewis.dtd">'


def header(split, old, new):
    return (f'<REUTERS TOPICS="YES" LEWISSPLIT="{split}" CGISPLIT="TRAINING-SET" '
            f'OLDID="{old}" NEWID="{new}">')


NORMAL = "\n".join([
    header("TRAIN", 5544, 1),
    "<DATE>26-FEB-1987 15:01:01.79</DATE>",
    "<TOPICS><D>cocoa</D><D>tea</D></TOPICS>",
    "<PLACES><D>el-salvador</D></PLACES>",
    "<TEXT>&#2;",
    "<TITLE>T ONE</TITLE>",
    "<DATELINE>    SALVADOR, Feb 26 - </DATELINE><BODY>first line",
    "second",
    "Reuter",
    "&#3;</BODY></TEXT>",
    "</REUTERS>",
])
NO_BODY = "\n".join([
    header("TEST", 5545, 2), "<TOPICS></TOPICS>", "<TEXT>", "<TITLE>brief only", "</TITLE>",
    "</TEXT>", "</REUTERS>",
])
ONE_LINE = "\n".join([
    header("TRAIN", 5546, 3), "<TOPICS><D>tea</D></TOPICS>", "<TEXT>", "<TITLE>multi", "line</TITLE>",
    "<DATELINE>Y - </DATELINE><BODY>one line body</BODY></TEXT>", "</REUTERS>",
])
UNUSED = "\n".join([
    header("NOT-USED", 5547, 4), "<TOPICS><D>tea</D></TOPICS>", "<TEXT>", "<BODY>never parsed",
    "</BODY></TEXT>", "</REUTERS>",
])
RAW_TEXT = "\n".join([
    header("TRAIN", 5548, 5), "<TOPICS><D>x</D></TOPICS>", '<TEXT TYPE="UNPROC">',
    "&#2; some raw text", "more raw", "</TEXT>", "</REUTERS>",
])
BLANK_LABEL = "\n".join([
    header("TRAIN", 5549, 6), "<TOPICS><D></D><D>a</D></TOPICS>", "<TEXT>", "<BODY>blank label body",
    "</BODY></TEXT>", "</REUTERS>",
])
TILDE_LABEL = "\n".join([
    header("TRAIN", 5550, 7), "<TOPICS><D>a~b</D></TOPICS>", "<TEXT>", "<BODY>tilde body",
    "</BODY></TEXT>", "</REUTERS>",
])
CLOSED_TEXT = "\n".join([
    header("TRAIN", 5551, 8), "<TOPICS><D>a</D></TOPICS>", "<TEXT>z</TEXT>", "<TEXT>",
    "<BODY>second text body", "</BODY></TEXT>", "</REUTERS>",
])
NO_TOPICS = "\n".join([
    header("TRAIN", 5552, 9), "<TEXT>", "<BODY>no topics here", "</BODY></TEXT>", "</REUTERS>",
])
ENTITY = "\n".join([
    header("TEST", 5553, 10), "<TOPICS><D>a</D></TOPICS>", "<TEXT>", "<BODY>&lt;IBM> shares",
    "</BODY></TEXT>", "</REUTERS>",
])


def write(path, name, text, mode="w", newline=""):
    os.makedirs(os.path.dirname(os.path.join(path, name)) or path, exist_ok=True)
    with open(os.path.join(path, name), mode, newline=newline) as f:
        f.write(text)


def docs_of(corpus: SgmlCorpus):
    return {r["doc_id"]: r for r in corpus.documents.collect()}


@pytest.fixture()
def collection(workdir):
    write(workdir, "a.sgm", DOCTYPE + "\n" + "\n".join(
        [NORMAL, NO_BODY, ONE_LINE, UNUSED, RAW_TEXT]) + "\n")
    write(workdir, "b.sgm", "\n".join([BLANK_LABEL, TILDE_LABEL, CLOSED_TEXT, NO_TOPICS, ENTITY]) + "\n")
    return workdir


def test_elements(spark, collection):
    docs = docs_of(read_sgml(spark, collection))
    n = docs[1]
    assert (n["split"], n["old_id"], n["title"], n["body"], n["topics"]) == \
        ("TRAIN", 5544, "T ONE", "first line\nsecond\nReuter", ["cocoa", "tea"])
    assert (docs[2]["title"], docs[2]["body"], docs[2]["topics"]) == ("brief only", "", [])
    o = docs[3]
    assert (o["title"], o["body"], o["topics"]) == \
        ("multi", "<DATELINE>Y - </DATELINE>one line body</TEXT>", ["tea"])
    assert 4 not in docs                                   # NOT-USED routed away
    assert docs[5]["body"] == ""
    assert docs[6]["topics"] == ["a"]
    assert docs[7]["topics"] == ["a", "b"]
    assert docs[8]["body"] == "second text body"
    assert docs[9]["topics"] == []


def test_unused_split_kept_on_request(spark, collection):
    docs = docs_of(read_sgml(spark, collection, splits=None))
    assert docs[4]["split"] == "NOT-USED"


def test_kept_documents_and_entity_tokens(spark, collection):
    corpus = read_sgml(spark, collection)
    kept = R.keep_documents(corpus.documents, order=SgmlCorpus.ORDER)
    ids = sorted(r["doc_id"] for r in kept.collect())
    assert ids == [1, 3, 6, 7, 8, 9, 10]                  # empty bodies 2 and 5 dropped
    run = run_pipeline(corpus.documents, Config(order=SgmlCorpus.ORDER))
    try:
        terms = {r["term"] for r in run.prepared.term_freq().where(F.col("doc_id") == 10).collect()}
        assert terms == {"lt", "ibm", "shares"}
    finally:
        run.close()


def test_duplicates_last_non_empty_wins(spark, workdir):
    first = "\n".join([header("TRAIN", 1, 50), "<TEXT>", "<BODY>first copy", "</BODY></TEXT>", "</REUTERS>"])
    second = "\n".join([header("TRAIN", 2, 50), "<TEXT>", "<BODY>second copy", "</BODY></TEXT>", "</REUTERS>"])
    empty = "\n".join([header("TRAIN", 3, 50), "<TEXT>", "<TITLE>t</TITLE>", "</TEXT>", "</REUTERS>"])
    write(workdir, "a.sgm", first + "\n")
    write(workdir, "b.sgm", second + "\n" + empty + "\n")
    corpus = read_sgml(spark, workdir)
    (d,) = R.keep_documents(corpus.documents, order=SgmlCorpus.ORDER).collect()
    assert (d["doc_id"], d["old_id"], d["body"]) == (50, 2, "second copy")


def test_rejects_truncated_unclosed_bad_id(spark, workdir):
    truncated = "\n".join([header("TRAIN", 1, 60), "<TEXT>", "<BODY>cut off"])
    unclosed = "\n".join([header("TRAIN", 2, 61), "<TEXT>", "<BODY>never closed"])
    after = "\n".join([header("TRAIN", 3, 62), "<TEXT>", "<BODY>fine", "</BODY></TEXT>", "</REUTERS>"])
    bad = "\n".join([header("TRAIN", 4, "x"), "<TEXT>", "<BODY>bad id", "</BODY></TEXT>", "</REUTERS>"])
    write(workdir, "a.sgm", unclosed + "\n" + after + "\n" + bad + "\n")
    write(workdir, "b.sgm", truncated)
    corpus = read_sgml(spark, workdir)
    assert sorted(docs_of(corpus)) == [62]
    reasons = sorted(r["reason"] for r in corpus.rejects.collect())
    assert reasons == ["bad_id", "unclosed_record", "unclosed_record"]
    with pytest.raises(ValueError):
        read_sgml(spark, workdir, mode="FAILFAST")


def test_no_final_newline(spark, workdir):
    write(workdir, "a.sgm", NORMAL)
    assert sorted(docs_of(read_sgml(spark, workdir))) == [1]


def test_line_endings_give_identical_rows(spark, workdir):
    text = DOCTYPE + "\n" + NORMAL + "\n" + ONE_LINE + "\n"
    lf, crlf, cr = (os.path.join(workdir, d) for d in ("lf", "crlf", "cr"))
    write(lf, "a.sgm", text)
    write(crlf, "a.sgm", text.replace("\n", "\r\n"))
    write(cr, "a.sgm", text.replace("\n", "\r"))
    cols = ["doc_id", "old_id", "split", "title", "body", "topics"]
    a = sorted(tuple(r) for r in read_sgml(spark, lf).documents.select(cols).collect())
    b = sorted(tuple(r) for r in read_sgml(spark, crlf).documents.select(cols).collect())
    c = sorted(tuple(r) for r in read_sgml(spark, cr).documents.select(cols).collect())
    assert a == b == c and len(a) == 2


def test_bad_bytes_become_replacement_char(spark, workdir):
    raw = ("\n".join([header("TRAIN", 1, 70), "<TEXT>", "<BODY>M\xfcller", "</BODY></TEXT>", "</REUTERS>"])
           + "\n").encode("latin-1")
    with open(os.path.join(workdir, "a.sgm"), "wb") as f:
        f.write(raw)
    (d,) = read_sgml(spark, workdir).documents.collect()
    assert d["body"] == "M�ller"


def test_only_matching_names_are_read(spark, workdir):
    write(workdir, "x.sgm", NORMAL + "\n")
    write(workdir, "x.sgml", ONE_LINE + "\n")
    write(workdir, "x.SGM", BLANK_LABEL + "\n")
    write(workdir, "sub/y.sgm", TILDE_LABEL + "\n")
    assert sorted(docs_of(read_sgml(spark, workdir))) == [1]


def test_missing_inputs_raise(spark, workdir):
    with pytest.raises(FileNotFoundError):
        read_sgml(spark, workdir)
    write(workdir, "f.txt", "x")
    with pytest.raises(NotADirectoryError):
        read_sgml(spark, os.path.join(workdir, "f.txt"))


def test_tiny_splits_give_identical_rows(spark, collection):
    cols = ["doc_id", "old_id", "split", "title", "body", "topics"]
    normal = sorted(tuple(r) for r in read_sgml(spark, collection).documents.select(cols).collect())
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        corpus = read_sgml(spark, collection)
        assert read_records(spark, collection).rdd.getNumPartitions() > 4
        tiny = sorted(tuple(r) for r in corpus.documents.select(cols).collect())
        assert corpus.rejects.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert tiny == normal


def test_round_trip(spark, workdir):
    rows = [(11, 1, "TRAIN", "a title", "line one\nline two\n", ["x", "y"]),
            (12, 2, "TEST", "", "single", ["z"]),
            (13, 3, "TRAIN", "t", "no topics", [])]
    docs = spark.createDataFrame(rows, "doc_id bigint, old_id bigint, split string, title string, "
                                       "body string, topics array<string>")
    out = os.path.join(workdir, "out")
    write_sgml(docs, out)
    back = read_sgml(spark, out, glob="part-*").documents
    cols = ["doc_id", "old_id", "split", "title", "body", "topics"]
    assert sorted(tuple(r) for r in back.select(cols).collect()) == sorted(rows)


def test_every_piece_is_a_document_or_a_reject(spark, workdir):
    big = "\n".join([header("TRAIN", 2**31 + 5, 3 * 10**9), "<TEXT>", "<TITLE>t\nu</TITLE>", "<BODY>b", "</BODY></TEXT>", "</REUTERS>"])
    split = "\n".join([header("TRAIN", 1, 80), "<TEXT>", "<BODY>one", "<REUTERS REPORT> two", "</BODY></TEXT>", "</REUTERS>"])
    huge = "\n".join([header("TRAIN", 1, 10**19), "<TEXT>", "<BODY>b", "</BODY></TEXT>", "</REUTERS>"])
    for end, folder in (("\n", "lf"), ("\r\n", "crlf"), ("\r", "cr")):
        text = DOCTYPE + "\npreamble\n" + "\n".join([big, split, NORMAL, huge, ONE_LINE]) + "\ntrailer\n"
        path = os.path.join(workdir, folder)
        write(path, "a.sgm", text.replace("\n", end))
        write(path, "b.sgm", (NORMAL + "\n").replace("\n", end))
        corpus = read_sgml(spark, path)
        docs = corpus.documents.collect()
        assert sorted(r["doc_id"] for r in docs) == [1, 1, 3, 80, 3 * 10**9]
        assert {r["body"] for r in docs if r["doc_id"] == 80} == {"one\n<REUTERS REPORT> two"}
        assert sorted(r["reason"] for r in corpus.rejects.collect()) == ["bad_id"]
        with pytest.raises(ValueError):
            read_sgml(spark, path, mode="FAILFAST")


def test_closing_line_and_inline_options(spark, workdir):
    record = "\n".join([header("TRAIN", 1, 90), "<TEXT>", "<TITLE>first", "last</TITLE>", "<DATELINE>D</DATELINE><BODY>one</BODY></TEXT>", "</REUTERS>"])
    write(workdir, "a.sgm", record + "\n")
    (d,) = read_sgml(spark, workdir, keep_closing_line=True, strip_inline=True).documents.collect()
    assert (d["title"], d["body"]) == ("first\nlast", "one")
    (d,) = read_sgml(spark, workdir).documents.collect()
    assert (d["title"], d["body"]) == ("first", "<DATELINE>D</DATELINE>one</TEXT>")


def plain_records(text):
    """(doc_id, body) of the closed TRAIN records, and the ids of the others: a
    reading line by line, in which a full header line always begins a record."""
    docs, rejects, current = [], [], None
    for line in text.replace("\r\n", "\n").replace("\r", "\n").split("\n"):
        found = re.fullmatch(r'<REUTERS.*LEWISSPLIT="(.*?)".*OLDID="(.*?)".*NEWID="(.*?)".*>', line)
        if found:
            if current and current["split"] == "TRAIN" and not current["closed"]:
                rejects.append(current["id"])
            current = {"split": found[1], "id": int(found[3]), "state": "doc", "body": None, "closed": False}
        elif current and not current["closed"]:
            if current["state"] == "doc" and "<TEXT" in line:
                current["state"] = "text"
            elif current["state"] == "doc" and line == "</REUTERS>":
                current["closed"] = True
                if current["split"] == "TRAIN":
                    docs.append((current["id"], "" if current["body"] is None else "\n".join(current["body"])))
            elif current["state"] == "text" and "<BODY>" in line:
                current["state"], current["body"] = "body", [line[line.index("<BODY>") + 6 :]]
            elif current["state"] == "body":
                if "</BODY>" in line:
                    current["state"] = "doc"
                else:
                    current["body"].append(line)
    if current and current["split"] == "TRAIN" and not current["closed"]:
        rejects.append(current["id"])
    return sorted(docs), sorted(rejects)


def cut_records(seed, n=40):
    rng = random.Random(seed)
    odd = ["<REUTERS", "<REUTERS note> more", "x <REUTERS y", "<REUTERS<REUTERS", "a <REUTERS<REUTERS> b <REUTERS", "see " + header("TRAIN", 1, 999),
           "<REUTERS " + header("TRAIN", 1, 998)[9:] + " tail", "plain line", ""]
    out = [rng.choice(["", DOCTYPE, "<REUTERS before", "x <REUTERS"])]
    for i in range(n):
        lines = [rng.choice(odd) for _ in range(rng.randrange(6))]
        split = rng.choice(["TRAIN", "TRAIN", "NOT-USED"])
        out += [header(split, i, i), "<TEXT>", "<BODY>first " + str(i), *lines]
        if rng.random() < 0.85:
            out += ["</BODY></TEXT>", "</REUTERS>"]
            out += [rng.choice(["<REUTERS after", "junk <REUTERS x> <REUTERS", "trailer"]) for _ in range(rng.randrange(3))]
    text = "\n".join(out) + rng.choice(["", "\n"])
    return text.removeprefix("\n") if rng.random() < 0.5 else text


@pytest.mark.parametrize("split_bytes", ["64", "700", "128m"])
@pytest.mark.parametrize("parts", [1, 8])
def test_records_that_the_tag_cuts_are_put_together(spark, workdir, split_bytes, parts):
    texts = {f"f{i}.sgm": cut_records(i).replace("\n", end) for i, end in enumerate(["\n", "\r\n", "\r", "\n"])}
    for name, text in texts.items():
        write(workdir, name, text)
    want = [plain_records(t) for t in texts.values()]
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        corpus = read_sgml(spark, workdir)
        docs = sorted((r["doc_id"], r["body"]) for r in corpus.documents.collect())
        bad = sorted(int(re.search(r'NEWID="(\d+)"', r["value"])[1]) for r in corpus.rejects.collect())
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert docs == sorted(d for docs_, _ in want for d in docs_)
    assert bad == sorted(b for _, bad_ in want for b in bad_)


def test_whole_files_are_not_scanned_for_cut_records(spark, collection, monkeypatch):
    def no_scan(parsed):
        raise AssertionError("nothing is cut")

    monkeypatch.setattr(sgml, "loose_pieces", no_scan)
    assert len(docs_of(read_sgml(spark, collection))) == 9


def test_failfast_starts_no_job_of_its_own(spark, collection):
    def jobs(mode):
        spark.sparkContext.setJobGroup(f"read-{mode}", mode)
        try:
            read_sgml(spark, collection, mode=mode)
            return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"read-{mode}"))
        finally:
            spark.sparkContext._jsc.clearJobGroup()

    assert jobs("FAILFAST") == jobs("PERMISSIVE")
