import re
from collections import defaultdict

from helpers import clashing, documents, prose

from protoclass.llm.queries import QUERIES
from protoclass.llm.unit_dedup import by_document, units, without_repeats

SF = "/root/testdata/sf0.001"


def brute(rows):
    """{doc_id: removed spans} by one pass in order of (id, text, place); texts of one id must differ."""
    seen, out = set(), defaultdict(list)
    for doc_id, text in sorted(rows):
        for a, z, d in units(text or ""):
            if d in seen:
                out[doc_id].append((a, z))
            seen.add(d)
    return dict(out)


def sentences(seed, n=6):
    return " ".join(prose(seed * 50 + i, 12, 10**6).replace("\n", " ") + "." for i in range(n))


def spans(df):
    return {r.doc_id: [(s.start, s.stop) for s in r.spans] for r in df.collect()}


def test_units():
    text = "one two three four five six seven eight. Short one.\nA b c d e f g h i\n\n  j k l m n o p q!? x"
    assert [text[a:z] for a, z, _ in units(text)] == ["one two three four five six seven eight.", "A b c d e f g h i", "j k l m n o p q!?"]
    assert units("a  B c d e f g h.")[0][2] == units("A b\tc d e f g h.")[0][2]


def test_against_brute_force(spark):
    shared = sentences(99)
    rows = [(i, sentences(i) + ("\n" + shared if i % 3 == 0 else "")) for i in range(40)] + [(100, sentences(5)), (101, shared + " " + shared), (102, None), (103, ""), (104, sentences(777, 3000))]
    got = by_document(documents(spark, rows))
    assert spans(got) == brute(rows)
    assert {d for r in got.collect() for d in r.kept_doc_ids} == {0, 5}


def test_texts_without_repeats_and_clashing_names(spark):
    shared = sentences(99)
    rows = [(1, sentences(1) + "\n" + shared + " tail"), (2, shared), (None, "x y"), (3, sentences(3)), (3, sentences(3)), (4, "é " + shared + "\nß")]
    docs = clashing(documents(spark, rows), "spans", "_id", "_hash", "row", "digest", "start", "first")
    out = without_repeats(docs)
    assert out.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    texts = dict(rows)
    want = [(1, texts[1]), (2, " " * 5), (None, "x y"), (3, texts[3]), (3, texts[3]), (4, "".join(c for c in _cut(texts[4], brute([(1, texts[1]), (4, texts[4])])[4])))]
    assert got == sorted(want, key=str)


def _cut(text, removed):
    at = 0
    for a, z in removed:
        yield text[at:a]
        at = z
    yield text[at:]


def test_empty_table(spark):
    assert by_document(documents(spark, [])).count() == 0 and without_repeats(documents(spark, [])).count() == 0


def plain(rows, least=8):
    """{doc_id: removed spans}, read without the operator's own cutting: repeated lines, and sentences of ``least`` words."""
    seen, out = set(), defaultdict(set)
    for doc_id, text in sorted(rows):
        for line in re.finditer(r"[^\n]+", text or ""):
            inner = list(re.finditer(r"\S(?:.*?[.!?](?=\s)|.*)", line[0]))
            whole = " ".join(line[0].lower().split())
            if not whole:
                continue
            keys = {whole: inner} if len(inner) == 1 else {whole: inner} | {" ".join(m[0].lower().split()): [m] for m in inner if len(m[0].split()) >= least}
            for key, parts in keys.items():
                if key in seen:
                    out[doc_id].update((line.start() + m.start(), line.start() + m.end()) for m in parts)
                seen.add(key)
    return {d: sorted(s) for d, s in out.items()}


def words_left(text, removed):
    return "".join(_cut(text, removed)).split() + text[removed[-1][1] if removed else 0 :].split()


def test_short_and_mixed_lines_go_whole(spark):
    nine = "one two three four five six seven. Eight nine."
    short = "Yes. No. Perhaps so."
    rows = [(1, f"{nine}\nfirst of them\n{short}"), (2, f"second one here\n  {nine.upper()}\n{short}\n\n"), (3, f"x {nine}\nthird\nfirst  of them")]
    got = spans(by_document(documents(spark, rows)))
    assert {d: words_left(dict(rows)[d], s) for d, s in got.items()} == {2: ["second", "one", "here"], 3: ["x", *nine.split(), "third"]}


def test_whole_table_against_plain_reading(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: r.spans for r in QUERIES["op4_unit_dedup"](spark, SF).collect()}
    at = {d: [tuple(map(int, x.split(":"))) for x in s.split(",")] for d, s in got.items()}
    want = plain(rows)
    assert at.keys() == want.keys()
    texts = dict(rows)
    for d in want:
        assert {i for a, z in at[d] for i in range(a, z) if not texts[d][i].isspace()} == {i for a, z in want[d] for i in range(a, z) if not texts[d][i].isspace()}, d
    # No line that stood before stays in any word.
    seen = set()
    for d, text in sorted(rows):
        gone = {i for a, z in at.get(d, ()) for i in range(a, z)}
        for line in re.finditer(r"[^\n]+", text or ""):
            key = " ".join(line[0].lower().split())
            if key and key in seen:
                assert all(i in gone or text[i].isspace() for i in range(*line.span()))
            seen.add(key)
