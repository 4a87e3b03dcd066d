import random

import duckdb
from helpers import clashing, documents, prose

from protoclass.llm.queries import ORACLE_SQL, QUERIES
from protoclass.llm.spaced_seeds import MASKS, MIN_SCORE, PENALTY, decontaminated, overlaps

SF = "/root/testdata/sf0.01"


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, text string")


def inside(seed, passage):
    return prose(seed, 40) + " " + passage + " " + prose(seed + 1, 40)


def pairs(docs, benchmark):
    return {(r.doc_id, r.item_id): r.score for r in overlaps(docs, benchmark).collect()}


def test_exact_and_substituted_passages(spark):
    passage = prose(77, 40, 10**6)
    w = passage.split()
    rng = random.Random(1)
    swapped = [f"new{i}" if i % 6 == 3 else x for i, x in enumerate(w)]
    half = w[:20]
    rows = [(1, inside(1, passage)), (2, inside(2, " ".join(swapped))), (3, inside(3, " ".join(half).upper())), (4, prose(4, 400)),
            (5, inside(5, " ".join(rng.sample(w, len(w))))), (6, inside(6, " ".join(w[:8])))]
    got = pairs(documents(spark, rows), items(spark, [(10, passage), (11, None), (12, "")]))
    assert got[1, 10] == 40 and set(got) == {(1, 10), (2, 10), (3, 10)} and got[3, 10] == 20


def missed(masks):
    """A pattern of equal (1) and substituted (0) words that scores MIN_SCORE
    and fits no mask, or None: a walk over all (last words, score) that the
    words of a stretch can reach. A stretch starts where its score leaves 0."""
    span = max(map(len, masks))
    ways, open_ways = {("", 0): ""}, [("", 0)]
    while open_ways:
        state = open_ways.pop()
        for word, step in (("1", 1), ("0", -PENALTY)):
            last, score = (state[0] + word)[-span:], state[1] + step
            fits = any(len(last) >= len(m) and all(x == "1" for x, c in zip(last[-len(m):], m) if c == "1") for m in masks)
            if fits or score <= 0:
                continue
            way = ways[state] + word
            if score >= MIN_SCORE:
                return way
            if (last, score) not in ways:
                ways[last, score] = way
                open_ways.append((last, score))
    return None


def test_masks_lose_no_overlap():
    assert max(map(len, MASKS)) <= MIN_SCORE - 1   # items of all-equal words that are shorter than MIN_SCORE
    assert missed(MASKS) is None
    way = missed(MASKS[:3])
    assert way and way.count("1") - PENALTY * way.count("0") >= MIN_SCORE


def test_substitution_patterns_against_all_diagonals(spark):
    rng = random.Random(3)
    passages = [prose(1000 + k, 60, 10**6) for k in range(40)]
    rows, k = [], 0
    for p in passages:
        for _ in range(5):
            share = rng.choice((4, 5, 6, 8))
            rows.append((k, inside(2000 + k, " ".join(f"s{k}n{i}" if rng.randrange(share) == 0 else w for i, w in enumerate(p.split())))))
            k += 1
    got = pairs(documents(spark, rows), items(spark, list(enumerate(passages))))

    def best(a, b):
        top = 0
        for d in range(1 - len(b), len(a)):
            now = 0
            for j in range(max(0, -d), min(len(b), len(a) - d)):
                now = max(0, now + (1 if a[j + d] == b[j] else -PENALTY))
                top = max(top, now)
        return top

    want = {(k, k // 5): best(text.split(), passages[k // 5].split()) for k, text in rows}
    assert got == {pair: score for pair, score in want.items() if score >= MIN_SCORE} and 0 < len(got) < len(rows)


def test_short_items_need_all_their_words(spark):
    rows = [(1, "aa bb cc dd ee ff gg"), (2, "aa bb cc xx ee ff gg"), (3, "zz aa, BB; cc-dd! ee")]
    got = pairs(documents(spark, rows), items(spark, [(1, "aa bb cc dd ee"), (2, "aa bb cc dd"), (3, "")]))
    assert got == {(1, 1): 5, (3, 1): 5}


def test_nulls_long_texts_repeats_and_clashing_names(spark):
    passage = prose(5, 30, 10**6)
    rows = [(1, None), (2, ""), (None, inside(1, passage)), (3, prose(3, 50_000) + " " + passage), (3, "other " * 3), (4, passage), (4, passage), (5, prose(9, 50))]
    docs = clashing(documents(spark, rows), "t", "h", "_h", "_doc", "_hash", "text_hash", "row", "key", "score")
    bench = items(spark, [(7, passage), (7, passage), (None, passage)])
    assert set(pairs(docs, bench)) == {(None, 7), (3, 7), (4, 7), (None, None), (3, None), (4, None)}
    kept = decontaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, (r.text or "")[:6]) for r in kept.collect()) == [(1, ""), (2, ""), (3, "other "), (5, prose(9, 50)[:6])]


def test_empty_tables(spark):
    docs, bench = documents(spark, [(1, prose(1, 50))]), items(spark, [(1, prose(1, 20))])
    assert overlaps(docs.limit(0), bench).count() == 0 and overlaps(docs, bench.limit(0)).count() == 0
    assert decontaminated(docs, bench.limit(0)).count() == 1 and decontaminated(docs, bench).count() == 0


def test_query_equals_its_sql(spark):
    got = sorted((r.doc_id, r.item_id, r.score) for r in QUERIES["op6_spaced_seeds"](spark, SF).collect())
    db = duckdb.connect()
    for t in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    assert got == sorted(db.execute(ORACLE_SQL["op6_spaced_seeds"]).fetchall()) and got


def test_no_python_in_the_plan(spark, capsys):
    overlaps(documents(spark, [(1, prose(1, 50))]).repartition(1), items(spark, [(1, prose(1, 20))])).explain()
    assert "Python" not in capsys.readouterr().out
