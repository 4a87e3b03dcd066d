import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from helpers import clashing, documents, prose

from protoclass.llm import chosen_path
from protoclass.llm.chosen_path import Bucket, classes, compare, components, one_of_each, runs_for, sketch, token_set
from protoclass.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def brute(rows, similarity=0.8):
    """{row: (class, links)} by comparing all sets."""
    sets = [frozenset(token_set(t).tolist()) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and min(len(a), len(b)) >= similarity * max(len(a), len(b)):
                c = len(a & b)
                if c >= similarity * (len(a) + len(b) - c) - 1e-9:
                    links[i] += 1
                    links[j] += 1
                    x, y = find(i), find(j)
                    parent[max(x, y)] = min(x, y)
    of = {}
    for i, (doc_id, _) in enumerate(rows):
        of.setdefault(find(i), []).append(doc_id)
    least = {r: min((x for x in ids if x is not None), default=None) for r, ids in of.items()}
    return [(d, least[find(i)], links[i]) for i, (d, _) in enumerate(rows)]


def copies(seed, n, words, changes):
    base = prose(seed, words, 10**6).split()
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(changes):
            w[rng.randrange(len(w))] = f"r{rng.random()}"
        out.append(" ".join(w))
    return out


def sample():
    texts = [prose(i, 30 + i % 90, 10**6) for i in range(120)]
    texts += copies(1, 60, 200, 1) + copies(2, 40, 120, 2) + copies(3, 30, 40, 1) + copies(4, 12, 7, 0)
    shared = prose(50, 30, 10**6)
    texts += [shared + " " + prose(500 + i, 60, 10**6) for i in range(60)]
    return [(i * 3 % 1009, t) for i, t in enumerate(texts)]


def got(df):
    return sorted(((r.doc_id, r.class_id, r.n_links) for r in df.collect()), key=str)


def test_against_brute_force(spark):
    rows = sample()
    assert got(classes(documents(spark, rows))) == sorted(brute(rows), key=str)


def test_split_buckets_and_tiles_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(chosen_path, "SPLIT_ABOVE", 8)
    monkeypatch.setattr(chosen_path, "BLOCK_RECORDS", 7)
    rows = sample()
    assert got(classes(documents(spark, rows))) == sorted(brute(rows), key=str)


def test_blocks_bounded_by_tokens_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(chosen_path, "SPLIT_ABOVE", 8)
    monkeypatch.setattr(chosen_path, "BLOCK_TOKENS", 900)
    rows = sample()
    assert got(classes(documents(spark, rows))) == sorted(brute(rows), key=str)


def tile(sets, blocks, key=9, keys=None):
    """One tile of records with these sets, the block of each, and their buckets."""
    low, high = min(blocks), max(blocks)
    return pa.table({
        "key": [key] * len(sets), "tile": [(low << 31) + high] * len(sets), "block": blocks, "rec": [b"%06d" % i for i in range(len(sets))],
        "n": [len(x) for x in sets], "m": [1 + i % 2 for i in range(len(sets))], "sketch": [sketch(x).tobytes() for x in sets], "keys": keys or [[key]] * len(sets)})


def plain_links(sets, blocks, keys, key, similarity=0.8):
    count = [0] * len(sets)
    for j in range(len(sets)):
        for i in range(j):
            if (len(set(blocks)) > 1 and blocks[i] == blocks[j]) or any(k < key for k in set(keys[i]) & set(keys[j])):
                continue
            c = len(np.intersect1d(sets[i], sets[j]))
            if c >= similarity * (len(sets[i]) + len(sets[j]) - c) - 1e-9:
                count[i] += 1 + j % 2
                count[j] += 1 + i % 2
    return count


@pytest.mark.parametrize("across", [False, True])
@pytest.mark.parametrize("way", ["pairs", "matrix", "either"])
def test_tiles_against_plain_comparison(monkeypatch, across, way):
    if way != "either":
        monkeypatch.setattr(chosen_path, "_PER_PAIR", 0.0 if way == "pairs" else 1e9)
        monkeypatch.setattr(chosen_path, "_PER_LOOKUP", 0.0 if way == "pairs" else 1e9)
    monkeypatch.setattr(chosen_path, "CHUNK", 50)
    monkeypatch.setattr(chosen_path, "STRIP", 16)
    rng = random.Random(3)
    sets = [token_set(t) for _, t in sample()[100:230]]
    blocks = [rng.randrange(2) * 3 if across else 4 for _ in sets]
    keys = [sorted({9, *rng.sample([3, 5, 20], rng.randrange(2))}) for _ in sets]
    told = compare(Bucket(tile(sets, blocks, 9, keys), 0.8), sets.__getitem__)
    assert told[0].tolist() == plain_links(sets, blocks, keys, 9)


@pytest.mark.parametrize("across", [False, True])
def test_memory_of_a_full_tile(across):
    """As many records and tokens as a tile has at most: a fraction of the memory that one pair of blocks could take."""
    per = chosen_path.BLOCK_TOKENS // chosen_path.BLOCK_RECORDS
    g = chosen_path.BLOCK_RECORDS * (2 if across else 1)
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**64, per, np.uint64)
    sets = []
    for _ in range(g):
        x = base.copy()
        x[rng.integers(0, per, 5)] = rng.integers(0, 2**64, 5, np.uint64)
        sets.append(np.unique(x))
    bucket = Bucket(tile(sets, [i % 2 if across else 0 for i in range(g)]), 0.8)
    tracemalloc.start()
    count, label = compare(bucket, lambda k: sets[k].copy())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200 << 20
    assert (label == label[0]).all() and set(count.tolist()) <= ({g // 2, g} if across else set(range(g, 2 * g)))


def test_nulls_short_and_long_texts_and_repeats(spark):
    long = prose(9, 40_000, 10**6)
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a"), (5, "A"), (6, "a b c"), (None, "a"), (7, long), (8, long + " end"), (9, "x y z v w"), (9, "x y z v w"), (None, "q r"), (None, "q r")]
    df = clashing(documents(spark, rows), "rec", "class", "_rec", "row", "key", "n", "m", "_n", "tile", "text_hash")
    assert got(classes(df)) == sorted(((d, c if t and t.strip() else d, k) for (d, t), (_, c, k) in zip(rows, brute(rows), strict=True)), key=str)
    kept = one_of_each(df)
    assert kept.columns == df.columns
    # The least id of a class stands for it; a null id is least of all.
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "2", "3", "None", "6", "7", "9", "None"])


def test_one_of_each_class_stays(spark):
    rows = sample()
    want = {}
    for d, c, _ in brute(rows):
        want.setdefault(c, []).append(d)
    assert sorted(r.doc_id for r in one_of_each(documents(spark, rows)).collect()) == sorted(min(x) for x in want.values())


def test_empty_table(spark):
    assert classes(documents(spark, [])).count() == 0 and one_of_each(documents(spark, [])).count() == 0


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7)]
    df = spark.createDataFrame([(bytes([a]), bytes([b])) for a, b in edges], "u binary, v binary")
    roots = {bytes(r.rec)[0]: bytes(r.root)[0] for r in components(df).collect()}
    assert roots == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_more_recall_takes_more_runs(depth):
    assert runs_for(0.9, 0.8, depth) < runs_for(0.999, 0.8, depth) < runs_for(0.9999, 0.8, depth + 1)


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert got(QUERIES["op9_chosen_path"](spark, SF)) == sorted(brute(rows), key=str)
