import math

import numpy as np
import pytest

from protoclass.llm.embedding_whitening import whiten
from protoclass.llm.queries import QUERIES
from protoclass.llm.spectrum import count_above, leading

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id bigint, embedding array<float>, n int, whitened string"


def vectors(spark, rows):
    """rows: (vec_id, embedding), with further columns of names that the operator uses."""
    return spark.createDataFrame([(*r, 1, "own") for r in rows], SCHEMA)


def brute(rows, most=32):
    """{(vec_id, component): (deviation, whitened without its sign, explained)} from a library's eigenvectors."""
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in rows], object)
    n, s = len(x), x.sum(axis=0)
    y = (n * x - s).astype(np.float64) / n
    e, q = np.linalg.eigh(y.T @ y / n)
    e, q = e[::-1], q[:, ::-1]
    out = {}
    for (key, _), row, exact in zip(rows, y, x, strict=True):
        deviation = sum((n * c - t) ** 2 for c, t in zip(exact, s, strict=True))
        for k in range(min(most, len(e))):
            if e[k] > 1e-9 * e[0]:
                out[key, k + 1] = (deviation, abs(row @ q[:, k]) / math.sqrt(e[k]), e[k] / e.sum())
    return out


def agrees(got, want, n):
    assert {(r.vec_id, r.component) for r in got} == want.keys()
    for r in got:
        deviation, value, explained = want[r.vec_id, r.component]
        assert (r.n, r.deviation) == (n, deviation)
        assert abs(abs(r.whitened) - value) < 1e-6 and abs(r.explained - explained) <= 1e-10 and r.identity_error <= 1e-8
    assert len({r.identity_error for r in got}) <= 1


def turned(values, seed=1):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    v = (q * values) @ q.T
    return (v + v.T) / 2


@pytest.mark.parametrize("values", [
    np.arange(40.0, 0, -1), np.repeat(np.arange(10.0, 0, -1), 4), 1 + np.arange(40) * 1e-9, 10.0 ** -np.arange(0, 10, 0.25), np.append(np.arange(7.0, 0, -1), np.zeros(33)),
    np.ones(40), np.array([3.0]), np.zeros(5), np.arange(20.0, -20, -1)], ids=["apart", "fourfold", "near", "steep", "low rank", "one group", "single", "zero", "signs"])
def test_spectrum(values):
    v = turned(values)
    want = np.sort(values)[::-1][:32]
    e, x = leading(v, 32)
    scale = max(np.abs(values).max(), 1e-300)
    assert np.abs(e - want).max() <= 1e-13 * scale and np.abs(v @ x - x * e).max() <= 1e-13 * scale
    real = np.abs(e) > 1e-11 * scale
    if real.any():
        inner = x[:, real].T @ x[:, real] - np.eye(real.sum())
        assert np.abs(inner).max() < 1e-5
    for shift in (-0.5, 0.37, 2.5, 8.25):
        if np.abs(values - shift).min() > 1e-6:
            assert count_above(v, shift) == (values > shift).sum()


def test_pivots_of_two():
    v = np.array([[0.0, 1, 0], [1, 0, 2], [0, 2, 0]])
    e, x = leading(v, 3)
    assert np.allclose(e, [5**0.5, 0, -(5**0.5)]) and np.allclose(v @ x, x * e) and count_above(v, 0.1) == 1


def test_against_a_library(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(c) for c in rng.standard_normal(9) * np.arange(1, 10)]) for i in range(300)]
    rows += [(1000, rows[0][1])]
    bad = [(2000, None), (2001, [1.0] * 8 + [None]), (2002, [float("nan")] + [1.0] * 8), (2003, [float("inf")] + [1.0] * 8), (2004, [])]
    agrees(whiten(vectors(spark, rows + bad).repartition(7)).collect(), brute(rows), len(rows))


def test_repeated_rows_and_null_ids(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(c) for c in rng.standard_normal(3)]) for i in range(20)]
    got = whiten(vectors(spark, [*rows, rows[5], (None, rows[6][1])])).collect()
    assert len(got) == 3 * 22 and sum(r.vec_id is None for r in got) == 3 and sum(r.vec_id == 5 for r in got) == 6


def test_shorter_vectors_have_zeros_behind(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(c) for c in rng.standard_normal(4)]) for i in range(30)]
    cut = [(i, v[:2] if i % 3 == 0 else v) for i, v in rows]
    full = [(i, [*v[:2], 0.0, 0.0] if i % 3 == 0 else v) for i, v in rows]
    agrees(whiten(vectors(spark, cut).repartition(5)).collect(), brute(full), 30)


def test_vectors_without_variance(spark):
    assert whiten(vectors(spark, [])).count() == 0
    assert whiten(vectors(spark, [(1, [1.0, 2.0])])).count() == 0
    assert whiten(vectors(spark, [(i, [1.0, 2.0]) for i in range(5)])).count() == 0
    flat = whiten(vectors(spark, [(i, [float(i), 2.0]) for i in range(5)])).collect()
    assert {r.component for r in flat} == {1} and flat[0].explained == 1.0


def test_huge_entries(spark):
    rows = [(i, [1e15 * (i % 3), float(i)]) for i in range(9)] + [(9, [3e38, 0.0])]
    got = whiten(vectors(spark, rows)).collect()
    assert {r.vec_id for r in got} == set(range(10)) and all(r.deviation is None for r in got)


def test_query_on_whole_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    agrees(QUERIES["op13_embedding_whitening"](spark, SF).collect(), brute(rows), len(rows))
