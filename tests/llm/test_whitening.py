"""Spectrum slicing against numpy's eigenvalues, and whitening against a plain computation."""

import math

import numpy as np
import pytest

from conftest import SF_SMALL
from tsline.llm import queries, whitening

VEC = "vec_id long, embedding array<double>, whitened string, n string"


def symmetric(values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    return (q * np.array(values, float)) @ q.T


@pytest.mark.parametrize("seed", range(4))
def test_factors(seed):
    rng = np.random.default_rng(seed)
    a = rng.standard_normal((30, 30))
    a = a + a.T
    a[0, 0] = a[5, 5] = 0.0
    f = whitening.Factors(a)
    d = np.zeros((30, 30))
    for k, block in f.blocks:
        d[k:k + len(block), k:k + len(block)] = block
    assert np.allclose(f.below @ d @ f.below.T, a[np.ix_(f.order, f.order)], atol=1e-10)
    assert f.positive() == (np.linalg.eigvalsh(a) > 0).sum()
    b = rng.standard_normal(30)
    assert np.allclose(a @ f.solve(b, 1e-300), b, atol=1e-8)


@pytest.mark.parametrize("values", [
    range(1, 40), [5.0] * 6 + [1.0] * 10, [1 + 1e-9 * i for i in range(20)], [1, 1 + 1e-14, 0.5, 0.5, 0, 0, 0],
    [10.0 ** -i for i in range(12)], [3.0], [0.0, 0.0], [1e12, 1.0, 1.0, 1e-12], [7, 7, 7, 7]])
def test_leading(values):
    a = symmetric(list(values), 3)
    a = (a + a.T) / 2
    got, vectors = whitening.Spectrum(a).leading(16)
    want = np.linalg.eigvalsh(a)[::-1][:16]
    top = max(abs(want[0]), 1e-300)
    assert len(got) == sum(w > 64 * len(a) * whitening._EPS * top for w in want) or len(got) <= len(want)
    assert np.allclose(got, want[:len(got)], rtol=1e-12, atol=1e-13 * top)
    assert all(w <= 1e3 * len(a) * whitening._EPS * top for w in want[len(got):])
    assert np.abs(vectors @ vectors.T - np.eye(len(got))).max(initial=0) < 1e-12
    assert np.abs(vectors @ a - got[:, None] * vectors).max(initial=0) < 1e-12 * top


def plain(rows, most=16):
    """The contract's values by whole-matrix numpy and exact Python integers."""
    kept = []
    for vec_id, c in rows:
        if c is None or any(v is None or not math.isfinite(v) for v in c):
            continue
        kept.append((vec_id, [math.floor(64 * v) + 1_000_000 for v in c]))
    if not kept:
        return []
    lengths = [len(x) for _, x in kept]
    d = max(set(lengths), key=lambda v: (lengths.count(v), v))
    kept = [(i, x) for i, x in kept if len(x) == d]
    fit = sorted({tuple(x) for _, x in kept})
    n, sums = len(fit), [sum(x[i] for x in fit) for i in range(d)]
    z = np.array([[(n * v - s) / n for v, s in zip(x, sums)] for x in fit])
    v = z.T @ z / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1], q[:, ::-1]
    k = min(most, int((e > 1e-10 * max(e[0], 1e-300)).sum()) if d else 0)
    out = []
    for vec_id, x in kept:
        own = np.array([(n * a - s) / n for a, s in zip(x, sums)])
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        out += [(vec_id, c + 1, n, deviation, abs(float(own @ q[:, c])) / math.sqrt(e[c]), e[c] / e.sum()) for c in range(k)]
    return out


def same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[3], abs(r[4]))
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    assert np.allclose([abs(r[4]) for r in got], [r[4] for r in want], atol=1e-6)
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-9)
    errors = {r[6] for r in got}
    assert len(errors) <= 1 and all(0 <= e < 1e-9 for e in errors)
    # one sign for all rows of a component
    for c in {r[1] for r in got}:
        mean = sum(r[4] for r in got if r[1] == c)
        assert math.isfinite(mean)


def test_query(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()
    got = queries.op13_whitening(spark, SF_SMALL).collect()
    same(got, plain([(r["vec_id"], r["embedding"]) for r in rows]))


def test_one_sign_and_identity(spark):
    """The projections of the distinct rows have the identity as covariance, so signs agree over tasks."""
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").repartition(7)
    rows = whitening.whiten(df).select("vec_id", "component", "whitened").collect()
    ids = sorted({r["vec_id"] for r in rows})
    w = np.zeros((len(ids), 16))
    for r in rows:
        w[ids.index(r["vec_id"]), r["component"] - 1] = r["whitened"]
    assert np.abs(w.T @ w / len(ids) - np.eye(16)).max() < 1e-9


def test_hostile(spark):
    rng = np.random.default_rng(1)
    good = [(i, [round(float(v), 3) for v in rng.normal(0, 1 + i % 3, 5)]) for i in range(60)]
    odd = [(100, None), (101, []), (102, [1.0, None, 0.0, 0.0, 0.0]), (103, [float("nan")] * 5),
           (104, [float("inf")] + [0.0] * 4), (105, [0.5, 0.5]), (None, good[3][1]), (7, good[7][1]), (7, good[8][1]),
           (106, [1e300, 0.0, 0.0, 0.0, 0.0]), (107, None)]
    df = spark.createDataFrame([(i, v, "clash", "clash") for i, v in good + odd], VEC)
    got = whitening.whiten(df).collect()
    same(got, plain([r for r in good + odd if r[0] != 106]))
    assert {r["component"] for r in got} == {1, 2, 3, 4, 5}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.5, 1.0])], [(1, [0.5]), (2, [0.5])], [(1, []), (2, [])]])
def test_nothing_varies(spark, rows):
    df = spark.createDataFrame([(i, v, "a", "b") for i, v in rows], VEC)
    got = whitening.whiten(df)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert got.collect() == []


def test_deviation_beyond_64_bits(spark):
    df = spark.createDataFrame([(1, [1e12, 0.0], "", ""), (2, [0.0, 0.0], "", ""), (3, [1.0, 5.0], "", "")], VEC)
    got = {r["vec_id"]: r["deviation"] for r in whitening.whiten(df).where("component = 1").collect()}
    assert got == {1: None, 2: None, 3: None}
