"""Whitening against numpy's eigenvalues, and the incremental decomposition itself."""

import numpy as np
import pandas as pd
import pytest

from ledgerloom.llm.queries import QUERIES
from ledgerloom.llm.whitening import Spectrum, incremental, rank_one, whiten


def scatter(x):
    away = x - x.mean(0)
    return away.T @ away


def rebuilt(s):
    return s.vectors * s.values @ s.vectors.T


SETS = {
    "normal": lambda r: np.floor(64 * r.normal(size=(300, 24)) * r.uniform(0.01, 1, 24)),
    "constant columns": lambda r: np.floor(64 * r.normal(size=(200, 16)) * (np.arange(16) % 3 > 0)),
    "fewer rows than columns": lambda r: np.floor(64 * r.normal(size=(9, 32))),
    "zeros and ones": lambda r: r.integers(0, 2, (150, 20)).astype(float),
    "equal rows": lambda r: np.ones((20, 5)),
    "one column": lambda r: r.integers(-50, 50, (60, 1)).astype(float),
    "one row": lambda r: r.integers(-50, 50, (1, 7)).astype(float),
}


@pytest.mark.parametrize("name", SETS)
def test_updates_equal_the_scatter_matrix(name):
    x = SETS[name](np.random.default_rng(5))
    whole, left, right = (Spectrum(x.shape[1]) for _ in range(3))
    for i, row in enumerate(x):
        whole.add(row)
        (left if i % 3 else right).add(row)
    left.combine(right)
    bound = 1e-12 * max(np.abs(scatter(x)).max(), 1)
    for s in (whole, left):
        assert s.n == len(x) and np.abs(s.mean - x.mean(0)).max() < 1e-10
        assert np.abs(rebuilt(s) - scatter(x)).max() < bound
        assert np.abs(s.vectors.T @ s.vectors - np.eye(x.shape[1])).max() < 1e-12


def test_rank_one_with_very_unequal_weights():
    rng = np.random.default_rng(2)
    for _ in range(50):
        d = np.sort(rng.uniform(0, 10, 12)) + np.arange(12) * 1e-6
        z = rng.normal(size=12) * 10.0 ** rng.integers(-5, 2, 12)
        values, vectors = rank_one(d, z, 2.5)
        want = np.diag(d) + 2.5 * np.outer(z, z)
        assert np.allclose(values, np.linalg.eigvalsh(want), rtol=1e-12, atol=1e-12)
        assert np.abs(want @ vectors - vectors * values).max() < 1e-11 * np.abs(want).max()
        assert np.abs(vectors.T @ vectors - np.eye(12)).max() < 1e-12


def check(rows, vectors, most=16):
    """``rows`` of whitening against a plain computation over (id, vector)."""
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for _, v in vectors], object)
    fit = np.array(sorted(set(map(tuple, x.tolist()))), object)
    n, total = len(fit), fit.sum(0)
    away = (fit * n - total).astype(float) / n
    e, q = np.linalg.eigh(away.T @ away / n)
    e, q = e[::-1], q[:, ::-1]
    k = min(most, x.shape[1])
    assert len(rows) == len(x) * k
    got = {(r["vec_id"], r["component"]): r for r in rows}
    spread = e > e[0] * 1e-12
    for (i, _), row in zip(vectors, x):
        deviation = int(((row * n - total) ** 2).sum())
        for c in range(1, k + 1):
            r = got[i, c]
            assert (r["n"], r["deviation"]) == (n, deviation)
            assert r["explained"] == pytest.approx(e[c - 1] / e.sum(), rel=1e-9, abs=1e-14)
            assert 0 <= r["identity_error"] < 1e-9
            assert (r["whitened"] is None) == (not spread[c - 1])
    white = np.array([[got[i, c]["whitened"] or 0.0 for c in range(1, k + 1)] for i, _ in vectors])
    want = ((x * n - total).astype(float) / n) @ q[:, :k] / np.sqrt(np.where(spread, e, 1))[:k]
    for c in range(k):
        apart = np.diff(e, prepend=np.inf, append=-np.inf)[c : c + 2]
        if spread[c] and (np.abs(apart) > 1e-6 * e[0]).all():
            sign = np.sign((white[:, c] * want[:, c]).sum())
            assert np.abs(white[:, c] * sign - want[:, c]).max() < 1e-6


def test_given_vectors(spark, small):
    table = pd.read_parquet(f"{small}/embeddings.parquet")
    rows = [r.asDict() for r in QUERIES["op11_whitening"](spark, small).collect()]
    check(rows, list(zip(table.vec_id.tolist(), table.embedding.tolist())))


def test_odd_vectors(spark):
    rng = np.random.default_rng(3)
    good = [(i, [float(c) for c in rng.normal(size=5)]) for i in range(40)]
    copies = [(100 + i, good[0][1]) for i in range(30)]
    odd = [(200, None), (201, [None] * 5), (202, [float("nan")] * 5), (203, [float("inf"), 0.0, 0.0, 0.0, 0.0]),
           (204, []), (205, [1.0, 2.0]), (206, [1e30, 0.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in good + copies + odd], "vec_id long, embedding array<double>, x int, at int")
    rows = [r.asDict() for r in whiten(df.repartition(7)).collect()]
    check(rows, good + copies)


def test_no_variance_and_few_rows(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (None, [1.0, 2.0])], "vec_id long, embedding array<float>")
    rows = whiten(df).collect()
    assert len(rows) == 6 and all(r["whitened"] is None and r["deviation"] == 0 and r["n"] == 1 for r in rows)
    assert sum(r["vec_id"] is None for r in rows) == 2
    two = spark.createDataFrame([(1, [1.0, 2.0, 0.0]), (2, [4.0, 2.0, 0.0])], "vec_id long, embedding array<float>")
    got = {(r["vec_id"], r["component"]): r for r in whiten(two).collect()}
    assert sorted(round(got[i, 1]["whitened"], 9) for i in (1, 2)) == [-1.0, 1.0]
    assert got[1, 2]["whitened"] is None and got[1, 1]["explained"] == pytest.approx(1)


def test_large_deviations_stay_exact(spark):
    data = [(i, [float((-1) ** i * 2**23 + i), float(i)]) for i in range(200)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    x = np.array([[int(np.floor(64 * c)) for c in v] for _, v in data], object)
    total = x.sum(0)
    want = {i: int(((r * 200 - total) ** 2).sum()) for (i, _), r in zip(data, x)}
    got = {r["vec_id"]: r["deviation"] for r in whiten(df).collect()}
    assert got == {i: w if w < 2**63 else None for i, w in want.items()}


def test_spectra_of_many_tasks_are_combined(spark):
    rng = np.random.default_rng(8)
    x = np.floor(64 * rng.normal(size=(500, 6)))
    df = spark.createDataFrame([([int(c) for c in r],) for r in x], "x array<int>").repartition(70)
    found = incremental(df, 6)
    assert found.n == 500 and np.abs(rebuilt(found) - scatter(x)).max() < 1e-8
