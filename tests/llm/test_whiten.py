"""Whitening: against a dense eigenvalue routine and exact integers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from appendlog.llm import whiten

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, components=16):
    """{(key, x): deviation}, n, eigenvalues, eigenvectors, fit mean by numpy and Python integers."""
    x = [(k, tuple(math.floor(64 * c) + 1_000_000 for c in v)) for k, v in rows
         if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({v for _, v in x})
    n = len(fit)
    s = [sum(c) for c in zip(*fit)]
    deviation = {v: sum((n * a - b) ** 2 for a, b in zip(v, s)) for v in fit}
    z = np.array([[(n * a - b) / n for a, b in zip(v, s)] for v in fit])
    e, w = np.linalg.eigh(z.T @ z / n)
    return x, n, deviation, e[::-1][:components], w[:, ::-1][:, :components], np.trace(z.T @ z / n), s


def check(spark, rows, components=16, tol=1e-7, extra=()):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in extra:
        df = df.withColumn(name, F.lit("x"))
    got = whiten.whiten(df, components=components).collect()
    x, n, deviation, e, w, trace, s = brute(rows, components)
    assert len(got) == len(x) * len(e)
    assert {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    by_key = {}
    for r in got:
        by_key.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append((r.whitened, r.explained))
    sign = np.zeros(len(e))
    for k, v in x:
        mine = by_key[(k, deviation[v])]
        want = np.array([(n * a - b) / n for a, b in zip(v, s)]) @ w / np.sqrt(e)
        for c in range(len(e)):
            values = [m[0] for m in mine[c + 1]]
            assert all(abs(m[1] - e[c] / trace) <= 1e-9 * m[1] for m in mine[c + 1])
            if sign[c] == 0 and abs(want[c]) > 1e-3:
                sign[c] = np.sign(want[c]) * np.sign(min(values, key=lambda a: abs(abs(a) - abs(want[c]))))
            assert min(abs(a * (sign[c] or 1) - want[c]) for a in values) < tol
    return got


def test_against_dense(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((300, 24)) * np.linspace(3, 0.3, 24) + rng.standard_normal(24)
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(base)]
    rows += [(1000 + i, rows[7][1]) for i in range(150)]  # copies count once
    rows += [(5, rows[5][1]), (None, rows[6][1]), (2000, None), (2001, [None] + rows[0][1][1:]),
             (2002, [float("nan")] * 24), (2003, [float("-inf")] + [0.0] * 23)]
    check(spark, rows, extra=("key", "n", "x", "component"))


def test_sf(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(spark, rows)


def test_other_lengths_take_no_part(spark):
    rng = random.Random(1)
    rows = [(i, [rng.random() * 9, rng.random() * 3]) for i in range(50)]
    odd = [(100, [1.0]), (101, []), (102, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame(rows + odd, SCHEMA)
    assert {r.vec_id for r in whiten.whiten(df).collect()} == set(range(50))


def test_no_variance(spark):
    assert whiten.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whiten.whiten(spark.createDataFrame([(1, None), (2, [float("nan")])], SCHEMA)).count() == 0
    assert whiten.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], SCHEMA)).count() == 0
    assert whiten.whiten(spark.createDataFrame([(1, []), (2, [])], SCHEMA)).count() == 0
    # one direction of two varies
    got = whiten.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [2.0, 2.0])], SCHEMA)).collect()
    assert sorted((r.vec_id, r.component, abs(round(r.whitened, 9)), r.explained) for r in got) == [(1, 1, 1.0, 1.0), (2, 1, 1.0, 1.0)]


def test_deviation_is_exact_for_large_entries(spark):
    rows = [(i, [float(2**30 + 128 * i), float(-(2**29) * i)]) for i in range(9)]
    want = brute(rows)[2]
    got = {r.deviation for r in whiten.whiten(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {min(v, 2**63 - 1) for v in want.values()}


CASES = {
    "spread": np.linspace(1, 100, 40), "cluster": np.r_[150, np.linspace(76, 60, 39)],
    "equal": np.r_[[5.0] * 10, [3.0] * 20, [1.0] * 7], "deficient": np.r_[np.linspace(10, 1, 9), np.zeros(20)],
    "falling": 10.0 ** -np.arange(0, 14, 0.5), "identity": np.ones(12), "zero": np.zeros(5), "one": np.array([3.0]),
    "near": np.r_[100, 100 - 1e-6, 100 - 2e-6, np.linspace(50, 1, 20)], "signs": np.linspace(-3, 3, 14),
}


@pytest.mark.parametrize("name", CASES)
def test_spectral_split(name):
    values = np.sort(CASES[name])[::-1]
    n = len(values)
    q = np.linalg.qr(np.random.default_rng(n).standard_normal((n, n)))[0]
    a = (q * values) @ q.T
    e, w = whiten.spectral(a)
    size = max(1e-300, np.abs(values).max())
    assert np.abs(e - values).max() <= 1e-13 * size
    assert np.abs(w.T @ w - np.eye(n)).max() < 1e-13
    assert np.abs(a @ w - w * e).max() <= 1e-12 * size


def test_polar_factor():
    rng = np.random.default_rng(2)
    a = rng.standard_normal((30, 30))
    a = a + a.T
    e, w = np.linalg.eigh(a)
    assert np.abs(whiten.polar_factor(a) - (w * np.sign(e)) @ w.T).max() < 1e-12
