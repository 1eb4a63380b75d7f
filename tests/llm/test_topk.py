"""Exact top-k: against all scores, with ties, copies, odd vectors and small annuli."""

import math
import random

import pytest
from pyspark.sql import functions as F

from appendlog.llm import topk

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k=20, every=20):
    """Rows (query_id, rank, vec_id, score), sorted."""
    def usable(v):
        return v is not None and all(c is not None and math.isfinite(c) for c in v)

    xs = [(i, key, [math.floor(64 * c) for c in v]) for i, (key, v) in enumerate(rows) if usable(v)]
    out = []
    for i, key, x in xs:
        if key is None or key % every:
            continue
        got = sorted(((-sum(a * b for a, b in zip(x, y)), o is None, o or 0, j, o) for j, o, y in xs if j != i and len(y) == len(x)))
        out += [(key, r + 1, g[4], -g[0]) for r, g in enumerate(got[:k])]
    return sorted(out, key=str)


def answer(spark, rows, k=20, every=20, extra=()):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in extra:
        df = df.withColumn(name, F.lit("x"))
    return sorted(map(tuple, topk.top_k(df, F.col("vec_id") % every == 0, k=k).collect()), key=str)


def points(rng, n, width=6, clusters=4, spread=0.1):
    """Floats that single precision holds exactly, in clusters of unequal size."""
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(clusters)]
    return [[round(c + rng.gauss(0, spread), 2) // (1 / 64) / 64 for c in centres[min(rng.randrange(9), clusters - 1)]] for _ in range(n)]


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_small_annuli_many_rounds(spark, monkeypatch, spread):
    """Annuli of a few vectors: many are left out by their bounds, results stay exact."""
    monkeypatch.setattr(topk, "ANNULUS", 8)
    monkeypatch.setattr(topk, "GROUP", 7)
    rng = random.Random(int(100 * spread))
    rows = list(zip(rng.sample(range(5000), 600), points(rng, 600, spread=spread)))
    assert answer(spark, rows, k=5) == brute(rows, k=5)


def test_bounds_leave_annuli_out(spark, monkeypatch):
    """Far fewer (query, annulus) meetings than all, where vectors are clustered."""
    monkeypatch.setattr(topk, "ANNULUS", 8)
    met = []
    make = topk._router

    def counting(index, done, more):
        met.append((len(index.annuli["block"]), done))
        return make(index, done, more)

    monkeypatch.setattr(topk, "_router", counting)
    sizes = []
    keep = topk.pinned
    monkeypatch.setattr(topk, "pinned", lambda df, tag: (out := keep(df, tag), sizes.append(
        out.agg(F.sum("n")).first()[0] or 0) if tag == "topk-routes" else None)[0])
    rng = random.Random(4)
    rows = [(i, p) for i, p in enumerate(points(rng, 800, clusters=8, spread=0.01))]
    assert answer(spark, rows, k=5) == brute(rows, k=5)
    annuli = met[0][0]
    assert annuli > 50 and sum(sizes) < 0.5 * annuli * 40  # 40 queries


def test_copies_ties_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(topk, "ANNULUS", 16)
    rng = random.Random(2)
    hot = [0.5, -0.25, 1.0]
    rows = [(i, hot) for i in range(0, 300)]  # a third of all rows is one vector
    rows += [(300 + i, [rng.randrange(-3, 4) / 2 for _ in range(3)]) for i in range(200)]  # many equal scores
    rows += [(600, hot), (600, hot), (620, [0.0, 0.0, 0.0]), (621, [0.0, 0.0, 0.0]), (-40, [-1.0, 0.0, 2.0])]
    rows += [(None, hot), (None, [9.0, 9.0, 9.0]), (700, None), (720, [1.0, None, 2.0]), (740, [float("nan"), 0.0, 1.0]),
             (760, [float("inf"), 0.0, 0.0]), (780, []), (781, []), (800, [1.0, 2.0]), (801, [3.0, 4.0]), (820, [5.0])]
    assert answer(spark, rows, k=4, extra=("x", "id", "row", "score")) == brute(rows, k=4)


def test_large_entries(spark):
    """Scores beyond single and double precision stay exact; beyond a long the row takes no part."""
    rng = random.Random(9)
    rows = [(i, [float(rng.randrange(-2**22, 2**22)) for _ in range(4)]) for i in range(120)]
    assert answer(spark, rows, k=6) == brute(rows, k=6)
    assert answer(spark, rows + [(1000, [1e30, 0.0, 0.0, 0.0])], k=6) == brute(rows, k=6)


def test_few_or_no_rows(spark):
    assert answer(spark, []) == []
    assert answer(spark, [(20, [1.0])]) == []
    assert answer(spark, [(1, [1.0]), (2, [2.0])]) == []
    assert answer(spark, [(20, [1.0]), (2, [2.0])]) == [(20, 1, 2, 64 * 128)]


def test_sf(spark):
    from appendlog.llm.queries import op12_top_k

    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert sorted(map(tuple, op12_top_k(spark, sf).collect()), key=str) == brute(rows)
