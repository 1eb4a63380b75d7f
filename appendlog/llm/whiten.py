"""Embedding whitening by QDWH spectral divide-and-conquer.

Entries become integers, ``floor(scale * c) + shift``.  The distinct vectors
are the fit list; sums and the covariance come from partial aggregates over its
partitions.  The covariance (dimension x dimension, the only matrix on the
driver) is split recursively: for a shift s, the orthogonal polar factor U of
``V - s I`` has eigenvalues +1 and -1, so ``(U + I) / 2`` is the spectral
projector onto the directions with variance above s.  An orthonormal basis of
its range and of the complement cut V into two smaller blocks.  U comes from
the dynamically weighted Halley iteration in its QR form (Nakatsukasa and
Higham 2013), so no inverse and no eigenvalue routine is used.  Mean and components then travel to the tasks,
which project their rows batch by batch.

Defined results: vectors that are null, hold null or non-finite entries or an
entry beyond +-2^53 after scaling take no part, nor do vectors of another
length than the commonest (ties: the longest); a null key stays a null key;
repeated rows each get their rows, and count once in the fit list; components
whose variance is zero to rounding (under dimension x 2^-48 of the largest)
are left out, so one distinct vector, or none, gives no rows; a deviation
beyond a long is given as the largest long; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from appendlog.llm.common import pinned
from appendlog.session import ship_package

SCHEMA = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
          "identity_error double")
EPS = float(np.finfo(np.float64).eps)


# --- the polar factor and the recursive split (driver, dimension x dimension) ---


def polar_factor(a: np.ndarray, rounds: int = 40) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix, by the QR-based dynamically
    weighted Halley iteration.

    ``low`` bounds the smallest singular value of the scaled matrix from below;
    it starts at rounding level, so any matrix (nearly singular ones too) takes
    at most a few rounds more.
    """
    n = len(a)
    size = np.linalg.norm(a)  # Frobenius: an upper bound of the largest singular value
    if size == 0.0:
        return np.eye(n)
    x, low = a / size, EPS
    for _ in range(rounds):
        l2 = low * low
        d = np.cbrt(4.0 * (1.0 - l2) / (l2 * l2)) if low < 1.0 else 0.0
        root = np.sqrt(1.0 + d)
        wa = root + 0.5 * np.sqrt(max(0.0, 8.0 - 4.0 * d + 8.0 * (2.0 - l2) / (l2 * root)))
        wb = (wa - 1.0) ** 2 / 4.0
        wc = wa + wb - 1.0
        q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, np.eye(n)]))
        new = (wb / wc) * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        new = (new + new.T) / 2.0
        low = min(1.0, low * (wa + wb * l2) / (1.0 + wc * l2))
        moved = np.linalg.norm(new - x)
        x = new
        if moved < np.cbrt(EPS) / 4 and 1.0 - low < 1e-8:  # third order: the next step is exact
            break
    return x


def _basis(projector: np.ndarray, rank: int, rng: np.random.Generator) -> np.ndarray:
    """Square orthogonal matrix whose first ``rank`` columns span the projector's range."""
    q = rng.standard_normal((len(projector), rank))
    for _ in range(2):
        q = np.linalg.qr(projector @ q)[0]
    return np.linalg.qr(projector @ q, mode="complete")[0]


def _split(a: np.ndarray, tiny: float, rng: np.random.Generator) -> tuple[np.ndarray, int] | None:
    """(orthogonal matrix, size of its first part) that makes ``a`` block diagonal;
    None if ``a`` is a multiple of the identity up to ``tiny``."""
    n = len(a)
    middle = np.trace(a) / n
    spread = np.linalg.norm(a - middle * np.eye(n))
    if spread <= tiny * np.sqrt(n):
        return None
    # the mean of the eigenvalues always lies strictly between two of them; the
    # median of the diagonal cuts nearer to halves
    diagonal = np.sort(np.diag(a))
    tries = [float(np.median(diagonal)), middle] + [middle + spread / np.sqrt(n) * f for f in (0.13, -0.13, 0.29, -0.29, 0.61, -0.61)]
    best = None
    for shift in tries:
        u = polar_factor(a - shift * np.eye(n))
        rank = int(round((np.trace(u) + n) / 2.0))
        if not 0 < rank < n:
            continue
        q = _basis((u + np.eye(n)) / 2.0, rank, rng)
        off = np.linalg.norm(q[:, :rank].T @ a @ q[:, rank:])
        if best is None or off < best[0]:
            best = (off, q, rank)
        if off <= tiny * n:
            break
    return None if best is None else best[1:]


def spectral(v: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of a symmetric matrix."""
    v = (v + v.T) / 2.0
    rng = np.random.default_rng(seed)
    tiny = EPS * max(np.linalg.norm(v), np.finfo(np.float64).tiny)
    vectors = []
    todo = [np.eye(len(v))]  # bases of invariant subspaces, split until a single direction is left
    while todo:
        basis = todo.pop()
        if basis.shape[1] == 1:
            vectors.append(basis)
            continue
        block = basis.T @ v @ basis
        cut = _split((block + block.T) / 2.0, tiny, rng)
        if cut is None:  # equal eigenvalues: any basis will do
            vectors.extend(basis[:, i:i + 1] for i in range(basis.shape[1]))
            continue
        q, rank = cut
        todo += [basis @ q[:, :rank], basis @ q[:, rank:]]
    w = np.hstack(vectors)
    w, r = np.linalg.qr(w)  # products of many bases: orthogonal to the last bit again
    w = w * np.sign(np.where(np.diag(r) == 0, 1.0, np.diag(r)))
    values = np.einsum("ij,ij->j", w, v @ w)
    order = np.argsort(-values, kind="stable")
    return values[order], w[:, order]


# --- the fit, by partial aggregates ---


def whole_numbers(vector: Column, scale: float, shift: int) -> Column:
    """``floor(scale * c) + shift`` of each entry, as longs; null for a vector that takes no part."""
    x = F.transform(vector, lambda c: F.lit(float(scale)) * c.cast("double"))
    fits = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < 2.0**53))
    return F.when(vector.isNotNull() & fits, F.transform(x, lambda c: F.floor(c).cast("bigint") + F.lit(shift).cast("bigint")))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """A column of longs' lists (none null, all of ``width``) as a matrix."""
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.int64).reshape(-1, width)


class Centre:
    """The exact mean S / n, and rows relative to it."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums

    def exact(self, x: np.ndarray) -> np.ndarray:
        """``n * x - S``, exactly (Python integers where longs could overflow)."""
        most = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) * self.n + max(map(abs, self.sums), default=0)
        kind = np.int64 if most < 2**63 else object
        return x.astype(kind) * self.n - np.array(self.sums, dtype=kind)

    def rows(self, x: np.ndarray) -> np.ndarray:
        """``x - S / n`` in doubles, rounded once."""
        return self.exact(x).astype(np.float64) / self.n

    def deviation(self, x: np.ndarray) -> list[int]:
        """Sum of squares of ``n * x - S``, exactly."""
        y = self.exact(x)
        if y.dtype == np.int64:
            most = max(int(y.max(initial=0)), -int(y.min(initial=0)))
            if most * most * max(1, y.shape[1]) < 2**63:
                return np.einsum("ij,ij->i", y, y).tolist()
        return [min(sum(int(c) * int(c) for c in r), 2**63 - 1) for r in y]


def _sums(width: int):
    """Arrow function: per partition, the exact sum of each column, as rows
    (i, s); row ``width`` has the number of vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * (width + 1)
        for b in batches:
            x = _matrix(b.column(0), width)
            high, low = (x >> 20).sum(axis=0).tolist(), (x & 0xFFFFF).sum(axis=0).tolist()
            total = [t + (h << 20) + w for t, h, w in zip(total, [*high, 0], [*low, len(x)])]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(width + 1), pa.int32()), pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))], ["i", "s"])

    return run


def _products(make, width: int):
    """Arrow function: per partition, the sum of products of each two columns of
    ``make(x)``, as rows (i, j, s) with i <= j."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            z = make(b.column(0))
            total = z.T @ z if total is None else total + z.T @ z
        if total is not None:
            i, j = np.triu_indices(width)
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])],
                                             ["i", "j", "s"])

    return run


def _covariance(fit: DataFrame, make, width: int, n: int) -> np.ndarray:
    """Covariance (divisor n) of the centred columns of ``make(x)``."""
    got = fit.mapInArrow(_products(make, width), "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    out = np.zeros((width, width))
    for r in got:
        out[r.i, r.j] = out[r.j, r.i] = r.s / n
    return out


class Whitening:
    """What tasks know: the centre, the components and their variances."""

    def __init__(self, centre: Centre, width: int, values: np.ndarray, vectors: np.ndarray, trace: float):
        self.centre, self.width = centre, width
        self.values, self.vectors, self.trace = values, vectors, trace
        self.error = 0.0

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centre.rows(x) @ self.vectors / np.sqrt(self.values)


def _apply(w: Whitening):
    k = len(w.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column(1), w.width)
            rows = len(x)
            yield pa.RecordBatch.from_arrays(
                [pa.array(b.column(0).to_pylist(), pa.int64()).take(pa.array(np.repeat(np.arange(rows), k))),
                 pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)), pa.array(np.full(rows * k, w.centre.n, np.int64)),
                 pa.array(np.repeat(np.array(w.centre.deviation(x), np.int64), k)), pa.array(w.project(x).ravel()),
                 pa.array(np.tile(w.values / w.trace, rows)), pa.array(np.full(rows * k, w.error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return run


def fit(x: DataFrame, width: int, components: int) -> Whitening | None:
    """Fit on the distinct vectors of ``x`` (column ``x``); None where no direction varies."""
    distinct = pinned(x.select("x").distinct(), "whiten-distinct")
    if not width:
        return None
    sums = {r.i: int(r.s) for r in distinct.mapInArrow(_sums(width), "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s")).collect()}
    n = sums[width]
    centre = Centre(n, [sums[i] for i in range(width)])
    v = _covariance(distinct, lambda c: centre.rows(_matrix(c, width)), width, n)
    values, vectors = spectral(v)
    live = int(np.sum(values > width * 2.0**-48 * values[0])) if values[0] > 0 else 0
    if not live:
        return None
    k = min(components, live)
    w = Whitening(centre, width, values[:k], vectors[:, :k], float(np.trace(v)))
    # the result's own covariance: its mean first, then centred products
    def mean_of(batches):
        total = np.zeros(k)
        for b in batches:
            total += w.project(_matrix(b.column(0), width)).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k, dtype=np.int32)), pa.array(total)], ["i", "s"])

    means = {r.i: r.s / n for r in distinct.mapInArrow(mean_of, "i int, s double").groupBy("i").agg(F.sum("s").alias("s")).collect()}
    mean = np.array([means[i] for i in range(k)])
    c = _covariance(distinct, lambda col: w.project(_matrix(col, width)) - mean, k, n)
    w.error = float(np.abs(c - np.eye(k)).max())
    return w


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: float = 64.0, shift: int = 1_000_000,
           components: int = 16) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``:
    a row for each vector and each of the first ``components`` components."""
    spark = df.sparkSession
    ship_package(spark)
    x = pinned(df.select(F.col(key).cast("long").alias("key"), whole_numbers(F.col(vector), scale, shift).alias("x"))
               .where("x is not null"), "whiten-rows")
    sizes = x.groupBy(F.size("x").alias("size")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), F.desc("size")).first()
    if sizes is None:
        return spark.createDataFrame([], SCHEMA)
    width = sizes["size"]
    x = x.where(F.size("x") == width)
    w = fit(x, width, components)
    if w is None:
        return spark.createDataFrame([], SCHEMA)
    return x.select("key", "x").mapInArrow(_apply(w), SCHEMA)
