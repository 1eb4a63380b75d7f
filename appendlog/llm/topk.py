"""Exact top-k inner products through a pivot-distance index.

Vectors of integers go onto one sphere (the largest norm M is the radius, one
more coordinate fills shorter vectors up), where a larger inner product with a
query is a smaller angle to it, and angles obey the triangle inequality.

* Index: each distinct vector is keyed by its nearest pivot and its angle to
  it.  A pivot's vectors, sorted by angle, are cut into annuli of bounded size,
  each packed into one row.
* Search: for a query at angle t from a pivot, no vector of the annulus
  [lo, hi] scores above ``|q| M cos(max(0, lo - t, t - hi))``.  A query visits
  its annuli by falling bound, 1, then 8, then 64 ... more per round, and stops
  where the bound can't beat the k-th score found (equal scores: the smaller
  key).  Rows (annulus, up to ``GROUP`` queries) meet the annuli in one shuffle.

Pivots come from a bounded sample (``SAMPLE`` distinct vectors by hash, a few
rounds of spherical k-means); every row is indexed and results are exact
whatever the pivots.  Equal vectors are one index entry that carries its k + 1
smallest rows, so copies cost no search of their own.

Defined results: vectors that are null, hold null or non-finite entries, or
whose scaled squared norm is 2^62 or more (scores would leave a long) take no
part; vectors meet vectors of their own length only; a null key is never a
query and comes last among ties; repeated rows are rows of their own (each is
a candidate of the other); an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from appendlog.llm.common import pinned, sized
from appendlog.session import ship_package

#: Distinct vectors that the pivots are fitted on, most pivots, rounds of k-means.
SAMPLE, PIVOTS, FIT_ROUNDS = 4096, 256, 4
#: Vectors of an annulus (more where there would be over ``ANNULI`` of them: their
#: bounds travel to every task), angle steps that annuli are cut at.
ANNULUS, ANNULI, STEPS = 16_384, 16_384, 1024
#: Queries that travel together, rows of queries of one annulus per task, growth per round.
GROUP, GROUPS_PER_PART, GROWTH = 256, 64, 8
#: Rows of queries that one partition of the search holds (about).
GROUPS_PER_TASK = 32
#: Angles are taken as known to this much (arc cosine of doubles near 1).
SLACK = 1e-7
_LAST = np.iinfo(np.int64).max  # key of a null, last in order


def scaled(vector: Column, scale: float) -> Column:
    """``floor(scale * x)`` of each entry, as longs; null for a vector that takes no part."""
    x = F.transform(vector, lambda c: F.lit(float(scale)) * c.cast("double"))
    whole = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < 2.0**31))
    norm = F.aggregate(x, F.lit(0.0), lambda s, c: s + F.floor(c).cast("double") * F.floor(c))
    return F.when(vector.isNotNull() & whole & (norm < 2.0**62), F.transform(x, lambda c: F.floor(c).cast("bigint")))


def _packer(dtype: str):
    """Arrow function: the ``x`` lists as packed bytes of one number type."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            i = b.schema.get_field_index("x")
            packed = [np.asarray(v.values.to_numpy(zero_copy_only=False), np.int64).astype(dtype).tobytes() for v in b.column(i)]
            yield b.set_column(i, "x", pa.array(packed, pa.binary()))

    return run


def _unit(x: np.ndarray, radius: float) -> np.ndarray:
    """Rows on the unit sphere, one coordinate filled up."""
    u = x.astype(np.float64) / radius
    return np.hstack([u, np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", u, u)))[:, None]])


def _fit(units: np.ndarray, n: int) -> np.ndarray:
    """``n`` pivots on the sphere: spread seeds, then spherical k-means."""
    seeds, near = [0], units @ units[0]
    while len(seeds) < n:
        far = int(np.argmin(near))
        if near[far] > 1 - 1e-12:
            break
        # every second seed is spread, the others follow the mass
        far = far if len(seeds) % 2 else (far + len(seeds) * 7919) % len(units)
        seeds.append(far)
        near = np.maximum(near, units @ units[far])
    pivots = units[seeds]
    for _ in range(FIT_ROUNDS):
        own = np.argmax(units @ pivots.T, axis=1)
        sums = np.zeros_like(pivots)
        np.add.at(sums, own, units)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        pivots = np.where(norms > 1e-9, sums / np.maximum(norms, 1e-9), pivots)
    return pivots


class Index:
    """What tasks know of the index: sphere, pivots and (once cut) the annuli."""

    def __init__(self, dtype: str, radius: float, width: int, pivots: np.ndarray):
        self.dtype, self.radius, self.width, self.pivots = dtype, radius, width, pivots
        self.annuli: dict[str, np.ndarray] = {}

    def angles(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Angle of each row to each pivot; queries lie in the plane of the added coordinate's 0."""
        if query:
            norm = np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
            u = np.hstack([x / np.maximum(norm, 1e-300), np.zeros((len(x), 1))])
        else:
            u = _unit(x, self.radius)
        return np.arccos(np.clip(u @ self.pivots.T, -1.0, 1.0))

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cell, angle) of each row; a row of another length than the fitted one has its length's cell."""
        if x.shape[1] != self.width:
            return np.full(len(x), len(self.pivots) + x.shape[1]), np.zeros(len(x))
        a = self.angles(x, False)
        own = np.argmin(a, axis=1)
        return own, a[np.arange(len(x)), own]

    def bounds(self, x: np.ndarray) -> np.ndarray:
        """Largest score of each query (row) with each annulus (column); below any score: other lengths."""
        t, n = self.annuli, len(x)
        norm = np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True) * self.radius
        if x.shape[1] == self.width:
            ours = t["cell"] < len(self.pivots)
            angle = self.angles(x, True)[:, np.where(ours, t["cell"], 0)]
            gap = np.maximum(0.0, np.maximum(t["lo"] - angle, angle - t["hi"]) - SLACK)
            best = norm * np.cos(np.minimum(gap, np.pi))
        else:
            ours, best = t["cell"] == len(self.pivots) + x.shape[1], np.broadcast_to(norm, (n, len(t["cell"])))
        return np.where(ours, np.floor(best + 1e-9 * norm + 1e-6), -np.inf)

    def rows(self, column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
        """(positions, matrix) for each length in a column of packed vectors."""
        raw = column.to_pylist()
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        each = np.dtype(self.dtype).itemsize
        return [(at := np.flatnonzero(size == s),
                 np.frombuffer(b"".join(raw[i] for i in at), self.dtype).reshape(len(at), s // each))
                for s in np.unique(size)]


_PARTS = "block long, part int, kind int, n int, ids binary, vectors binary, tau binary, firsts binary"


def _keyed(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cell, angle = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows)
            for at, x in index.rows(b.column("x")):
                cell[at], angle[at] = index.cells(x)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell), pa.array(angle)], [*b.schema.names, "cell", "angle"])

    return run


def _packed_annuli(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block and first key -> one row per block."""
    block, held = None, []

    def row() -> pa.RecordBatch:
        c = {n: [v for h in held for v in h.column(n).to_pylist()] for n in ("id", "x", "first", "angle")}
        ids, firsts = np.array(c["id"], np.int64), np.array(c["first"], np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), pa.array([held[0].column("cell")[0].as_py()], pa.int64()),
             pa.array([min(c["angle"])], pa.float64()), pa.array([max(c["angle"])], pa.float64()),
             pa.array([int(firsts.min())], pa.int64()), pa.array([len(ids)], pa.int32()),
             pa.array([ids.tobytes()], pa.binary()), pa.array([b"".join(c["x"])], pa.binary()),
             pa.array([firsts.tobytes()], pa.binary())],
            ["block", "cell", "lo", "hi", "low", "n", "ids", "vectors", "firsts"])

    for b in batches:
        keys = b.column("block").to_numpy()
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)] if len(keys) else []
        for lo, hi in zip(cuts, cuts[1:]):
            if held and keys[lo] != block:
                yield row()
                held.clear()
            block = int(keys[lo])
            held.append(b.slice(lo, hi - lo))
    if held:
        yield row()


def _router(index: Index, done: int, more: int):
    """Arrow function: queries -> rows (block, group of queries) of this round."""
    t = index.annuli

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, firsts, tau = (b.column(n).to_numpy(zero_copy_only=False) for n in ("id", "tau_first", "tau"))
            for at, x in index.rows(b.column("x")):
                for lo in range(0, len(at), GROUP):
                    rows, q = at[lo:lo + GROUP], x[lo:lo + GROUP]
                    best = index.bounds(q)
                    order = np.argsort(-best, axis=1, kind="stable")[:, done:done + more]
                    bound = np.take_along_axis(best, order, axis=1)
                    kth = tau[rows][:, None]
                    go = (bound > kth) | ((bound == kth) & (t["low"][order] < firsts[rows][:, None]))
                    i, j = np.nonzero(go & (bound > -np.inf))
                    to = order[i, j]
                    by = np.argsort(to, kind="stable")
                    i, to = i[by], to[by]
                    starts = np.flatnonzero(np.r_[True, to[1:] != to[:-1]]) if len(to) else []
                    out = [(int(t["block"][to[s]]), i[s:e]) for s, e in zip(starts, [*starts[1:], len(to)])]
                    if not out:
                        continue
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([o[0] for o in out], pa.int64()), pa.array([zlib.crc32(ids[rows[o[1]]].tobytes()) % 65_536 for o in out], pa.int32()),
                         pa.array([1] * len(out), pa.int32()), pa.array([len(o[1]) for o in out], pa.int32()),
                         pa.array([ids[rows[o[1]]].tobytes() for o in out], pa.binary()),
                         pa.array([q[o[1]].tobytes() for o in out], pa.binary()),
                         pa.array([tau[rows[o[1]]].tobytes() for o in out], pa.binary()),
                         pa.array([firsts[rows[o[1]]].tobytes() for o in out], pa.binary())],
                        ["block", "part", "kind", "n", "ids", "vectors", "tau", "firsts"])

    return run


def _best_of(scores: np.ndarray, firsts: np.ndarray, tau: np.ndarray, tau_first: np.ndarray, keep: int):
    """(query, vector) positions of each row's ``keep`` highest scores (ties: the
    earlier column) that are not behind the k-th found so far."""
    floor = tau
    if scores.dtype == np.int64:  # beyond doubles: a little more passes, the merge is exact
        tau = np.nextafter(tau, -np.inf)
    if scores.shape[1] > keep:
        kth = np.partition(scores, scores.shape[1] - keep, axis=1)[:, scores.shape[1] - keep].astype(np.float64)
        floor = np.maximum(tau, np.nextafter(kth, -np.inf) if scores.dtype == np.int64 else kth)
    i, j = np.nonzero(scores >= floor[:, None])
    s = scores[i, j]
    live = (s > tau[i]) | (firsts[j] < tau_first[i])
    i, j, s = i[live], j[live], s[live]
    order = np.lexsort((j, -s, i))
    i, j, s = i[order], j[order], s[order]
    start = np.searchsorted(i, i)  # rows are sorted by query: place within the query
    top = np.arange(len(i)) - start < keep
    return i[top], j[top], s[top]


def _searcher(dtype: str, exact: str, keep: int):
    """Arrow function: annuli and groups of queries, sorted by (block, part, kind) -> hits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = matrix = ids = firsts = None
        for b in batches:
            for r in b.to_pylist():
                own, first = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["firsts"], np.int64)
                x = np.frombuffer(r["vectors"], dtype).reshape(r["n"], -1).astype(exact)
                if r["kind"] == 0:
                    at, matrix, ids, firsts = (r["block"], r["part"]), x, own, first
                    continue
                if at != (r["block"], r["part"]):
                    raise RuntimeError(f"annulus {r['block']} did not arrive")
                tau = np.frombuffer(r["tau"], np.float64)
                scores = x @ matrix.T
                i, j, s = _best_of(scores, firsts, tau, first, keep)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[i]), pa.array(s.astype(np.int64)), pa.array(firsts[j]), pa.array(ids[j])],
                    ["query", "score", "first", "id"])

    return run


def _number_types(most: int, norm: float) -> tuple[str, str]:
    """(packed type, type whose products and sums are exact) for entries up to ``most``."""
    packed = "int16" if most < 2**15 else "int32" if most < 2**31 else "int64"
    return packed, "float32" if norm < 2**24 else "float64" if norm < 2**53 else "int64"


def build(classes: DataFrame, n: int, packed: str, radius: float, width: int) -> tuple[Index, DataFrame, DataFrame]:
    """Index of the distinct vectors (columns ``id, x, first, asks``): what tasks
    know, the keyed vectors, and the packed annuli."""
    size = width * np.dtype(packed).itemsize
    sample = classes.where(F.octet_length("x") == size).orderBy(F.xxhash64("x"), "id").limit(SAMPLE).select("x").collect()
    units = _unit(np.frombuffer(b"".join(bytes(r[0]) for r in sample), packed).reshape(len(sample), width), radius)
    index = Index(packed, radius, width, _fit(units, min(PIVOTS, max(1, round(n**0.5 / 4)))))
    keyed = pinned(classes.mapInArrow(_keyed(index), "id long, x binary, first long, asks boolean, cell long, angle double"),
                   "topk-keyed")
    # annuli: steps of the angle, counted, then cut where a running count fills one
    limit = max(ANNULUS, -(-n // ANNULI))
    step = F.least(F.floor(F.col("angle") * (STEPS / np.pi)), F.lit(STEPS - 1)).cast("long")
    up = Window.partitionBy("cell").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    steps = pinned(keyed.groupBy("cell", step.alias("step")).agg(F.count(F.lit(1)).alias("rows")).select(
        "cell", "step", F.floor(F.coalesce(F.sum("rows").over(up), F.lit(0)) / limit).alias("ring"),
        F.ceil(F.col("rows") / limit).alias("split")), "topk-steps")
    # a step fuller than an annulus is dealt by hash (its vectors lie within one step)
    block = F.col("cell") * (1 << 34) + F.col("ring") * (1 << 20) + F.pmod(F.xxhash64("id"), F.col("split"))
    placed = keyed.withColumn("step", step).join(sized(steps), ["cell", "step"]).select(
        block.alias("block"), "cell", "angle", "first", "id", "x")
    tasks = max(1, -(-n // (2 * limit)))
    annuli = pinned(placed.repartition(tasks, "block").sortWithinPartitions("block", "first", "id").mapInArrow(
        _packed_annuli, "block long, cell long, lo double, hi double, low long, n int, ids binary, vectors binary, firsts binary"),
        "topk-annuli")
    table = annuli.select("block", "cell", "lo", "hi", "low").orderBy("block").toPandas()
    index.annuli = {c: table[c].to_numpy() for c in table.columns}
    return index, keyed, annuli


def search(index: Index, keyed: DataFrame, annuli: DataFrame, exact: str, keep: int) -> DataFrame:
    """``id, best`` of each asking vector: its ``keep`` best distinct vectors as
    (score, first key, id), by rounds over sorted annuli."""
    n_annuli = len(index.annuli["block"])
    near = ("cell", "angle", "id")  # neighbours travel together: a group of queries then shares its annuli
    state = keyed.where("asks").select("id", "x", "cell", "angle", F.lit(float("-inf")).alias("tau"), F.lit(int(_LAST)).alias("tau_first"),
                                       F.expr("cast(array() as array<struct<score:bigint,first:bigint,id:bigint>>)").alias("best"))
    state = pinned(state.orderBy(*near), "topk-queries")
    done, more = 0, 1
    top = Window.partitionBy("query").orderBy(F.desc("score"), "first", "id")
    while done < n_annuli:
        routes = pinned(state.select("id", "x", "tau", "tau_first").mapInArrow(_router(index, done, more), _PARTS), "topk-routes")
        counts = routes.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / GROUPS_PER_PART).alias("parts"), F.count(F.lit(1)).alias("rows"))
        counts = pinned(counts, "topk-counts")
        total = counts.agg(F.sum("rows")).first()[0]
        if not total:
            break
        asked = routes.join(counts.select("block", "parts"), "block").withColumn("part", F.pmod("part", "parts").cast("int"))
        given = annuli.join(counts, "block").select(
            "block", F.explode(F.sequence(F.lit(0), F.col("parts").cast("int") - 1)).alias("part"), F.lit(0).alias("kind"), "n", "ids",
            "vectors", F.lit(None).cast("binary").alias("tau"), "firsts")
        hits = (given.unionByName(asked.select(*given.columns))
                .repartition(max(1, -(-total // GROUPS_PER_TASK)), "block", "part")
                .sortWithinPartitions("block", "part", "kind")
                .mapInArrow(_searcher(index.dtype, exact, keep), "query long, score long, first long, id long"))
        old = state.select(F.col("id").alias("query"), F.explode("best").alias("b")).select("query", "b.score", "b.first", "b.id")
        best = (hits.unionByName(old).withColumn("place", F.row_number().over(top)).where(F.col("place") <= keep)
                .groupBy("query").agg(F.array_sort(F.collect_list(F.struct("place", "score", "first", "id"))).alias("b")))
        kth = F.get("b", keep - 1)
        new = state.select("id", "x", "cell", "angle").join(best.withColumnRenamed("query", "id"), "id", "left").select(
            "id", "x", "cell", "angle", F.coalesce(kth["score"].cast("double"), F.lit(float("-inf"))).alias("tau"),
            F.coalesce(kth["first"], F.lit(int(_LAST))).alias("tau_first"),
            F.transform(F.coalesce("b", F.array()), lambda e: F.struct(e["score"], e["first"], e["id"])).alias("best"))
        state = pinned(new.orderBy(*near), "topk-state")
        done, more = done + more, more * GROWTH
    return state.select("id", "best")


def top_k(df: DataFrame, asks: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding",
          scale: float = 64.0) -> DataFrame:
    """``query_id, rank, vec_id, score``: of each row where ``asks`` holds, the
    ``k`` rows other than itself with the highest inner product of
    ``floor(scale * x)`` vectors, ties to the smaller key."""
    spark = df.sparkSession
    ship_package(spark)
    raw = pinned(df.select(F.col(key).cast("long").alias("key"), F.coalesce(asks & F.col(key).isNotNull(), F.lit(False)).alias("asks"),
                           scaled(F.col(vector), scale).alias("x"))
                 .where("x is not null").withColumn("row", F.monotonically_increasing_id()), "topk-rows")
    entry = F.aggregate("x", F.lit(0).cast("bigint"), lambda s, c: F.greatest(s, F.abs(c)))
    norm = F.aggregate("x", F.lit(0.0), lambda s, c: s + c.cast("double") * c)
    most, largest, width = raw.agg(F.max(entry), F.max(norm), F.mode(F.size("x"), True)).first()
    if most is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    packed, exact = _number_types(most, largest)
    rows = pinned(raw.mapInArrow(_packer(packed), "key long, asks boolean, x binary, row long"), "topk-packed")
    # equal vectors: one entry, with its k + 1 smallest rows (limited before the shuffle)
    low = Window.partitionBy("x").orderBy(F.col("key").asc_nulls_last(), "row")
    members = (rows.withColumn("place", F.row_number().over(low)).where(F.col("place") <= k + 1)
               .groupBy("x").agg(F.array_sort(F.collect_list(F.struct("place", "key", "row"))).alias("rows")))
    asking = rows.where("asks").select("x").distinct().withColumn("asks", F.lit(True))
    members = pinned(members.join(asking, "x", "left").select(
        F.col("rows")[0]["row"].alias("id"), "x", F.coalesce(F.col("rows")[0]["key"], F.lit(int(_LAST))).alias("first"),
        F.coalesce("asks", F.lit(False)).alias("asks"), "rows"), "topk-members")
    n = members.count()
    index, keyed, annuli = build(members.select("id", "x", "first", "asks"), n, packed, max(1.0, largest**0.5), width)
    found = search(index, keyed, annuli, exact, k + 1)
    # entries back to rows: k + 1 of them hold k besides the query's own
    own = Window.partitionBy("query").orderBy(F.desc("score"), F.col("key").asc_nulls_last(), "row")
    lists = (found.select(F.col("id").alias("query"), F.explode("best").alias("b")).select("query", "b.score", "b.id")
             .join(members.select("id", "rows"), "id")
             .select("query", "score", F.explode("rows").alias("r")).select("query", "score", "r.key", "r.row")
             .withColumn("place", F.row_number().over(own)).where(F.col("place") <= k + 1)
             .groupBy("query").agg(F.array_sort(F.collect_list(F.struct("place", "score", "key", "row"))).alias("found")))
    lists = members.where("asks").select(F.col("id").alias("query"), "x").join(lists, "query")
    return (rows.where("asks").join(lists, "x")
            .select(F.col("key").alias("query_id"),
                    F.posexplode(F.slice(F.filter("found", lambda e: e["row"] != F.col("row")), 1, k)).alias("at", "e"))
            .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("e.key").alias("vec_id"), F.col("e.score").alias("score")))
