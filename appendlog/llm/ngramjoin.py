"""N-gram Jaccard join by T-occurrence search.

Documents are sets of word shingles; two link when their Jaccard similarity is
at least ``percent`` / 100.  The steps:

1. A text's node is its 64-bit digest, whatever its row's id (a second digest
   shows that no two texts of the table share one; else the seed changes), so
   exact copies are never compared or expanded.
2. Candidates without loss: sets of similar size that link differ in at most D
   shingles.  Cutting the hash range into m parts leaves m - D of them equal at
   least; a set with fewer empty parts therefore shares the hash of a
   non-empty part with each set that it links with (one with more is cut anew
   under the next seed; parts of few shingles are left out, see
   ``block_keys``).  Such a key takes an
   equal handful of shingles and nothing else in their part, which unrelated
   documents with a common passage do not have.  Every task replaces the equal
   keys of its own documents by links to the smallest of them before the
   shuffle, so a key of very many documents arrives as one row per task.
   Documents connected by equal keys are a cluster.
3. T-occurrence search: a cluster's documents are dealt to units of about
   ``UNIT`` documents, each with inverted lists of its own.  A query's lists are
   merged by a heap where they are short; DivideSkip binary-probes the long
   ones for documents that reached ``T - L``, and those with the required
   overlap are links.  A query goes to the units that hold a document with one of
   its keys.  First the least document of each unit searches its cluster.
4. Links make components.  Where a cluster's documents fell into several, all
   but those of its largest component (of the first one, where the cluster is a
   single unit and its task goes on by itself) search the units that hold a
   document with one of their keys and of another component, which leaves no
   pair of different components with a common key unexamined.

Words are runs without ASCII white space, A-Z lower-cased; a text with fewer
words than a shingle is one shingle; null, empty and blank texts have an empty
set and link with nothing.  Whole texts, no caps.  A component's id is the
smallest id of its rows (null if all are null).  Rows with equal ids share
their component, whichever texts they hold; rows with null ids do so by their
texts only.  Repeated rows share theirs; an empty table gives no rows; columns
other than id and text are not read (``keep_one`` returns them).  Shingles are
compared by 64-bit hashes.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from appendlog.llm.common import components, dropped, pinned, released, sized
from appendlog.session import ship_package

#: Documents of a unit, and queries of one unit that go to one task (about).
UNIT, QUERIES = 256, 2048
#: Keys that a task holds before it merges the equal ones and passes them on.
HELD = 1 << 20
#: Seeds that a set with too many empty parts tries.
SEEDS = 64
#: DivideSkip's cost ratio between a probe and a heap step.
MU = 0.01


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, size: int) -> np.ndarray:
    """Ascending distinct 64-bit hashes of the word shingles."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh3_64_intdigest
    w = np.fromiter(map(digest, words), np.uint64, len(words))
    n = max(1, len(words) - size + 1)
    h = np.full(n, min(size, len(words)), np.uint64)
    for k in range(min(size, len(words))):
        h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + w[k:k + n])
    return np.unique(h)


@lru_cache(maxsize=None)
def _levels(percent: int) -> tuple[list[int], list[int]]:
    """Upper sizes of the size classes, and the parts of each (0: only equal sets link)."""
    tops = [1]
    while tops[-1] < 1 << 40:
        tops.append(max(tops[-1] + 1, tops[-1] * 100 // percent))
    return tops, [d + 2 + d // 6 if (d := _differ(u, u, percent)) else 0 for u in tops]


def _differ(n: int, m: int, percent: int) -> int:
    """Shingles that linked sets of ``n`` and ``m`` differ in, at most."""
    return (n + m) * (100 - percent) // (100 + percent)


@lru_cache(maxsize=256)
def _edges(parts: int) -> np.ndarray:
    return np.array([(k << 64) // parts for k in range(1, parts)], np.uint64)


def block_keys(s: np.ndarray, percent: int) -> np.ndarray:
    """Keys of the whole set and of the parts of it, for its size class and the next one.

    Of m parts, linked sets have all but D equal at least, D being the most
    that this set and any set of the class can differ in.  If fewer than m - D
    of its parts are empty, they share the key of a non-empty one.  Else the set is
    cut anew under the next seed, up to the first where that holds, so two
    linked sets have both cut themselves under the smaller of their last seeds.

    There a set leaves out its parts of the fewest shingles, which unrelated texts
    share the most: all below the largest size that fewer than m - D parts stay
    below.  The equal part with the most shingles is among those that either set keeps.
    """
    n = len(s)
    if not n:
        return np.empty(0, np.uint64)
    tops, parts = _levels(percent)
    level = bisect_left(tops, n)
    out = [_mix(s.sum(dtype=np.uint64, keepdims=True) + _mix(np.array([n], np.uint64)))]
    for lv in (level, level + 1):
        m = parts[lv]
        allowed = m - 1 - _differ(n, min(tops[lv], n * 100 // percent), percent)
        for seed in range(SEEDS if m else 0):
            turned = s if not seed else np.sort(_mix(s + np.uint64(seed)))
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mix(turned), dtype=np.uint64)])
            cut = np.concatenate([[0], np.searchsorted(turned, _edges(m)), [n]])
            count = cut[1:] - cut[:-1]
            empty = m - np.count_nonzero(count)
            # the part after the ``allowed`` lightest ones is kept, with all of its size
            full = np.flatnonzero(count >= (np.partition(count, allowed)[allowed] if empty <= allowed else 1))
            sums = total[cut[full + 1]] - total[cut[full]]
            out.append(_mix(sums + _mix(full.astype(np.uint64) + np.uint64((lv << 38) + (seed << 32)))))
            if empty <= allowed:
                break
        else:
            if m:  # practically never: meets all others that are left
                out.append(_mix(np.array([(lv << 38) + (1 << 31)], np.uint64)))
    return np.concatenate(out)


def required(n: int, m: int, percent: int) -> int:
    """Least overlap of sets of ``n`` and ``m`` items that link."""
    return -(-percent * (n + m) // (100 + percent))


class Lists:
    """Inverted lists of a unit's sets, for T-occurrence searches."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = [len(s) for s in sets]
        items = np.concatenate(sets) if sets else np.empty(0, np.uint64)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(items, kind="stable")  # owners stay ascending within an item
        self.owner = owner[order]
        self.terms, starts = np.unique(items[order], return_index=True)
        self.starts = np.append(starts, len(items))

    def search(self, query: np.ndarray, percent: int) -> list[int]:
        """Positions of the sets that link with ``query``."""
        n = len(query)
        at = np.searchsorted(self.terms, query)
        at = at[(at < len(self.terms)) & (self.terms[np.minimum(at, len(self.terms) - 1)] == query)] if len(self.terms) else at[:0]
        need = [required(n, m, percent) for m in self.sizes]
        # a set of a size that can't link needs more than either set has
        least = min((t for t, m in zip(need, self.sizes) if t <= min(n, m)), default=None)
        if least is None or len(at) < least:
            return []
        length = self.starts[at + 1] - self.starts[at]
        at = at[np.argsort(length, kind="stable")]
        n_long = min(least - 1, len(at) - 1, int(least / (MU * math.log2(int(length.max()) + 1) + 1)))
        cut = len(at) - n_long
        short = [self.owner[self.starts[i]:self.starts[i + 1]].tolist() for i in at[:cut]]
        long = [self.owner[self.starts[i]:self.starts[i + 1]].tolist() for i in at[cut:]]
        found, run, count = [], -1, 0
        for c in [*heapq.merge(*short), len(self.sizes)]:
            if c != run:
                if run >= 0 and count >= least - n_long:
                    for k, probed in enumerate(long):
                        if count >= need[run] or count + len(long) - k < need[run]:
                            break
                        i = bisect_left(probed, run)
                        count += i < len(probed) and probed[i] == run
                    if count >= need[run]:
                        found.append(run)
                run, count = c, 0
            count += 1
        return found


def divide_skip(query: np.ndarray, index: list[np.ndarray], percent: int) -> list[int]:
    """Positions in ``index`` of the sets that link with ``query``."""
    return Lists(index).search(query, percent)


def _node(text: str, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col(text)) if seed else F.xxhash64(text)


def _seed(df: DataFrame, text: str) -> int:
    """The first seed under which no two texts share a node."""
    seed = 0
    while True:
        pairs = df.where(F.col(text).isNotNull()).groupBy(_node(text, seed).alias("id")).agg(
            F.min(F.xxhash64(F.lit(-1 - seed), F.col(text))).alias("a"), F.max(F.xxhash64(F.lit(-1 - seed), F.col(text))).alias("b"))
        if pairs.where("a <> b").isEmpty():
            return seed
        seed += 1


def counted(df: DataFrame, size: int, key: str, text: str, seed: int) -> DataFrame:
    """``doc_id, id, n``: node and set size of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = [len(shingles(t.as_py(), size)) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(n, pa.int64())], ["doc_id", "id", "n"])

    return df.select(key, _node(text, seed), text).mapInArrow(run, "doc_id long, id long, n long")


def _merged(keys: list[np.ndarray], nodes: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """A task's keys: one row (0, key, least node) each, and rows (1, least
    node, node) for the other nodes of a key."""
    k = np.concatenate(keys).view(np.int64)
    v = np.repeat(np.concatenate(nodes), [len(x) for x in keys])
    order = np.lexsort((v, k))
    k, v = k[order], v[order]
    first = np.r_[True, k[1:] != k[:-1]]
    least = v[np.flatnonzero(first)[np.cumsum(first) - 1]]
    pairs = np.unique(np.stack([least[~first], v[~first]], axis=1)[least[~first] != v[~first]], axis=0)
    for kind, a, b in ((0, k[first], v[first]), (1, pairs[:, 0], pairs[:, 1])):
        for at in range(0, len(a), 1 << 16):
            x, y = a[at:at + (1 << 16)], b[at:at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), kind, np.int32)), pa.array(x), pa.array(y)],
                                             ["kind", "key", "node"])


def _meetings(df: DataFrame, size: int, percent: int, text: str, seed: int) -> DataFrame:
    """``a, b``: the least node of each key that occurs in several sets, with each other one."""

    def keys_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, nodes, held = [], [], 0
        for b in batches:
            for node, t in zip(b.column(0).to_numpy(), b.column(1), strict=True):
                own = block_keys(shingles(t.as_py(), size), percent)
                keys.append(own)
                nodes.append(np.array([node], np.int64))
                held += len(own)
                if held >= HELD:
                    yield from _merged(keys, nodes)
                    keys, nodes, held = [], [], 0
        if held:
            yield from _merged(keys, nodes)

    def pairs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, least = None, None
        for b in batches:
            kind, k, v = (b.column(i).to_numpy() for i in range(3))
            if not len(k):
                continue
            known = kind == 1
            first = np.r_[key is None or (kind[0], k[0]) != key, (k[1:] != k[:-1]) | (kind[1:] != kind[:-1])]
            heads = np.where(first, v, 0)
            if not first[0]:
                heads[0] = least
            start = np.maximum.accumulate(np.where(first, np.arange(len(k)), 0))
            a = np.where(known, k, heads[start])
            key, least = (kind[-1], k[-1]), heads[start][-1]
            pairs = np.stack([a, v], axis=1)[a != v]
            pairs = np.unique(pairs, axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    entries = df.where(F.col(text).isNotNull()).select(_node(text, seed).alias("id"), text).mapInArrow(
        keys_of, "kind int, key long, node long")
    # links that tasks have made already are dealt by their other node: the least one may have very many
    deal = F.when(F.col("kind") == 0, F.col("key")).otherwise(F.col("node"))
    return entries.repartition(deal).sortWithinPartitions("kind", "key", "node").mapInArrow(
        pairs_of, "a long, b long").distinct()


def _sets(df: DataFrame, size: int, text: str, seed: int, placed: DataFrame) -> DataFrame:
    """``cluster, unit, alone, id, items`` of the texts whose nodes are ``placed``.
    A task passes a text of several rows on once, so a text of very many rows
    comes once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                b = whole.slice(at, 512)
                ids, new = b.column(3).to_pylist(), []
                for i, node in enumerate(ids):
                    if node not in seen:
                        seen.add(node)
                        new.append(i)
                b = b.take(pa.array(new, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*b.columns[:4], pa.array([shingles(t.as_py(), size).tobytes() for t in b.column(4)], pa.binary())],
                    ["cluster", "unit", "alone", "id", "items"])

    texts = df.where(F.col(text).isNotNull()).select(_node(text, seed).alias("node"), F.col(text).alias("text"))
    return texts.join(sized(placed), "node").select("cluster", "unit", "alone", F.col("node").alias("id"), "text").mapInArrow(
        run, "cluster long, unit long, alone boolean, id long, items binary")


def _keys(sets: DataFrame, percent: int) -> DataFrame:
    """``cluster, unit, id, key``: the block keys of the ``sets``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                b = whole.slice(at, 512)
                keys = [block_keys(np.frombuffer(s, np.uint64), percent) for s in b.column(3).to_pylist()]
                rows = pa.array(np.repeat(np.arange(len(keys)), [len(k) for k in keys]))
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(i).take(rows) for i in range(3)), pa.array(np.concatenate(keys).view(np.int64))],
                    ["cluster", "unit", "id", "key"])

    return sets.select("cluster", "unit", "id", "items").mapInArrow(run, "cluster long, unit long, id long, key long")


def _routes(keyed: DataFrame, asking: DataFrame) -> DataFrame:
    """``cluster, unit, id``: the units that hold a text with a key of the
    ``asking`` one (``id``) and of another component ``c``."""
    places = keyed.groupBy("cluster", "key", "unit").agg(F.min("c").alias("low"), F.max("c").alias("high"))
    own = keyed.join(sized(asking), "id", "left_semi").select("cluster", "key", "id", "c")
    return own.join(places, ["cluster", "key"]).where("low <> c or high <> c").select("cluster", "unit", "id").distinct()


def _solve(ids: list[int], sets: list[np.ndarray], percent: int) -> Iterator[tuple[int, int]]:
    """Links that join a whole cluster's documents to their components: the first
    searches, then all that it and its links don't reach."""
    if len(ids) < 2:
        return
    lists = Lists(sets)
    first = set(lists.search(sets[0], percent)) - {0}
    yield from ((ids[0], ids[i]) for i in first)
    for k in range(1, len(ids)):
        if k not in first:
            yield from ((ids[k], ids[i]) for i in lists.search(sets[k], percent) if i != k)


def _search(held: DataFrame, queries: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b``: of the ``queries`` (``cluster, unit, part, id, items``) with the
    documents ``held`` in their units (the same columns and ``alone``); a
    cluster of one unit (``alone``) is solved as it stands."""
    rows = held.select("cluster", "unit", "part", F.lit(0).alias("side"), "alone", "id", "items").union(
        queries.select("cluster", "unit", "part", F.lit(1), F.lit(False), "id", "items"))
    rows = rows.repartition("cluster", "unit", "part").sortWithinPartitions("cluster", "unit", "part", "side", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, alone, lists, ids, held, asked = None, False, None, [], [], None
        for b in batches:
            found: list[tuple[int, int]] = []
            for cluster, unit, part, side, own, doc, items in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if (cluster, unit, part) != group:
                    if alone:
                        found += _solve(ids, held, percent)
                    group, alone, lists, ids, held, asked = (cluster, unit, part), own, None, [], [], None
                # a text that several tasks have passed on
                if doc == (asked if side else ids[-1] if ids else None):
                    continue
                s = np.frombuffer(items, np.uint64)
                if side == 0:
                    ids.append(doc)
                    held.append(s)
                    continue
                asked = doc
                lists = lists or Lists(held)
                found += [(doc, ids[i]) for i in lists.search(s, percent) if ids[i] != doc]
            yield _links(found)
        if alone:
            yield _links(list(_solve(ids, held, percent)))

    return rows.mapInArrow(run, "a long, b long")


def _links(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], ["a", "b"])


def _linked(df: DataFrame, size: int, percent: int, text: str, seed: int) -> tuple[DataFrame, DataFrame]:
    """Links ``a, b`` and components ``node, component`` of the texts' nodes."""
    ship_package(df.sparkSession)
    met = pinned(_meetings(df, size, percent, text, seed), "join-met")
    clusters = components(met, "join-clusters")
    dropped(met)
    released(df.sparkSession)  # the keys' shuffle is the largest one
    sizes = clusters.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / UNIT).alias("units"))
    placed = pinned(clusters.join(sizes, "component").select(
        "node", F.col("component").alias("cluster"), F.pmod(F.xxhash64("node"), F.col("units")).alias("unit"),
        (F.col("units") == 1).alias("alone")), "join-placed")
    dropped(clusters)
    large = pinned(placed.where("not alone"), "join-large")
    keyed = pinned(_keys(_sets(df, size, text, seed, large), percent), "join-keys")
    # the least document of each unit searches its cluster; a cluster of a single unit is solved there
    sets = _sets(df, size, text, seed, placed).withColumn("part", F.lit(0))
    least = large.groupBy("cluster", "unit").agg(F.min("node").alias("node"))
    roots = pinned(least.withColumn("alone", F.lit(False)).select("node", "cluster", "unit", "alone"), "join-roots")
    routes = pinned(_routes(keyed.withColumn("c", F.col("id")), roots.select(F.col("node").alias("id"))), "join-routes")
    asking = _sets(df, size, text, seed, roots).select("id", "items")
    links = pinned(_search(sets, asking.join(sized(routes), "id").withColumn("part", F.lit(0)), percent), "join-links")
    dropped(roots, routes)
    released(df.sparkSession)
    found = components(links)
    # large clusters that still hold several components: all outside the largest one search where they share keys
    parted = pinned(large.join(found, "node", "left").select("node", "cluster", F.coalesce("component", "node").alias("c")), "join-parted")
    counts = parted.groupBy("cluster", "c").count()
    mixed = counts.groupBy("cluster").agg(F.count(F.lit(1)).alias("k"), F.max_by("c", F.struct("count", "c")).alias("main")).where("k > 1")
    mixed = pinned(mixed.select("cluster", "main"), "join-mixed")
    open_ = pinned(parted.join(sized(mixed), "cluster").where("c <> main").select(F.col("node").alias("id")), "join-open")
    if not open_.isEmpty():
        told = keyed.join(sized(mixed), "cluster", "left_semi").join(parted.select(F.col("node").alias("id"), "c"), "id")
        routes = pinned(_routes(told, open_), "join-routes")
        parts = pinned(routes.groupBy("cluster", "unit").agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("parts")), "join-parts")
        again = pinned(large.join(sized(mixed), "cluster", "left_semi").select("node", "cluster", "unit", "alone"), "join-again")
        sets = pinned(_sets(df, size, text, seed, again), "join-sets")
        held = sets.join(sized(parts), ["cluster", "unit"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        asking = sets.select("id", "items").join(sized(routes), "id").join(sized(parts), ["cluster", "unit"]).select(
            "cluster", "unit", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"), "id", "items")
        links = links.union(pinned(_search(held, asking, percent), "join-links"))
        dropped(found, routes, parts, again, sets)
        found = components(links)
    dropped(placed, large, keyed, parted, mixed, open_)
    return links, found


def link_components(df: DataFrame, size: int = 3, percent: int = 90, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row."""
    ship_package(df.sparkSession)
    seed = _seed(df, text)
    links, found = _linked(df, size, percent, text, seed)
    # empty sets have a node for each id
    rows = counted(df, size, key, text, seed).withColumn(
        "id", F.when(F.col("n") > 0, F.col("id")).otherwise(F.xxhash64(F.lit("empty"), F.col("doc_id"))))
    rows = pinned(rows, "join-rows")
    named = rows.where("doc_id is not null").groupBy("doc_id").agg(F.min("id").alias("low"), F.max("id").alias("high"))
    clashes = pinned(named.where("low < high").select("doc_id", "low"), "join-clashes")
    if not clashes.isEmpty():
        equal = rows.join(sized(clashes), "doc_id").select(F.col("low").alias("a"), F.col("id").alias("b"))
        found = components(links.select("a", "b").union(equal))
    rows = rows.join(sized(found), F.col("id") == F.col("node"), "left").withColumn("c", F.coalesce("component", "id"))
    least = rows.groupBy("c").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("k")).where("k > 1").drop("k")
    return rows.join(sized(pinned(least, "join-least")), "c", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))


def keep_one(df: DataFrame, size: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, with ``df``'s columns: the smallest id's (null
    ids last); of rows that are equal in id and text, the first by their JSON.  Texts
    are told apart by their content, not by their ids; rows with empty sets all stay."""
    seed = _seed(df, text)
    _, found = _linked(df, size, percent, text, seed)
    worded = F.coalesce(F.col(text).rlike(r"[^ \t-\r]"), F.lit(False))
    rows = df.where(worded).select(F.col(key).alias("doc_id"), _node(text, seed).alias("id"))
    rows = rows.join(sized(found), F.col("id") == F.col("node"), "left").select("doc_id", "id", F.coalesce("component", "id").alias("c"))
    rows = pinned(rows, "join-rows")
    best = rows.groupBy("c").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "id")).alias("best"), F.count(F.lit(1)).alias("k")).where("k > 1")
    best = sized(pinned(best.select("c", F.col("best.doc_id").alias("__best"), F.col("best.id").alias("__node")), "join-best"))
    fates = pinned(rows.select("id", "c").join(best, "c").select(F.col("id").alias("__id"), "__best", "__node").distinct(), "join-fates")
    marked = df.withColumn("__id", F.when(worded, _node(text, seed))).join(sized(fates), "__id", "left")
    wins = (F.col("__id") == F.col("__node")) & F.col(key).eqNullSafe(F.col("__best"))
    first = marked.where(wins).withColumn("__order", F.to_json(F.struct(*df.columns))).withColumn("__place", F.row_number().over(
        Window.partitionBy("__id").orderBy("__order"))).where("__place = 1")
    return marked.where("__node is null").select(*df.columns).union(first.select(*df.columns))
