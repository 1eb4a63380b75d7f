r"""Removal of repeated passages by bounded suffix-array search.

A byte is repeated when a string of ``length`` bytes that covers it also starts
somewhere else in the corpus (the same text included).  The steps:

1. Equal texts become one; all of a text that occurs twice and is long enough
   is repeated.
2. Every window of ``length`` bytes belongs to one anchor, its least hashed
   ``GRAM``-byte gram (leftmost of equals): a choice that depends on the
   window's bytes alone, so equal windows meet under equal anchors.  The
   windows of one anchor are a run and span a stretch of text.  Anchors that
   occur once drop out in an aggregation, which leaves few of the stretches.
3. A stretch that occurs twice is repeated throughout; this too is a count.
4. The distinct stretches of an anchor go to one task.  It sorts their
   suffixes, takes the Burrows-Wheeler transform and expands intervals
   breadth-first by backward extension, which derives common-prefix lengths in
   increasing order and stops at ``length``: suffixes still without a value
   share at least that many bytes with a neighbour.
5. An anchor with more than ``HOT`` distinct stretches is not given to one
   task but halved by counts over all tasks (``_halved``): windows are taken in
   ranges of their place around the anchor.  A range that occurs twice as a
   whole is repeated; one whose common core occurs once is not; any other is
   cut in two, down to single windows.

The same steps find repeated passages by words: the units of a text are then
64-bit hashes of its words (``[^\x20\x09-\x0D]+``) instead of its bytes,
``length`` and all places count words, and what separates words plays no part.

Null texts count as empty and, like texts shorter than ``length``, lose
nothing.  Rows with equal texts are repeats of each other, whatever their ids;
rows that share an id only are not.
Texts are read whole; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from appendlog.llm.common import dropped, pinned, sized
from appendlog.session import ship_package

LENGTH = 400
GRAM = 64
#: The same in words, where passages are told by their words.
WORD_GRAM = 8
#: Distinct stretches of one anchor that one task searches; bytes per search.
HOT = 400
SEARCH_BYTES = 1 << 20
#: Windows scanned at once (about 90 bytes of memory each).
SCAN = 1 << 21

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


@lru_cache(maxsize=4)
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2 ** 64."""
    inverse = pow(base, -1, 1 << 64)
    out = []
    for b in (base, inverse):
        p = np.full(size, b, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


class Hashes:
    """Hash of any range of a text's bytes or words, from prefix sums (modulo 2 ** 64)."""

    def __init__(self, data: np.ndarray, base: np.uint64):
        size = 1 << max(16, int(len(data)).bit_length())
        self.power, self.back = _powers(int(base), size)
        if data.dtype == np.uint8:
            value = _mix(np.arange(1, 257, dtype=np.uint64) * base)[data]
        else:
            value = _mix((data + np.uint64(1)) * base)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(value * self.power[:len(data)], out=self.sums[1:])

    def of(self, start, stop):
        return (self.sums[stop] - self.sums[start]) * self.back[start]


def word_units(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and stop (bytes) of each word of a text's bytes."""
    start, stop = runs((data != 32) & ((data < 9) | (data > 13)))
    a, b = (Hashes(data, base).of(start, stop) for base in (_A, _B))
    return _mix(a + _mix(b)), start, stop


def stretches(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Start, stop, anchor hash, two digests and anchor place of each stretch."""
    n = len(data) - length + 1
    h = Hashes(data, _A)
    at = np.arange(len(data) - gram + 1)
    grams = _mix(h.of(at, at + gram))
    bits = np.uint64(max(24, int(len(data)).bit_length()))
    low = (grams >> bits << bits) | at.astype(np.uint64)
    span, step = length - gram + 1, 1
    while step * 2 <= span:  # least value over windows of doubling size
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    rest = span - step
    low = np.minimum(low[:n], low[rest:rest + n])
    anchor = (low & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    first = np.concatenate([[0], np.flatnonzero(anchor[1:] != anchor[:-1]) + 1])
    start = first
    stop = np.concatenate([first[1:] - 1, [n - 1]]) + length
    other = Hashes(data, _B)
    size = (stop - start).astype(np.uint64)
    # the place of the anchor within the stretch is part of its identity
    shape = _mix(size * _A + (anchor[first] - start).astype(np.uint64))
    return (start, stop, grams[anchor[first]], _mix(h.of(start, stop) + shape), other.of(start, stop) ^ shape,
            anchor[first] - start)


def all_stretches(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """``stretches`` of a text of any length, by blocks of ``SCAN`` windows; a
    stretch over a border becomes two."""
    if len(data) - length + 1 <= SCAN:
        return stretches(data, length, gram)
    parts = []
    for at in range(0, len(data) - length + 1, SCAN):
        start, stop, *rest = stretches(data[at:at + SCAN + length - 1], length, gram)
        parts.append((start + at, stop + at, *rest))
    return tuple(map(np.concatenate, zip(*parts, strict=True)))


def suffix_order(sym: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes ordered by their first ``depth`` symbols, by prefix doubling
    of the groups that are still undecided."""
    bits = max(9, int(sym.max()).bit_length())
    n, wide = len(sym), 63 // bits
    padded = np.concatenate([sym.astype(np.int64), np.zeros(wide, np.int64)])
    key = np.zeros(n, np.int64)
    for k in range(wide):
        key = (key << bits) | padded[k:k + n]
    order = np.argsort(key, kind="stable")
    rank = np.empty(n, np.int64)

    def heads(keys: np.ndarray, slots: np.ndarray) -> np.ndarray:
        new = np.concatenate([[True], keys[1:] != keys[:-1]])
        return slots[new][np.cumsum(new) - 1]

    rank[order] = heads(key[order], np.arange(n))
    h = wide
    while h < depth:
        head = rank[order]
        same = head[1:] == head[:-1]
        slots = np.flatnonzero(np.concatenate([same, [False]]) | np.concatenate([[False], same]))
        if not len(slots):
            break
        pos = order[slots]
        second = np.where(pos + h < n, rank[np.minimum(pos + h, n - 1)] + 1, 0)
        key = head[slots] * (n + 1) + second
        by = np.argsort(key, kind="stable")
        order[slots] = pos[by]
        rank[order[slots]] = heads(key[by], slots)
        h *= 2
    return order


def long_prefixes(sym: np.ndarray, length: int) -> np.ndarray:
    """Mark of each position whose suffix shares ``length`` symbols or more
    with another suffix.

    ``sym`` ends with a symbol that occurs nowhere else.  Intervals of equal
    prefixes are extended backwards level by level; an interval whose right
    neighbour has no value yet sets it to the level and goes on to the next.
    """
    n = len(sym)
    order = suffix_order(sym, length + 1)
    bwt = sym[order - 1]
    by = np.argsort(bwt, kind="stable")  # LF: slot by[k] maps to slot k
    lf = np.empty(n, np.int64)
    lf[by] = np.arange(n)
    same = bwt[by[1:]] == bwt[by[:-1]]
    before, after = np.full(n, -1, np.int64), np.full(n, n, np.int64)
    before[by[1:][same]] = by[:-1][same]
    after[by[:-1][same]] = by[1:][same]
    open_ = np.ones(n + 1, bool)  # no common-prefix length known yet
    open_[0] = open_[n] = False
    lo, hi = np.zeros(1, np.int64), np.full(1, n - 1, np.int64)
    for _ in range(length):
        size = hi - lo + 1
        first = np.cumsum(size) - size
        slot = np.arange(int(size.sum())) - np.repeat(first - lo, size)
        # extensions of disjoint intervals are disjoint, so sorted starts and stops pair up
        starts = np.sort(lf[slot[before[slot] < np.repeat(lo, size)]])
        stops = np.sort(lf[slot[after[slot] > np.repeat(hi, size)]])
        new = open_[stops + 1]
        lo, hi = starts[new], stops[new]
        open_[hi + 1] = False
        if not len(lo):
            break
    out = np.zeros(n, bool)
    near = np.flatnonzero(open_[:n])
    out[order[near]] = True
    out[order[near - 1]] = True
    return out


def repeated_windows(parts: list[bytes], length: int, words: bool = False) -> list[np.ndarray]:
    """For each part, the marks of its windows that also start elsewhere."""
    flat = np.frombuffer(b"".join(parts), np.uint64 if words else np.uint8)
    sizes = [len(p) // flat.itemsize for p in parts]
    if words:
        flat = np.unique(flat, return_inverse=True)[1]
    ends = np.cumsum(np.array(sizes) + 1) - 1
    joined = np.ones(len(flat) + len(parts), np.int64)
    joined[np.delete(np.arange(len(joined)), ends)] = flat.astype(np.int64) + 2
    marks = long_prefixes(np.concatenate([joined, [0]]), length)
    return [marks[e - s:e - length + 1] for s, e in zip(sizes, ends)]


def runs(mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of the runs of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mark.astype(np.int8), [0]])))
    return edge[::2], edge[1::2]


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _units(text: str | None, words: bool) -> np.ndarray:
    data = np.frombuffer(_bytes(text), np.uint8)
    return word_units(data)[0] if words else data


def _scan(docs: DataFrame, length: int, words: bool = False) -> DataFrame:
    """One row per anchor stretch and text; equal stretches of a text share
    one row with all their starts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                b = whole.slice(at, 512)
                out: list[tuple] = []
                for doc, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                    data = _units(t.as_py(), words)
                    if len(data) < length:
                        continue
                    start, stop, key, d1, d2, place = all_stretches(data, length, WORD_GRAM if words else GRAM)
                    order = np.lexsort((start, d2, d1, key))
                    k, x, y = key[order], d1[order], d2[order]
                    new = np.concatenate([[True], (k[1:] != k[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])])
                    first = order[new]
                    count = np.diff(np.append(np.flatnonzero(new), len(order)))
                    out.append((doc, key[first], d1[first], d2[first], (stop - start)[first], count, start[order], place[first]))
                cat = lambda i: np.concatenate([o[i] for o in out])
                if not out:
                    continue
                offsets = np.concatenate([[0], np.cumsum(cat(5))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat([o[0] for o in out], [len(o[1]) for o in out]), pa.int64()),
                     *[pa.array(cat(i).view(np.int64)) for i in (1, 2, 3)], pa.array(cat(4), pa.int32()), pa.array(cat(7), pa.int32()),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(cat(6), pa.int32()))],
                    ["id", "key", "d1", "d2", "size", "place", "starts"])

    return docs.mapInArrow(run, "id long, key long, d1 long, d2 long, size int, place int, starts array<int>")


def _cut(docs: DataFrame, wanted: DataFrame, words: bool = False) -> DataFrame:
    """The bytes, or the hashes of the words, of the stretches ``wanted`` (id, key, start, size, place)."""
    lists = wanted.groupBy("id").agg(F.collect_list(F.struct("key", "start", "size", "place")).alias("parts"))
    ids = sized(pinned(wanted.select("id").distinct(), "suffix-ids"))
    rows = docs.join(ids, "id", "left_semi").dropDuplicates(["id"]).join(lists, "id").select("id", "text", "parts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                ids, keys, starts, places, datas = [], [], [], [], []
                for doc, t, parts in zip(*[c.to_pylist() for c in b.columns], strict=True):
                    data = _units(t, words)
                    for p in parts:
                        ids.append(doc)
                        keys.append(p["key"])
                        starts.append(p["start"])
                        places.append(p["place"])
                        datas.append(data[p["start"]:p["start"] + p["size"]].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(keys, pa.int64()), pa.array(starts, pa.int32()),
                     pa.array(places, pa.int32()), pa.array(datas, pa.binary())], ["id", "key", "start", "place", "data"])

    return rows.mapInArrow(run, "id long, key long, start int, place int, data binary")


def _search(parts: DataFrame, length: int, words: bool = False) -> DataFrame:
    """Covered ranges ``id, lo, hi`` within the stretches of moderate anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None

        def found() -> pa.RecordBatch:
            ids, los, his = [], [], []
            for (doc, start, _), mark in zip(held, repeated_windows([h[2] for h in held], length, words), strict=True):
                for lo, hi in zip(*runs(mark)):
                    ids.append(doc)
                    los.append(start + int(lo))
                    his.append(start + int(hi) - 1 + length)
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(los, pa.int32()), pa.array(his, pa.int32())],
                                              ["id", "lo", "hi"])

        for b in batches:
            for doc, key, start, data in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if key != last and size >= SEARCH_BYTES:  # whole anchors only
                    yield found()
                    held, size = [], 0
                held.append((doc, start, data))
                size += len(data)
                last = key
        if held:
            yield found()

    rows = parts.select("id", "key", "start", "data").repartition("key").sortWithinPartitions("key", "id", "start")
    return rows.mapInArrow(run, "id long, lo int, hi int")


def _digests(length: int, words: bool = False):
    """For ranges ``lo .. lo + width - 1`` of window places (a window's place is
    the anchor's distance from its start): digests of the core that all windows
    of the range share, and of the whole that this stretch has of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "key", "start", "lo", "last", "from", "to", "c1", "c2", "w1", "w2"]
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                out = []
                for doc, key, start, place, data, lo, width in zip(*[c.to_pylist() for c in whole.slice(at, 256).columns],
                                                                   strict=True):
                    d = np.frombuffer(data, np.uint64 if words else np.uint8)
                    # places that the stretch owns, from its last window to its first
                    first, last = max(lo, place - (len(d) - length)), min(lo + width - 1, place)
                    if first > last:
                        continue
                    cuts = np.array([[place - lo, place - (lo + width - 1) + length], [place - last, place - first + length]])
                    h = [_mix(Hashes(d, base).of(cuts[:, 0], cuts[:, 1])).view(np.int64) for base in (_A, _B)]
                    out.append((doc, key, start, lo, last, start + place - last, start + place - first + length,
                                int(h[0][0]), int(h[1][0]), int(h[0][1]), int(h[1][1])))
                cols = list(zip(*out, strict=True)) or [()] * len(names)
                kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 5, *[pa.int64()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

    return run


def _halved(parts: DataFrame, length: int, words: bool = False) -> DataFrame | None:
    """Covered ranges within the stretches of anchors beyond ``HOT``; every
    step is a count over all tasks, and each stretch goes on with the one or
    two ranges that are repeated in part."""
    parts = pinned(parts, "suffix-hot")
    width = 1 << (length - 1).bit_length() - 1  # the core of a range is never empty
    state = parts.select("id", "key", "start", F.explode(F.array(*[F.lit(k) for k in range(0, length, width)])).alias("lo"))
    found: DataFrame | None = None
    while width >= 1 and not state.isEmpty():
        some = parts.join(sized(state), ["id", "key", "start"]).select("id", "key", "start", "place", "data", "lo", F.lit(width))
        some = pinned(some.mapInArrow(_digests(length, words), "id long, key long, start int, lo int, last int, from int, to int, "
                                                        "c1 long, c2 long, w1 long, w2 long"), "suffix-ranges")
        rows = some.withColumn("size", F.col("to") - F.col("from"))
        whole, core = ["key", "lo", "size", "w1", "w2"], ["key", "lo", "c1", "c2"]
        twice = pinned(rows.groupBy(*whole).count().where("count > 1").drop("count"), "suffix-whole")
        ranges = pinned(rows.join(sized(twice), whole, "left_semi").select("id", F.col("from").alias("lo"), F.col("to").alias("hi")),
                        "suffix-found")
        found = ranges if found is None else found.union(ranges)
        shared = pinned(rows.groupBy(*core).count().where("count > 1").drop("count"), "suffix-core")
        # what is shared in its core but not as a whole is cut in two; of the rows of a repeated
        # whole with such a core, which are covered already, one goes on as a witness of their windows
        single = pinned(rows.join(sized(twice), whole, "left_anti").join(sized(shared), core, "left_semi"), "suffix-single")
        cores = pinned(single.select(*core).distinct(), "suffix-cores")
        witness = rows.join(sized(twice), whole, "left_semi").join(sized(cores), core, "left_semi").groupBy(
            *whole, "c1", "c2", "last").agg(F.min(F.struct("id", "start")).alias("one")).select("one.id", "key", "one.start", "lo")
        left = single.select("id", "key", "start", "lo").union(witness)
        width //= 2
        if not width:
            break
        old, state = state, pinned(left.select("id", "key", "start", F.explode(F.array("lo", F.col("lo") + width)).alias("lo")),
                                   "suffix-state")
        dropped(old, some, twice, shared, single, cores)
    return found


def _merge(spans: list) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(lo, hi) for lo, hi in out]


def _joined(spans: DataFrame) -> DataFrame:
    """``id, spans`` with the ranges of each text merged into maximal runs."""
    kind = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            new = [[{"lo": lo, "hi": hi} for lo, hi in _merge([(x["lo"], x["hi"]) for x in r])]
                   for r in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(new, kind)], ["id", "spans"])

    return spans.mapInArrow(run, "id long, spans array<struct<lo:int,hi:int>>")


def covered(docs: DataFrame, length: int = LENGTH, words: bool = False) -> DataFrame:
    """``id, spans`` (array of lo, hi: the maximal covered runs of bytes, or of words) of the texts of ``docs`` (``id, text``; distinct texts) that repeat."""
    spans = pinned(_scan(docs, length, words), "suffix-stretches")
    keys = spans.groupBy("key").agg(
        F.sum(F.size("starts")).alias("n"),
        F.min(F.struct("d1", "d2")).alias("low"), F.max(F.struct("d1", "d2")).alias("high")).where("n > 1")
    keys = pinned(keys.select("key", (F.col("low") != F.col("high")).alias("several")), "suffix-anchors")
    met = pinned(spans.join(sized(keys), "key"), "suffix-met")
    dropped(spans, keys)
    digest = ["key", "d1", "d2"]
    kinds = pinned(met.groupBy(*digest).agg(
        F.sum(F.size("starts")).alias("n"), F.min(F.struct("id", F.get("starts", F.lit(0)).alias("start"), "size", "place")).alias("first"),
        F.max("several").alias("several")), "suffix-kinds")
    # stretches that occur twice are repeated throughout
    twice = kinds.where("n > 1").select(*digest)
    whole = met.join(twice, digest).select("id", F.explode("starts").alias("lo"), "size").select(
        "id", "lo", (F.col("lo") + F.col("size")).alias("hi"))
    # the others are searched against all distinct stretches of their anchor
    per = kinds.where("several").groupBy("key").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least")).where("least = 1")
    per = pinned(per.select("key", (F.col("kinds") > HOT).alias("hot")), "suffix-open")
    wanted = kinds.where("several").join(sized(per), "key").select("key", "hot", "first.id", "first.start", "first.size", "first.place")
    wanted = pinned(wanted, "suffix-wanted")
    parts = pinned(_cut(docs, wanted.select("id", "key", "start", "size", "place"), words), "suffix-parts")
    hot = pinned(per.where("hot").select("key"), "suffix-hot-keys")
    searched = _search(parts.join(sized(hot), "key", "left_anti"), length, words)
    ranges = whole.select("id", "lo", "hi").union(searched)
    counted = _halved(parts.join(sized(hot), "key", "left_semi"), length, words)
    if counted is not None:
        ranges = ranges.union(counted)
    out = pinned(_joined(ranges.groupBy("id").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))), "suffix-spans")
    dropped(met, kinds, per, wanted, parts, hot)
    return out


def _marked(df: DataFrame, text: str, length: int, words: int | None = None) -> DataFrame:
    """``df`` with ``__copy`` (another row has the same text), ``__spans`` and,
    for passages of ``words`` words, ``__words`` (spans in words).

    Texts are told apart by a digest, so ids may be null, repeated or shared by
    different texts."""
    ship_package(df.sparkSession)
    rows = df.withColumn("__md5", F.md5(F.coalesce(F.col(text), F.lit("")))).withColumn("__id", F.xxhash64("__md5"))
    least = min(length, 2 * words - 1) if words else length  # so many words have a byte each and one between
    copies = rows.where(F.octet_length(text) >= least).groupBy("__md5").agg(F.count(F.lit(1)).alias("__n"))
    copies = sized(pinned(copies.where("__n > 1").select("__md5", F.lit(True).alias("__copy")), "suffix-copies"))
    rows = rows.join(copies, "__md5", "left").withColumn("__copy", F.col("__copy").isNotNull())
    texts = rows.select(F.col("__id").alias("id"), F.col(text).alias("text"), "__copy")
    once = pinned(texts.where("__copy").select("id", "text").dropDuplicates(["id"]), "suffix-once")
    distinct = texts.where(~F.col("__copy")).select("id", "text").union(once)
    found = [("__spans", covered(distinct, length))]
    if words:
        found.append(("__words", covered(distinct, words, True)))
    dropped(once)
    for name, spans in found:
        rows = rows.join(sized(spans).select(F.col("id").alias("__id"), F.col("spans").alias(name)), "__id", "left")
    return rows.drop("__id", "__md5")


def _spans(n: int, copy: bool, spans: list | None, length: int) -> list[tuple[int, int]]:
    if copy and n >= length:
        return [(0, n)]
    return _merge([(s["lo"], s["hi"]) for s in spans or ()])


def _word_spans(data: bytes, copy: bool, spans: list | None, words: int) -> list[tuple[int, int]]:
    """Byte ranges from the first to the last word of the spans."""
    if not copy and not spans:
        return []
    _, start, stop = word_units(np.frombuffer(data, np.uint8))
    return [(int(start[lo]), int(stop[hi - 1])) for lo, hi in _spans(len(start), copy, spans, words)]


def report(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """Bytes, removed bytes and runs, and the digest of the rest, per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                b = whole.slice(at, 512)
                rows = []
                for doc, t, copy, spans in zip(*[c.to_pylist() for c in b.columns], strict=True):
                    data = _bytes(t)
                    gone = _spans(len(data), copy, spans, length)
                    kept, at_byte = hashlib.sha256(), 0
                    for lo, hi in gone:
                        kept.update(data[at_byte:lo])
                        at_byte = hi
                    kept.update(data[at_byte:])
                    rows.append((doc, len(data), sum(hi - lo for lo, hi in gone), len(gone), kept.hexdigest()))
                cols = list(zip(*rows, strict=True)) or [()] * 5
                kinds = [*[pa.int64()] * 4, pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                                 ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return _marked(df.select(key, text), text, length).select(key, text, "__copy", "__spans").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH,
                    words: int | None = None) -> DataFrame:
    """``df`` with repeated passages cut out of ``text``: ``length`` bytes or
    more (whole characters only: a character that a range covers in part
    stays) and, if ``words`` is given, ``words`` words or more, judged on the
    same input.  Nulls stay null."""
    marked = _marked(df, text, length, words)
    names, place = df.columns, marked.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            by_words = b.column("__words").to_pylist() if words else [None] * b.num_rows
            for t, copy, spans, more in zip(b.column(place).to_pylist(), b.column("__copy").to_pylist(),
                                            b.column("__spans").to_pylist(), by_words, strict=True):
                data = _bytes(t)
                left, at = [], 0
                gone = _spans(len(data), copy, spans, length)
                if words:
                    gone = _merge(gone + _word_spans(data, copy, more, words))
                for lo, hi in gone:
                    while lo < hi and data[lo] & 0xC0 == 0x80:
                        lo += 1
                    while hi > lo and hi < len(data) and data[hi] & 0xC0 == 0x80:
                        hi -= 1
                    left.append(data[at:lo])
                    at = hi
                left.append(data[at:])
                out.append(None if t is None else b"".join(left).decode("utf-8", "surrogatepass"))
            kept = [b.column(n) if n != text else pa.array(out, b.schema.field(place).type) for n in names]
            yield pa.RecordBatch.from_arrays(kept, names)

    return marked.mapInArrow(run, df.schema)
