"""Token-id files as wavelet matrices: succinct bit-planes with rank support.

A shard holds the ids of documents with neighbouring keys, in ascending key
order, as one wavelet matrix: per bit (highest first) a packed bit-plane, the
number of zeros, and a rank directory of one count per 512 bits, which selects
are looked up in too.  Access, count (rank) and occurrence lookup (select) work on
the planes without decoding them.

``write`` makes one compressed file set through Spark's writer (so a retried
task leaves no half file, and any file system works): a row per shard, its
planes as binary columns.  A shard closes once it holds ``SHARD_TOKENS`` ids; a
document is never cut, so a row is bounded by that plus the longest document.
``count``, ``occurrences`` and ``access`` answer from the files, a task per few shards.

Null texts are empty (the end id alone).  Rows with equal keys stay, ordered by
text.  An empty table gives an empty file set.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from appendlog.llm.common import bucket_of, pinned, range_bounds, sized
from appendlog.llm.tokenizers_io import ByteBpe
from appendlog.session import ship_package

#: Tokens per shard, bits of rank directory granularity, bytes of text per range bucket.
SHARD_TOKENS = 1 << 20
BLOCK = 512
BUCKET_BYTES = 8 << 20


class WaveletMatrix:
    """A sequence of non-negative integers below ``2 ** bits``."""

    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int], ranks: list[np.ndarray]):
        self.n, self.planes, self.zeros, self.ranks = n, planes, zeros, ranks

    @classmethod
    def build(cls, values: np.ndarray, bits: int = 16) -> WaveletMatrix:
        v = np.ascontiguousarray(values, dtype=np.uint16 if bits <= 16 else np.uint32)
        planes, zeros, ranks = [], [], []
        for k in reversed(range(bits)):
            one = (v & v.dtype.type(1 << k)) != 0
            packed = np.packbits(one)
            pad = -len(packed) % (BLOCK // 8)
            blocks = np.pad(packed, (0, pad)).reshape(-1, BLOCK // 64, 8).view(np.uint64)
            per = np.bitwise_count(blocks).sum(axis=(1, 2), dtype=np.uint32)
            ranks.append(np.concatenate([np.zeros(1, np.uint32), np.cumsum(per, dtype=np.uint32)]))
            planes.append(packed)
            low = v[~one]
            zeros.append(len(low))
            v = np.concatenate([low, v[one]])
        return cls(len(values), planes, zeros, ranks)

    def _rank1(self, k: int, i: int) -> int:
        """Ones among the first ``i`` bits of plane ``k``."""
        b = i // BLOCK
        part = self.planes[k][b * (BLOCK // 8):(i + 7) // 8]
        got = int(self.ranks[k][b])
        if len(part):
            got += int(np.unpackbits(part)[:i - b * BLOCK].sum())
        return got

    def access(self, i: int) -> int:
        value = 0
        for k in range(len(self.planes)):
            bit = (int(self.planes[k][i >> 3]) >> (7 - (i & 7))) & 1
            ones = self._rank1(k, i)
            i = self.zeros[k] + ones if bit else i - ones
            value = value << 1 | bit
        return value

    def rank(self, value: int, i: int) -> int:
        """Occurrences of ``value`` among the first ``i`` items."""
        lo, hi, bits = 0, i, len(self.planes)
        for k in range(bits):
            a, b = self._rank1(k, lo), self._rank1(k, hi)
            if value >> (bits - 1 - k) & 1:
                lo, hi = self.zeros[k] + a, self.zeros[k] + b
            else:
                lo, hi = lo - a, hi - b
        return hi - lo

    def interval(self, value: int) -> list[tuple[int, int]]:
        """Where the occurrences of ``value`` lie in front of each plane and
        behind the last; it ends early once there are none."""
        out, bits = [(0, self.n)], len(self.planes)
        for k in range(bits):
            lo, hi = out[-1]
            if lo == hi:
                break
            a, b = self._rank1(k, lo), self._rank1(k, hi)
            out.append((self.zeros[k] + a, self.zeros[k] + b) if value >> (bits - 1 - k) & 1 else (lo - a, hi - b))
        return out

    def _select(self, k: int, bit: int, at: np.ndarray) -> np.ndarray:
        """Positions in plane ``k`` of the bits ``bit`` with the numbers ``at``
        (from 0, ascending): by the counts of whole blocks, then inside the block."""
        ones = self.ranks[k].astype(np.int64)
        before = ones if bit else np.arange(len(ones), dtype=np.int64) * BLOCK - ones
        block = np.searchsorted(before, at, side="right") - 1
        out = np.empty(len(at), np.int64)
        starts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]]) if len(at) else []
        for lo, hi in zip(starts, [*starts[1:], len(at)]):
            b = int(block[lo])
            part = np.unpackbits(self.planes[k][b * (BLOCK // 8):(b + 1) * (BLOCK // 8)])
            out[lo:hi] = b * BLOCK + np.flatnonzero(part == bit)[at[lo:hi] - before[b]]
        return out

    def occurrences(self, value: int) -> np.ndarray:
        """Ascending positions of ``value``."""
        levels = self.interval(value)
        lo, hi = levels[-1]
        if lo == hi:
            return np.empty(0, np.int64)
        return self._up(value, np.arange(lo, hi, dtype=np.int64))

    def _up(self, value: int, at: np.ndarray) -> np.ndarray:
        """Places behind the last plane back to positions in the sequence."""
        bits = len(self.planes)
        for k in reversed(range(bits)):
            bit = value >> (bits - 1 - k) & 1
            at = self._select(k, bit, at - (self.zeros[k] if bit else 0))
        return at

    def select(self, value: int, j: int) -> int:
        """Position of the ``j``-th (from 0) occurrence, or -1."""
        lo, hi = self.interval(value)[-1]
        if j < 0 or j >= hi - lo:
            return -1
        return int(self._up(value, np.array([lo + j], np.int64))[0])

    def decode(self) -> np.ndarray:
        """All items in order: the planes' partitions undone, lowest bit first."""
        bits = len(self.planes)
        kind = np.uint16 if bits <= 16 else np.uint32
        v = np.zeros(self.n, kind)
        for k in reversed(range(bits)):
            one = np.unpackbits(self.planes[k], count=self.n).view(bool)
            out = np.empty(self.n, kind)
            out[~one] = v[:self.zeros[k]]
            out[one] = v[self.zeros[k]:] | kind(1 << (bits - 1 - k))
            v = out
        return v


SHARD_SCHEMA = ("bucket int, shard int, n long, doc_ids array<long>, lengths array<long>, "
                "zeros array<long>, planes array<binary>, ranks array<binary>")


def _shard_row(bucket: int, shard: int, docs: list, ids: list[np.ndarray], bits: int) -> dict:
    all_ids = np.concatenate(ids)
    wm = WaveletMatrix.build(all_ids, bits)
    return {"bucket": bucket, "shard": shard, "n": wm.n, "doc_ids": [d for d, _ in docs],
            "lengths": [n for _, n in docs], "zeros": wm.zeros,
            "planes": [p.tobytes() for p in wm.planes], "ranks": [r.astype("<u4").tobytes() for r in wm.ranks]}


def _matrix(row: dict) -> WaveletMatrix:
    return WaveletMatrix(row["n"], [np.frombuffer(p, np.uint8) for p in row["planes"]], list(row["zeros"]),
                         [np.frombuffer(r, "<u4") for r in row["ranks"]])


def write(df: DataFrame, path: str, json_path: str, ranks_path: str, key: str = "doc_id", text: str = "text",
          end_id: int = 2, bits: int = 16, shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode ``df`` and write its shards to ``path``."""
    ship_package(df.sparkSession)
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(SHARD_SCHEMA))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe(json_path, ranks_path)
        bucket, shard, docs, ids, held = None, 0, [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal docs, ids, held, shard
            row = _shard_row(bucket, shard, docs, ids, bits)
            docs, ids, held, shard = [], [], 0, shard + 1
            return pa.RecordBatch.from_pylist([row], schema)

        for b in batches:
            for at, doc, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                if at != bucket:
                    if docs:
                        yield close()
                    bucket, shard = at, 0
                own = bpe.encode(t.as_py() or "")
                own.append(end_id)
                docs.append((doc, len(own)))
                ids.append(np.array(own, np.uint16 if bits <= 16 else np.uint32))
                held += len(own)
                if held >= shard_tokens:
                    yield close()
        if docs:
            yield close()

    bounds = range_bounds(df, key, text, BUCKET_BYTES)
    rows = df.select(bucket_of(F.col(key), bounds).alias("bucket"), F.col(key).alias("doc_id"), F.col(text).alias("t"))
    rows = rows.repartition(len(bounds) + 1, "bucket").sortWithinPartitions("bucket", "doc_id", "t")
    rows.mapInArrow(run, SHARD_SCHEMA).write.option("compression", "zstd").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files alone: ``start`` (ids of all documents
    before it), ``n_tokens`` and the checksum of its ids."""
    ship_package(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                ids = _matrix(row).decode().astype("<u4")
                stops = np.cumsum([0, *row["lengths"]])
                k = len(row["doc_ids"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["bucket"]] * k, pa.int32()), pa.array([row["shard"]] * k, pa.int32()),
                     pa.array(row["doc_ids"], pa.int64()), pa.array(stops[:-1], pa.int64()),
                     pa.array(row["lengths"], pa.int64()),
                     pa.array([zlib.crc32(ids[i:j]) for i, j in zip(stops, stops[1:])], pa.int64())],
                    ["bucket", "shard", "doc_id", "at", "n_tokens", "ids_crc32"])

    files = spark.read.schema(SHARD_SCHEMA).parquet(path)
    docs = files.mapInArrow(run, "bucket int, shard int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return docs.join(_bases(files), ["bucket", "shard"]).select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def _bases(files: DataFrame) -> DataFrame:
    """``bucket, shard, n, base``: ids before each shard.  Buckets first (their
    number is bounded by ``range_bounds``), then the shards of a bucket."""
    sizes = files.select("bucket", "shard", "n")
    by_bucket = sizes.groupBy("bucket").agg(F.sum("n").alias("total")).select(
        "bucket", (F.sum("total").over(Window.orderBy("bucket")) - F.col("total")).alias("before"))
    in_bucket = Window.partitionBy("bucket").orderBy("shard")
    return sizes.withColumn("inside", F.sum("n").over(in_bucket) - F.col("n")).join(by_bucket, "bucket").select(
        "bucket", "shard", "n", (F.col("before") + F.col("inside")).alias("base"))


_PLANES = ("bucket", "shard", "n", "zeros", "planes", "ranks")


def count(spark: SparkSession, path: str, tokens: list[int]) -> DataFrame:
    """``token, n``: occurrences of each of ``tokens`` in the files, as ranks in
    each shard's planes (document lists are not read, no plane is decoded)."""
    ship_package(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                wm = _matrix(row)
                spans = [wm.interval(t)[-1] if 0 <= t < 1 << len(wm.planes) else (0, 0) for t in tokens]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tokens, pa.int64()), pa.array([hi - lo for lo, hi in spans], pa.int64())], ["token", "n"])

    asked = spark.createDataFrame([(t, 0) for t in dict.fromkeys(tokens)], "token long, n long")
    found = spark.read.schema(SHARD_SCHEMA).parquet(path).select(*_PLANES).mapInArrow(run, "token long, n long")
    return asked.union(found).groupBy("token").agg(F.sum("n").alias("n"))


def occurrences(spark: SparkSession, path: str, token: int) -> DataFrame:
    """``position``: where ``token`` stands in the whole sequence, as selects in
    each shard's planes plus the ids before the shard."""
    ship_package(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                wm = _matrix(row)
                at = wm.occurrences(token) if 0 <= token < 1 << len(wm.planes) else np.empty(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["bucket"]] * len(at), pa.int32()), pa.array([row["shard"]] * len(at), pa.int32()), pa.array(at)],
                    ["bucket", "shard", "at"])

    files = spark.read.schema(SHARD_SCHEMA).parquet(path)
    found = files.select(*_PLANES).mapInArrow(run, "bucket int, shard int, at long")
    return found.join(_bases(files), ["bucket", "shard"]).select((F.col("base") + F.col("at")).alias("position"))


def access(spark: SparkSession, path: str, positions: DataFrame) -> DataFrame:
    """``position, token`` of the ``positions`` (column ``position``; those
    outside the sequence are left out).  Only shards that hold one are read."""
    ship_package(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                wm = _matrix(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["asked"], pa.int64()), pa.array([wm.access(p - row["base"]) for p in row["asked"]], pa.int64())],
                    ["position", "token"])

    files = spark.read.schema(SHARD_SCHEMA).parquet(path)
    bases = _bases(files)
    starts = sorted(tuple(r) for r in bases.groupBy("bucket").agg(F.min("base")).select("min(base)", "bucket").collect())  # a few thousand at most
    if not starts:
        return spark.createDataFrame([], "position long, token long")
    asked = positions.select(F.col("position").cast("long").alias("position")).where("position >= 0").distinct()
    bucket = F.element_at(F.array(*[F.lit(b) for _, b in starts]), bucket_of(F.col("position"), [s for s, _ in starts[1:]]) + 1)
    met = asked.withColumn("bucket", bucket).join(bases, "bucket").where("position >= base and position < base + n")
    per = pinned(met.groupBy("bucket", "shard", "base").agg(F.collect_list("position").alias("asked")), "wavelet-asked")
    return files.select(*_PLANES).join(sized(per), ["bucket", "shard"]).mapInArrow(run, "position long, token long")
