"""Shared helpers of the text operators: inputs, work folders, buckets."""

from __future__ import annotations

import gc
import uuid
import weakref

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from appendlog.session import checkpoint_root, ship_package

#: Upper bound on range buckets (their bounds travel as one literal array).
MAX_BUCKETS = 4096


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The ``documents`` table, only the named columns."""
    ship_package(spark)
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return df.select(*columns) if columns else df


_PATHS: "weakref.WeakKeyDictionary[DataFrame, str]" = weakref.WeakKeyDictionary()


def pinned(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read back: its
    lineage ends there, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/llm/{tag}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _PATHS[out] = path
    return out


def dropped(*tables: DataFrame | None) -> None:
    """Delete pinned tables whose consumers are all pinned themselves (tables
    that are not pinned, and None, are passed over)."""
    for t in tables:
        path = _PATHS.pop(t, None) if t is not None else None
        if path is not None:
            at = t.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


def released(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished jobs: Spark deletes them when the
    driver's garbage collector finds their plans unused, which may be much later."""
    gc.collect()
    spark._jvm.System.gc()


def range_bounds(df: DataFrame, key: str, text: str, bytes_per_bucket: int) -> list[int]:
    """Ascending values of ``key`` that cut ``df`` into buckets of about
    ``bytes_per_bucket`` bytes of ``text``; no bound for a small table.

    Bounds are values that occur in ``key``, the smallest left out, so that no
    bucket is empty.  At most ``MAX_BUCKETS - 1`` come to the driver.
    """
    size, low = df.agg(F.sum(F.octet_length(text)), F.min(key)).first()
    n = min(MAX_BUCKETS, -(-(size or 0) // bytes_per_bucket))
    if n < 2:
        return []
    cuts = df.agg(F.percentile_approx(key, [i / n for i in range(1, n)], 20 * n)).first()[0]
    return sorted({c for c in cuts or [] if c is not None and c > low})


def bucket_of(key: Column, bounds: list[int]) -> Column:
    """Number of the bucket (from 0) that ``key`` falls into; null keys: 0.

    Two levels: a key is compared with every 64th bound, then with the up to 63
    that follow the last of them it reaches.
    """
    if not bounds:
        return F.lit(0)

    def reached(some: Column) -> Column:
        return F.size(F.filter(some, lambda b: b <= key))

    every = F.array(*[F.lit(b).cast("bigint") for b in bounds])
    if len(bounds) <= 64:
        return reached(every)
    coarse = F.array(*[F.lit(b).cast("bigint") for b in bounds[::64]])
    return let(reached(coarse), lambda c: F.when(c == 0, F.lit(0)).otherwise(
        (c - 1) * 64 + 1 + reached(F.slice(every, (c - 1) * 64 + 2, F.lit(63)))))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often the
    body (lambdas included) refers to it."""
    return F.get(F.transform(F.array(value), body), 0)


#: Written bytes up to which a pinned side of a join may be broadcast.
BROADCAST_BYTES = 16 << 20


def sized(df: DataFrame) -> DataFrame:
    """A pinned table, marked for broadcast if its files are small enough;
    beyond that, and for tables that are not pinned, the join shuffles (and AQE
    splits hot keys)."""
    path = _PATHS.get(df)
    if path is None:
        return df
    spark = df.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    size = at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def components(links: DataFrame, tag: str = "links") -> DataFrame:
    """``node, component`` (smallest node it reaches) for every node of the
    undirected ``links`` (columns ``a, b``), by alternating star contraction.

    Each round hangs a node's neighbours on the smallest of them; rounds go on
    until the edges stay as they are.  Every table is pinned.
    """
    edges = pinned(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                   .where("u <> v").distinct(), tag)
    mark = None
    while True:
        # larger neighbours go to the smallest of a node and its neighbours
        both = edges.union(edges.select("v", "u"))
        low = pinned(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), f"{tag}-low")
        large = pinned(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                       .where("u <> v").distinct(), f"{tag}-large")
        dropped(low, edges)
        # then a node and its smaller neighbours go to the smallest neighbour
        low = pinned(large.groupBy("u").agg(F.min("v").alias("m")), f"{tag}-low")
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = pinned(small.select("e.u", "e.v").where("u <> v").distinct(), tag)
        dropped(low, large)
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    out = pinned(edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots), f"{tag}-components")
    dropped(edges)
    return out
