"""Sparse newline index (S2): where lines start, and with which number.

For every full block of ``block`` committed bytes of a file the index keeps the
number of line ends before it and the first line start in it (null if a line
covers it whole).  New blocks are counted once, by tasks of bounded bytes,
and added to a ``RunLog`` beside the manifest; numbers go on from the last
indexed block.  With it

* ``seek`` turns line numbers into byte ranges without reading the file: each
  begins and ends at the nearest indexed line starts, at most about a block away;
* ``read_numbered`` reads those ranges only, as ``node, name, line, value``.

Line numbers count from 0.  Only committed bytes are indexed, and those end
with a line end, so the index never has to be taken back while a file grows; a
file that restarts (replaced, truncated) loses its blocks at the next ``extend``.
"""

from __future__ import annotations

import os

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from appendlog.functions.bytescan import read_exact
from appendlog.functions.linescan import iter_line_arrays
from appendlog.operators.runlog import RunLog
from appendlog.session import materialize, ship_package, unpin
from appendlog.sources.options import ReadConfig

BLOCK = 1 << 20
BYTES_PER_TASK = 256 << 20
GROUP = 1024  # blocks whose counts one window sums


def index_log(path: str) -> RunLog:
    """The index kept under ``path``: line ends before the block and in it, its
    first line start and that line's number; ``head`` tells files of one name apart."""
    return RunLog(path, ["node", "name", "block"], "lines bigint, ends bigint, start bigint, number bigint, head string")


def _path(cfg: ReadConfig):
    if cfg.spec.has_node:
        return F.concat(F.lit(cfg.spec.prefix + "/"), "node", F.lit(cfg.spec.suffix + "/"), "name")
    return F.concat(F.lit(cfg.spec.directory + "/"), "name")


def _key(b):
    return F.lpad(b.cast("string"), 16, "0")


def _count(block: int):
    def run(it):
        for pdf in it:
            ends, starts = [], []
            for path, b in zip(pdf["path"], pdf["b"]):
                fd = os.open(path, os.O_RDONLY)
                try:
                    lo = int(b) * block
                    data = read_exact(fd, lo, block, path)
                    before = b"\n" if lo == 0 else read_exact(fd, lo - 1, 1, path)
                finally:
                    os.close(fd)
                ends.append(data.count(b"\n"))
                at = 0 if before == b"\n" else data.find(b"\n") + 1
                # the line end that closes the block starts the next block's first line
                starts.append(None if at == block or (at == 0 and before != b"\n") else lo + at)
            pdf["ends"], pdf["start"] = ends, pd.Series(starts, index=pdf.index, dtype="Int64")
            yield pdf

    return run


def extend(spark: SparkSession, cfg: ReadConfig, manifest: RunLog, index: RunLog, block: int = BLOCK) -> int:
    """Index the committed full blocks that are not indexed yet; returns the new version."""
    ship_package(spark)
    known = index.rows(spark)
    now = manifest.rows(spark).where(F.col("name") != "").select("node", "name", "offset", F.col("md5").alias("head"))
    # a restarted file: another head, or less committed than is indexed
    have = known.groupBy("node", "name").agg(
        (F.max(F.col("block").cast("bigint")) + 1).alias("blocks"), F.first("head").alias("was"))
    both = now.join(have, ["node", "name"], "left").withColumn("full", F.floor(F.col("offset") / block).cast("bigint"))
    restarted = (F.col("was") != "") & (F.col("was") != F.col("head")) | (F.col("blocks") > F.col("full"))
    both = both.withColumn("first", F.when(F.col("blocks").isNull() | restarted, 0).otherwise(F.col("blocks")))
    fresh, n = materialize(both.where("full > first").select(
        "node", "name", "head", _path(cfg).alias("path"), F.explode(F.sequence("first", F.col("full") - 1)).alias("b"), "first"))
    counted = fresh.repartition(max(1, -(-n * block // BYTES_PER_TASK))).mapInPandas(
        _count(block), "node string, name string, head string, path string, b bigint, first bigint, ends bigint, start bigint")
    counted, _ = materialize(counted)
    # line ends before each block: before its group of blocks, then inside the group
    group = F.floor(F.col("b") / GROUP)
    groups = counted.groupBy("node", "name", group.alias("g")).agg(F.sum("ends").alias("n"))
    of_file = Window.partitionBy("node", "name").orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("node", "name", "g", F.coalesce(F.sum("n").over(of_file), F.lit(0)).alias("before"))
    in_group = Window.partitionBy("node", "name", "g").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    last = known.join(known.groupBy("node", "name").agg(F.max("block").alias("block")), ["node", "name", "block"]).select(
        "node", "name", (F.col("lines") + F.col("ends")).alias("base"))
    rows = (counted.withColumn("g", group).withColumn("inside", F.coalesce(F.sum("ends").over(in_group), F.lit(0)))
            .join(groups, ["node", "name", "g"]).join(last, ["node", "name"], "left")
            .withColumn("lines", F.when(F.col("first") > 0, F.col("base")).otherwise(0) + F.col("before") + F.col("inside")))
    # a line that starts inside the block comes after a line end in it
    number = F.when(F.col("start").isNotNull(), F.col("lines") + F.when(F.col("start") == F.col("b") * block, 0).otherwise(1))
    fresh_rows = rows.select("node", "name", _key(F.col("b")).alias("block"), "lines", "ends", "start", number.alias("number"),
                             "head", F.lit(False).alias("gone"))
    # blocks of files that are gone or restarted
    keep = both.select("node", "name", F.when(restarted, 0).otherwise(F.col("blocks")).alias("upto"), "full")
    stale = known.join(keep, ["node", "name"], "left").where(
        F.col("upto").isNull() | ((F.col("upto") == 0) & (F.col("block").cast("bigint") >= F.col("full"))))
    none = F.lit(None)
    stale = stale.select("node", "name", "block", *[none.cast(k).alias(c) for c, k in (
        ("lines", "bigint"), ("ends", "bigint"), ("start", "bigint"), ("number", "bigint"), ("head", "string"))], F.lit(True).alias("gone"))
    delta, m = materialize(fresh_rows.unionByName(stale))
    version = index.commit(spark, delta, m)
    for t in (fresh, counted, delta):
        unpin(t)
    return version


def seek(spark: SparkSession, cfg: ReadConfig, manifest: RunLog, index: RunLog, asked: DataFrame) -> DataFrame:
    """Byte ranges for ``asked`` (``node, name, first, last``: lines [first,
    last)): ``node, name, first, last, path, lo, hi, line``, where the range [lo, hi)
    starts with line number ``line`` and holds all lines asked for that exist."""
    marks = index.rows(spark).where("start is not null").select("node", "name", "start", "number")
    ends = manifest.rows(spark).where(F.col("name") != "").select("node", "name", "offset")
    near = asked.join(marks, ["node", "name"], "left").groupBy("node", "name", "first", "last").agg(
        F.max(F.when(F.col("number") <= F.col("first"), F.struct("number", "start"))).alias("low"),
        F.min(F.when(F.col("number") >= F.col("last"), F.col("start"))).alias("high"))
    return near.join(ends, ["node", "name"]).select(
        "node", "name", "first", "last", _path(cfg).alias("path"), F.coalesce("low.start", F.lit(0)).alias("lo"),
        F.least(F.coalesce("high", "offset"), "offset").alias("hi"), F.coalesce("low.number", F.lit(0)).alias("line")).where("hi > lo")


def read_numbered(spark: SparkSession, cfg: ReadConfig, manifest: RunLog, index: RunLog, asked: DataFrame) -> DataFrame:
    """The lines ``asked`` for (``node, name, first, last``): ``node, name, line, value``."""
    ship_package(spark)
    ranges, n = materialize(seek(spark, cfg, manifest, index, asked))

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                fd = os.open(r["path"], os.O_RDONLY)
                try:
                    at = r["line"]
                    for values in iter_line_arrays(fd, r["lo"], r["hi"], r["lo"], r["hi"], r["path"]):
                        lo, hi = max(0, r["first"] - at), min(len(values), r["last"] - at)
                        if hi > lo:
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([r["node"]] * (hi - lo)), pa.array([r["name"]] * (hi - lo)),
                                 pa.array(range(at + lo, at + hi), pa.int64()), values.slice(lo, hi - lo).cast(pa.string())],
                                ["node", "name", "line", "value"])
                        at += len(values)
                finally:
                    os.close(fd)

    return ranges.repartition(max(1, n)).mapInArrow(run, "node string, name string, line bigint, value string")
