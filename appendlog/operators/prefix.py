"""Committed-prefix check (T3, S5), off unless ``prefix.check.block`` is set.

The head checksum can't see a file that was rewritten behind its head without
getting smaller.  With a block size B given, every row of the manifest also has
the digest of the last B bytes of what is committed (all of it, where it is less).  A file whose size or time changed has
that block read again before it is planned; if it differs, the file counts as
replaced.

A change before that is found by an audit: ``seal`` keeps the digests of
all full blocks (a list per file, each block hashed once, by tasks of bounded
bytes) and ``audit`` hashes them again and names the blocks that differ.
"""

from __future__ import annotations

import hashlib
import os

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from appendlog.functions.bytescan import read_exact
from appendlog.operators.runlog import RunLog
from appendlog.session import materialize, ship_package, unpin
from appendlog.sources.options import ReadConfig

BYTES_PER_TASK = 256 << 20
CHUNK = 8 << 20
REWRITTEN = "rewritten"  # stands in for a stored head checksum: equals none


def block_md5(fd: int, lo: int, hi: int, path: str) -> str:
    """Digest of the bytes ``[lo, hi)``, read in chunks."""
    h = hashlib.md5()
    for at in range(lo, hi, CHUNK):
        h.update(read_exact(fd, at, min(CHUNK, hi - at), path))
    return h.hexdigest()


def _digests(it):
    """``path, lo, hi`` -> ``digest``, null where the range can't be read now."""
    for pdf in it:
        out = []
        for path, lo, hi in zip(pdf["path"], pdf["lo"], pdf["hi"]):
            digest = None
            if not pd.isna(hi) and hi > lo >= 0:
                try:
                    fd = os.open(path, os.O_RDONLY)
                    try:
                        digest = block_md5(fd, int(lo), int(hi), path)
                    finally:
                        os.close(fd)
                except OSError:
                    pass
            out.append(digest)
        pdf["digest"] = pd.Series(out, index=pdf.index, dtype=object)
        yield pdf


def digests(ranges: DataFrame) -> DataFrame:
    """``ranges`` (``path, lo, hi`` and more) with the ``digest`` of each range."""
    ship_package(ranges.sparkSession)
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranges.schema.fields)
    return ranges.mapInPandas(_digests, f"{ddl}, digest string")


def _lo(offset, block: int):
    """Start of the last ``block`` bytes before ``offset``."""
    return F.greatest(F.lit(0).cast("bigint"), offset - block)


def with_tails(rows: DataFrame, block: int) -> DataFrame:
    """``rows`` (``path, offset`` and more) with ``tail``, the digest of the last
    block before ``offset`` (empty where there is none)."""
    columns = rows.columns
    some = rows.withColumn("lo", _lo(F.col("offset"), block)).withColumn("hi", F.col("offset"))
    return digests(some).select(*columns, F.coalesce("digest", F.lit("")).alias("tail"))


def rewritten(listing: DataFrame, known: DataFrame, block: int) -> DataFrame:
    """``node, name`` of the listed files whose last committed block differs
    from the one in the manifest rows ``known``.  Files of unchanged size and
    time are not opened; smaller ones are truncated anyway."""
    old = known.where("offset > 0 and tail <> ''").select(
        "node", "name", "offset", "tail", F.col("size").alias("_size"), F.col("mtime").alias("_mtime"))
    seen = listing.select("node", "name", "path", "size", "mtime").join(old, ["node", "name"])
    changed = ~(F.col("size").eqNullSafe(F.col("_size")) & F.col("mtime").eqNullSafe(F.col("_mtime")))
    asked = seen.where(changed & (F.col("size") >= F.col("offset"))).select(
        "node", "name", "path", "tail", _lo(F.col("offset"), block).alias("lo"), F.col("offset").alias("hi"))
    return digests(asked).where("digest is not null and digest <> tail").select("node", "name")


def marked(state: DataFrame, broken: DataFrame) -> DataFrame:
    """Planner state in which the files of ``broken`` count as replaced."""
    return state.join(broken.withColumn("_broken", F.lit(True)), ["node", "name"], "left").withColumn(
        "md5", F.when(F.col("_broken"), F.lit(REWRITTEN)).otherwise(F.col("md5"))).drop("_broken")


# --- the list of all blocks ---


def block_log(path: str) -> RunLog:
    """Digests of full blocks, kept under ``path``."""
    return RunLog(path, ["node", "name", "block"], "hi bigint, digest string")


def _blocks(cfg: ReadConfig, rows: DataFrame, block: int) -> DataFrame:
    """``node, name, block, path, lo, hi`` of every full committed block."""
    prefix = F.concat(F.lit(cfg.spec.prefix), F.lit("/"), "node", F.lit(cfg.spec.suffix)) if cfg.spec.has_node else F.lit(cfg.spec.directory)
    full = rows.where(F.col("offset") >= block).select(
        "node", "name", F.concat(prefix, F.lit("/"), "name").alias("path"), (F.floor(F.col("offset") / block) - 1).alias("last"))
    b = full.select("node", "name", "path", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("last").cast("bigint"))).alias("b"))
    return b.select("node", "name", F.lpad(F.col("b").cast("string"), 16, "0").alias("block"), "path",
                    (F.col("b") * block).alias("lo"), ((F.col("b") + 1) * block).alias("hi"))


def _dealt(blocks: DataFrame, block: int) -> DataFrame:
    pinned, n = materialize(blocks)
    return pinned.repartition(max(1, -(-n * block // BYTES_PER_TASK)))


def seal(spark: SparkSession, cfg: ReadConfig, manifest: RunLog, kept: RunLog, block: int) -> int:
    """Hash the committed blocks that ``kept`` does not have yet and drop those
    that are no longer committed; returns the new version."""
    known = kept.rows(spark)
    now = _blocks(cfg, manifest.rows(spark).where("name <> ''"), block)
    keys = ["node", "name", "block"]
    fresh = digests(_dealt(now.join(known.select(*keys), keys, "left_anti"), block)).where("digest is not null").select(
        *keys, "hi", "digest", F.lit(False).alias("gone"))
    none = F.lit(None)
    gone = known.select(*keys).join(now.select(*keys), keys, "left_anti").select(
        *keys, none.cast("bigint").alias("hi"), none.cast("string").alias("digest"), F.lit(True).alias("gone"))
    delta, n = materialize(fresh.unionByName(gone))
    version = kept.commit(spark, delta, n)
    unpin(delta)
    return version


def audit(spark: SparkSession, cfg: ReadConfig, kept: RunLog, block: int) -> DataFrame:
    """``node, name, block`` of the sealed blocks that read differently now (or
    can't be read any more)."""
    rows = kept.rows(spark).withColumnRenamed("digest", "sealed")
    prefix = F.concat(F.lit(cfg.spec.prefix), F.lit("/"), "node", F.lit(cfg.spec.suffix)) if cfg.spec.has_node else F.lit(cfg.spec.directory)
    asked = rows.select("node", "name", "block", F.concat(prefix, F.lit("/"), "name").alias("path"),
                        (F.col("hi") - block).alias("lo"), "hi", "sealed")
    return digests(_dealt(asked, block)).where(~F.col("digest").eqNullSafe(F.col("sealed"))).select(
        "node", "name", F.col("block").cast("bigint").alias("block"))
