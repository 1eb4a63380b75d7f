"""One incremental batch as DataFrame jobs: list, plan against the saved
state, read the new ranges, write them, then commit.

Everything runs on executors (listing, checksums, alignment, reads), so this
is the path for file counts too large for the stream source's driver-side
planner.  ``state_path`` holds the state as a manifest (``operators.manifest``):
a batch adds the rows of the files that it touched.  Lines of batch ``n`` go to
``<output>/batch=<n>/`` first; the manifest's next version then makes lines and
state valid together, by one exclusive file creation.  A batch that died before it is
planned and written again under the same number (its output folder
overwritten), so each line lands once.  One job at a time writes a state; of
two, the later commit fails.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from appendlog.operators.manifest import NODE_ROW, freeze, offset_log, plan_step
from appendlog.operators.ranges import read_ranges
from appendlog.operators.runlog import RunLog
from appendlog.operators.state import empty_state
from appendlog.session import posix_path
from appendlog.sources.options import ReadConfig, resolve

COMPACT_EVERY = 64  # batches between snapshots of the whole state


def _last_batch(log: RunLog) -> int:
    version = log.version()
    return log.meta(version)["batch"] if version >= 0 else -1


def last_state(spark: SparkSession, state_path: str) -> tuple[int, DataFrame]:
    """(last committed batch or -1, its state; a node folder without files has a null name)."""
    log = offset_log(state_path)
    if log.version() < 0:
        return -1, empty_state(spark)
    rows = log.rows(spark)
    files = rows.where(F.col("name") != NODE_ROW).select("node", "name", "offset", "md5")
    bare = rows.where(F.col("name") == NODE_ROW).select("node").join(files.select("node").distinct(), "node", "left_anti")
    none = F.lit(None)
    return _last_batch(log), files.unionByName(bare.select(
        "node", none.cast("string").alias("name"), none.cast("bigint").alias("offset"), none.cast("string").alias("md5")))


def run_increment(spark: SparkSession, path: str, state_path: str, output: str, target: DataFrame | None = None,
                  **options) -> int | None:
    """Read what was appended since the last saved state, as far as ``target``
    goes (``manifest.freeze``), everything without one.

    Returns the batch number, or None when nothing changed (then nothing is
    written, so an idle run costs a listing and a plan).
    """
    output = posix_path(output)
    cfg = ReadConfig.from_options(resolve(spark, path=path, **options))
    log = offset_log(state_path)
    step = plan_step(spark, cfg, log, target)
    if step is None:
        return None
    batch = _last_batch(log) + 1
    # restarting files (new, replaced, truncated) have empty ranges now and are
    # read from 0 by the next batch, as in the stream
    lines = read_ranges(step.planned, split_bytes=cfg.split_bytes, work=(step.bytes, step.ranges),
                        verify_sample=cfg.md5_sample if cfg.md5_check else None)
    lines.select("value").write.mode("overwrite").parquet(os.path.join(output, f"batch={batch}"))
    log.commit(spark, step.delta(), step.changed, {"batch": batch}, base=step.base)
    step.drop()
    if batch % COMPACT_EVERY == COMPACT_EVERY - 1:
        log.compact(spark)
        log.expire(COMPACT_EVERY)
    return batch


def read_output(spark: SparkSession, output: str, state_path: str) -> DataFrame:
    """All lines written by the batches that committed (the folder of a batch
    that did not is left out)."""
    last = _last_batch(offset_log(state_path))
    if last < 0:
        return spark.createDataFrame([], "value string")
    # the batch folder is a partition: the filter prunes the others' files
    return spark.read.schema("value string, batch int").parquet(posix_path(output)).where(
        F.col("batch") <= last).select("value")


def settle(spark: SparkSession, path: str, state_path: str, output: str, **options) -> int:
    """Run batches until one has nothing to do; returns the number of batches written."""
    n = 0
    while run_increment(spark, path, state_path, output, **options) is not None:
        n += 1
    return n


def settle_frozen(spark: SparkSession, path: str, state_path: str, output: str, run: str, **options) -> int:
    """Batches up to what is there now, then an end by itself (T8): lines and files
    that come while it runs are left to the next run.

    ``run`` names the run: the end is written once under the state, so a run
    that died goes on to the end it was started with.
    """
    cfg = ReadConfig.from_options(resolve(spark, path=path, **options))
    target = freeze(spark, cfg, os.path.join(posix_path(state_path), "targets", run))
    n = 0
    while run_increment(spark, path, state_path, output, target=target, **options) is not None:
        n += 1
    return n
