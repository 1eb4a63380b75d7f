"""The file catalog and the offsets as one versioned manifest (S4, T6-T9).

The manifest is a ``RunLog`` with one row per file: how far it is read, its
head checksum, the size and time at which that was taken, its credit under a
byte budget, and the digest of its last committed block where that is asked for (``prefix``).  Node folders have a row of their own (an empty name), so a
folder without files is known too.

``plan_step`` lists, checks and plans on executors against the newest version
and pins the plan; committing it adds only the rows of files that changed.
``advance`` also writes the ranges of the step, cut into sub-ranges and dealt
to files of bounded work, next to the manifest: a stream then needs the version
number and the names of those files, nothing per log file.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from appendlog.operators.prefix import marked, rewritten, with_tails
from appendlog.operators.ranges import RANGES_PER_TASK, planned_bytes, split_ranges
from appendlog.operators.runlog import RunLog
from appendlog.plans import rules as R
from appendlog.plans.admission import admit
from appendlog.plans.planner import align, plan
from appendlog.session import pin, ship_package, shared_root, unpin
from appendlog.sources.catalog import LISTED_PER_TASK, list_files, listing_tasks, node_frame, node_names, snapshot
from appendlog.sources.options import ReadConfig

KEYS = ["node", "name"]
VALUES = "offset bigint, md5 string, size bigint, mtime timestamp, credit bigint, tail string, inode bigint"
NODE_ROW = ""  # name of a node folder's own row
FILES_PER_SCAN = 32  # small files that one scan partition of a listing holds (about)


def offset_log(path: str) -> RunLog:
    """The manifest kept under ``path``."""
    return RunLog(path, KEYS, VALUES)


def manifest_path(spark: SparkSession, cfg: ReadConfig, stream: str) -> str:
    """Where a stream's manifest is kept: ``catalog.path``, else a folder of its own under the shared root."""
    import hashlib

    key = hashlib.md5(stream.encode("utf-8")).hexdigest()[:16]
    return cfg.catalog_path or os.path.join(shared_root(spark), "appendlog-manifest", key)


def state_rows(rows: DataFrame) -> DataFrame:
    """Manifest rows as planner state (``node, name, offset, md5, credit``)."""
    return rows.where(F.col("name") != NODE_ROW).select("node", "name", "offset", "md5", "credit")


def freeze(spark: SparkSession, cfg: ReadConfig, path: str) -> DataFrame:
    """What is there now, as the target of a bounded run (``node, name, size``):
    written once under ``path``, so a run that is started again keeps its end."""
    if not os.path.exists(os.path.join(path, "_SUCCESS")):
        ship_package(spark)
        list_files(spark, cfg.spec).select("node", "name", "size").write.mode("overwrite").parquet(path)
    return spark.read.schema("node string, name string, size bigint").parquet(path)


def within(listing: DataFrame, target: DataFrame) -> DataFrame:
    """``listing`` as far as ``target`` goes: no file that came later, no byte
    beyond the size that a file had."""
    end = target.select("node", "name", F.col("size").alias("_end"))
    return listing.join(end, KEYS).withColumn("size", F.least("size", "_end")).drop("_end")


def moves() -> Column:
    """The row moves an offset, registers, restarts or drops a file (a held
    tail, with no newline yet, is no change)."""
    status = F.col("status")
    return ~status.isin(R.UNCHANGED, R.CARRIED) & ~((status == R.APPENDED) & (F.col("end_offset") == F.col("known")))


def changes() -> Column:
    """The row has to be written: it moves, or its credit does."""
    return moves() | (F.col("credit") != F.col("credit_before"))


@dataclass
class Step:
    """A planned step, pinned, and what it comes to."""

    base: int  # version that it starts from
    planned: DataFrame
    changed: int  # rows to commit
    bytes: int  # to read
    ranges: int
    table: DataFrame  # the pinned table behind ``planned``
    prefix_block: int | None = None

    def delta(self) -> DataFrame:
        """Rows to commit on top of ``base``."""
        rows = self.planned.where(changes()).select(
            "node", "name", "path", F.col("end_offset").alias("offset"), "md5", "size", "mtime", "credit", "inode",
            (F.col("status") == R.DELETED).alias("gone"))
        rows = with_tails(rows, self.prefix_block) if self.prefix_block else rows.withColumn("tail", F.lit(""))
        return rows.drop("path")

    def drop(self) -> None:
        unpin(self.table)


def plan_step(spark: SparkSession, cfg: ReadConfig, log: RunLog, target: DataFrame | None = None) -> Step | None:
    """Plan the step after the newest version; None when nothing would move."""
    base = log.version()
    known = log.rows(spark, base)
    listed = list_files(spark, cfg.spec)
    few = listing_tasks(listed) * LISTED_PER_TASK * FILES_PER_SCAN  # files, about
    # sizes and times are kept with the offsets: unchanged files are not opened
    listing = snapshot(spark, cfg.spec, cfg.md5_sample, cfg.md5_check, files=listed,
                       previous=known.where(F.col("name") != NODE_ROW) if base >= 0 else None)
    if target is not None:
        listing = within(listing, target)
    nodes = node_frame(spark, node_names(cfg.spec))
    state = state_rows(known)
    if cfg.prefix_block and cfg.md5_check and base >= 0:
        state = marked(state, rewritten(listing, known.where(F.col("name") != NODE_ROW), cfg.prefix_block))
    moved = None
    if cfg.identity and cfg.md5_check and base >= 0:
        listing = pin(listing, "listing")  # read for the renames and for the plan
        moved = pin(renames(listing, known), "renames")
        state = renamed(state, moved)
    planned = align(plan(listing, state, nodes, policy=cfg.starting_offsets, cap=cfg.max_bytes,
                         check=cfg.md5_check, first_run=base < 0), files=few)
    fresh = nodes.join(known.where(F.col("name") == NODE_ROW).select("node"), "node", "left_anti")
    planned = planned.unionByName(_node_rows(fresh))
    if moved is not None:  # names that a file has left and no other has taken
        left = moved.join(listing.select("node", "name"), ["node", "name"], "left_anti").select("node", "name")
        planned = planned.unionByName(_node_rows(left).withColumn("status", F.lit(R.DELETED)))
        # a position under a new name has to be written, whether it moves or not
        taken = moved.select("node", F.col("now").alias("name"), F.lit(1).alias("_taken")).distinct()
        planned = planned.join(taken, ["node", "name"], "left").withColumn(
            "credit_before", F.col("credit_before") - F.coalesce("_taken", F.lit(0))).drop("_taken")
    table = planned = pin(planned, "plan")
    if moved is not None:
        unpin(moved)
        unpin(listing)
    cut = admit(planned, cfg.batch_bytes) if cfg.batch_bytes else None
    if cut is not None:
        planned = pin(align(cut, files=few), "plan")
        unpin(table)
        table = planned
    else:  # all demands fit: no file keeps a credit
        planned = planned.withColumn("credit", F.when(F.col("status") == R.CARRIED, F.col("credit")).otherwise(0))
    n = planned_bytes(F.col("start_offset"), F.col("end_offset"))
    row = planned.agg(F.count_if(moves()).alias("moved"), F.count_if(changes()).alias("changed"),
                      F.sum(n).alias("bytes"), F.count_if(n > 0).alias("ranges")).first()
    if not row.moved:
        unpin(table)
        return None
    return Step(base, planned, row.changed, row.bytes or 0, row.ranges, table, cfg.prefix_block)


def renames(listing: DataFrame, known: DataFrame) -> DataFrame:
    """``node, name, now``: files that go on under another name (rotation by
    rename).  A listed file is the one that the manifest has under ``name`` if
    inode and head checksum are equal, it is no smaller than what is committed,
    and the old name is gone or another file's.  Files shorter than the checksum
    sample have neither and are not followed."""
    old = known.where((F.col("name") != NODE_ROW) & F.col("inode").isNotNull() & (F.col("md5") != "")).select(
        "node", "inode", "md5", "name", "offset")
    new = listing.where(F.col("inode").isNotNull() & (F.col("md5") != "")).select(
        "node", "inode", "md5", F.col("name").alias("now"), "size")
    same = listing.select("node", "name", F.col("inode").alias("_at"))
    return (new.join(old, ["node", "inode", "md5"]).where("now <> name and size >= offset")
            .join(same, ["node", "name"], "left").where("_at is null or _at <> inode")
            # hard links: one name goes on
            .groupBy("node", "name").agg(F.min("now").alias("now")))


def renamed(state: DataFrame, moved: DataFrame) -> DataFrame:
    """Planner state with the positions of ``moved`` files under their names of
    now; what was kept under a name that another file has taken is dropped."""
    taken = moved.select("node", F.col("now").alias("name")).distinct()
    stay = state.join(moved, ["node", "name"], "left_anti").join(taken, ["node", "name"], "left_anti")
    return stay.unionByName(state.join(moved, ["node", "name"]).withColumn("name", F.col("now")).drop("now"))


def _node_rows(nodes: DataFrame) -> DataFrame:
    """Plan rows that make node folders known."""
    zero = F.lit(0).cast("bigint")
    null = F.lit(None)
    name = F.col("name") if "name" in nodes.columns else F.lit(NODE_ROW)
    return nodes.select(
        "node", name.alias("name"), null.cast("string").alias("path"), F.lit(R.NEW).alias("status"),
        zero.alias("size"), null.cast("bigint").alias("known"), zero.alias("start_offset"), zero.alias("end_offset"),
        F.lit("").alias("md5"), F.lit(R.ALIGN_NONE).alias("align"), zero.alias("credit"), zero.alias("credit_before"),
        null.cast("timestamp").alias("mtime"), null.cast("bigint").alias("inode"))


RANGES = "ranges"  # folder of the written ranges, beside the manifest's own


def write_ranges(spark: SparkSession, cfg: ReadConfig, log: RunLog, step: Step) -> str:
    """The step's sub-ranges, a file for each task of a stream to read; the folder's name."""
    name = f"{step.base + 1:020d}-{uuid.uuid4().hex[:12]}"
    subs = split_ranges(step.planned, cfg.split_bytes).select(
        "path", F.col("start_offset").alias("start"), F.col("end_offset").alias("end"), "lo", "hi", "md5")
    tasks = max(1, -(-step.bytes // cfg.split_bytes), -(-step.ranges // RANGES_PER_TASK))
    subs.repartition(tasks).write.parquet(os.path.join(log.path, RANGES, name))
    return name


def advance(spark: SparkSession, cfg: ReadConfig, log: RunLog, target: DataFrame | None = None) -> int | None:
    """Plan one step, write its ranges and commit it as the next version; None
    when nothing would move.  Nothing is read from the log files but heads and
    the blocks around planned ends."""
    step = plan_step(spark, cfg, log, target)
    if step is None:
        return None
    meta = {"directory": cfg.spec.directory, "bytes": step.bytes}
    if step.ranges:
        meta["ranges"] = write_ranges(spark, cfg, log, step)
    version = log.commit(spark, step.delta(), step.changed, meta, base=step.base)
    step.drop()
    return version


def range_files(log: RunLog, version: int) -> list[str]:
    """Paths of a version's range files (no session needed)."""
    name = log.meta(version).get("ranges")
    if not name:
        return []
    folder = os.path.join(log.path, RANGES, name)
    return sorted(os.path.join(folder, f) for f in os.listdir(folder) if f.startswith("part-"))


def expire(log: RunLog, keep: int) -> None:
    """Forget all versions but the newest ``keep``, with their ranges."""
    import shutil

    log.expire(keep)
    oldest = min(log.versions(), default=-1)
    folder = os.path.join(log.path, RANGES)
    for name in os.listdir(folder) if os.path.isdir(folder) else []:
        if int(name.split("-")[0]) < oldest:
            shutil.rmtree(os.path.join(folder, name), ignore_errors=True)
