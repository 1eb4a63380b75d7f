"""File selection (S3) and file metadata snapshots (S4, S5).

Listing uses Spark's own file index (``binaryFile`` with only ``path``,
``length`` and ``modificationTime`` selected, so no file body is read), then a
whole-name regex on the base name.  Head checksums are computed on executors,
reading only the first ``md5.sample.length`` bytes of each file.
"""

from __future__ import annotations

import os

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from appendlog.functions.bytescan import head_md5
from appendlog.session import local_frame, ship_package
from appendlog.sources.pathspec import LOCAL_NODE, PathSpec

LISTING_SCHEMA = "node string, name string, path string, size bigint, mtime timestamp"
SNAPSHOT_SCHEMA = "node string, name string, path string, size bigint, mtime timestamp, md5 string, inode bigint"
NODES_SCHEMA = "node string"
LISTED_PER_TASK = 8  # partitions of the listing whose heads one task reads


def node_names(spec: PathSpec) -> list[str]:
    """Names of the node folders that can be read now (listed on the driver).

    The set is bounded by the number of hosts writing logs.  A folder that
    fails to list (I/O error) is left out: its files are then carried
    forward, not forgotten.
    """
    if not spec.has_node:
        return [LOCAL_NODE] if os.path.isdir(spec.directory) else []
    nodes = []
    try:
        with os.scandir(spec.prefix) as it:
            for entry in it:
                if entry.name.startswith((".", "_")) or not entry.is_dir():
                    continue
                try:
                    with os.scandir(spec.node_dir(entry.name)):
                        nodes.append(entry.name)
                except OSError:
                    continue
    except FileNotFoundError:
        pass
    return sorted(nodes)


def list_nodes(spark: SparkSession, spec: PathSpec) -> DataFrame:
    """Node folders that can be read now, as a frame with a recorded row count."""
    return node_frame(spark, node_names(spec))


def node_frame(spark: SparkSession, nodes) -> DataFrame:
    """A ``node`` frame from names, with its row count recorded (a proven size bound)."""
    return local_frame(spark, [(n,) for n in sorted(set(nodes))], NODES_SCHEMA)


def list_files(spark: SparkSession, spec: PathSpec) -> DataFrame:
    """Matching regular files: ``node, name, path, size, mtime``.

    Non-recursive; names starting with ``.`` or ``_`` are never selected; a
    missing directory gives an empty frame.
    """
    try:
        # logs rotate: a file removed between building the index and the scan is skipped
        raw = spark.read.format("binaryFile").option("ignoreMissingFiles", "true").load(spec.glob)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return spark.createDataFrame([], LISTING_SCHEMA)
        raise
    path = F.regexp_replace(F.col("path"), "^file:(//)?", "")
    parts = F.split(path, "/")
    node = F.element_at(parts, spec.node_depth) if spec.has_node else F.lit(LOCAL_NODE)
    return (
        raw.select(
            node.alias("node"),
            F.element_at(parts, -1).alias("name"),
            path.alias("path"),
            F.col("length").alias("size"),
            F.col("modificationTime").alias("mtime"),
        )
        .where(F.col("name").rlike(f"^(?:{spec.pattern})$"))
    )


def _head_md5_fn(sample: int):
    def look(path: str, size: int) -> tuple[str | None, int | None]:
        # a file that cannot be read now (gone, shrunk, I/O error, a host
        # without the mount) keeps its row with a null checksum and is
        # planned as carried; only a file missing from a listing is deleted
        try:
            if size < sample:
                return "", None
            fd = os.open(path, os.O_RDONLY)
            try:
                return head_md5(fd, size, sample, path), os.fstat(fd).st_ino
            finally:
                os.close(fd)
        except OSError:
            return None, None

    def fn(it):
        for pdf in it:
            if "old_md5" in pdf.columns:  # unchanged since an earlier snapshot: not opened
                old = zip(pdf.pop("old_md5"), pdf.pop("old_inode"))
            else:
                old = [(None, None)] * len(pdf)
            rows = [(m, i) if m is not None else look(p, int(n)) for p, n, (m, i) in zip(pdf["path"], pdf["size"], old)]
            pdf["md5"] = pd.Series([m for m, _ in rows], index=pdf.index, dtype=object)
            pdf["inode"] = pd.Series([i for _, i in rows], index=pdf.index, dtype="Int64")
            yield pdf

    return fn


def listing_tasks(files: DataFrame) -> int:
    """Tasks for head reads of a listing: its scan partitions, a few merged.
    ``binaryFile`` is not splittable, so a scan partition holds one large file or a
    few dozen small ones, and the number follows the files."""
    return max(1, -(-files.rdd.getNumPartitions() // LISTED_PER_TASK))


def snapshot(
    spark: SparkSession,
    spec: PathSpec,
    sample: int = 1024,
    check: bool = True,
    previous: DataFrame | None = None,
    files: DataFrame | None = None,
) -> DataFrame:
    """``node, name, path, size, mtime, md5, inode`` for every matching file
    (md5 null where its head could not be read now; inode null where it was not opened).

    With ``previous`` (an earlier snapshot), files whose size and modification
    time did not change keep their checksum and are not opened again.
    ``files`` is a listing (``list_files``) that is there already.
    """
    ship_package(spark)
    files = list_files(spark, spec) if files is None else files
    if not check:
        # no checksums: no Python pass, no file opened
        return files.withColumn("md5", F.lit("")).withColumn("inode", F.lit(None).cast("bigint"))
    n = listing_tasks(files)
    if previous is None:
        # head reads run on the listing's own partitions (no shuffle)
        return files.coalesce(n).mapInPandas(_head_md5_fn(sample), SNAPSHOT_SCHEMA)
    inode = F.col("inode") if "inode" in previous.columns else F.lit(None).cast("bigint")
    keep = previous.where(F.col("md5").isNotNull()).select("node", "name", "size", "mtime", F.col("md5").alias("old_md5"), inode.alias("old_inode"))
    files = files.join(keep, ["node", "name", "size", "mtime"], "left").select(
        "node", "name", "path", "size", "mtime", "old_md5", "old_inode")
    # the join may have left the rows in few partitions
    return files.repartition(n).mapInPandas(_head_md5_fn(sample), SNAPSHOT_SCHEMA)
