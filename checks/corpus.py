"""Log corpus derived from the ``events`` table, written to shared storage.

Layout ``<root>/<node>/<name>``: node ``node<user_id % 4>``, name
``service.log.<event_type>``, one line ``event_id|user_id|event_type|props``
per event in ``event_id`` order, every line newline-terminated.  Three
snapshots (``v`` = 0, 1, 2; the last holds every event) exercise every file
status, deletion and re-creation included.

The write is a distributed positional write, so that no file (one of them may
hold a third of all rows) goes through a single task or the driver:

1. lines are bucketed into fixed ``event_id`` chunks; a partial aggregate gives
   the byte size of each (file, chunk);
2. a two-level running sum over the chunk table gives each chunk's base offset;
3. the lines shuffle by (file, chunk), sort inside the partition, and each task
   ``pwrite``s its chunks at their offsets.  Retries rewrite the same bytes.
"""

from __future__ import annotations

import os
import sys

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from appendlog.session import ship_package

# task functions travel inside the job: this folder is not installed on executors
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values of the corpus definition.
N_NODES = 4
NAME_PREFIX = "service.log."
DECOY_SUFFIX = ".gz"
DECOY_PREFIX = "x"
DECOY_DIR = "service.log.dir"

CHUNK_ROWS = 1 << 16
FANOUT = 1 << 10
CHUNKS_PER_TASK = 4


def corpus_lines(events: DataFrame, snapshot: int, n_events: int, n_nodes: int = N_NODES) -> DataFrame:
    """Lines of one snapshot: ``node, name, event_type, event_id, line``."""
    e = events.select(
        F.concat(F.lit("node"), (F.col("user_id") % n_nodes).cast("string")).alias("node"),
        F.concat(F.lit(NAME_PREFIX), F.col("event_type")).alias("name"),
        "event_type",
        "event_id",
        F.concat(
            F.col("event_id").cast("string"), F.lit("|"),
            F.col("user_id").cast("string"), F.lit("|"),
            F.col("event_type"), F.lit("|"),
            F.col("props"),
        ).alias("line"),
    ).where(F.col("line").isNotNull())
    early = F.col("event_id") * 10 < F.lit(n_events) * 6
    if snapshot == 0:
        cond = early & (F.col("event_type") != "signup")
    elif snapshot == 1:
        et = F.col("event_type")
        cond = (
            et.isin("click", "signup")
            | ((et == "error") & ~early)
            | ((et == "view") & (F.col("event_id") * 10 < F.lit(n_events) * 2))
        )
    elif snapshot == 2:
        cond = F.lit(True)
    else:
        raise ValueError(f"snapshot must be 0, 1 or 2, got {snapshot}")
    return e.where(cond)


def _prepare_files(root: str, decoys: bool):
    def fn(it):
        for pdf in it:
            out = []
            for node, name, size in zip(pdf["node"], pdf["name"], pdf["size"]):
                d = os.path.join(root, node)
                os.makedirs(d, exist_ok=True)
                p = os.path.join(d, name)
                if pd.isna(size):
                    if os.path.lexists(p):
                        os.remove(p)
                    out.append(0)
                    continue
                fd = os.open(p, os.O_WRONLY | os.O_CREAT, 0o644)
                try:
                    if os.fstat(fd).st_size > int(size):
                        os.ftruncate(fd, int(size))
                finally:
                    os.close(fd)
                if decoys:
                    for decoy in (DECOY_PREFIX + name, name + DECOY_SUFFIX):
                        with open(os.path.join(d, decoy), "wb") as f:
                            f.write(b"not a log\n")
                    os.makedirs(os.path.join(d, DECOY_DIR), exist_ok=True)
                out.append(1)
            yield pd.DataFrame({"done": out}, dtype="int64")

    return fn


def _joined(lines: pa.Array) -> bytes:
    """The lines of a string array, each followed by a newline, as one buffer
    (numpy inserts the newlines; no per-line Python)."""
    wide = pa.types.is_large_string(lines.type)
    offsets = np.frombuffer(lines.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[lines.offset: lines.offset + len(lines) + 1].astype(np.int64)
    values = lines.buffers()[2]
    data = (np.frombuffer(values, dtype=np.uint8)[offsets[0]:offsets[-1]] if values is not None
            else np.empty(0, dtype=np.uint8))
    return np.insert(data, offsets[1:] - offsets[0], 0x0A).tobytes()


def _write_chunks(root: str):
    """Arrow batches sorted by (node, name, chunk, key): each run of one chunk
    is written with one ``pwrite`` at its offset."""

    def fn(batches):
        fds: dict[str, int] = {}
        nxt: dict[tuple, int] = {}
        try:
            for batch in batches:
                written = 0
                n = batch.num_rows
                if n:
                    node = batch.column(0).to_numpy(zero_copy_only=False)
                    name = batch.column(1).to_numpy(zero_copy_only=False)
                    chunk = batch.column(2).to_numpy()
                    base = batch.column(3).to_numpy()
                    lines = batch.column(4)
                    cut = np.flatnonzero(
                        (node[1:] != node[:-1]) | (name[1:] != name[:-1]) | (chunk[1:] != chunk[:-1])) + 1
                    for a, b in zip(np.concatenate([[0], cut]), np.concatenate([cut, [n]])):
                        a, b = int(a), int(b)
                        key = (node[a], name[a], int(chunk[a]))
                        path = os.path.join(root, key[0], key[1])
                        fd = fds.get(path)
                        if fd is None:
                            if len(fds) > 64:
                                for v in fds.values():
                                    os.close(v)
                                fds.clear()
                            fd = fds[path] = os.open(path, os.O_WRONLY)
                        at = nxt.pop(key, int(base[a]))
                        data = _joined(lines.slice(a, b - a))
                        os.pwrite(fd, data, at)
                        nxt[key] = at + len(data)
                        written += len(data)
                yield pa.RecordBatch.from_arrays([pa.array([written], type=pa.int64())], names=["bytes"])
        finally:
            for v in fds.values():
                os.close(v)

    return fn


def chunk_offsets(chunks: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """Base offset of each (file, chunk): a two-level running sum.

    Chunks are grouped by ``chunk // fanout``; the running sum inside a group
    and the running sum over group totals each see at most ``fanout`` rows,
    respectively one row per ``fanout * CHUNK_ROWS`` lines of a file, so even a
    file holding a third of all lines never puts a long list in one task.
    """
    chunks = chunks.withColumn("grp", F.floor(F.col("chunk") / fanout))
    inner = Window.partitionBy("node", "name", "grp").orderBy("chunk")
    chunks = chunks.withColumn("in_grp", F.sum("chunk_bytes").over(inner) - F.col("chunk_bytes"))
    groups = chunks.groupBy("node", "name", "grp").agg(F.sum("chunk_bytes").alias("grp_bytes"))
    outer = Window.partitionBy("node", "name").orderBy("grp")
    groups = groups.select("node", "name", "grp",
                           (F.sum("grp_bytes").over(outer) - F.col("grp_bytes")).alias("grp_base"))
    return chunks.join(groups, ["node", "name", "grp"]).select(
        "node", "name", "chunk", "chunk_bytes", (F.col("grp_base") + F.col("in_grp")).alias("base"))


def write_lines(
    spark: SparkSession,
    lines: DataFrame,
    root: str,
    *,
    key: str,
    remove: DataFrame | None = None,
    decoys: bool = False,
    chunk_rows: int = CHUNK_ROWS,
) -> None:
    """Write ``lines`` (``node, name, <key>, line``) as ``<root>/<node>/<name>``,
    one newline-terminated line per row in ``key`` order; files listed in
    ``remove`` (``node, name``) are deleted.  Existing files are shrunk, extended
    or overwritten in place."""
    ship_package(spark)
    lines = lines.select(
        "node", "name", F.col(key).alias("_k"), "line",
        (F.octet_length("line") + 1).alias("nbytes"),
        F.floor(F.col(key) / chunk_rows).alias("chunk"),
    )
    # one row per (file, chunk); kept so that the two-level running sum does
    # not scan the lines twice
    sizes = lines.groupBy("node", "name", "chunk").agg(F.sum("nbytes").alias("chunk_bytes")).cache()
    chunks = chunk_offsets(sizes).cache()

    targets = chunks.groupBy("node", "name").agg(F.sum("chunk_bytes").alias("size"))
    if remove is not None:
        gone = remove.select("node", "name").distinct().join(targets, ["node", "name"], "left_anti")
        targets = targets.unionByName(gone.withColumn("size", F.lit(None).cast("bigint")))
    (
        targets.mapInPandas(_prepare_files(root, decoys), "done long")
        .write.format("noop").mode("overwrite").save()
    )
    # a few chunks per task: independent of the session's shuffle partitions, of
    # AQE and of the cluster
    n = max(1, -(-chunks.count() // CHUNKS_PER_TASK))
    (
        lines.join(chunks.select("node", "name", "chunk", "base"), ["node", "name", "chunk"])
        .repartition(n, "node", "name", "chunk")
        .sortWithinPartitions("node", "name", "chunk", "_k")
        .select("node", "name", "chunk", "base", "line")
        .mapInArrow(_write_chunks(root), "bytes long")
        .write.format("noop").mode("overwrite").save()
    )
    chunks.unpersist()
    sizes.unpersist()


def write_snapshot(
    spark: SparkSession,
    events: DataFrame,
    root: str,
    snapshot: int,
    *,
    decoys: bool = True,
    n_events: int | None = None,
    n_nodes: int = N_NODES,
) -> None:
    """Make ``root`` hold exactly the files of ``snapshot`` (replacing, extending,
    shrinking or deleting earlier ones in place)."""
    if n_events is None:
        n_events = events.count()
    lines = corpus_lines(events, snapshot, n_events, n_nodes)
    # files of other snapshots may be on disk and must go; a new folder has none,
    # and the last snapshot holds every file
    fresh = not os.path.isdir(root) or not os.listdir(root)
    others = None if fresh else corpus_lines(events, 2, n_events, n_nodes)
    write_lines(spark, lines, root, key="event_id", remove=others, decoys=decoys)
