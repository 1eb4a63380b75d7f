"""Offset state as DataFrames (T7, T9, T11, T13).

State rows: ``node, name, offset, md5``; a node that was listed with no files
keeps one row with a null name, so that "first run" (state wholly empty)
turns false.  The stream offset is one JSON document per directory::

    {"directory": d, "offsets": {node: {file: {"offset": n, "md5": s}}}}

Its size grows with the number of files, never with their bytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from appendlog.plans import rules as R
from appendlog.session import local_frame

STATE_SCHEMA = "node string, name string, offset bigint, md5 string"
OFFSET_DDL = (
    "struct<directory:string, "
    "offsets:map<string,map<string,struct<offset:bigint,md5:string>>>>"
)


def empty_state(spark) -> DataFrame:
    """State of a stream that has read nothing yet (first run)."""
    return local_frame(spark, [], STATE_SCHEMA)


def state_from_plan(planned: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """New state after a plan: every row but deleted ones, at its planned end.

    Listed nodes without files keep an empty entry (a row with null name).
    """
    rows = planned.where(F.col("status") != R.DELETED).select(
        "node", "name", F.col("end_offset").alias("offset"), "md5")
    if nodes is None:
        return rows
    empty = (
        nodes.select("node").distinct()
        .join(rows.select("node").distinct(), "node", "left_anti")
        .select("node", F.lit(None).cast("string").alias("name"),
                F.lit(None).cast("bigint").alias("offset"), F.lit(None).cast("string").alias("md5"))
    )
    return rows.unionByName(empty)


def carry_forward(planned: DataFrame) -> DataFrame:
    """State rows of nodes not listed now stay as they were (T7); others advance."""
    return state_from_plan(planned).where(F.col("name").isNotNull())


def bytes_behind(planned: DataFrame) -> DataFrame:
    """Reported position (T13): bytes of each listed file beyond its saved offset.

    Files read again from 0 (new, replaced, truncated) count their whole size.
    """
    restart = F.col("status").isin(R.NEW, R.REPLACED, R.TRUNCATED)
    return planned.where(~F.col("status").isin(R.DELETED, R.CARRIED)).select(
        "node", "name", "status",
        F.when(restart, F.col("size")).otherwise(F.col("size") - F.col("known")).alias("bytes_behind"))


def _by_key(a, b):
    return F.when(a.k < b.k, -1).when(a.k > b.k, 1).otherwise(0)


def to_offset_json(state: DataFrame, directory: DataFrame | str | None = None) -> DataFrame:
    """State rows to one offset JSON per directory: ``directory, offset_json``.

    ``state`` may carry a ``directory`` column; else ``directory`` names it.
    """
    if "directory" not in state.columns:
        state = state.withColumn("directory", F.lit(directory))
    files = (
        state.groupBy("directory", "node")
        .agg(
            F.array_sort(
                F.collect_list(
                    F.when(
                        F.col("name").isNotNull(),
                        F.struct(F.col("name").alias("k"),
                                 F.struct("offset", "md5").alias("v")),
                    )
                )
            ).alias("entries")
        )
        .select("directory", "node", F.map_from_entries("entries").alias("files"))
    )
    return files.groupBy("directory").agg(
        F.to_json(
            F.struct(
                F.col("directory").alias("directory"),
                F.map_from_entries(
                    F.array_sort(F.collect_list(F.struct(F.col("node").alias("k"), F.col("files").alias("v"))),
                                 _by_key)
                ).alias("offsets"),
            )
        ).alias("offset_json")
    )


def from_offset_json(docs: DataFrame, column: str = "offset_json", keep=()) -> DataFrame:
    """Offset JSON back to rows: ``directory, node, name, offset, md5`` (plus ``keep``).

    A node with an empty map gives one row with a null name.
    """
    keep = list(keep)
    parsed = docs.select(*keep, F.from_json(F.col(column), OFFSET_DDL).alias("o"))
    nodes = parsed.select(*keep, F.col("o.directory").alias("directory"),
                          F.explode(F.col("o.offsets")).alias("node", "files"))
    files = nodes.select(*keep, "directory", "node", F.explode_outer("files").alias("name", "fo"))
    return files.select(*keep, "directory", "node", "name",
                        F.col("fo.offset").alias("offset"), F.col("fo.md5").alias("md5"))


def to_offset_lines(state: DataFrame, directory: DataFrame | str | None = None) -> DataFrame:
    """State rows to JSON, one document per file (no row grows with the number
    of files): ``offset_json``, for ``from_offset_lines``."""
    if "directory" not in state.columns:
        state = state.withColumn("directory", F.lit(directory))
    return state.select(F.to_json(F.struct("directory", "node", "name", "offset", "md5")).alias("offset_json"))


def from_offset_lines(lines: DataFrame, column: str = "offset_json") -> DataFrame:
    """Documents of ``to_offset_lines`` back to rows: ``directory, node, name, offset, md5``."""
    return lines.select(F.from_json(F.col(column), "directory string, " + STATE_SCHEMA).alias("o")).select("o.*")


def newer_of(local: DataFrame, shared: DataFrame) -> DataFrame:
    """Newest offset per directory from two stores (``directory, ts, offset_json``).

    A tie keeps the local record.
    """
    both = local.select("directory", "ts", "offset_json", F.lit(1).alias("rank")).unionByName(
        shared.select("directory", "ts", "offset_json", F.lit(0).alias("rank")))
    return both.groupBy("directory").agg(
        F.max("ts").alias("ts"),
        F.max_by("offset_json", F.struct("ts", "rank")).alias("offset_json"),
    )


def merge_by_node(local: DataFrame, shared: DataFrame) -> DataFrame:
    """One state out of two stores of one stream that are ahead on different
    nodes (T11): ``node, name, offset, md5, version`` of, for each node, the
    store whose newest row of that node is the later one (a tie keeps the local one).

    Both sides have ``version`` (a version or time of the row's last change)
    and may have ``gone`` rows, which count as changes and leave no row.
    """
    def stamps(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("node").agg(F.max("version").alias(name))

    ahead = stamps(local, "mine").join(stamps(shared, "theirs"), "node", "full_outer").select(
        "node", (F.col("mine").isNull() | (F.col("theirs") > F.col("mine"))).alias("take"))
    take = F.coalesce("take", F.lit(False))

    def chosen(rows: DataFrame, wanted) -> DataFrame:
        rows = rows.where(~F.col("gone")) if "gone" in rows.columns else rows
        return rows.join(ahead.where(wanted), "node").select("node", "name", "offset", "md5", "version")

    return chosen(local, ~take).unionByName(chosen(shared, take))
