"""Range planning as a DataFrame job.

``plan`` joins the listing with the saved state (full outer on node, name)
and applies the decision table (``rules``) as one ``when`` chain; ``align``
then moves each planned end onto a line boundary, reading a few blocks of the
file on an executor.  Both sides of the join are catalog-sized (one row per
file), never data-sized.
"""

from __future__ import annotations

import os

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from appendlog.functions.bytescan import aligned_end, tail_start
from appendlog.plans import rules as R
from appendlog.plans.admission import next_credit
from appendlog.session import KNOWN_ROWS, materialize, ship_package

FILES_PER_TASK = 64  # files whose ends one task aligns

PLAN_SCHEMA = (
    "node string, name string, path string, status string, size bigint, "
    "known bigint, start_offset bigint, end_offset bigint, md5 string, align int, credit bigint, credit_before bigint, "
    "mtime timestamp"
)
#: A plan's columns with the files' inodes, as ``align`` returns them.
ALIGNED_SCHEMA = PLAN_SCHEMA + ", inode bigint"


def _when_chain(pairs: list[tuple[Column, Column]], otherwise: Column) -> Column:
    out = None
    for cond, val in pairs:
        out = F.when(cond, val) if out is None else out.when(cond, val)
    return out.otherwise(otherwise)


def plan(
    listing: DataFrame,
    state: DataFrame,
    nodes: DataFrame,
    *,
    policy: str = "earliest",
    cap: int = 2147483647,
    check: bool = True,
    first_run: bool | None = None,
) -> DataFrame:
    """Unaligned plan, one row per (node, file) of listing or state.

    ``listing``: node, name, size, md5 [, path, mtime, inode]; ``state``: node, name, offset,
    md5 [, credit] (a node with an empty map has one row with a null name);
    ``nodes``: the nodes listed now.  ``first_run`` defaults to "state has no
    row".  Credits (``admission``) stay with files that go on from their position.
    """
    if cap < 1:
        raise ValueError("bytes.max must be at least 1")
    state_rows = KNOWN_ROWS.get(state)
    if first_run is None:
        first_run = state_rows == 0 if state_rows is not None else state.limit(1).count() == 0
    if "path" not in listing.columns:
        listing = listing.withColumn("path", F.lit(None).cast("string"))
    for column, kind in (("mtime", "timestamp"), ("inode", "bigint")):
        if column not in listing.columns:
            listing = listing.withColumn(column, F.lit(None).cast(kind))
    l = listing.select("node", "name", "path", "size", "mtime", "inode", F.col("md5").alias("cur_md5"))
    # A listed file proves that its node is listed, so only saved files without
    # a listing look for their node; the others get keys of their own (their
    # names behind a NUL), so a node holding a third of all files stays spread.
    listed = nodes.select(F.col("node").alias("asked")).distinct().withColumn("listed", F.lit(True))
    if state_rows == 0:
        # nothing saved yet: no join, every listed file is new
        j = l.select("*", F.lit(None).cast("bigint").alias("known"), F.lit(None).cast("string").alias("kmd5"),
                     F.lit(None).cast("bigint").alias("credit"))
    else:
        credit = F.col("credit") if "credit" in state.columns else F.lit(None)
        s = state.where(F.col("name").isNotNull()).select(
            "node", "name", F.col("offset").alias("known"), F.col("md5").alias("kmd5"), credit.cast("bigint").alias("credit"))
        j = l.join(s, ["node", "name"], "full_outer")
    if state_rows == 0:
        j = j.withColumn("listed", F.lit(True))
    else:
        j = j.withColumn("asked", F.when(F.col("size").isNull(), F.col("node")).otherwise(
            F.concat(F.lit("\0"), F.col("name")))).join(listed, "asked", "left")

    known, size, kmd5, md5 = F.col("known"), F.col("size"), F.col("kmd5"), F.col("cur_md5")
    # carried: the node was not listed, or the file's head could not be read
    not_listed = F.coalesce(F.when(size.isNull(), F.col("listed").isNull()), md5.isNull())
    gone = size.isNull()
    new = known.isNull()
    replaced = F.lit(check) & (kmd5 != "") & (kmd5 != md5)
    truncated = known > size
    unchanged = known == size
    capped = F.least(known + F.lit(cap), size)

    status = _when_chain(
        [(not_listed, F.lit(R.CARRIED)), (gone, F.lit(R.DELETED)), (new, F.lit(R.NEW)),
         (replaced, F.lit(R.REPLACED)), (truncated, F.lit(R.TRUNCATED)),
         (unchanged, F.lit(R.UNCHANGED))],
        F.lit(R.APPENDED),
    )
    zero = F.lit(0).cast("bigint")
    if first_run and policy == "earliest":
        new_start, new_end, new_align = zero, F.least(F.lit(cap).cast("bigint"), size), R.ALIGN_RANGE
    elif first_run and policy == "latest":
        new_start, new_end, new_align = size, size, R.ALIGN_TAIL
    else:
        new_start, new_end, new_align = zero, zero, R.ALIGN_NONE
    null = F.lit(None).cast("bigint")
    pairs_start = [(not_listed, known), (gone, null), (new, new_start),
                   (replaced | truncated, zero), (unchanged, known)]
    pairs_end = [(not_listed, known), (gone, null), (new, new_end),
                 (replaced | truncated, zero), (unchanged, known)]
    align = _when_chain(
        [(not_listed | gone, F.lit(R.ALIGN_NONE)), (new, F.lit(new_align)),
         (replaced | truncated | unchanged, F.lit(R.ALIGN_NONE))],
        F.lit(R.ALIGN_RANGE),
    )
    # an unreadable file that is not known yet registers once it can be read
    return j.where(known.isNotNull() | size.isNull() | md5.isNotNull()).select(
        "node",
        "name",
        "path",
        status.alias("status"),
        size.alias("size"),
        known.alias("known"),
        _when_chain(pairs_start, known).alias("start_offset"),
        _when_chain(pairs_end, capped).alias("end_offset"),
        F.when(not_listed, kmd5).when(gone, F.lit(None)).otherwise(md5).alias("md5"),
        align.cast("int").alias("align"),
        F.when(not_listed | (known <= size) & ~replaced, F.coalesce("credit", F.lit(0))).otherwise(0).cast("bigint").alias("credit"),
        F.coalesce("credit", F.lit(0)).cast("bigint").alias("credit_before"),
        "mtime",
        "inode",
    )


def _align_fn(it):
    for pdf in it:
        ends = pdf["end_offset"].copy()
        starts = pdf["start_offset"].copy()
        for i, (path, start, end, size, mode) in enumerate(
            zip(pdf["path"], pdf["start_offset"], pdf["end_offset"], pdf["size"], pdf["align"])
        ):
            if mode == R.ALIGN_NONE or pd.isna(end):
                continue
            try:
                fd = os.open(path, os.O_RDONLY)
            except FileNotFoundError:  # removed since listing: read nothing now
                if mode == R.ALIGN_TAIL:
                    starts.iat[i] = 0
                ends.iat[i] = starts.iat[i]
                continue
            try:
                if mode == R.ALIGN_TAIL:
                    e = tail_start(fd, int(size), path)
                    starts.iat[i] = e
                    ends.iat[i] = e
                else:
                    ends.iat[i] = aligned_end(fd, int(start), int(end), int(size), path)
            except OSError:  # shrank since listing: hold at the start for now
                ends.iat[i] = starts.iat[i]
            finally:
                os.close(fd)
        if "share" in pdf.columns:  # admitted under a byte budget: what is left of each share
            sent = ends - starts
            pdf["credit"] = [next_credit(int(s), int(d), int(n)) if d > 0 else int(c) if k == R.CARRIED else 0 for s, d, n, c, k in
                             zip(pdf.pop("share"), pdf.pop("demand"), sent, pdf["credit"], pdf["status"])]
        pdf["start_offset"] = starts
        pdf["end_offset"] = ends
        pdf["inode"] = pdf["inode"].astype("Int64")
        yield pdf


def align(planned: DataFrame, files: int | None = None) -> DataFrame:
    """Move planned ends onto line ends (rows needing it read their file).

    The number of ``files`` gives the number of tasks; where it is not known
    the plan is pinned and counted first.
    """
    ship_package(planned.sparkSession)
    rows = KNOWN_ROWS.get(planned) if files is None else files
    if rows is None:
        planned, rows = materialize(planned)
    # the plan is tiny in bytes: an explicit count keeps AQE from folding the
    # per-file reads into one task
    return planned.repartition(max(1, -(-rows // FILES_PER_TASK))).mapInPandas(_align_fn, ALIGNED_SCHEMA)
