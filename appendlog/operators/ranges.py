"""Byte-range line reads (S2) as a ``mapInArrow`` job.

Each planned range ``[start, end)`` (aligned to line ends) is cut into
sub-ranges of at most ``split_bytes``; a sub-range owns the lines that start in
it.  Sub-ranges are spread round-robin over a number of partitions that follows
from their bytes and their number, so one huge file (a hot source) is read by
many tasks, and many small files share tasks.  Rows come out as Arrow batches (no per-row Python objects).
"""

from __future__ import annotations

import os

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from appendlog.functions.bytescan import head_md5
from appendlog.functions.linescan import iter_line_arrays
from appendlog.session import KNOWN_ROWS, materialize, ship_package

LINES_SCHEMA = "node string, name string, value string"
SPLIT_BYTES = 128 << 20
# Without a given split size: 4 MiB at least, SPLIT_BYTES at most, and between
# them a fixed share of all bytes, whatever the cluster.
LEAST_SPLIT_BYTES = 4 << 20
SPLITS = 4096
RANGES_PER_TASK = 256  # file opens per task stay bounded when many files grow a little


def split_size(total_bytes: int) -> int:
    """Sub-range size for a plan of ``total_bytes``."""
    return min(SPLIT_BYTES, max(LEAST_SPLIT_BYTES, -(-total_bytes // SPLITS)))


def split_ranges(ranges: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """One row per sub-range: adds ``lo``, ``hi`` (``[lo, hi)`` within ``[start, end)``)."""
    r = ranges.where(F.col("end_offset") > F.col("start_offset"))
    lo = F.explode(F.sequence(F.col("start_offset"), F.col("end_offset") - 1, F.lit(split_bytes).cast("bigint")))
    return r.select("*", lo.alias("lo")).withColumn(
        "hi", F.least(F.col("lo") + F.lit(split_bytes), F.col("end_offset")))


def planned_bytes(start: Column, end: Column) -> Column:
    """Column: bytes of the range ``[start, end)``."""
    return F.when(end > start, end - start).otherwise(0)


def _read_fn(sample: int | None):
    out_schema = pa.schema([("node", pa.large_string()), ("name", pa.large_string()),
                            ("value", pa.large_string())])

    def fn(batches):
        for batch in batches:
            cols = batch.to_pydict()
            for node, name, path, start, end, lo, hi, md5 in zip(
                cols["node"], cols["name"], cols["path"], cols["start_offset"],
                cols["end_offset"], cols["lo"], cols["hi"], cols["md5"],
            ):
                fd = os.open(path, os.O_RDONLY)
                try:
                    if sample and md5:
                        now = head_md5(fd, os.fstat(fd).st_size, sample, path)
                        if now != md5:
                            raise IOError(
                                f"{path} was replaced after planning (head checksum {now!r}, planned {md5!r})")
                    for arr in iter_line_arrays(fd, lo, hi, start, end, path):
                        n = len(arr)
                        if n:
                            yield pa.RecordBatch.from_arrays(
                                [pa.repeat(node, n).cast(pa.large_string()),
                                 pa.repeat(name, n).cast(pa.large_string()), arr],
                                schema=out_schema,
                            )
                finally:
                    os.close(fd)

    return fn


def read_ranges(
    ranges: DataFrame,
    *,
    split_bytes: int | None = None,
    verify_sample: int | None = None,
    work: tuple[int, int] | None = None,
) -> DataFrame:
    """Lines of every range: ``node, name, value``.

    ``ranges`` needs ``node, name, path, start_offset, end_offset`` (and ``md5``
    when ``verify_sample`` is given: the head checksum is re-checked when the
    range is opened, so a file replaced since planning fails clearly).
    ``work`` (planned bytes and number of ranges with any) spares a pass over a
    pinned plan; ``split_bytes`` defaults to ``split_size`` of the bytes.
    """
    spark = ranges.sparkSession
    ship_package(spark)
    if "md5" not in ranges.columns:
        ranges = ranges.withColumn("md5", F.lit(""))
    if ranges not in KNOWN_ROWS and work is None:
        # catalog-sized; pinned so that every task reads the ranges of one
        # plan, even if an executor is lost and files grew
        ranges, _ = materialize(ranges.select("node", "name", "path", "start_offset", "end_offset", "md5"))
    if work is None:
        n = planned_bytes(F.col("start_offset"), F.col("end_offset"))
        row = ranges.agg(F.sum(n), F.sum((n > 0).cast("int"))).first()
        work = (row[0] or 0, row[1] or 0)
    total, files = work
    split_bytes = split_bytes or split_size(total)
    subs = split_ranges(ranges, split_bytes).select(
        "node", "name", "path", "start_offset", "end_offset", "lo", "hi", "md5")
    # an explicit partition count: the sub-range rows are tiny, so AQE would
    # otherwise coalesce all reads into one task
    tasks = max(1, -(-total // split_bytes), -(-files // RANGES_PER_TASK))
    return subs.repartition(tasks).mapInArrow(_read_fn(verify_sample), LINES_SCHEMA)
