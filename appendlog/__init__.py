"""appendlog: incremental reading of growing (append-only) log files on Spark.

Batch building blocks are ordinary DataFrame jobs (listing, planning, range
reading, offset state); the streaming source ``format("appendlog")`` ties them
together for Structured Streaming.
"""

from appendlog.sources.pathspec import PathSpec, parse_path
from appendlog.sources.options import ReadConfig, resolve
from appendlog.sources.catalog import list_files, list_nodes, snapshot
from appendlog.plans.planner import plan, align
from appendlog.operators.ranges import read_ranges
from appendlog.operators.state import (
    bytes_behind,
    carry_forward,
    from_offset_json,
    newer_of,
    state_from_plan,
    to_offset_json,
)
from appendlog.streaming.backup import OffsetBackup, TableBackup, recover, register_backup
from appendlog.streaming.job import (
    attach_backup,
    console_query,
    drain,
    end_offset,
    read_stream,
    register,
    run_available,
    start_stream,
    stop_stream,
    stream_lag,
)

__all__ = [
    "PathSpec", "parse_path", "ReadConfig", "resolve",
    "list_files", "list_nodes", "snapshot",
    "plan", "align", "read_ranges",
    "bytes_behind", "carry_forward", "from_offset_json", "newer_of",
    "state_from_plan", "to_offset_json",
    "read_stream", "run_available", "start_stream", "stop_stream", "drain", "register", "attach_backup", "console_query", "stream_lag", "end_offset",
    "OffsetBackup", "TableBackup", "recover", "register_backup",
]
