"""The ``appendlog`` Structured Streaming source (Python data source API).

Planning (``latestOffset``) runs in the source's process on the driver and
touches metadata only: directory listings, file sizes, head checksums and a
short scan around each planned end to align it to a newline.  All data bytes
are read by executors in ``read``, as Arrow batches.

Offset (no timestamp in it, so an idle stream runs no batches)::

    {"directory": d, "offsets": {node: {file: {"offset": n, "md5": s}}}}

(an entry has a ``credit`` too while a byte budget holds its file back).  With
``catalog=manifest`` Spark jobs list and plan (``operators.manifest``), and the
offset is the manifest's version, whatever the number of files::

    {"directory": d, "version": v}
"""

from __future__ import annotations

import json
import logging
import os
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

from appendlog.functions.bytescan import aligned_end, head_md5, tail_start
from appendlog.functions.linescan import iter_line_arrays
from appendlog.operators.manifest import offset_log, range_files
from appendlog.plans import rules as R
from appendlog.plans.admission import fair_level, next_credit
from appendlog.sources.options import ReadConfig
from appendlog.sources.pathspec import LOCAL_NODE, AppendLogError, PathSpec

FORMAT = "appendlog"
SCHEMA = StructType([StructField("value", StringType(), False)])
IO_THREADS = 16
MAX_SAID = 10_000  # warnings remembered so as not to repeat them
MAX_RANGES_PER_TASK = 256  # file opens per task stay bounded when many files grow a little


class FileRange(InputPartition):
    """Aligned range ``[start, end)`` of one file; this task owns lines starting in ``[lo, hi)``."""

    def __init__(self, node, path, start, end, lo, hi, md5, sample):
        self.node, self.path, self.start, self.end = node, path, start, end
        self.lo, self.hi, self.md5, self.sample = lo, hi, md5, sample
        self.value = None

    def __repr__(self) -> str:
        return f"FileRange({self.path}, [{self.start}, {self.end}), owns [{self.lo}, {self.hi}))"


def empty_offset(directory: str) -> dict:
    return {"directory": directory, "offsets": {}}


def normalize(offset: dict) -> dict:
    """Keys sorted, so equal positions give equal JSON."""
    return {
        "directory": offset["directory"],
        "offsets": {
            node: {name: {"offset": int(fo["offset"]), "md5": fo["md5"] or "",
                          **({"credit": int(fo["credit"])} if fo.get("credit") else {})}
                   for name, fo in sorted(files.items())}
            for node, files in sorted(offset["offsets"].items())
        },
    }


def list_dir(spec: PathSpec, node: str) -> list[tuple[str, int, int, int]] | None:
    """(name, size, mtime_ns, inode) of matching regular files; None if unreadable."""
    out = []
    try:
        with os.scandir(spec.node_dir(node)) as it:
            for e in it:
                if e.name.startswith((".", "_")) or not spec.matches(e.name):
                    continue
                try:
                    if not e.is_file(follow_symlinks=True):
                        continue
                    st = e.stat(follow_symlinks=True)
                except FileNotFoundError:  # removed while listing
                    continue
                out.append((e.name, st.st_size, st.st_mtime_ns, st.st_ino))
    except OSError:
        return None
    return out


def list_node_names(spec: PathSpec) -> list[str]:
    if not spec.has_node:
        return [LOCAL_NODE]
    try:
        with os.scandir(spec.prefix) as it:
            return sorted(e.name for e in it
                          if not e.name.startswith((".", "_")) and e.is_dir())
    except OSError:
        return []


class Planner:
    """Driver-side planning for one stream (the Python twin of ``plans.planner``)."""

    def __init__(self, cfg: ReadConfig):
        self.cfg = cfg
        self._md5_cache: dict[str, tuple[int, int, int, str]] = {}
        self._held: dict[str, tuple] = {}
        self._said: set[str] = set()
        self._target: dict[tuple[str, str], int] | None = None
        if cfg.target_path:
            import pyarrow.parquet as pq

            end = pq.read_table(cfg.target_path).to_pydict()
            self._target = dict(zip(zip(end["node"], end["name"]), end["size"]))

    def _warn(self, message: str) -> None:
        """Log a warning, once for each change it tells of."""
        if message not in self._said:
            if len(self._said) >= MAX_SAID:
                self._said.clear()
            self._said.add(message)
            logging.getLogger("appendlog").warning(message)

    def _md5(self, path: str, size: int, mtime: int, ino: int) -> str:
        cfg = self.cfg
        if not cfg.md5_check or size < cfg.md5_sample:
            return ""
        hit = self._md5_cache.get(path)
        if hit and hit[:3] == (size, mtime, ino):
            return hit[3]
        fd = os.open(path, os.O_RDONLY)
        try:
            m = head_md5(fd, size, cfg.md5_sample, path)
        finally:
            os.close(fd)
        self._md5_cache[path] = (size, mtime, ino, m)
        return m

    def _align(self, path: str, d: R.Decision, size: int, stamp: tuple) -> int:
        if d.align == R.ALIGN_NONE:
            return d.end
        # a held tail (no newline yet) is not scanned again until the file changes
        key = (d.start, d.end, size) + stamp
        if self._held.get(path) == key:
            return d.start
        fd = os.open(path, os.O_RDONLY)
        try:
            if d.align == R.ALIGN_TAIL:
                return tail_start(fd, size, path)
            e = aligned_end(fd, d.start, d.end, size, path)
        finally:
            os.close(fd)
        if e == d.start:
            self._held[path] = key
        else:
            self._held.pop(path, None)
        return e

    def _admit(self, backlog: list, pool: ThreadPoolExecutor) -> None:
        """Bring the ends of backlogged files within the batch's budget
        (``plans.admission``), in place."""
        level = fair_level([(demand, credit) for _, (_, _, _, _, demand, credit) in backlog], self.cfg.batch_bytes)
        if level is None:
            return

        def cut(entry) -> None:
            fo, (path, d, size, stamp, demand, credit) = entry
            share = level + credit
            if demand <= share:
                return
            try:
                short = d._replace(end=d.start + max(0, share))
                end = d.start if share <= 0 else self._align(path, short, size, stamp)
            except OSError:
                end = d.start
            fo["offset"] = int(end)
            fo["credit"] = next_credit(share, demand, int(end) - d.start)

        list(pool.map(cut, backlog))

    def plan(self, start: dict) -> dict:
        cfg, spec = self.cfg, self.cfg.spec
        offsets = start["offsets"]
        first_run = not offsets
        node_names = sorted(set(list_node_names(spec)) | set(offsets))
        with ThreadPoolExecutor(IO_THREADS) as pool:
            listings = dict(zip(node_names, pool.map(lambda n: list_dir(spec, n), node_names)))
            jobs = []
            for node, files in listings.items():
                if files is None:
                    continue
                known = offsets.get(node, {})
                for name, size, mtime, ino in files:
                    if self._target is not None:  # a bounded run sees nothing that came later
                        if (node, name) not in self._target:
                            continue
                        size = min(size, self._target[node, name])
                    jobs.append((node, name, size, mtime, ino, known.get(name)))

            def one(job):
                node, name, size, mtime, ino, k = job
                path = spec.file_path(node, name)
                try:
                    md5 = self._md5(path, size, mtime, ino)
                    d = R.decide(
                        None if k is None else int(k["offset"]), None if k is None else k["md5"],
                        size, md5, node_listed=True, first_run=first_run,
                        policy=cfg.starting_offsets, cap=cfg.max_bytes, check=cfg.md5_check,
                    )
                    end = self._align(path, d, size, (mtime, ino))
                except OSError:  # cannot be read now: keep the saved position (a file that
                    return node, name, k, None  # is gone will be missing from the next listing)
                if d.status in (R.REPLACED, R.TRUNCATED):
                    self._warn(f"{path} was {d.status} (size {size}, saved position {k['offset']}); "
                               "it is read again from 0")
                fo = {"offset": int(end), "md5": d.md5 or ""}
                if d.align != R.ALIGN_RANGE or end <= d.start:
                    return node, name, fo, None
                # what the file could send, for a byte budget of the batch
                kept = int(k.get("credit", 0)) if k is not None and d.status == R.APPENDED else 0
                return node, name, fo, (path, d, size, (mtime, ino), int(end) - d.start, kept)

            results = list(pool.map(one, jobs))
            if cfg.batch_bytes:
                self._admit([(fo, more) for _, _, fo, more in results if more is not None], pool)
        seen = {spec.file_path(j[0], j[1]) for j in jobs}
        for cache in (self._md5_cache, self._held):
            for stale in [p for p in cache if p not in seen]:
                del cache[stale]
        new: dict[str, dict] = {}
        if not os.path.isdir(spec.prefix):
            self._warn(f"directory {spec.prefix} does not exist")
        for node, files in listings.items():
            if files is None:  # not listed now: carry forward (T7)
                self._warn(f"{spec.node_dir(node)} cannot be listed; its files keep their positions")
                if node in offsets:
                    new[node] = offsets[node]
            else:
                new[node] = {}
        for node, name, fo, _ in results:
            if fo is not None:
                new[node][name] = fo
        return normalize({"directory": spec.directory, "offsets": new})


class RangeBin(InputPartition):
    """Several ranges read by one task (many small appends share a task)."""

    def __init__(self, pieces: list[FileRange]):
        self.pieces = pieces
        self.value = None

    def __repr__(self) -> str:
        return f"RangeBin({len(self.pieces)} ranges)"


def pack(pieces: list[FileRange], target: int, max_files: int = MAX_RANGES_PER_TASK) -> list[RangeBin]:
    """Bins of at most ``target`` bytes and ``max_files`` ranges (a piece is <= target).

    Next-fit decreasing: pieces sorted by size, largest first, and a bin is
    closed when the next piece would overflow it (linear after the sort).
    """
    bins: list[list[FileRange]] = []
    used = 0
    for p in sorted(pieces, key=lambda p: p.hi - p.lo, reverse=True):
        size = p.hi - p.lo
        if not bins or used + size > target or len(bins[-1]) >= max_files:
            bins.append([])
            used = 0
        bins[-1].append(p)
        used += size
    return [RangeBin(items) for items in bins]


def partitions_between(cfg: ReadConfig, start: dict, end: dict) -> list[RangeBin]:
    first_run = not start["offsets"]
    out = []
    for node, files in sorted(end["offsets"].items()):
        before = start["offsets"].get(node, {})
        for name, fo in sorted(files.items()):
            e = int(fo["offset"])
            if name in before:
                s = int(before[name]["offset"])
            else:
                s = e if (first_run and cfg.starting_offsets == "latest") else 0
            s = min(s, e)  # rectify after replacement or truncation
            if e <= s:
                continue
            path = cfg.spec.file_path(node, name)
            check = cfg.md5_sample if cfg.md5_check else 0
            lo = s
            while lo < e:
                hi = min(e, lo + cfg.split_bytes)
                out.append(FileRange(node, path, s, e, lo, hi, fo.get("md5", ""), check))
                lo = hi
    return pack(out, cfg.split_bytes)


def read_range(p: FileRange):
    schema = pa.schema([pa.field("value", pa.large_string(), nullable=False)])
    fd = os.open(p.path, os.O_RDONLY)
    try:
        if p.sample and p.md5:
            now = head_md5(fd, os.fstat(fd).st_size, p.sample, p.path)
            if now != p.md5:
                raise AppendLogError(
                    f"{p.path} was replaced after range [{p.start}, {p.end}) was planned "
                    f"(head checksum {now!r}, planned {p.md5!r}); restart from a new checkpoint")
        for arr in iter_line_arrays(fd, p.lo, p.hi, p.start, p.end, p.path):
            if len(arr):
                yield pa.RecordBatch.from_arrays([arr], schema=schema)
    finally:
        os.close(fd)


class RangeTable(InputPartition):
    """A file of sub-ranges that a Spark job has written; one task reads them."""

    def __init__(self, path: str, sample: int):
        self.path, self.sample = path, sample
        self.value = None

    def __repr__(self) -> str:
        return f"RangeTable({self.path})"

    @property
    def pieces(self):
        import pyarrow.parquet as pq

        t = pq.read_table(self.path).to_pydict()
        return [FileRange(None, *row, self.sample) for row in zip(
            t["path"], t["start"], t["end"], t["lo"], t["hi"], t["md5"], strict=True)]


class ManifestReader(DataSourceStreamReader):
    """The stream over a manifest that Spark jobs advance: this process sees
    version numbers and the names of range files, no log file."""

    def __init__(self, cfg: ReadConfig):
        self.cfg, self.log = cfg, offset_log(cfg.catalog_path)
        self.pos: dict | None = None

    def _at(self, version: int) -> dict:
        return {"directory": self.cfg.spec.directory, "version": version}

    def initialOffset(self) -> dict:
        raw = self.cfg.initial_offset_json
        if not raw:
            return self._at(-1)
        o = json.loads(raw)
        if o.get("directory") != self.cfg.spec.directory or "version" not in o:
            raise AppendLogError(f"initial offset {raw[:200]!r} is no version of a manifest of {self.cfg.spec.directory!r}")
        return self._at(int(o["version"]))

    def latestOffset(self) -> dict:
        # one version is one admitted step, so one batch
        at = int((self.pos or self.initialOffset())["version"])
        self.pos = self._at(at + 1 if self.log.has(at + 1) else at)
        return self.pos

    def partitions(self, start: dict, end: dict):
        self.pos = end
        sample = self.cfg.md5_sample if self.cfg.md5_check else 0
        return [RangeTable(f, sample) for v in range(int(start["version"]) + 1, int(end["version"]) + 1)
                for f in range_files(self.log, v)]

    def read(self, partition: RangeTable):
        for piece in partition.pieces:
            yield from read_range(piece)

    def commit(self, end: dict) -> None:
        pass


class AppendLogStreamReader(DataSourceStreamReader):
    def __init__(self, cfg: ReadConfig):
        self.cfg = cfg
        self.pos: dict | None = None
        self._init: dict | None = None
        self._planner = Planner(cfg)

    def _initial(self) -> dict:
        if self._init is None:
            raw = self.cfg.initial_offset_json
            if raw:
                o = json.loads(raw)
                if o.get("directory") != self.cfg.spec.directory:
                    raise AppendLogError(
                        f"initial offset is for directory {o.get('directory')!r}, "
                        f"not {self.cfg.spec.directory!r}")
                self._init = normalize(o)
            else:
                self._init = empty_offset(self.cfg.spec.directory)
        return self._init

    def initialOffset(self) -> dict:
        return self._initial()

    def latestOffset(self) -> dict:
        start = self.pos if self.pos is not None else self._initial()
        end = self._planner.plan(start)
        self.pos = end
        return end

    def partitions(self, start: dict, end: dict):
        self.pos = end
        return partitions_between(self.cfg, start, end)

    def read(self, partition: RangeBin):
        for piece in partition.pieces:
            yield from read_range(piece)

    def commit(self, end: dict) -> None:
        # offsets are backed up from completed batches by the query listener
        pass


class AppendLogDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self):
        return SCHEMA

    def reader(self, schema: StructType):
        raise AppendLogError(
            f"the {FORMAT} source reads streams only (spark.readStream); for batch jobs use "
            "appendlog.snapshot / plan / align / read_ranges or operators.increment.run_increment")

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        if [(f.name, f.dataType) for f in schema.fields] != [("value", StringType())]:
            raise AppendLogError(
                f"the {FORMAT} source has the fixed schema 'value STRING'; got {schema.simpleString()}")
        cfg = ReadConfig.from_options(self.options)
        return ManifestReader(cfg) if cfg.catalog == "manifest" else AppendLogStreamReader(cfg)
