"""Offset backup outside the checkpoint (T10, T12, T14).

A ``StreamingQueryListener`` stores the end offset of every completed batch
(never a merely planned one) through a provider.  The default provider is a
table: one small JSON-lines file per record under a folder on shared storage;
the newest record per stream wins (``max_by(offset_json, ts)``).

Records are kept by stream: the full ``path`` option, plus ``#`` and the
``stream.name`` option where one is given, so two streams over one folder with
other patterns or names do not start from each other's offsets.
"""

from __future__ import annotations

import ast
import hashlib
import json
import os
import threading
import time
import uuid
from abc import ABC, abstractmethod
from datetime import datetime, timezone
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from appendlog.operators.runlog import RunLog
from appendlog.session import posix_path, shared_root
from appendlog.sources.pathspec import AppendLogError

BACKUP_SCHEMA = "directory string, ts bigint, offset_json string"
KEEP = 16  # records of a stream that stay, by arrival, besides the newest by time


class OffsetBackup(ABC):
    """A place that keeps the newest offset of a stream, outside its checkpoint."""

    @abstractmethod
    def store(self, stream: str, ts: int, offset_json: str) -> None: ...

    @abstractmethod
    def fetch(self, spark: SparkSession, stream: str) -> tuple[int, str] | None:
        """``(ts, offset_json)`` of the newest record, or None."""

    def close(self) -> None:
        pass


class NoBackup(OffsetBackup):
    def store(self, stream, ts, offset_json):
        pass

    def fetch(self, spark, stream):
        return None


def _key(directory: str) -> str:
    return hashlib.md5(directory.encode("utf-8")).hexdigest()[:16]


class TableBackup(OffsetBackup):
    """Backup rows ``directory, ts, offset_json`` in a folder of JSON-lines files.

    The listener adds one small file per completed batch; beyond the last few
    to arrive, files of the same stream are removed, but never the record with
    the highest ``ts`` and never the one just written.  ``append`` adds rows
    from a DataFrame job.  Readers take the newest row per stream (the column
    is named ``directory``).
    """

    def __init__(self, path: str):
        self.path = posix_path(path)

    def store(self, stream: str, ts: int, offset_json: str) -> None:
        os.makedirs(self.path, exist_ok=True)
        key = _key(stream)
        name = f"{key}-{time.time_ns():020d}-{ts:020d}-{uuid.uuid4().hex[:8]}.json"
        tmp = os.path.join(self.path, "." + name)
        with open(tmp, "w", encoding="utf-8") as f:
            f.write(json.dumps({"directory": stream, "ts": ts, "offset_json": offset_json}) + "\n")
            f.flush()
            os.fsync(f.fileno())
        os.replace(tmp, os.path.join(self.path, name))
        old = sorted(n for n in os.listdir(self.path) if n.startswith(key + "-") and n.endswith(".json"))
        newest = max(old, key=lambda n: n.split("-")[2])
        for n in old[:-KEEP]:
            if n in (newest, name):
                continue
            try:
                os.remove(os.path.join(self.path, n))
            except FileNotFoundError:
                pass

    def append(self, docs: DataFrame) -> None:
        """Add backup rows (``directory, ts, offset_json``) with a Spark write."""
        docs.select("directory", F.col("ts").cast("bigint"), "offset_json").write.mode(
            "append").json(self.path)

    def rows(self, spark: SparkSession) -> DataFrame:
        if not os.path.isdir(self.path) or not any(
                n.endswith(".json") and not n.startswith((".", "_")) for n in os.listdir(self.path)):
            return spark.createDataFrame([], BACKUP_SCHEMA)
        return spark.read.schema(BACKUP_SCHEMA).json(self.path)

    def fetch(self, spark: SparkSession, stream: str) -> tuple[int, str] | None:
        row = latest_backup(self.rows(spark).where(F.col("directory") == stream)).first()
        return None if row is None else (row["ts"], row["offset_json"])


class LogBackup(OffsetBackup):
    """Backup as a versioned run log (``operators.runlog``), one per stream: a
    batch adds the rows of the files that it moved, each with the batch's time,
    and old rows merge in the background of later ones.

    For streams whose source process plans, whose offset names every file.  The
    offset of a manifest stream is a version number and needs no more than ``table``.
    """

    KEEP_VERSIONS = 16

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, posix_path(path)
        self._last: dict[str, dict] = {}

    def log(self, stream: str) -> RunLog:
        return RunLog(os.path.join(self.path, _key(stream)), ["node", "name"], "offset bigint, md5 string, credit bigint, ts bigint")

    def store(self, stream: str, ts: int, offset_json: str) -> None:
        new = _entries(offset_json)
        log = self.log(stream)
        version = log.version()
        if version >= 0 and ts < log.meta(version)["ts"]:
            return  # a late event: what is kept is newer
        if stream not in self._last:  # the first record of this application: compare with what is kept
            self._last[stream] = {(r.node, r.name): (r.offset, r.md5, r.credit) for r in log.rows(self.spark).toLocalIterator()}
        old = self._last[stream]
        rows = [(*k, *v, ts, False) for k, v in new.items() if old.get(k) != v]
        rows += [(*k, None, None, None, ts, True) for k in old if k not in new]
        if rows or version < 0:
            delta = self.spark.createDataFrame(
                rows, "node string, name string, offset bigint, md5 string, credit bigint, ts bigint, gone boolean")
            version = log.commit(self.spark, delta, len(rows), {"stream": stream, "ts": ts, "directory": json.loads(offset_json)["directory"]})
            if version % self.KEEP_VERSIONS == 0:
                log.expire(self.KEEP_VERSIONS)
        self._last[stream] = new

    def rows(self, spark: SparkSession, stream: str) -> DataFrame:
        """``node, name, offset, md5, version, gone`` with the batch time of each
        row's last change as its version (a node's own row has an empty name)."""
        return self.log(stream).stamped(spark).select("node", "name", "offset", "md5", F.col("ts").alias("version"), "gone")

    def fetch(self, spark: SparkSession, stream: str) -> tuple[int, str] | None:
        log = self.log(stream)
        version = log.version()
        if version < 0:
            return None
        meta = log.meta(version)
        offsets: dict[str, dict] = {}
        for r in log.rows(spark, version).toLocalIterator():
            files = offsets.setdefault(r.node, {})
            if r.name:
                files[r.name] = {"offset": r.offset, "md5": r.md5 or "", **({"credit": r.credit} if r.credit else {})}
        return meta["ts"], json.dumps({"directory": meta["directory"], "offsets": offsets}, sort_keys=True)


def _entries(offset_json: str) -> dict[tuple[str, str], tuple[int, str, int]]:
    """(node, name) -> (offset, md5, credit) of a stream offset; nodes have a row of their own."""
    out = {}
    for node, files in json.loads(offset_json)["offsets"].items():
        out[node, ""] = (0, "", 0)
        for name, fo in files.items():
            out[node, name] = (int(fo["offset"]), fo["md5"] or "", int(fo.get("credit", 0)))
    return out


def latest_backup(rows: DataFrame) -> DataFrame:
    """Newest record per directory: ``directory, ts, offset_json``."""
    return rows.groupBy("directory").agg(
        F.max("ts").alias("ts"), F.max_by("offset_json", "ts").alias("offset_json"))


_PROVIDERS: dict[str, Callable[..., OffsetBackup]] = {}


def register_backup(name: str, factory: Callable[..., OffsetBackup]) -> None:
    """Make a provider usable as ``offset.backup.provider=<name>``.

    ``factory(spark, cfg)`` returns an ``OffsetBackup``.
    """
    _PROVIDERS[name] = factory


register_backup("none", lambda spark, cfg: NoBackup())
register_backup(
    "log",
    lambda spark, cfg: LogBackup(
        spark, cfg.backup_path or os.path.join(shared_root(spark), "appendlog-offset-log")),
)
register_backup(
    "table",
    lambda spark, cfg: TableBackup(
        cfg.backup_path or os.path.join(shared_root(spark), "appendlog-offsets")),
)


def get_backup(spark: SparkSession, cfg) -> OffsetBackup:
    name = cfg.backup_provider
    factory = _PROVIDERS.get(name)
    if factory is None:
        raise AppendLogError(f"offset backup provider {name!r} is not registered")
    try:
        provider = factory(spark, cfg)
    except Exception as e:  # noqa: BLE001
        raise AppendLogError(f"offset backup provider {name!r} could not be created: {e}") from e
    if not isinstance(provider, OffsetBackup):
        raise AppendLogError(f"offset backup provider {name!r} could not be created: "
                             f"got {type(provider).__name__}, not an OffsetBackup")
    return provider


def parse_offset(end) -> dict | None:
    """A progress' end offset as a dict (a listener event has it as JSON, a
    query's own progress as a dict or a Python literal); None for others."""
    if isinstance(end, str):
        try:
            end = json.loads(end)
        except ValueError:
            try:
                end = ast.literal_eval(end)
            except (ValueError, SyntaxError):
                return None
    return end if isinstance(end, dict) else None


def _epoch_ms(ts: str) -> int:
    return int(datetime.fromisoformat(ts.replace("Z", "+00:00"))
               .astimezone(timezone.utc).timestamp() * 1000)


def stream_key(cfg) -> str:
    """The name under which a stream's offsets are kept."""
    return cfg.spec.path + (f"#{cfg.stream_name}" if cfg.stream_name else "")


class BackupListener(StreamingQueryListener):
    """Stores the end offset of each completed batch of one query.

    It is added before the query starts and keeps what arrives until ``bind``
    names the query, so the first batch is never missed.
    """

    def __init__(self, provider: OffsetBackup, directory: str, stream: str):
        self.provider = provider
        self.directory, self.stream = directory, stream
        self.query_id: str | None = None
        self.done = False
        self._early: list = []
        self._last: str | None = None
        self._lock = threading.Lock()

    def bind(self, query_id: str) -> None:
        with self._lock:
            self.query_id = str(query_id)
            early, self._early = self._early, []
        for p in early:
            self.save(p)

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        with self._lock:
            if self.query_id is None:
                self._early.append(event.progress)
                return
        self.save(event.progress)

    def save(self, progress) -> None:
        """Store the end offset of a finished batch (once)."""
        if progress is None or str(progress.id) != self.query_id:
            return
        for src in progress.sources:
            o = parse_offset(src.endOffset)
            if o is None or o.get("directory") != self.directory:
                continue
            end = json.dumps(o, sort_keys=True)
            with self._lock:
                if end != self._last:
                    self.provider.store(self.stream, _epoch_ms(progress.timestamp), end)
                    self._last = end

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        if self.query_id is not None and str(event.id) == self.query_id:
            self.close()

    def close(self) -> None:
        if not self.done:
            self.done = True
            self.provider.close()


def recover(spark: SparkSession, local: OffsetBackup, shared: OffsetBackup, stream: str) -> str | None:
    """The newer offset of two stores for ``stream`` (ties keep the local one).

    Pass it as ``initial.offset.json`` to a query with a **new** checkpoint.
    """
    from appendlog.operators.state import newer_of

    def rows(store):
        got = store.fetch(spark, stream)
        return spark.createDataFrame([] if got is None else [(stream, *got)], BACKUP_SCHEMA)

    row = newer_of(rows(local), rows(shared)).select("offset_json").first()
    return None if row is None else row[0]


def recover_by_node(spark: SparkSession, local: LogBackup, shared: LogBackup, stream: str) -> str | None:
    """The offset of two log backups of ``stream``, for each node from the store
    that is ahead there (``state.merge_by_node``); None if both are empty.

    Pass it as ``initial.offset.json`` to a query with a **new** checkpoint.
    """
    from appendlog.operators.state import merge_by_node

    logs = [log for log in (local.log(stream), shared.log(stream)) if log.version() >= 0]
    if not logs:
        return None
    offsets: dict[str, dict] = {}
    for r in merge_by_node(local.rows(spark, stream), shared.rows(spark, stream)).toLocalIterator():
        files = offsets.setdefault(r.node, {})
        if r.name:
            files[r.name] = {"offset": r.offset, "md5": r.md5 or ""}
    return json.dumps({"directory": logs[0].meta(logs[0].version())["directory"], "offsets": offsets}, sort_keys=True)
