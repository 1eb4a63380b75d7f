"""Versioned rows by key, kept as sorted runs (S4, T9, T10).

A ``RunLog`` is a small log-structured table for state that has one row per
file and changes a little at a time.  A commit writes the changed rows only, as
one run sorted by key (Parquet, by Spark's writer), and then makes its version
visible by creating one small file exclusively, so

* a version is there as a whole or not at all, whatever dies in between;
* two writers that started from one version can't both commit the next;
* readers learn the newest version from a file name, without any row.

``FANOUT`` runs of a level merge into one of the next, so a row is rewritten
once per level and a read meets a few dozen runs at most.  A key that is gone
leaves a tombstone.  It is dropped when its run merges with the oldest rows and
no version from before it is kept any more.

Layout under ``path``::

    runs/<name>/        rows of one run: keys, values, gone, version
    versions/<n>.json   the live runs of version n, and the caller's ``meta``
"""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from appendlog.session import posix_path
from appendlog.sources.pathspec import AppendLogError

FANOUT = 8  # runs of one level that merge into one of the next
ROWS_PER_FILE = 1 << 20  # rows of a merged run that one task writes (about)


class CommitConflict(AppendLogError):
    """Another writer has committed the version that this one was to become."""


@dataclass(frozen=True)
class Run:
    name: str
    level: int
    rows: int
    low: int  # versions of its rows, both ends included
    high: int


class RunLog:
    """Rows ``keys, values`` by version, on mounted shared storage."""

    def __init__(self, path: str, keys: list[str], values: str, fanout: int = FANOUT):
        """``values``: the value columns as DDL; all keys are strings."""
        self.path = posix_path(path).rstrip("/")
        self.keys, self.fanout = list(keys), fanout
        self.ddl = ", ".join([f"{k} string" for k in keys] + [values])
        self.run_ddl = f"{self.ddl}, gone boolean, version bigint"

    # --- versions (a file each; nothing here reads a row) ---

    def _version_file(self, version: int) -> str:
        return os.path.join(self.path, "versions", f"{version:020d}.json")

    def versions(self) -> list[int]:
        """Versions that are kept, ascending."""
        try:
            names = os.listdir(os.path.join(self.path, "versions"))
        except FileNotFoundError:
            return []
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def version(self) -> int:
        """The newest version, -1 before the first commit."""
        return max(self.versions(), default=-1)

    def has(self, version: int) -> bool:
        return os.path.exists(self._version_file(version))

    def _load(self, version: int) -> dict:
        try:
            with open(self._version_file(version), encoding="utf-8") as f:
                return json.load(f)
        except FileNotFoundError:
            raise AppendLogError(f"{self.path} has no version {version}") from None

    def meta(self, version: int) -> dict:
        """What the caller committed with a version."""
        return self._load(version)["meta"]

    def runs(self, version: int) -> list[Run]:
        return [Run(**r) for r in self._load(version)["runs"]] if version >= 0 else []

    # --- reading ---

    def _read(self, spark: SparkSession, runs: list[Run]) -> DataFrame:
        if not runs:
            return spark.createDataFrame([], self.run_ddl)
        return spark.read.schema(self.run_ddl).parquet(*[os.path.join(self.path, "runs", r.name) for r in runs])

    def _newest(self, rows: DataFrame, runs: list[Run]) -> DataFrame:
        """The newest row of each key (a single run has one row per key)."""
        if len(runs) <= 1:
            return rows
        values = [c for c in rows.columns if c not in self.keys]
        best = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*values), "version").alias("_r"))
        return best.select(*self.keys, *[F.col(f"_r.{c}").alias(c) for c in values])

    def rows(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """Keys and values as of ``version`` (the newest by default)."""
        runs = self.runs(self.version() if version is None else version)
        newest = self._newest(self._read(spark, runs), runs)
        return newest.where("not gone").drop("gone", "version")

    def stamped(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """The same with ``gone`` and the ``version`` that each row is from
        (tombstones included, as far as they are still kept)."""
        runs = self.runs(self.version() if version is None else version)
        return self._newest(self._read(spark, runs), runs)

    def changes(self, spark: SparkSession, after: int, upto: int | None = None) -> DataFrame:
        """Rows (``gone`` and ``version`` included) whose newest entry as of
        ``upto`` is later than ``after``; runs without such rows are not opened."""
        runs = [r for r in self.runs(self.version() if upto is None else upto) if r.high > after]
        return self._newest(self._read(spark, runs), runs).where(F.col("version") > after)

    # --- writing ---

    def _write(self, rows: DataFrame, level: int, n: int, low: int, high: int) -> Run:
        name = f"{low:020d}-{high:020d}-{uuid.uuid4().hex[:12]}"
        order = [F.col(k) for k in self.keys]
        files = max(1, -(-n // ROWS_PER_FILE))
        dealt = rows.coalesce(1) if files == 1 else rows.repartitionByRange(files, *order)
        dealt.sortWithinPartitions(*order).write.parquet(os.path.join(self.path, "runs", name))
        return Run(name, level, n, low, high)

    def commit(self, spark: SparkSession, delta: DataFrame, n: int, meta: dict | None = None,
               base: int | None = None) -> int:
        """Commit ``delta`` (keys, values, ``gone``; one row per key; ``n`` rows)
        on top of version ``base`` (the newest by default) and return the new
        version.  A conflicting commit raises ``CommitConflict`` and leaves no trace
        but an unreferenced run."""
        base = self.version() if base is None else base
        new = base + 1
        runs = self.runs(base)
        if n:
            columns = [c.split()[0] for c in self.ddl.split(", ")]
            stamped = delta.select(*columns, "gone", F.lit(new).cast("bigint").alias("version"))
            runs = self._merged(spark, runs + [self._write(stamped, 0, n, new, new)])
        self._publish(new, runs, meta or {})
        return new

    def sync(self, spark: SparkSession, rows: DataFrame, meta: dict | None = None, base: int | None = None) -> int:
        """Commit what makes the log's rows equal to ``rows`` (keys, values; one
        row per key): changed, new and missing keys only."""
        from appendlog.session import materialize, unpin  # not for the source's own process

        base = self.version() if base is None else base
        values = [c.split()[0] for c in self.ddl.split(", ")][len(self.keys):]
        new = rows.select(*self.keys, F.struct(*values).alias("_new"))
        old = self.rows(spark, base).select(*self.keys, F.struct(*values).alias("_old"))
        delta = new.join(old, self.keys, "full_outer").where(~F.col("_new").eqNullSafe(F.col("_old")))
        delta, n = materialize(delta.select(*self.keys, *[F.col(f"_new.{c}").alias(c) for c in values], F.col("_new").isNull().alias("gone")))
        version = self.commit(spark, delta, n, meta, base)
        unpin(delta)
        return version

    def _merged(self, spark: SparkSession, runs: list[Run]) -> list[Run]:
        """``runs`` (oldest first) with every full level merged into the next."""
        while True:
            by_level: dict[int, list[Run]] = {}
            for r in runs:
                by_level.setdefault(r.level, []).append(r)
            full = next((k for k in sorted(by_level) if len(by_level[k]) >= self.fanout), None)
            if full is None:
                return runs
            merged = self._merge(spark, by_level[full], full + 1, oldest=by_level[full][0] is runs[0])
            at = runs.index(by_level[full][0])
            runs = [r for r in runs if r.level != full]
            runs[at:at] = [merged] if merged.rows else []

    def _merge(self, spark: SparkSession, runs: list[Run], level: int, oldest: bool) -> Run:
        rows = self._newest(self._read(spark, runs), runs)
        if oldest:  # nothing older that a tombstone could hide, but changes since older versions name it
            rows = rows.where(~F.col("gone") | (F.col("version") > min(self.versions(), default=-1)))
        run = self._write(rows, level, sum(r.rows for r in runs), runs[0].low, runs[-1].high)
        n = self._read(spark, [run]).count()  # from the files' footers
        return Run(run.name, level, n, run.low, run.high)

    def _publish(self, version: int, runs: list[Run], meta: dict) -> None:
        folder = os.path.join(self.path, "versions")
        os.makedirs(folder, exist_ok=True)
        tmp = os.path.join(folder, f".{version}-{uuid.uuid4().hex[:12]}")
        with open(tmp, "w", encoding="utf-8") as f:
            json.dump({"version": version, "runs": [asdict(r) for r in runs], "meta": meta}, f)
            f.flush()
            os.fsync(f.fileno())
        try:
            os.link(tmp, self._version_file(version))  # fails where the version exists
        except FileExistsError:
            raise CommitConflict(f"version {version} of {self.path} was committed by another writer") from None
        finally:
            os.unlink(tmp)

    def compact(self, spark: SparkSession, meta: dict | None = None) -> int:
        """Commit a version of one run that holds every live row (a snapshot)."""
        base = self.version()
        runs = self.runs(base)
        if len(runs) <= 1:
            return base
        merged = self._merge(spark, runs, max(r.level for r in runs), oldest=True)
        self._publish(base + 1, [merged] if merged.rows else [], self.meta(base) if meta is None else meta)
        return base + 1

    def expire(self, keep: int) -> int:
        """Forget all versions but the newest ``keep`` and the runs that only
        they use (runs of commits that never became visible too, unless they could
        belong to the next version); returns the number of runs removed."""
        import shutil

        kept = self.versions()
        for v in kept[:-keep]:
            os.unlink(self._version_file(v))
        kept = kept[-keep:]
        used = {r.name for v in kept for r in self.runs(v)}
        newest = kept[-1] if kept else -1
        removed = 0
        folder = os.path.join(self.path, "runs")
        for name in os.listdir(folder) if os.path.isdir(folder) else []:
            if name not in used and int(name.split("-")[1]) <= newest:
                shutil.rmtree(os.path.join(folder, name), ignore_errors=True)
                removed += 1
        return removed
