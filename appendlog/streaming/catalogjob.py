"""The Spark side of a manifest stream: a thread that advances the manifest.

A Python source plans in a process without a session, so with
``catalog=manifest`` the driver application runs the listing and planning as
Spark jobs here, one step at a time, and the source only learns the newest version.
The thread stays at most ``AHEAD`` versions before the batches that the query
has completed, and lets go of versions that it needs no more.
"""

from __future__ import annotations

import logging
import threading

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from appendlog.operators.manifest import advance, expire
from appendlog.operators.runlog import CommitConflict, RunLog
from appendlog.sources.options import ReadConfig
from appendlog.streaming.backup import parse_offset

AHEAD = 4  # versions planned before the query has read them
KEEP = 16  # versions kept behind the last completed batch
EXPIRE_EVERY = 16
TRIES = 3  # failures in a row that end the stream


class CatalogThread(threading.Thread):
    """Advances ``log`` every ``interval`` seconds until stopped (or, with a
    ``target``, until that end is reached)."""

    def __init__(self, spark: SparkSession, cfg: ReadConfig, log: RunLog, interval: float, target=None):
        super().__init__(name="appendlog-catalog", daemon=True)
        self.spark, self.cfg, self.log, self.interval, self.target = spark, cfg, log, interval, target
        self.query: StreamingQuery | None = None
        self.error: BaseException | None = None
        self.idle = 0  # steps that found nothing to move
        self._halt = threading.Event()
        self._turn = threading.Condition()

    def done_version(self) -> int:
        """Version of the last batch that the query completed."""
        progress = self.query.lastProgress if self.query is not None else None
        if progress is None or not progress.sources:
            return -1
        o = parse_offset(progress.sources[0].endOffset)
        return int(o["version"]) if o and "version" in o else -1

    def run(self) -> None:
        failures = steps = 0
        while not self._halt.is_set():
            wait = 0.0
            try:
                done = self.done_version()
                if self.query is not None and self.log.version() - done >= AHEAD:
                    wait = 0.05
                elif advance(self.spark, self.cfg, self.log, self.target) is None:
                    with self._turn:
                        self.idle += 1
                        self._turn.notify_all()
                    wait = self.interval
                else:
                    steps += 1
                    if steps % EXPIRE_EVERY == 0 and done >= 0:
                        expire(self.log, self.log.version() - done + KEEP)
                failures = 0
            except CommitConflict as e:  # another application writes this manifest
                return self._fail(e)
            except Exception as e:  # noqa: BLE001
                failures += 1
                logging.getLogger("appendlog").warning("the catalog step failed (%d of %d): %s", failures, TRIES, e)
                if failures >= TRIES:
                    return self._fail(e)
                wait = self.interval or 0.1
            self._halt.wait(wait)

    def _fail(self, e: BaseException) -> None:
        self.error = e
        with self._turn:
            self._turn.notify_all()
        if self.query is not None:
            self.query.stop()

    def settle(self) -> None:
        """Block until a step that began after this call has found nothing to move."""
        with self._turn:
            goal = self.idle + 2  # the step under way may have begun before
            while self.idle < goal and self.error is None and self.is_alive():
                self._turn.wait(0.2)
                if self.query is not None and not self.query.isActive:
                    break
        if self.error is not None:
            raise self.error

    def stop(self) -> None:
        self._halt.set()
        if threading.current_thread() is not self and self.is_alive():
            self.join()
