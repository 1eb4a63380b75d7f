"""Pure-Python drivers of the stream's planner and reader (no Spark)."""

from __future__ import annotations

import os

from appendlog.sources.options import ReadConfig
from appendlog.streaming.source import Planner, empty_offset, partitions_between, read_range


def cfg(path, **opts) -> ReadConfig:
    return ReadConfig.from_options({"path": path, **{k: str(v) for k, v in opts.items()}})


class Tail:
    """Plans and reads batches like the stream does, in one process."""

    def __init__(self, c: ReadConfig, start: dict | None = None):
        self.cfg = c
        self.planner = Planner(c)
        self.pos = start or empty_offset(c.spec.directory)

    def batch(self) -> list[str]:
        end = self.planner.plan(self.pos)
        rows = []
        for part in partitions_between(self.cfg, self.pos, end):
            for p in part.pieces:
                for b in read_range(p):
                    rows += b.column(0).to_pylist()
        self.pos = end
        return rows

    def drain(self, limit: int = 10_000) -> list[str]:
        out = []
        for _ in range(limit):
            before = self.pos
            out += self.batch()
            if self.pos == before:
                return out
        raise AssertionError("did not settle")

    def offset(self, name: str, node: str = "local") -> int | None:
        fo = self.pos["offsets"].get(node, {}).get(name)
        return None if fo is None else fo["offset"]


def write(path: str, data: bytes, mode: str = "wb") -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, mode) as f:
        f.write(data)
