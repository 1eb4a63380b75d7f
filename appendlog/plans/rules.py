"""The decision table for one file, in plain Python.

The stream reader plans in its own process on the driver, which has no Spark
session, so the rules exist here as well as in ``planner`` (Columns).  A
parity test keeps both equal.

Inputs per (node, file): ``known`` (state offset or None), ``kmd5``, ``size``,
``md5`` (None when the file is not listed), ``node_listed``, ``first_run``
(state wholly empty), ``policy``, ``cap`` and ``check``.  First match wins.

| # | condition | status | start | end (before alignment) |
| 1 | file not listed, node listed | deleted | - | - (dropped) |
| 2 | neither file nor node listed (or the file's head not readable) | carried | known | known |
| 3 | new, first run, earliest | new | 0 | min(cap, size) |
| 4 | new, first run, latest | new | size | size (tail start) |
| 5 | new, later run | new | 0 | 0 |
| 6 | check on, kmd5 != "", kmd5 != md5 | replaced | 0 | 0 |
| 7 | known > size | truncated | 0 | 0 |
| 8 | known == size | unchanged | known | known |
| 9 | otherwise | appended | known | min(known + cap, size) |
"""

from __future__ import annotations

from typing import NamedTuple

# File status labels.
DELETED, CARRIED, NEW, REPLACED, TRUNCATED, UNCHANGED, APPENDED = (
    "deleted", "carried", "new", "replaced", "truncated", "unchanged", "appended",
)

# how the end is aligned to a line boundary
ALIGN_NONE, ALIGN_RANGE, ALIGN_TAIL = 0, 1, 2


class Decision(NamedTuple):
    status: str
    start: int | None
    end: int | None
    md5: str | None
    align: int


def decide(
    known: int | None,
    kmd5: str | None,
    size: int | None,
    md5: str | None,
    *,
    node_listed: bool,
    first_run: bool,
    policy: str,
    cap: int,
    check: bool,
) -> Decision:
    if size is None and not node_listed:  # a listed file proves that its node is listed
        return Decision(CARRIED, known, known, kmd5, ALIGN_NONE)
    if size is None:
        return Decision(DELETED, None, None, None, ALIGN_NONE)
    if known is None:
        if first_run and policy == "earliest":
            return Decision(NEW, 0, min(cap, size), md5, ALIGN_RANGE)
        if first_run and policy == "latest":
            return Decision(NEW, size, size, md5, ALIGN_TAIL)
        return Decision(NEW, 0, 0, md5, ALIGN_NONE)
    if check and kmd5 and kmd5 != md5:
        return Decision(REPLACED, 0, 0, md5, ALIGN_NONE)
    if known > size:
        return Decision(TRUNCATED, 0, 0, md5, ALIGN_NONE)
    if known == size:
        return Decision(UNCHANGED, known, known, md5, ALIGN_NONE)
    return Decision(APPENDED, known, min(known + cap, size), md5, ALIGN_RANGE)
