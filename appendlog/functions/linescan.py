"""Split a byte range of a file into lines, as Arrow string arrays.

A range ``[range_start, range_end)`` is aligned to line ends.  It may be cut
into sub-ranges ``[lo, hi)`` read by different tasks: a sub-range owns the
lines that *start* in it, and its reader runs past ``hi`` to finish the last
one.  Memory per call is bounded by the chunk size plus the longest line.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from appendlog.functions.bytescan import _blocks, first_line_end, read_exact

CHUNK = 8 << 20


def _first_owned_start(fd: int, lo: int, hi: int, range_start: int, path: str) -> int:
    """First line start in ``[lo, hi)`` (lines start at range_start or after a
    newline); ``hi`` when no line starts there.  No byte past ``hi`` is read."""
    if lo <= range_start:
        return range_start
    e = first_line_end(fd, lo - 1, hi - 1, path)
    return hi if e is None else e


def _lines_array(buf: bytes) -> pa.Array:
    """``buf`` holds whole newline-terminated lines; return them without the
    newlines, as a ``large_string`` array over one compacted copy of ``buf``."""
    data = np.frombuffer(buf, dtype=np.uint8)
    nl = np.flatnonzero(data == 0x0A)
    n = len(nl)
    compact = data[data != 0x0A]
    offsets = np.empty(n + 1, dtype=np.int64)
    offsets[0] = 0
    offsets[1:] = nl - np.arange(n, dtype=np.int64)
    arr = pa.LargeStringArray.from_buffers(n, pa.py_buffer(offsets), pa.py_buffer(compact))
    try:
        arr.validate(full=True)
    except pa.ArrowInvalid:
        # invalid UTF-8: decode with the replacement character, line by line
        text = buf.decode("utf-8", errors="replace")
        arr = pa.array(text.split("\n")[:-1], type=pa.large_string())
    return arr


def iter_line_arrays(
    fd: int,
    lo: int,
    hi: int,
    range_start: int,
    range_end: int,
    path: str = "?",
    chunk: int = CHUNK,
):
    """Yield Arrow string arrays of the lines starting in ``[lo, hi)``."""
    hi = min(hi, range_end)
    pos = _first_owned_start(fd, lo, hi, range_start, path)
    carry: list[bytes] = []  # pieces of a line longer than one chunk
    while pos < hi:
        stop = min(hi, pos + chunk)
        block = read_exact(fd, pos, stop - pos, path)
        pos = stop
        cut = block.rfind(b"\n") + 1
        if cut:
            yield _lines_array(b"".join(carry) + block[:cut])
            carry = []
        if cut < len(block):
            carry.append(block[cut:])
    # the last line starts before hi and may end past it: small blocks up to its end
    sizes = _blocks()
    while carry and pos < range_end:
        stop = min(range_end, pos + next(sizes))
        block = read_exact(fd, pos, stop - pos, path)
        pos = stop
        cut = block.find(b"\n") + 1
        carry.append(block[:cut] if cut else block)
        if cut:
            yield _lines_array(b"".join(carry))
            return
    if carry:
        raise IOError(f"range of {path} does not end on a line boundary at {range_end}")
