"""Head checksum and newline alignment of planned range ends."""

from __future__ import annotations

import hashlib
import os

NL = 0x0A
FIRST_BLOCK = 4 << 10
MAX_BLOCK = 1 << 20


def read_exact(fd: int, offset: int, length: int, path: str = "?") -> bytes:
    """``length`` bytes at ``offset``; a short read is an error (file shrank)."""
    parts = []
    got = 0
    while got < length:
        b = os.pread(fd, length - got, offset + got)
        if not b:
            raise IOError(
                f"short read in {path}: range [{offset}, {offset + length}) "
                f"has only {got} bytes; the file shrank after planning"
            )
        parts.append(b)
        got += len(b)
    return b"".join(parts) if len(parts) != 1 else parts[0]


def head_md5(fd: int, size: int, sample: int, path: str = "?") -> str:
    """Lower-case hex MD5 of the first ``sample`` bytes; "" when the file is shorter."""
    if size < sample:
        return ""
    return hashlib.md5(read_exact(fd, 0, sample, path)).hexdigest()


def _blocks():
    """Block sizes for newline searches: small first (a line end is usually
    near), growing 4x up to 1 MiB, so long lines cost few reads."""
    size = FIRST_BLOCK
    while True:
        yield size
        size = min(size * 4, MAX_BLOCK)


def last_line_end(fd: int, lo: int, hi: int, path: str = "?") -> int | None:
    """One past the last newline in bytes [lo, hi), or None."""
    pos = hi
    sizes = _blocks()
    while pos > lo:
        start = max(lo, pos - next(sizes))
        block = read_exact(fd, start, pos - start, path)
        i = block.rfind(b"\n")
        if i >= 0:
            return start + i + 1
        pos = start
    return None


def first_line_end(fd: int, lo: int, hi: int, path: str = "?") -> int | None:
    """One past the first newline in bytes [lo, hi), or None."""
    pos = lo
    sizes = _blocks()
    while pos < hi:
        stop = min(hi, pos + next(sizes))
        block = read_exact(fd, pos, stop - pos, path)
        i = block.find(b"\n")
        if i >= 0:
            return pos + i + 1
        pos = stop
    return None


def aligned_end(fd: int, start: int, end: int, size: int, path: str = "?") -> int:
    """Move a planned end onto a line boundary so every line arrives once and whole.

    End becomes one past the last newline in ``(start, end]``.  If there is
    none and the cap stopped short of the file end, it extends to one past the
    next newline.  If there is none up to ``size`` the range is held at
    ``start`` (a half-written line is read once it is completed).
    """
    if end <= start:
        return start
    e = last_line_end(fd, start, end, path)
    if e is not None:
        return e
    if end < size:
        e = first_line_end(fd, end, size, path)
        if e is not None:
            return e
    return start


def tail_start(fd: int, size: int, path: str = "?") -> int:
    """Start position for ``latest``: one past the last newline of the file, or 0."""
    e = last_line_end(fd, 0, size, path)
    return 0 if e is None else e
