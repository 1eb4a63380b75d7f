"""Fill-in-middle transformation by content-defined chunk memoization.

A text's UTF-8 bytes are cut into chunks where a rolling hash of the last
``WINDOW`` bytes says so, so equal passages of different documents fall into
equal chunks.  A memory of bounded bytes, keyed by the chunk's whole content (a
hit is a content match, never a hash match alone), holds each chunk's boundary
summary: characters, line ends and their places, whether a marker lies inside,
and its first and last bytes.  A document combines the summaries of its chunks:
running counts of line ends locate the chunk that holds a cut, whose stored
places give the cut itself, running counts of characters give its length, and
the edges of neighbouring chunks show a marker that two chunks share.

Defined results: a null or empty text is ``plain`` with 0 units; a null key is
drawn as the empty string; repeated rows are separate rows with equal results;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from appendlog.session import ship_package

# The markers and the forms.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"

#: Bytes that the rolling hash looks back on (a power of two, at most 32).
WINDOW = 16
#: A chunk ends where this many low bits of the hash are zero, but not before
#: ``LEAST`` bytes and at ``MOST`` bytes at the latest.
BITS, LEAST, MOST = 9, 128, 4096
#: Bytes hashed at once, and bytes of chunks remembered per Python worker.
BLOCK, MEMORY = 1 << 20, 32 << 20

_MULTIPLIER = np.uint32(0x9E3779B1)
_MIXED = (np.arange(1, 257, dtype=np.uint32) * _MULTIPLIER) ^ (np.arange(1, 257, dtype=np.uint32) << np.uint32(13))
_MIXED = _MIXED * _MULTIPLIER


def rolling(data: np.ndarray) -> np.ndarray:
    """Hash of the last ``WINDOW`` bytes at each byte (fewer at the beginning):
    the mixed bytes, each multiplied once more per step it lies back."""
    h, width, power = _MIXED[data], 1, int(_MULTIPLIER)
    while width < WINDOW:
        if len(h) > width:
            h[width:] = h[width:] + h[:-width] * np.uint32(power)
        width, power = 2 * width, power * power & 0xFFFFFFFF
    return h


def chunk_ends(raw: bytes) -> list[int]:
    """Ends of the chunks of ``raw``; all lie between characters."""
    data = np.frombuffer(raw, np.uint8)
    wanted = []
    for at in range(0, len(data), BLOCK):
        back = min(at, WINDOW - 1)
        h = rolling(data[at - back:at + BLOCK])[back:]
        # the bits above the lowest ones are mixed best
        wanted.append(np.flatnonzero((h >> np.uint32(32 - BITS)) == 0) + (at + 1))
    ends, last = [], 0
    for e in (np.concatenate(wanted).tolist() if wanted else []) + [len(raw)]:
        while e - last > MOST:
            last = _between(raw, last + MOST)
            ends.append(last)
        if e - last >= LEAST or e == len(raw):
            e = _between(raw, e)
            if e > last:
                ends.append(e)
                last = e
    return ends


def _between(raw: bytes, at: int) -> int:
    """The first place from ``at`` on that is not inside a character."""
    while at < len(raw) and raw[at] & 0xC0 == 0x80:
        at += 1
    return at


class Summary(NamedTuple):
    """Boundary summary of a chunk."""

    chars: int
    lines: list[int]  # one past each line end, in bytes from the chunk's start
    marked: bool
    head: bytes
    tail: bytes


_MARKS = tuple(m.encode() for m in (PREFIX, SUFFIX, MIDDLE))
_EDGE = len(_MARKS[0]) - 1


def summarize(chunk: bytes) -> Summary:
    """The summary of one chunk, from its bytes."""
    lines, at = [], chunk.find(b"\n")
    while at >= 0:
        lines.append(at + 1)
        at = chunk.find(b"\n", at + 1)
    return Summary(len(chunk.decode()), lines, any(m in chunk for m in _MARKS), chunk[:_EDGE], chunk[-_EDGE:])


class Memory:
    """Summaries by chunk content, of at most ``limit`` bytes of chunks."""

    def __init__(self, limit: int = MEMORY):
        self.limit, self.held, self.known = limit, 0, {}
        self.asked = self.met = 0

    def get(self, chunk: bytes) -> Summary:
        self.asked += 1
        s = self.known.get(chunk)
        if s is not None:
            self.met += 1
            return s
        if self.held > self.limit:
            self.known.clear()
            self.held = 0
        s = self.known[chunk] = summarize(chunk)
        self.held += len(chunk)
        return s


class Parts(NamedTuple):
    """How a text is rearranged: number of units, form, character counts of
    prefix and middle (None if plain), and the output."""

    n: int
    form: str
    prefix_chars: int | None
    middle_chars: int | None
    output: bytes


def draws(key: int | None) -> tuple[int, int, int, int]:
    """The four numbers drawn for a document."""
    h = hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()
    return tuple(int(h[i:i + 8], 16) for i in range(0, 32, 8))


class Document:
    """A text as the running counts of its chunks."""

    def __init__(self, raw: bytes, memory: Memory):
        self.raw, self.ends = raw, chunk_ends(raw)
        self.parts, at = [], 0
        for e in self.ends:
            self.parts.append(memory.get(raw[at:e]))
            at = e
        self.lines = np.cumsum([0] + [len(s.lines) for s in self.parts])
        self.chars = np.cumsum([0] + [s.chars for s in self.parts])
        self.marked = any(s.marked for s in self.parts) or any(
            m in a.tail + b.head for a, b in zip(self.parts, self.parts[1:]) for m in _MARKS)
        #: units: line ends, and a last line without one
        self.n = int(self.lines[-1]) + (len(raw) > 0 and not raw.endswith(b"\n"))

    def cut(self, units: int) -> tuple[int, int]:
        """(bytes, characters) that the first ``units`` units hold."""
        if units == 0:
            return 0, 0
        if units > self.lines[-1]:
            return len(self.raw), int(self.chars[-1])
        i = int(np.searchsorted(self.lines, units)) - 1
        start = self.ends[i - 1] if i else 0
        at = start + self.parts[i].lines[units - 1 - int(self.lines[i])]
        return at, int(self.chars[i]) + len(self.raw[start:at].decode())


def transform(key: int | None, text: str | None, memory: Memory, percent: int = 100, spm_percent: int = 50) -> Parts:
    """Rearrange one text: ``percent`` of the documents, ``spm_percent`` of those suffix first."""
    raw = (text or "").encode()
    doc = Document(raw, memory)
    h1, h2, h3, h4 = draws(key)
    if not raw or doc.marked or h3 % 100 >= percent:
        return Parts(doc.n, PLAIN, None, None, raw)
    a, b = h1 % (doc.n + 1), h2 % (doc.n + 1)
    (p, p_chars), (m, m_chars) = doc.cut(min(a, b)), doc.cut(max(a, b))
    prefix, middle, suffix = raw[:p], raw[p:m], raw[m:]
    pre, suf, mid = _MARKS
    if h4 % 100 < spm_percent:
        return Parts(doc.n, SPM, p_chars, m_chars - p_chars, suf + suffix + pre + prefix + mid + middle)
    return Parts(doc.n, PSM, p_chars, m_chars - p_chars, pre + prefix + suf + suffix + mid + middle)


def restore(output: str, form: str) -> str:
    """The text of a transformed output (no part holds a marker)."""
    if form == PLAIN:
        return output
    first, second = (PREFIX, SUFFIX) if form == PSM else (SUFFIX, PREFIX)
    head, middle = output[len(first):].split(MIDDLE)
    one, two = head.split(second)
    return one + middle + two if form == PSM else two + middle + one


_SHARED: list[Memory] = []


def shared_memory() -> Memory:
    """The Python worker's one memory (tasks refer to it by name: what a task's
    function holds itself is copied into every task)."""
    if not _SHARED:
        _SHARED.append(Memory())
    return _SHARED[0]


SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def fill_in_middle(df: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 100,
                   spm_percent: int = 50) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of each row."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = shared_memory()
        for b in batches:
            keys = b.column(0).to_pylist()
            done = [transform(k, t.as_py(), memory, percent, spm_percent)
                    for k, t in zip(keys, b.column(1), strict=True)]
            n, form, p, m, out = zip(*done) if done else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(n, pa.int64()), pa.array(form, pa.string()),
                 pa.array(p, pa.int64()), pa.array(m, pa.int64()),
                 pa.array(out, pa.large_binary()).cast(pa.large_string()).cast(pa.string())],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return df.select(key, text).mapInArrow(run, SCHEMA)


def restored(df: DataFrame, out: str = "text") -> DataFrame:
    """``df`` (columns ``form`` and ``output``) with the rebuilt text as ``out``,
    by built-in functions: no part holds a marker, so the markers cut the parts."""
    p = F.split("output", "<[PSM]>", -1)
    return df.withColumn(out, F.when(F.col("form") == PLAIN, F.col("output"))
                         .when(F.col("form") == PSM, F.concat(F.get(p, 1), F.get(p, 3), F.get(p, 2)))
                         .otherwise(F.concat(F.get(p, 2), F.get(p, 3), F.get(p, 1))))
