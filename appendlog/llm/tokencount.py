"""Token counts: batch encoding in Arrow functions that return lengths only.

Texts are cut at safe boundaries (see ``Counter``), the pieces of many texts
are gathered until a batch holds ``batch_bytes`` bytes, and each batch encodes
its distinct pieces once.  So a batch's work is bounded by bytes, not by rows:
a very long text fills several batches, many short ones share one.

Null texts count as empty: 0 bytes, 0 tokens.  Rows stay as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from appendlog.llm.tokenizers_io import library, special_strings
from appendlog.session import ship_package

#: Bytes of text per encoding batch, and pieces remembered per Python worker.
BATCH_BYTES = 1 << 20
MEMORY = 400_000

# The Unicode White_Space characters.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


class Counter:
    """Counts tokens of a vocabulary that drops white space and never joins
    across it.

    Safe boundaries: every white-space run, and the place between a run of
    ASCII or Latin letters and a following ``.``, ``,`` or ``!`` (letters and
    symbols are separate pre-tokens, and these three combine with nothing).
    """

    _PIECES = re.compile(rf"[A-Za-zÀ-ÖØ-öø-ÿ]+(?=[.,!])|[^{WHITE}]+")
    _PLAIN = re.compile(r"[a-z]+")

    def __init__(self, path: str):
        self.lib = library(path)
        self.special = special_strings(path)
        self.memory: dict[str, int] = {}

    def pieces(self, text: str) -> list[str]:
        return self._PIECES.findall(text)

    def learn(self, pieces: set[str]) -> None:
        """Encode the pieces not met before, as one batch."""
        if len(self.memory) > MEMORY:
            self.memory.clear()
        new = [p for p in pieces if p not in self.memory]
        # a run of a-z is one pre-token that no normalizer changes
        plain = [p for p in new if self._PLAIN.fullmatch(p)]
        self.memory.update((p, len(self.lib.model.tokenize(p))) for p in plain)
        rest = [p for p in new if p not in self.memory]
        for p, e in zip(rest, self.lib.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            self.memory[p] = len(e)

    def count(self, texts: list[str]) -> list[int]:
        cut = [self.pieces(t) for t in texts]
        self.learn(set().union(*cut))
        get = self.memory.__getitem__
        return [sum(map(get, p)) for p in cut]


_COUNTERS: dict[str, Counter] = {}


def _segments(text: str, limit: int) -> Iterator[str]:
    """``text`` cut after white space into parts of about ``limit`` characters."""
    at = 0
    space = re.compile(f"[{WHITE}]")
    while len(text) - at > limit:
        m = space.search(text, at + limit)
        if m is None:
            break
        yield text[at:m.end()]
        at = m.end()
    yield text[at:]


def counts(texts: list[str], path: str, batch_bytes: int = BATCH_BYTES) -> list[int]:
    """Tokens of each text, encoded in batches of bounded bytes."""
    counter = _COUNTERS.setdefault(path, Counter(path))
    totals = [0] * len(texts)
    owners, parts, held = [], [], 0

    def flush() -> None:
        nonlocal held
        for i, n in zip(owners, counter.count(parts), strict=True):
            totals[i] += n
        owners.clear()
        parts.clear()
        held = 0

    for i, text in enumerate(texts):
        for part in _segments(text, batch_bytes):
            owners.append(i)
            parts.append(part)
            held += len(part)
            if held >= batch_bytes:
                flush()
    if parts:
        flush()
    return totals


def count_tokens(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: int = 2048) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of each row."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            n = counts(texts, path)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(n, pa.int64()),
                 pa.array([x > limit for x in n])], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return df.select(key, text).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
