"""Best-fit packing of documents into fixed-length token sequences.

Bounded-space online best-fit: each task keeps at most ``open_bins`` unfinished
sequences, found through a bitset over free space (bit f is set while some open
bin has f free tokens).  A piece goes to the bin with the least sufficient free
space; where none fits, a new bin opens, and if that is one too many the
fullest closes first.  Pieces of one input batch arrive longest first.

A document's ids end with ``end_id``.  Only documents longer than ``size`` are
cut: the remainder comes first, then full pieces.  Each task packs the rows it
reads, so nothing is shuffled and the loss is at most its last bins.

Null texts are empty (one piece: the end id alone).  Repeated rows are packed
each; texts are encoded whole; an empty table gives no piece.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from appendlog.llm.tokenizers_io import ByteBpe
from appendlog.session import ship_package

SIZE = 2048
OPEN_BINS = 2048


class Packer:
    """Open bins of one task, keyed by free space."""

    def __init__(self, size: int = SIZE, open_bins: int = OPEN_BINS, first_id: int = 0):
        self.size, self.open_bins = size, open_bins
        self.free: list[list[int]] = [[] for _ in range(size + 1)]  # free space -> open bins
        self.bits = 0
        self.n_open = 0
        self.next_id = first_id

    def _put_back(self, bin_id: int, free: int) -> None:
        if free:
            self.free[free].append(bin_id)
            self.bits |= 1 << free
        else:
            self.n_open -= 1

    def _take(self, free: int) -> int:
        stack = self.free[free]
        bin_id = stack.pop()
        if not stack:
            self.bits &= ~(1 << free)
        return bin_id

    def place(self, length: int) -> tuple[int, int]:
        """Sequence and offset of a piece of ``length`` tokens."""
        fit = self.bits >> length
        if fit:
            free = length + (fit & -fit).bit_length() - 1
            bin_id = self._take(free)
        else:
            if length < self.size and self.n_open >= self.open_bins:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
                self.n_open -= 1
            bin_id, free = self.next_id, self.size
            self.next_id += 1
            self.n_open += 1
        self._put_back(bin_id, free - length)
        return bin_id, self.size - free


def piece_lengths(n: int, size: int = SIZE) -> list[int]:
    """Lengths of a document's pieces: the remainder first, then full ones."""
    full, rest = divmod(n, size)
    return ([rest] if rest else []) + [size] * full


def pack(df: DataFrame, json_path: str, ranks_path: str, key: str = "doc_id", text: str = "text",
         size: int = SIZE, end_id: int = 0, open_bins: int = OPEN_BINS) -> DataFrame:
    """One row per piece: its document, place in it, digest, sequence, offset."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        bpe = ByteBpe(json_path, ranks_path)
        packer = Packer(size, open_bins, TaskContext.get().partitionId() << 40)
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
        for b in batches:
            rows = []
            for doc, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                ids = bpe.encode(t.as_py() or "")
                ids.append(end_id)
                data, start = np.array(ids, "<u4"), 0
                for k, n in enumerate(piece_lengths(len(ids), size)):
                    rows.append((doc, k, start, n, zlib.crc32(data[start:start + n])))
                    start += n
            rows.sort(key=lambda r: -r[3])
            placed = [r + packer.place(r[3]) for r in rows]
            cols = list(zip(*placed, strict=True)) or [()] * 7
            kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

    return df.select(key, text).mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
