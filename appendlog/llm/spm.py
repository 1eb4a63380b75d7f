"""SentencePiece merge-type vocabularies: encoding and decoding.

Encoding keeps a score-ordered agenda (a heap) of adjacent symbol pairs whose
concatenation is a piece: the best-scored pair (leftmost among equals) merges,
its new neighbours enter the agenda, and entries whose symbols have changed are
skipped.  Symbols outside the vocabulary become their UTF-8 byte pieces.

A text is first cut where no piece of the vocabulary can reach across (before a
space mark that follows another character, and around characters that no piece
joins), so equal segments share one encoding.  In each Arrow batch every new
segment is checked against the sentencepiece library, and one that differs
takes the library's ids.

Null texts count as empty: no ids, empty decoding.  Any length, whole.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from appendlog.session import ship_package

#: Segments remembered per Python worker (up to twice as many).
MEMORY = 250_000
MARK = "▁"
#: Symbols up to which a segment's agenda is scanned instead of kept as a heap.
SHORT = 48


class Pieces:
    """One merge-type model: agenda encoder, decoder and their memory."""

    def __init__(self, path: str):
        import sentencepiece

        self.lib = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.lib.get_piece_size()
        special = [i for i in range(n) if self.lib.is_byte(i) or self.lib.is_control(i)
                   or self.lib.is_unknown(i) or self.lib.is_unused(i)]
        out = set(special)
        self.ids = {self.lib.id_to_piece(i): i for i in range(n) if i not in out}
        self.cost = {p: -self.lib.get_score(i) for p, i in self.ids.items()}
        self.bytes_of = [b""] * n
        for p, i in self.ids.items():
            self.bytes_of[i] = p.replace(MARK, " ").encode()
        self.byte = {int(self.lib.id_to_piece(i)[3:5], 16): i for i in special if self.lib.is_byte(i)}
        for v, i in self.byte.items():
            self.bytes_of[i] = bytes([v])
        self.unknown = self.lib.unk_id()
        self.bytes_of[self.unknown] = " \u2047 ".encode()
        pairs = {a + b for p in self.ids for a, b in zip(p, p[1:])}
        # a line feed that no piece joins to anything stands alone, and so begins a segment
        # a run of letters and digits ends before punctuation that no piece joins to
        # one (a few odd ones, such as a raised two, are not taken for such runs)
        loose = not any("\n" in x for x in pairs)
        joins = {c: {x[0] for x in pairs if x[1] == c and x[0].isalnum()} for c in ".,!?;:%$#&*|"}
        ends = re.escape("".join(c for c, before in joins.items() if len(before) < 4))
        odd = re.escape("".join(sorted(set().union(*[b for b in joins.values() if len(b) < 4]))))
        head = f"{MARK}*[^\\W_{odd}]+(?=[{ends}])|" if ends and loose else ""
        self.cut = re.compile(f"{head}{MARK}*[^{MARK}\n]+|\n|{MARK}+" if loose else f"{MARK}*[^{MARK}]+|{MARK}+")
        self.spaced = any(MARK in p.lstrip(MARK) for p in self.ids)
        # segment -> number of ids, ids as text, bytes; the older half is looked
        # up again before it is forgotten, so frequent segments stay
        self.memory: dict[str, tuple[int, str, bytes]] = {}
        self.older: dict[str, tuple[int, str, bytes]] = {}
        self.differed = 0

    def agenda(self, text: str) -> list[int]:
        """Ids of a segment (spaces already marks) by best-pair merging."""
        cost = self.cost.get
        sym: list[str] = list(text)
        n = len(sym)
        if n <= SHORT:
            return self._ids(self._merged(sym))
        prev, nxt = list(range(-1, n - 1)), [*range(1, n), -1] if n else []
        heap = []
        for i, p in enumerate(map("".join, zip(sym, sym[1:]))):
            c = cost(p)
            if c is not None:
                heap.append((c, i, i + 1, p))
        heapq.heapify(heap)
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            _, i, j, p = pop(heap)
            left = sym[i]
            if not left or nxt[i] != j or left + sym[j] != p:
                continue
            sym[i], sym[j] = p, ""
            k = nxt[i] = nxt[j]
            if k >= 0:
                prev[k] = i
                q = p + sym[k]
                c = cost(q)
                if c is not None:
                    push(heap, (c, i, k, q))
            h = prev[i]
            if h >= 0:
                q = sym[h] + p
                c = cost(q)
                if c is not None:
                    push(heap, (c, h, i, q))
        return self._ids([s for s in sym if s])

    def _merged(self, sym: list[str]) -> list[str]:
        """The same for a short segment: its agenda is the list of pair costs."""
        cost, never = self.cost.get, float("inf")
        agenda = [cost(p, never) for p in map("".join, zip(sym, sym[1:]))]
        while agenda:
            best = min(agenda)
            if best == never:
                break
            i = agenda.index(best)
            p = sym[i] + sym[i + 1]
            sym[i:i + 2] = [p]
            del agenda[i]
            if i < len(agenda):
                agenda[i] = cost(p + sym[i + 1], never)
            if i:
                agenda[i - 1] = cost(sym[i - 1] + p, never)
        return sym

    def _ids(self, symbols: list[str]) -> list[int]:
        out: list[int] = []
        for s in symbols:
            i = self.ids.get(s)
            if i is not None:
                out.append(i)
            elif self.byte:
                out.extend(self.byte[b] for b in s.encode())
            else:
                out.append(self.unknown)
        return out

    def raw(self, ids: list[int]) -> bytes:
        """Bytes that the ids stand for, marks as spaces."""
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def segments(self, text: str) -> list[str]:
        marked = MARK + text.replace(" ", MARK)
        return [marked] if self.spaced else self.cut.findall(marked)

    def learn(self, segments: set[str]) -> None:
        """Encode the segments not met before and check them, as one batch.

        The library adds a mark in front of its input, so segments that begin
        with one are given without it; others are checked behind a line feed
        (which the cut above proves to join with nothing).
        """
        if len(self.memory) > MEMORY:
            self.older, self.memory = self.memory, {}
        new = []
        for s in segments.difference(self.memory):
            got = self.older.get(s)
            if got is None:
                new.append(s)
            else:
                self.memory[s] = got
        whole = [s[1:] if s[0] == MARK else "\n" + s for s in new]
        want = self.lib.encode([w.replace(MARK, " ") for w in whole], num_threads=1) if new else []
        lead = self.lib.encode("\n")
        for s, ids in zip(new, want, strict=True):
            if s[0] != MARK:
                ids = ids[len(lead):]
            own = self.agenda(s)
            if own != ids and s != MARK:  # the library adds no mark to an empty text
                self.differed += 1
                own = ids
            self.memory[s] = (len(own), ",".join(map(str, own)), self.raw(own))

    def encode(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """Number of ids, ids as comma-joined text, and decoding of each text."""
        cut = [self.segments(t) if t else [] for t in texts]
        self.learn(set().union(*cut))
        get, out = self.memory.__getitem__, []
        for segs in cut:
            n, ids, data = zip(*map(get, segs)) if segs else ((), (), ())
            joined = ",".join(ids)
            out.append((sum(n), joined, self._text(joined, b"".join(data))))
        return out

    def _text(self, ids: str, data: bytes) -> str:
        try:
            s = data.decode()
        except UnicodeDecodeError:
            return self.lib.decode([int(i) for i in ids.split(",")])
        return s[1:] if s[:1] == " " else s

    def decode(self, ids: list[int]) -> str:
        return self._text(",".join(map(str, ids)), self.raw(ids))


@functools.lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def encode_decode(df: DataFrame, path: str, key: str = "doc_id", text: str = "text",
                  keep: bool = False) -> DataFrame:
    """Digests of the ids and of the decoded text of each row; with ``keep``
    also ``ids`` and ``decoded`` themselves."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                b = whole.slice(at, 512)
                got = model.encode([t or "" for t in b.column(1).to_pylist()])
                cols = [b.column(0), pa.array([n for n, _, _ in got], pa.int64()),
                        pa.array([hashlib.sha256(i.encode()).hexdigest() for _, i, _ in got]),
                        pa.array([hashlib.sha256(d.encode()).hexdigest() for _, _, d in got])]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep:
                    cols += [pa.array([[int(x) for x in i.split(",")] if i else [] for _, i, _ in got], pa.list_(pa.int32())),
                             pa.array([d for _, _, d in got])]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(cols, names)

    return df.select(key, text).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
        + (", ids array<int>, decoded string" if keep else ""))
