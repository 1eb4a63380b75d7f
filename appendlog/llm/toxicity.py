"""Toxicity by noisy-channel deobfuscation.

Three passes, each over all rows it concerns:

1. ``language_model``: letter-trigram counts of the whole corpus, summed in
   Spark (a table of fixed size, whatever the input).
2. ``fit``: document frequencies of words and word beginnings among labelled
   training rows, by label; features that mark toxic documents become a lexicon
   of log-odds weights (those whose log-odds is surely high by its standard
   error, however rare; ``MAX_FEATURES`` bounds the classifier's size).
3. ``score``: a text's words and the restored forms of its odd tokens look up
   the lexicon; weights of distinct words add up to a log-odds.

Restoring: a token with letters among digits or symbols, made of look-alikes
only, with doubled or stretched letters, or spelled in single characters (three
or more, look-alikes too) is read as a lattice, both as it stands and without
the punctuation at its edges.  A symbol may
stand for the letters it resembles or for nothing, a run of one letter for one
or two of it.  Viterbi decoding under the trigram model keeps the best path to
each pair of last letters; the best ``READINGS`` final paths are looked up.

Null and empty texts have no words and get the base score.  Repeated rows
score alike; training rows with equal texts and equal labels count once, all
others count each.  Only texts and the labels of training rows enter a model; a
corpus without training rows gives every text the base score.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from appendlog.llm.common import pinned, sized
from appendlog.session import ship_package

#: Toxic training texts that a feature must occur in, and standard errors that
#: its log-odds must lie above ``MIN_WEIGHT`` by.
MIN_TEXTS, SURE = 5, 1.0
#: Features of the classifier, the surest first: its size bound (it is broadcast).
MAX_FEATURES = 200_000
MIN_WEIGHT, MAX_WEIGHT = 2.0, 7.0
BASE = -4.0
THRESHOLD = 0.3
READINGS = 4
BEGINNINGS = (4, 5)
#: Tokens remembered per Python worker, and odd ones with their readings.
MEMORY = 400_000

# Letters that a digit or symbol resembles.
LOOKS = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
         "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "*": "aeiou", "#": "h", "&": "a"}
_LETTER = re.compile(r"[^\W\d_]+")
_DOUBLED = re.compile(r"([^\W\d_])\1")
_RUN = re.compile(r"(.)\1+")
_SIGNS = "@$!|+(#&"
# spelled words: "*" is a separator, or a letter among other separators
_SPELLED = [(re.compile(rf"(?<![^\W_]){u}(?:{gap}{{1,2}}{u}){{2,}}(?![^\W_])"), re.compile(u))
            for u, gap in ((rf"(?:[^\W_]|[{_SIGNS}])", "[ ._*-]"), (rf"(?:[^\W_]|[{_SIGNS}*])", "[ ._-]"))]
_EDGES = ".,;:?\"'()[]{}<>%&#*|!-_=~`/\\"
_BLANK_EDGES = "".join(c for c in _EDGES if c not in LOOKS)
# letter classes of the trigram model: 0 is "no letter"
_CODE = np.zeros(256, np.int64)
for _i, _c in enumerate([*range(97, 123), *[c for c in range(0xDF, 0x100) if c != 0xF7]]):
    _CODE[_c] = _i + 1
SIDE = 64


def language_model(df: DataFrame, text: str = "text") -> np.ndarray:
    """Log-probabilities of a letter class after two others, smoothed."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SIDE ** 3, np.int64)

        def count(parts: list[str]) -> None:
            c = _CODE[np.frombuffer(("  ".join(parts) + "  ").lower().encode("latin-1", "replace"), np.uint8)]
            c = np.concatenate([[0, 0], c])
            total[:] += np.bincount((c[:-2] * SIDE + c[1:-1]) * SIDE + c[2:], minlength=SIDE ** 3)

        for b in batches:
            held, size = [], 0
            for t in b.column(0):
                held.append(t.as_py() or "")
                size += len(held[-1])
                if size > 1 << 20:
                    count(held)
                    held, size = [], 0
            count(held)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], ["gram", "n"])

    # at most SIDE ** 3 rows come to the driver
    rows = df.select(text).mapInArrow(run, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    n = np.zeros(SIDE ** 3)
    for r in rows:
        n[r["gram"]] = r["n"]
    n = n.reshape(SIDE, SIDE, SIDE)
    after_one = n.sum(axis=0) + 0.1
    after_one /= after_one.sum(axis=1, keepdims=True)
    mass = n.sum(axis=2, keepdims=True)
    return np.log((n + 5 * after_one[None]) / (mass + 5)).astype(np.float32).ravel()


def _lattice(token: str) -> list[list[tuple[str, float]]]:
    """For each run of one character, its readings and their channel costs."""
    out = []
    i = 0
    while i < len(token):
        j = i
        while j < len(token) and token[j] == token[i]:
            j += 1
        c, n = token[i], j - i
        if c.isalpha():
            reads = [(c * n, 0.0)] if n < 3 else []
            if n > 1:
                reads += [(c, 1.0)] + ([(c * 2, 1.5)] if n > 2 else [])
        else:
            reads = [(a * min(n, 2) if n == 2 else a, 1.0 if c != "*" else 3.0) for a in LOOKS.get(c, "")]
            if n == 2:
                reads += [(a, 2.0) for a in LOOKS.get(c, "")]
            reads.append(("", 1.0 if c in "._- *" else 4.0))
        out.append(reads)
        i = j
    return out


def restore(token: str, model: np.ndarray, letters_at_edges: bool = False) -> list[str]:
    """The most probable readings of an obfuscated token, best first; symbols
    at its edges may have to be letters."""
    paths: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
    lattice = _lattice(token)
    if letters_at_edges:
        for k in (0, -1):
            lattice[k] = [r for r in lattice[k] if r[0]] or lattice[k]
    for reads in lattice:
        new: dict[tuple[int, int], tuple[float, str]] = {}
        for (a, b), (cost, word) in paths.items():
            for letters, channel in reads:
                x, y, c = a, b, cost + channel
                for ch in letters:
                    code = int(_CODE[ord(ch)]) if ord(ch) < 256 else 0
                    c -= float(model[(x * SIDE + y) * SIDE + code])
                    x, y = y, code
                if (x, y) not in new or c < new[x, y][0]:
                    new[x, y] = (c, word + letters)
        paths = new
    ended = sorted((cost - float(model[(a * SIDE + b) * SIDE]), word) for (a, b), (cost, word) in paths.items() if word)
    return [w for _, w in ended[:READINGS]]


class Reader:
    """Words of a text: its letter runs, and readings of its odd tokens.  What
    has been found for a token stays remembered."""

    def __init__(self, model: np.ndarray):
        self.model = model
        self.memory: dict[str, tuple[str, ...]] = {}

    def read(self, token: str) -> tuple[str, ...]:
        """Readings of a token, the likeliest first; none for a plain word."""
        got = self.memory.get(token)
        if got is None:
            if len(self.memory) > MEMORY:
                self.memory.clear()
            core, whole = token.strip(_EDGES), token.strip(_BLANK_EDGES)
            found = []
            for form in dict.fromkeys((core, whole, whole.rstrip(_EDGES), whole.lstrip(_EDGES))):
                if _is_odd(form):
                    found += restore(form, self.model)
                    if form != core:  # the core covers the case that its edges mean nothing
                        found += restore(form, self.model, True)
            if found and core.isalpha():
                found.append(core)
            got = self.memory[token] = tuple(dict.fromkeys(found))
        return got

    def words(self, text: str | None) -> tuple[set[str], list[tuple[str, ...]]]:
        """The plain words, and the readings of each odd token."""
        low = (text or "").lower()
        tokens, words = set(low.split()), spelled(low)
        odd = [r for t in tokens - words if (r := self.read(t))]
        return set(_LETTER.findall(low)), odd + [self.read(t) or (t,) for t in words]


# for the quick test of ``spelled``: letters, signs, gaps and all else of a Latin-1 text
_KINDS = bytes(ord("x") if chr(c).isalnum() else ord("s") if chr(c) in _SIGNS else ord(" ") if chr(c) in " ._-" else ord(".")
               for c in range(256))
_APART = re.compile(rb"[ .s][xs] [xs] [xs]")


def spelled(low: str) -> set[str]:
    """Words that a lower-cased text spells in single characters."""
    if "*" not in low:  # a star is a separator or a letter: no quick test
        try:
            kinds = b"." + low.encode("latin-1").translate(_KINDS).replace(b"  ", b" ")
        except UnicodeEncodeError:
            kinds = b""
        # two characters apart and a third beginning, which every spelled word has
        if kinds and (b" x x x" not in kinds and b".x x x" not in kinds if b"s" not in kinds else not _APART.search(kinds)):
            return set()
    return {"".join(unit.findall(m.group())) for pattern, unit in _SPELLED for m in pattern.finditer(low)}


_SHARED: dict[int, Reader] = {}


def shared_reader(model: np.ndarray) -> Reader:
    """The Python worker's reader under ``model``; tasks of one worker share it."""
    key = zlib.crc32(model.tobytes())
    if key not in _SHARED:
        _SHARED.clear()  # one model at a time
        _SHARED[key] = Reader(model)
    return _SHARED[key]


def _is_odd(token: str) -> bool:
    if token.isalpha():
        return _DOUBLED.search(token) is not None
    return any(c.isalpha() for c in token) or (len(token) > 1 and all(c in LOOKS for c in token))


def features(words: set[str]) -> set[str]:
    """Words, and word beginnings (marked by a trailing dash)."""
    out = set(words)
    for k in BEGINNINGS:
        out.update(w[:k] + "-" for w in words if len(w) > k)
    return out


def held_out(key: Column) -> Column:
    """Rows that no model may learn labels from."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(4)) == 2


def fit(df: DataFrame, labels: DataFrame, model: np.ndarray, key: str = "doc_id", text: str = "text",
        label: str = "toxic") -> dict[str, float]:
    """Lexicon: feature -> weight, from the labelled rows that are not held out."""
    known = sized(pinned(labels.where(F.col(label).isNotNull() & ~held_out(F.col(key))).groupBy(key).agg(
        F.max(label).alias("y")), "toxic-labels"))
    # equal texts of one label count once; any other training row counts by its own label
    rows = df.where(F.col(text).isNotNull()).join(known, key).groupBy(F.sha2(text, 256).alias("h"), "y").agg(
        F.first(text).alias("t")).select("t", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = shared_reader(model)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                words: list[str] = []
                ys: list[int] = []
                for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    plain, odd = reader.words(t)
                    got = features(plain | {r[0] for r in odd if r})
                    words += [*got, ""]  # the empty feature counts the texts
                    ys += [int(y)] * (len(got) + 1)
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(ys, pa.int32())], ["f", "y"])

    counts = rows.mapInArrow(run, "f string, y int").groupBy("f").agg(
        F.sum("y").alias("bad"), F.sum(1 - F.col("y")).alias("fine"))
    counts = pinned(counts.where("bad > 0"), "toxic-counts")
    total = counts.where("f = ''").first()
    if total is None:
        return {}
    n_bad, n_fine = total["bad"], total["fine"]
    weight = F.log((F.col("bad") + 0.1) / (n_bad + 1.0)) - F.log((F.col("fine") + 0.5) / (n_fine + 1.0))
    error = F.sqrt(1 / (F.col("bad") + 0.1) + 1 / (F.col("fine") + 0.5))
    best = counts.where((F.col("f") != "") & (F.col("bad") >= MIN_TEXTS) & (weight - SURE * error >= MIN_WEIGHT)).select(
        "f", F.least(weight, F.lit(MAX_WEIGHT)).alias("w"), "bad")
    best = best.orderBy(F.col("w") * F.sqrt("bad"), "f", ascending=[False, True]).limit(MAX_FEATURES)
    return {r["f"]: r["w"] for r in best.collect()}


class Scorer:
    """Scores texts by a lexicon.  A token is looked at once: its words and its
    readings that have a weight stay remembered; most tokens have none."""

    def __init__(self, reader: Reader, lexicon: dict[str, float]):
        self.reader, self.lexicon = reader, lexicon
        self.memory: dict[str, tuple | None] = {}
        # words and beginnings with every run of a letter as one: what no
        # reading of a plain word can reach needs no Viterbi
        self.beginnings = {f[:-1]: w for f, w in lexicon.items() if f.endswith("-")}
        self.words = {_once(f) for f in lexicon if not f.endswith("-")}
        self.starts = {_once(f[:-1]) for f in lexicon if f.endswith("-")}

    def weight(self, word: str) -> float:
        best = self.lexicon.get(word, 0.0)
        for k in BEGINNINGS:
            if len(word) > k and word[:k] in self.beginnings:
                best = max(best, self.beginnings[word[:k]])
        return best

    def _reaches(self, word: str) -> bool:
        """Some lexicon entry fits a word up to the lengths of its letters' runs."""
        low = _once(word)
        return low in self.words or any(low[:k] in self.starts for k in range(1, max(BEGINNINGS) + 1))

    def weighed(self, readings: tuple[str, ...]) -> tuple | None:
        """(reading, weight) of the readings that have one, None if none has."""
        return tuple((r, w) for r in readings if (w := self.weight(r))) or None

    def look(self, token: str) -> tuple | None:
        """(words with their weights, weighed readings or None) of a token; None if there is neither."""
        if len(self.memory) > MEMORY:
            self.memory.clear()
        core = token if token.isalpha() else token.strip(_EDGES)
        if core.isalpha() and (core is token or token.strip(_BLANK_EDGES) == core):  # a plain word
            hot = ((core, x),) if (x := self.weight(core)) else ()
            odd = _DOUBLED.search(core) is not None and self._reaches(core)
        else:
            hot = tuple((w, x) for w in _LETTER.findall(token) if (x := self.weight(w)))
            odd = True
        readings = self.weighed(self.reader.read(token)) if odd else None
        got = self.memory[token] = (hot, readings) if hot or readings else None
        return got

    def score(self, text: str | None) -> float:
        """Probability that a text is toxic."""
        low = (text or "").lower()
        apart = spelled(low)
        tokens = set(low.split())
        words: dict[str, float] = {}
        odd = [self.weighed(self.reader.read(t) or (t,)) for t in apart]
        known, look = self.memory, self.look
        for t in tokens:
            got = known[t] if t in known else look(t)
            if got is not None:
                words.update(got[0])
                if t not in apart:
                    odd.append(got[1])
        # what a reading has beyond the words that the text holds as they are
        more = [max(w for _, w in r) - max((w for x, w in r if x in words), default=0.0) for r in odd if r]
        total = BASE + math.fsum([*words.values(), *more])
        return 1 / (1 + math.exp(-min(50.0, total)))


def _once(word: str) -> str:
    """``word`` with each run of one letter as a single letter."""
    return _RUN.sub(r"\1", word)


def text_score(text: str | None, reader: Reader, lexicon: dict[str, float]) -> float:
    """Probability that a text is toxic."""
    return Scorer(reader, lexicon).score(text)


def score(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    model = language_model(df, text)
    lexicon = fit(df, labels, model, key, text)
    shared = df.sparkSession.sparkContext.broadcast((model, lexicon))  # both of bounded size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared_reader(shared.value[0]), shared.value[1])
        for b in batches:
            s = [scorer.score(t.as_py()) for t in b.column(1)]
            held = [zlib.crc32(str(d).encode()) % 4 == 2 if d is not None else None for d in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(held, pa.bool_()), pa.array(s, pa.float64()),
                 pa.array([int(x >= THRESHOLD) for x in s], pa.int32())], ["doc_id", "held_out", "score", "predicted"])

    return df.select(key, text).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
