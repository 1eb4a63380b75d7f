"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, phone and digit
cues, URL schemes and identifier cue words.  At each anchor a small
deterministic parser expands to the span's boundaries and validates it.

Kinds ``email ip card phone`` follow fixed grammars (leftmost, not overlapping
within a kind; a match that fails its check is dropped).  The expansion adds
``url`` (a scheme followed by user information or a bare address), ``iban``
(mod-97), ``ssn`` and ``secret`` (a value assigned to a password or token cue).

Null and empty texts give no spans.  Spans are code-point offsets, end
exclusive, sorted by start, then by kind in the order above.  Rows stay as they
are (repeated ids, extra columns and other nulls included); texts of any length
are read whole, one at a time.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from appendlog.session import ship_package

# Kinds in their order.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = BASE_KINDS + ("url", "iban", "ssn", "secret")
# Cue words of identifiers.
CUES = {"iban": "iban", "ssn": "ssn", "social security": "ssn",
        "password": "secret", "passwd": "secret", "pwd": "secret", "token": "secret",
        "secret": "secret", "api_key": "secret", "apikey": "secret", "access_key": "secret"}

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_LOCAL_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_ADDRESS = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_DIGITS = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_URL = re.compile(r"://([^\s/@]+@[^\s/]+|[0-9]+(\.[0-9]+){3}(?![0-9.]))[^\s\"'<>]*")
_SCHEME = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+.-")
_IBAN = re.compile(r"[\s:#=-]{0,4}(?:is\s)?\s?([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})(?![A-Za-z0-9])")
_SSN = re.compile(r"[\s:#=-]{0,4}(?:is\s)?\s?([0-9]{3}[\x20-][0-9]{2}[\x20-][0-9]{4})(?![0-9])")
_SECRET = re.compile(r"\"?\s?[=:]\s?[\"']?([A-Za-z0-9_+/.~-]{8,})")


@functools.lru_cache(maxsize=1)
def _anchors():
    import ahocorasick

    auto = ahocorasick.Automaton()
    auto.add_word("@", ("@", 1))
    for d in "0123456789":
        auto.add_word(d, ("digit", 1))
        auto.add_word("+" + d, ("+", 2))
    auto.add_word("://", ("scheme", 3))
    for word, kind in CUES.items():
        for form in {word, word.upper(), word.capitalize()}:
            auto.add_word(form, (kind, len(form)))
    auto.make_automaton()
    return auto


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else (2 * n - 9 if n > 4 else 2 * n)
    return total % 10 == 0


def _mod97(iban: str) -> bool:
    s = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def find_spans(text: str | None) -> list[tuple[str, int, int]]:
    """All spans ``(kind, start, end)`` of one text, sorted."""
    if not text:
        return []
    out: list[tuple[int, int, int]] = []
    done = dict.fromkeys(KINDS, 0)  # where the scan of each kind has come to

    def add(kind: str, start: int, end: int) -> None:
        out.append((start, KINDS.index(kind), end))

    for last, (what, size) in _anchors().iter(text):
        at = last - size + 1
        if what == "digit":
            if at >= done["ip"]:
                if m := _ADDRESS.match(text, at):
                    done["ip"] = m.end()
                    if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
                        add("ip", at, m.end())
                else:
                    done["ip"] = _DIGITS.match(text, at).end()
            if at >= done["card"]:
                if m := _CARD.match(text, at):
                    done["card"] = m.end()
                    digits = m.group().replace(" ", "").replace("-", "")
                    if 14 <= len(digits) <= 19 and luhn(digits):
                        add("card", at, m.end())
                else:
                    done["card"] = at + 1
        elif what == "@":
            if m := _DOMAIN.match(text, at):
                start = at
                while start > done["email"] and text[start - 1] in _LOCAL_CHARS:
                    start -= 1
                if start < at:
                    add("email", start, m.end())
                    done["email"] = m.end()
        elif what == "+":
            if at >= done["phone"] and (m := _PHONE.match(text, at)):
                done["phone"] = m.end()
                if 10 <= sum(c in "0123456789" for c in m.group()) <= 15:
                    add("phone", at, m.end())
        elif what == "scheme":
            start = at
            while start > done["url"] and text[start - 1] in _SCHEME:
                start -= 1
            if start < at and (m := _URL.match(text, at)):
                add("url", start, m.end())
                done["url"] = m.end()
        elif at >= done[what]:
            m = {"iban": _IBAN, "ssn": _SSN, "secret": _SECRET}[what].match(text, last + 1)
            if m and (what != "iban" or _mod97(m.group(1))) and (
                    what != "secret" or any(c in "0123456789" for c in m.group(1))):
                add(what, m.start(1), m.end(1))
                done[what] = m.end(1)
    return [(KINDS[k], s, e) for s, k, e in sorted(out)]


def digest(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def _with_column(schema: T.StructType, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name != name] + [T.StructField(name, kind)])


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                                  T.StructField("end", T.LongType())]))


def detect(df: DataFrame, text: str = "text", out: str = "spans") -> DataFrame:
    """``df`` with the array column ``out`` (kind, start, end) in place of any
    column of that name; ``text`` itself is kept."""
    from pyspark.sql.pandas.types import to_arrow_type

    ship_package(df.sparkSession)
    kind = to_arrow_type(SPANS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = [n for n in b.schema.names if n != out]
            spans = [[{"kind": k, "start": s, "end": e} for k, s, e in find_spans(t)]
                     for t in b.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(n) for n in names] + [pa.array(spans, kind)], names + [out])

    return df.mapInArrow(run, _with_column(df.schema, out, SPANS))


def redacted(text: str | None) -> str | None:
    """The text with each maximal covered run replaced by ``[KIND]`` of the
    span that opens it; a null text stays null."""
    if text is None:
        return None
    parts, at = [], 0
    for kind, start, end in find_spans(text):
        if start >= at:
            parts += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(parts) + text[at:]


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with personal data replaced by kind markers, same columns."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            i = b.schema.get_field_index(text)
            new = pa.array([redacted(t) for t in b.column(i).to_pylist()], b.schema.field(i).type)
            yield b.set_column(i, b.schema.field(i), new)

    return df.mapInArrow(run, df.schema)


def report(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts and digests of the spans of each row."""
    ship_package(df.sparkSession)
    names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [find_spans(t) for t in b.column(1).to_pylist()]
            base = [[x for x in f if x[0] in BASE_KINDS] for f in found]
            counts = [pa.array([sum(x[0] == k for x in f) for f in base], pa.int64()) for k in BASE_KINDS]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *counts, pa.array([hashlib.sha256(digest(f).encode()).hexdigest() for f in base]),
                 pa.array([digest(f) for f in found], pa.string())], names)

    return df.select(key, text).mapInArrow(
        run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
