"""Fill-in-middle: against a plain line split, with markers, odd texts and round trips."""

import hashlib
import random
import re

import numpy as np
import pytest

from appendlog.llm import infill
from tests.llm.texts import corpus

ODD = [None, "", "\n", "\n\n\n", "no end", "one\n", "a\r\nb\r\n", "é\n世界\n\U0001f600", "x <P> y\nz", "tail <S", "<M", "<M>",
       "a" * 200_000, "\n" * 9000, ("é" * 5000 + "\n") * 3, "<P" + "\n" * 300 + ">"]


def plain(key, text):
    """The contract by a plain split."""
    t = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", t)
    h = hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, _, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, t
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 50:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def check(df, rows):
    got = sorted((r.doc_id is None, r.doc_id or 0, r.output, r.n, r.form, r.prefix_chars, r.middle_chars) for r in df.collect())
    want = sorted((k is None, k or 0, p[4], *p[:4]) for k, p in ((k, plain(k, t)) for k, t in rows))
    assert got == want


def test_corpus_and_odd_texts(table):
    rows = corpus() + [(2000 + i, t) for i, t in enumerate(ODD)] + [(None, "null\nkey"), (3, "twice\n"), (3, "twice\n")]
    df = infill.fill_in_middle(table(rows, extra=("n", "form", "output", "raw")))
    check(df, rows)
    back = {(r.doc_id, r.text) for r in infill.restored(df).collect()}
    assert back == {(k, t or "") for k, t in rows}
    for r in df.collect():
        assert infill.restore(r.output, r.form) in {t or "" for k, t in rows if k == r.doc_id}


def test_empty_table(table):
    assert infill.fill_in_middle(table([(1, "x")]).where("doc_id < 0")).count() == 0


def test_percent(table):
    rows = [(i, f"a\nb{i}\n") for i in range(300)]
    forms = [r.form for r in infill.fill_in_middle(table(rows), percent=30, spm_percent=100).collect()]
    assert set(forms) == {"plain", "spm"} and 50 < forms.count("spm") < 130


@pytest.mark.parametrize("seed", range(4))
def test_marks_and_cuts_at_chunk_edges(seed):
    """Short random texts over few letters, cut into very small chunks."""
    rng, memory = random.Random(seed), infill.Memory(2000)
    least, most, bits = infill.LEAST, infill.MOST, infill.BITS
    infill.LEAST, infill.MOST, infill.BITS = 2, 9, 2
    try:
        for key in range(1500):
            t = "".join(rng.choice("<PSM>\n\né😀") for _ in range(rng.randint(0, 60)))
            p = infill.transform(key, t, memory)
            assert (*p[:4], p.output.decode()) == plain(key, t)
    finally:
        infill.LEAST, infill.MOST, infill.BITS = least, most, bits


def test_rolling_hash_sees_its_window_only():
    rng = np.random.default_rng(1)
    a, b = (rng.integers(0, 256, n, dtype=np.uint8) for n in (500, 900))
    same = rng.integers(0, 256, 3000, dtype=np.uint8)
    ha, hb = infill.rolling(np.concatenate([a, same])), infill.rolling(np.concatenate([b, same]))
    w = infill.WINDOW - 1
    assert (ha[500 + w:] == hb[900 + w:]).all() and (ha[500:] != hb[900:]).any()


def test_shared_passages_meet_in_the_memory(monkeypatch):
    """A passage behind different beginnings falls into equal chunks, across hash blocks too."""
    rng = random.Random(5)
    passage = "".join(rng.choice("abcdefgh \n") for _ in range(60_000))
    memory = infill.Memory()
    for i in range(5):
        infill.transform(i, "".join(rng.choice("xyz ") for _ in range(700 + 37 * i)) + passage, memory)
    assert memory.met > 0.7 * memory.asked
    text = ("é" * 700 + passage).encode()
    whole = infill.chunk_ends(text)
    monkeypatch.setattr(infill, "BLOCK", 1 << 12)
    assert infill.chunk_ends(text) == whole


def test_memory_is_bounded():
    memory = infill.Memory(1000)
    for i in range(200):
        memory.get(str(i).encode() * 50)
    assert memory.held <= 1200 and len(memory.known) < 25
