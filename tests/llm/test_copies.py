"""N-gram join and passage removal against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from appendlog.llm import ngramjoin, suffixdedup
from appendlog.llm.common import components

from .texts import WORDS, corpus, prose

ROWS = corpus()


def shingle_set(text, size):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def brute_components(rows, size, percent):
    sets = [(i, shingle_set(t, size)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            both = len(a & b)
            if a and b and 100 * both >= percent * (len(a) + len(b) - both):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets}


def near_copies(seed):
    """Chains and stars of texts with growing distance from one another."""
    rng = random.Random(seed)
    rows = []
    for _ in range(12):
        w = prose(rng, rng.choice([8, 12, 25, 60, 140])).split()
        for _ in range(rng.randint(2, 9)):
            rows.append(" ".join(w))
            for _ in range(rng.randint(0, 2)):
                at = rng.randrange(len(w))
                w = [list(w), w[:at] + w[at + 1:], w[:at] + ["new"] + w[at:]][rng.randrange(3)]
                w[rng.randrange(len(w))] = rng.choice(WORDS)
    rng.shuffle(rows)
    return list(enumerate(rows, 10))


@pytest.mark.parametrize("size,percent,rows", [(3, 90, ROWS), (5, 80, ROWS), (3, 90, near_copies(1)), (3, 80, near_copies(2))])
def test_components_equal_brute_force(table, monkeypatch, size, percent, rows):
    monkeypatch.setattr(ngramjoin, "UNIT", 4)
    monkeypatch.setattr(ngramjoin, "QUERIES", 3)
    monkeypatch.setattr(ngramjoin, "HELD", 500)
    got = ngramjoin.link_components(table(rows, ["key", "n"]), size, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows, size, percent)
    assert len(got) == len(rows)


def test_light_parts_are_no_keys():
    """Texts with single shingles in common meet by none of them; the keys are still enough (see below)."""
    rng = random.Random(16)
    met = 0
    for _ in range(60):
        common = {rng.getrandbits(64) for _ in range(40)}
        a, b = (common | {rng.getrandbits(64) for _ in range(440)} for _ in range(2))
        met += np.intersect1d(*(ngramjoin.block_keys(np.array(sorted(s), np.uint64), 80) for s in (a, b))).size > 0
    assert met < 8  # 14 with all parts that hold any


def test_queries_go_where_they_share_keys(table):
    """Unit 2 holds no key of text 1, unit 3 only those of its own component."""
    keyed = table([], []).sparkSession.createDataFrame(
        [(9, 1, 1, 5, 1), (9, 1, 2, 5, 1), (9, 2, 3, 6, 3), (9, 3, 4, 5, 1), (9, 4, 7, 5, 7), (8, 5, 8, 5, 8)],
        "cluster long, unit long, id long, key long, c long")
    asking = keyed.where("id = 1").select("id")
    assert [tuple(r) for r in ngramjoin._routes(keyed, asking).collect()] == [(9, 4, 1)]


def test_blocks_lose_no_link():
    rng = random.Random(6)
    for percent in (80, 90):
        for _ in range(1500):
            n = rng.randint(1, 60)
            a = {rng.getrandbits(64) for _ in range(n)}
            b = set(a)
            for _ in range(rng.randint(0, 1 + n // 8)):
                (b.discard(rng.choice(sorted(b))) if b and rng.random() < 0.5 else b.add(rng.getrandbits(64)))
            if a != b and 100 * len(a & b) >= percent * len(a | b):
                x, y = (ngramjoin.block_keys(np.array(sorted(s), np.uint64), percent) for s in (a, b))
                assert np.intersect1d(x, y).size, (len(a), len(b))


def test_divide_skip_equals_brute_force():
    rng = random.Random(9)
    for _ in range(200):
        base = rng.sample(range(400), rng.randint(1, 60))
        index = []
        for _ in range(rng.randint(1, 12)):
            s = set(base) - set(rng.sample(base, rng.randint(0, len(base) // 4))) | set(rng.sample(range(400), rng.randint(0, 8)))
            index.append(np.array(sorted(s or {1}), np.uint64))
        q = np.array(sorted(base), np.uint64)
        want = [k for k, s in enumerate(index)
                if 100 * len(np.intersect1d(q, s)) >= 80 * (len(q) + len(s) - len(np.intersect1d(q, s)))]
        assert ngramjoin.divide_skip(q, index, 80) == want


def test_components_of_links(spark):
    rng = random.Random(3)
    links = [(a, a + 1) for a in range(0, 60)] + [(rng.randrange(100, 160), rng.randrange(100, 160)) for _ in range(45)]
    links += [(500, k) for k in range(300, 340)] + [(7, 7)]
    root = {x: x for p in links for x in p}
    for _ in range(len(root)):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: c for x, c in root.items() if any(x in p and p[0] != p[1] for p in links)}


def test_one_of_each_group_stays(table):
    kept = ngramjoin.keep_one(table(ROWS, ["component_id"]))
    want = {c for _, c in brute_components(ROWS, 5, 80).values()}
    assert kept.columns[-1] == "component_id" and {r.doc_id for r in kept.collect()} == want
    assert ngramjoin.link_components(table([])).count() == 0
    assert ngramjoin.keep_one(table([])).count() == 0
    twice = ngramjoin.link_components(table([(4, "a b c d"), (4, "a b c d"), (2, "a b c d")])).collect()
    assert [(r.doc_id, r.component_id) for r in sorted(twice)] == [(2, 2), (4, 2), (4, 2)]


def brute_removed(rows, length):
    seen = Counter(t.encode()[i:i + length] for _, t in rows if t for i in range(len(t.encode()) - length + 1))
    out = {}
    for i, t in rows:
        data = (t or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for k in range(len(data) - length + 1):
            if seen[data[k:k + length]] > 1:
                gone[k:k + length] = True
        gone = gone[:len(data)]
        starts = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        out[i] = (len(data), int(gone.sum()), starts, hashlib.sha256(kept).hexdigest())
    return out


def passages(seed, length):
    """Texts that share runs around the limit, at odd places and nested."""
    rng = random.Random(seed)
    pool = [prose(rng, 60) for _ in range(4)] + ["é" * 300, "xy" * 250, "na " * 200]
    rows = []
    for _ in range(40):
        parts = []
        for _ in range(rng.randint(1, 4)):
            p = rng.choice(pool)
            at = rng.randrange(len(p))
            parts.append(p[at:at + rng.randint(length - 10, length + 60)])
            parts.append(prose(rng, rng.randint(1, 12)))
        rows.append(rng.choice(["", " "]).join(parts))
    return list(enumerate(rows, 3))


@pytest.mark.parametrize("length,rows,hot,size", [
    (400, ROWS, 400, 1 << 20), (400, ROWS, 1, 1 << 20), (100, passages(1, 100), 400, 3000), (100, passages(2, 100), 2, 3000)])
def test_removed_bytes_equal_brute_force(table, monkeypatch, length, rows, hot, size):
    monkeypatch.setattr(suffixdedup, "HOT", hot)
    monkeypatch.setattr(suffixdedup, "SEARCH_BYTES", size)
    got = suffixdedup.report(table(rows, ["id", "rep", "spans"]), length=length).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == brute_removed(rows, length)


def brute_cut(rows, length, words):
    """Texts without repeated windows of ``length`` bytes and of ``words`` words."""
    places = [[(m.start(), m.end(), m.group()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", (t or "").encode())] for _, t in rows]
    seen = Counter((t or "").encode()[i:i + length] for _, t in rows for i in range(len((t or "").encode()) - length + 1))
    met = Counter(tuple(x[2] for x in w[i:i + words]) for w in places for i in range(len(w) - words + 1))
    out = []
    for (_, t), w in zip(rows, places, strict=True):
        data = (t or "").encode()
        gone = [False] * len(data)
        for i in range(len(data) - length + 1):
            if seen[data[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        for i in range(len(w) - words + 1):
            if met[tuple(x[2] for x in w[i:i + words])] > 1:
                lo, hi = w[i][0], w[i + words - 1][1]
                gone[lo:hi] = [True] * (hi - lo)
        at = 0
        for ch in (t or ""):  # a character that goes in part stays
            n = len(ch.encode())
            gone[at:at + n] = [all(gone[at:at + n])] * n
            at += n
        out.append(None if t is None else bytes(b for b, g in zip(data, gone, strict=True) if not g).decode())
    return out


def worded(seed, words):
    """Texts that share runs of about ``words`` short words, with other blanks between them, and short copies."""
    rng = random.Random(seed)
    pool = [[rng.choice(["a", "of", "é", "stone", "river"]) + rng.choice("xyz") for _ in range(4 * words)] for _ in range(4)] + [["na"] * 3 * words]
    rows = []
    for _ in range(40):
        parts = []
        for _ in range(rng.randint(1, 4)):
            p = rng.choice(pool)
            at = rng.randrange(len(p))
            parts.append(rng.choice([" ", "\n", "  "]).join(p[at:at + rng.randint(words - 2, words + 6)]))
            parts.append(prose(rng, rng.randint(1, 12)))
        rows.append(rng.choice([" ", "\t"]).join(parts))
    return list(enumerate(rows + rows[:3] + [None, "", " ", "one two"], 3))


@pytest.mark.parametrize("length,words,rows,hot,size", [
    (400, 51, ROWS, 400, 1 << 20), (400, 51, worded(3, 51), 400, 1 << 20), (150, 12, worded(4, 12), 400, 3000), (150, 12, worded(5, 12), 2, 3000)])
def test_passages_by_words_equal_brute_force(table, monkeypatch, length, words, rows, hot, size):
    monkeypatch.setattr(suffixdedup, "HOT", hot)
    monkeypatch.setattr(suffixdedup, "SEARCH_BYTES", size)
    got = suffixdedup.without_repeats(table(rows, ["spans"]), length=length, words=words).collect()
    want = brute_cut(rows, length, words)
    assert {r.doc_id: r.text for r in got} == {i: t for (i, _), t in zip(rows, want, strict=True)} and len(got) == len(rows)
    if rows is not ROWS:
        assert want != brute_cut(rows, length, 10 ** 6)


def test_bounded_interval_expansion():
    rng = random.Random(12)
    for _ in range(60):
        parts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(12, 90))) for _ in range(rng.randint(1, 5))]
        limit = rng.choice([3, 8, 12])
        seen = Counter(p[i:i + limit] for p in parts for i in range(len(p) - limit + 1))
        for p, mark in zip(parts, suffixdedup.repeated_windows(parts, limit), strict=True):
            assert mark.tolist() == [seen[p[i:i + limit]] > 1 for i in range(len(p) - limit + 1)]


def test_whole_characters_stay(table):
    rng = random.Random(5)
    body = "é" * 220
    rows = [(1, "a" + body + prose(rng, 20)), (2, "bb" + body + prose(rng, 20)), (3, None), (4, "short")]
    df = suffixdedup.without_repeats(table(rows, ["id", "rep"]))
    assert df.columns[-2:] == ["id", "rep"]
    out = {r.doc_id: r.text for r in df.collect()}
    assert out[3] is None and out[4] == "short"
    assert all(len(out[i]) < len(dict(rows)[i]) - 200 and "�" not in out[i] for i in (1, 2))
    same = {r.doc_id: r.text for r in suffixdedup.without_repeats(table([(1, "z" + body), (2, "z" + body)])).collect()}
    assert same == {1: "", 2: ""}
    assert suffixdedup.report(table([])).count() == 0 and suffixdedup.without_repeats(table([])).count() == 0


def test_repeated_null_and_clashing_ids(table):
    """Stages 2 and 3 of the pipeline: one row of each text stays, and stays whole."""
    rng = random.Random(17)
    a, b, c, d, e = (prose(rng, 120) for _ in range(5))
    assert min(len(t.encode()) for t in (a, b, c, d, e)) > 400
    rows = [(1, a), (1, a), (1, a), (None, b), (None, b), (None, c), (7, c), (3, d), (2, d), (3, e), (5, None), (5, None)]
    kept = ngramjoin.keep_one(table(rows, ["c", "id"]))
    want = [(1, a), (2, d), (3, e), (5, None), (5, None), (7, c), (None, b)]
    by = lambda x: (x[0] is None, x[0] or 0, x[1] or "")
    assert sorted([(r.doc_id, r.text) for r in kept.collect()], key=by) == want
    cut = suffixdedup.without_repeats(kept)
    assert sorted([(r.doc_id, r.text) for r in cut.collect()], key=by) == want
    # copies lose all, whatever their ids; a namesake keeps its own bytes
    got = Counter((r.doc_id, r.n_bytes, r.n_removed) for r in suffixdedup.report(table(rows)).collect())
    size = {t: len(t.encode()) for t in (a, b, c, d, e)}
    assert got == Counter([(i, size.get(t, 0), 0 if t in (None, e) else size[t]) for i, t in rows])
    passage = prose(rng, 90)
    clash = [(1, prose(rng, 30) + passage), (1, d), (2, prose(rng, 50) + passage + prose(rng, 9))]
    out = {r.text for r in suffixdedup.without_repeats(table(clash)).collect()}
    assert d in out and len(out) == 3 and not any(passage in t for t in out)


def test_components_of_clashing_and_null_ids(table):
    rng = random.Random(18)
    a, b, c, d = (prose(rng, 60) for _ in range(4))
    rows = [(9, a), (9, b), (4, b), (6, a), (None, c), (8, c), (None, d), (9, "")]
    got = [(r.doc_id, r.component_id) for r in ngramjoin.link_components(table(rows)).collect()]
    assert Counter(got) == Counter([(9, 4), (9, 4), (4, 4), (6, 4), (None, 8), (8, 8), (None, None), (9, 4)])
