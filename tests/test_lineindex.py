"""Lines by number through the sparse newline index, against plain splits."""

import os
import random

from appendlog.functions import linescan
from appendlog.operators import lineindex
from appendlog.operators.increment import settle
from appendlog.operators.lineindex import extend, index_log, read_numbered, seek
from appendlog.operators.manifest import offset_log
from tests.helpers import cfg, write

B = 16


def ask(spark, c, log, index, wanted):
    asked = spark.createDataFrame(wanted, "node string, name string, first bigint, last bigint")
    got = {}
    for r in read_numbered(spark, c, log, index, asked).collect():
        got.setdefault((r.node, r.name), {}).setdefault(r.line, set()).add(r.value)
    return got


def test_lines_by_number(spark, tmp, monkeypatch):
    """Random files in growing steps; lines longer than blocks, empty ones, a half-written tail."""
    monkeypatch.setattr(lineindex, "GROUP", 4)
    rng = random.Random(6)
    path = f"{tmp}/logs/{{node}}/[a-d]\\.log"
    c = cfg(path, **{"md5.sample.length": 4})
    log, index = offset_log(f"{tmp}/state"), index_log(f"{tmp}/index")
    texts = {(n, f"{f}.log"): "" for n in "xy" for f in "abcd"}
    for step in range(3):
        for (node, name), text in texts.items():
            new = "".join("v" * rng.choice([0, 0, 1, 3, 15, 16, 40]) + "é" * rng.randrange(2) + "\n" for _ in range(rng.randint(0, 14)))
            new += "tail" if rng.random() < 0.3 else ""
            texts[node, name] = text + new
            write(f"{tmp}/logs/{node}/{name}", new.encode(), "ab")
        settle(spark, path, log.path, f"{tmp}/out", **{"md5.sample.length": 4})
        assert extend(spark, c, log, index, B) == step
        wanted, want = [], {}
        for (node, name), text in texts.items():
            lines = text.split("\n")[:-1]
            first = rng.randint(0, max(0, len(lines) - 1))
            last = rng.choice([first, first + 1, first + 5, len(lines), len(lines) + 9])
            wanted.append((node, name, first, last))
            if lines[first:last]:
                want[node, name] = {first + i: {v} for i, v in enumerate(lines[first:last])}
        assert ask(spark, c, log, index, wanted) == want, step
        # each full block's first line start, by a plain scan
        for r in index.rows(spark).collect():
            raw = texts[r.node, r.name].encode()
            lo = int(r.block) * B
            starts = [i for i in range(lo, lo + B) if i == 0 or raw[i - 1:i] == b"\n"]
            assert r.start == (starts[0] if starts else None) and r.lines == raw[:lo].count(b"\n")
            assert r.number == (raw[:r.start].count(b"\n") if starts else None)


def test_ranges_are_short_and_nothing_is_scanned(spark, tmp, monkeypatch):
    write(f"{tmp}/logs/a.log", b"".join(b"line %05d\n" % i for i in range(5000)))
    path = f"{tmp}/logs/a\\.log"
    c, log, index = cfg(path), offset_log(f"{tmp}/state"), index_log(f"{tmp}/index")
    settle(spark, path, log.path, f"{tmp}/out")
    extend(spark, c, log, index, 1024)
    asked = spark.createDataFrame([("local", "a.log", 3000, 3010)], "node string, name string, first bigint, last bigint")
    os.rename(f"{tmp}/logs/a.log", f"{tmp}/hidden")  # seeking opens no file
    r = seek(spark, c, log, index, asked).first()
    assert r.hi - r.lo <= 2 * 1024 + 110 and r.line <= 3000 and r.lo == r.line * 11
    os.rename(f"{tmp}/hidden", f"{tmp}/logs/a.log")
    assert ask(spark, c, log, index, [("local", "a.log", 3000, 3002)]) == {
        ("local", "a.log"): {3000: {"line 03000"}, 3001: {"line 03001"}}}
    assert linescan is not None


def test_restarted_files_are_indexed_anew(spark, tmp):
    path = f"{tmp}/logs/.*\\.log"
    opts = {"md5.sample.length": 4}
    c, log, index = cfg(path, **opts), offset_log(f"{tmp}/state"), index_log(f"{tmp}/index")
    for name in "rtg":
        write(f"{tmp}/logs/{name}.log", name.encode() * 3 + b"\n" + b"old line\n" * 20)
    settle(spark, path, log.path, f"{tmp}/out", **opts)
    extend(spark, c, log, index, B)
    write(f"{tmp}/logs/r.log", b"new head\n" + b"x\n" * 60)  # replaced
    os.truncate(f"{tmp}/logs/t.log", 40)
    os.remove(f"{tmp}/logs/g.log")
    settle(spark, path, log.path, f"{tmp}/out", **opts)
    extend(spark, c, log, index, B)
    counts = {r.name: r["count"] for r in index.rows(spark).groupBy("name").count().collect()}
    assert counts == {"r.log": 129 // B, "t.log": 40 // B}
    got = ask(spark, c, log, index, [("local", "r.log", 0, 3), ("local", "t.log", 1, 3), ("local", "g.log", 0, 9)])
    assert got == {("local", "r.log"): {0: {"new head"}, 1: {"x"}, 2: {"x"}},
                   ("local", "t.log"): {1: {"old line"}, 2: {"old line"}}}
