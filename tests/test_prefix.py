"""Rewrites behind the head: the last committed block, and the list of all blocks."""

import os

import pytest

from appendlog.operators.increment import read_output, settle
from appendlog.operators.manifest import offset_log, plan_step
from appendlog.operators.prefix import audit, block_log, rewritten, seal
from tests.helpers import cfg, write

OPTS = {"md5.sample.length": 8, "prefix.check.block": 32}


def overwrite(path, at, data):
    with open(path, "r+b") as f:
        f.seek(at)
        f.write(data)
    os.utime(path, (1, 1))


@pytest.mark.parametrize("on", [True, False])
def test_a_rewrite_behind_the_head(spark, tmp, on):
    for name in ("a", "b", "c", "short"):
        write(f"{tmp}/logs/{name}.log", b"".join(b"%s %03d\n" % (name.encode(), i) for i in range(2 if name == "short" else 40)))
    path, state, out = f"{tmp}/logs/.*\\.log", f"{tmp}/state", f"{tmp}/out"
    opts = OPTS if on else {"md5.sample.length": 8}
    settle(spark, path, state, out, **opts)
    n = read_output(spark, out, state).count()
    size = os.path.getsize(f"{tmp}/logs/a.log")
    overwrite(f"{tmp}/logs/a.log", size - 4, b"XY")  # same head and size
    write(f"{tmp}/logs/b.log", b"more\n", "ab")  # an honest append
    overwrite(f"{tmp}/logs/short.log", 8, b"Z")  # shorter than a block
    step = plan_step(spark, cfg(path, **opts), offset_log(state))
    status = {r.name: r.status for r in step.planned.collect() if r.name}
    assert status == {"a.log": "replaced" if on else "unchanged", "b.log": "appended", "c.log": "unchanged",
                      "short.log": "replaced" if on else "unchanged"}
    settle(spark, path, state, out, **opts)
    assert read_output(spark, out, state).count() == n + 1 + (42 if on else 0)


def test_only_the_last_block_is_read_again(spark, tmp):
    """A change before the last block is left to the audit."""
    write(f"{tmp}/logs/n/a.log", b"".join(b"line %03d\n" % i for i in range(100)))
    write(f"{tmp}/logs/n/b.log", b"".join(b"line %03d\n" % i for i in range(100)))
    path, state = f"{tmp}/logs/{{node}}/[ab]\\.log", f"{tmp}/state"
    c = cfg(path, **OPTS)
    settle(spark, path, state, f"{tmp}/out", **OPTS)
    log, blocks = offset_log(state), block_log(f"{tmp}/blocks")
    assert seal(spark, c, log, blocks, 32) == 0
    assert blocks.rows(spark).count() == 2 * (900 // 32)
    assert audit(spark, c, blocks, 32).count() == 0
    overwrite(f"{tmp}/logs/n/a.log", 100, b"#")
    overwrite(f"{tmp}/logs/n/b.log", 890, b"#")
    broken = rewritten_names(spark, c, log)
    assert broken == {"b.log"}
    assert {(r.name, r.block) for r in audit(spark, c, blocks, 32).collect()} == {("a.log", 3), ("b.log", 27)}
    # more lines: only their blocks are hashed, and a shorter file gives its blocks up
    write(f"{tmp}/logs/n/a.log", b"y" * 63 + b"\n", "ab")
    write(f"{tmp}/logs/n/b.log", b"new\n")
    settle(spark, path, state, f"{tmp}/out", **OPTS)
    assert seal(spark, c, log, blocks, 32) == 1
    rows = blocks.rows(spark).groupBy("name").count().collect()
    assert {r.name: r["count"] for r in rows} == {"a.log": (900 + 64) // 32}
    assert {(r.name, r.block) for r in audit(spark, c, blocks, 32).collect()} == {("a.log", 3)}


def rewritten_names(spark, c, log):
    from appendlog.sources.catalog import list_files

    return {r.name for r in rewritten(list_files(spark, c.spec), log.rows(spark), 32).collect()}
