"""The incremental DataFrame batch: same line-once semantics as the stream."""

import os

import pytest

from appendlog.operators.increment import read_output, run_increment, settle
from tests.helpers import write


def test_increment_semantics(spark, tmp):
    d = f"{tmp}/logs"
    write(f"{d}/n1/r.log", b"r-old-" + b"x" * 80 + b"\n")
    write(f"{d}/n1/t.log", b"t1\nt2\nt3\n")
    write(f"{d}/n2/g.log", b"gone\npart")
    path = f"{d}/{{node}}/[rtg]\\.log"
    state, out = f"{tmp}/state", f"{tmp}/out"
    opts = {"md5.sample.length": 16, "bytes.max": 7}
    assert settle(spark, path, state, out, **opts) > 1  # the cap forces several batches
    assert run_increment(spark, path, state, out, **opts) is None  # idle: nothing written
    write(f"{d}/n1/r.log", b"r-new-" + b"y" * 90 + b"\n")  # replaced
    with open(f"{d}/n1/t.log", "r+b") as f:  # truncated
        f.truncate(3)
    write(f"{d}/n2/g.log", b"ial\n", "ab")  # completes the held line
    settle(spark, path, state, out, **opts)
    os.remove(f"{d}/n2/g.log")
    settle(spark, path, state, out, **opts)
    write(f"{d}/n2/g.log", b"again\n")  # re-created: new
    os.makedirs(f"{d}/n3")  # a new empty node is registered
    settle(spark, path, state, out, **opts)
    got = sorted(r.value for r in read_output(spark, out, state).collect())
    assert got == sorted([
        "r-old-" + "x" * 80, "t1", "t2", "t3", "gone",
        "r-new-" + "y" * 90, "t1", "partial", "again",
    ])


def test_stream_planner_and_dataframe_batches_agree(spark, tmp):
    """Batch by batch, the stream's planner and run_increment reach the same offsets."""
    from appendlog.operators.increment import last_state
    from tests.helpers import Tail, cfg

    d = f"{tmp}/logs"
    path = f"{d}/{{node}}/[a-z]+\\.log"
    opts = {"md5.sample.length": 16, "bytes.max": 9}
    tail = Tail(cfg(path, **opts))
    state, out = f"{tmp}/state", f"{tmp}/out"

    def step():
        tail.batch()
        run_increment(spark, path, state, out, **opts)
        _, saved = last_state(spark, state)
        got = {(r.node, r.name): (r.offset, r.md5) for r in saved.collect() if r.name is not None}
        want = {(n, f): (fo["offset"], fo["md5"]) for n, files in tail.pos["offsets"].items()
                for f, fo in files.items()}
        assert got == want

    write(f"{d}/h1/a.log", b"alpha\nbeta\ngam")
    write(f"{d}/h2/b.log", b"x" * 20 + b"\n")
    for _ in range(3):
        step()
    write(f"{d}/h1/a.log", b"ma\ndelta\n", "ab")
    write(f"{d}/h2/c.log", b"new file\n")
    for _ in range(3):
        step()
    write(f"{d}/h2/b.log", b"y" * 20 + b"\n")  # replaced (new head)
    with open(f"{d}/h1/a.log", "r+b") as f:  # truncated
        f.truncate(6)
    for _ in range(4):
        step()


@pytest.mark.parametrize("dies", ["lines", "run"])
def test_batch_killed_before_its_commit_is_redone_once(spark, tmp, monkeypatch, dies):
    """A death after the lines are written, or after the state's rows are too,
    leaves nothing visible; the batch is redone under its number."""
    from appendlog.operators.runlog import RunLog

    write(f"{tmp}/logs/a.log", b"".join(b"line%02d\n" % i for i in range(20)))
    path, state, out = f"{tmp}/logs/a\\.log", f"{tmp}/state", f"{tmp}/out"
    opts = {"bytes.max": 50}
    assert run_increment(spark, path, state, out, **opts) == 0
    first = sorted(r.value for r in read_output(spark, out, state).collect())

    def die(*args, **kw):
        raise OSError("killed")

    with monkeypatch.context() as m:
        m.setattr(RunLog, "commit" if dies == "lines" else "_publish", die)
        with pytest.raises(OSError):
            run_increment(spark, path, state, out, **opts)
    assert os.path.isdir(f"{out}/batch=1")  # lines are there, and not read
    assert sorted(r.value for r in read_output(spark, out, state).collect()) == first
    assert run_increment(spark, path, state, out, **opts) == 1  # redone under the same number
    settle(spark, path, state, out, **opts)
    assert sorted(r.value for r in read_output(spark, out, state).collect()) == ["line%02d" % i for i in range(20)]


def test_a_batch_writes_the_rows_it_touched(spark, tmp):
    from appendlog.operators.manifest import offset_log

    for i in range(300):
        write(f"{tmp}/logs/f{i:03d}.log", b"one\n")
    path, state, out = f"{tmp}/logs/f\\d+\\.log", f"{tmp}/state", f"{tmp}/out"
    settle(spark, path, state, out)
    for i in range(10):
        write(f"{tmp}/logs/f{i:03d}.log", b"two\n", "ab")
    run_increment(spark, path, state, out)
    log = offset_log(state)
    last = log.runs(log.version())[-1]
    assert last.rows == 10 and log.rows(spark).count() == 301  # the node folder has a row of its own
    assert spark.read.parquet(f"{log.path}/runs/{last.name}").count() == 10


def test_frozen_run_ends_by_itself(spark, tmp, monkeypatch):
    """Lines and files that come while a bounded run goes on are left to the next."""
    from appendlog.operators import increment

    write(f"{tmp}/logs/a.log", b"".join(b"line%02d\n" % i for i in range(30)))
    path, state, out = f"{tmp}/logs/[ab]\\.log", f"{tmp}/state", f"{tmp}/out"
    step = increment.run_increment

    def growing(*args, **kw):
        write(f"{tmp}/logs/a.log", b"later\n", "ab")
        write(f"{tmp}/logs/b.log", b"new\n", "ab")
        return step(*args, **kw)

    monkeypatch.setattr(increment, "run_increment", growing)
    n = increment.settle_frozen(spark, path, state, out, "one", **{"bytes.max": 50})
    assert n >= 4
    assert sorted(r.value for r in read_output(spark, out, state).collect()) == ["line%02d" % i for i in range(30)]
    monkeypatch.setattr(increment, "run_increment", step)
    increment.settle_frozen(spark, path, state, out, "two")
    got = [r.value for r in read_output(spark, out, state).collect()]
    assert got.count("later") == n + 1 and got.count("new") == n + 1


def test_random_operations_keep_both_planners_equal(spark, tmp):
    import random

    from appendlog.operators.increment import last_state
    from tests.helpers import Tail, cfg

    rnd = random.Random(11)
    d = f"{tmp}/logs"
    path = f"{d}/{{node}}/[a-z]\\.log"
    opts = {"md5.sample.length": 6, "bytes.max": 13}
    tail = Tail(cfg(path, **opts))
    state, out = f"{tmp}/state", f"{tmp}/out"
    names = [f"{d}/h{i % 2}/{c}.log" for i, c in enumerate("abcd")]
    alphabet = "xyé\n\n"
    for n in names[:2]:
        write(n, b"seed\n")
    for step in range(12):
        target = rnd.choice(names)
        op = rnd.random()
        if op < 0.6 or not os.path.exists(target):
            write(target, "".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 30))).encode(), "ab")
        elif op < 0.75:
            with open(target, "r+b") as f:
                f.truncate(rnd.randint(0, os.path.getsize(target)))
        elif op < 0.9:
            write(target, "".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 30))).encode())
        else:
            os.remove(target)
        tail.batch()
        run_increment(spark, path, state, out, **opts)
        _, saved = last_state(spark, state)
        got = {(r.node, r.name): (r.offset, r.md5) for r in saved.collect() if r.name is not None}
        want = {(n, f): (fo["offset"], fo["md5"]) for n, files in tail.pos["offsets"].items()
                for f, fo in files.items()}
        assert got == want, step
