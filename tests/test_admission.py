"""The byte budget of a batch against a byte-by-byte round robin."""

import random

import pytest

from appendlog.operators.manifest import offset_log, plan_step
from appendlog.operators.increment import run_increment
from appendlog.plans.admission import admit, allowed_at, fair_level, fair_level_of, next_credit
from appendlog.plans.planner import PLAN_SCHEMA
from tests.helpers import Tail, cfg, write


def rounds(files, budget):
    """Bytes that each (demand, credit) may send: in every round each file that
    needs more gets one more byte, while the budget lasts for all of them; if nobody
    may send then, rounds go on until one does."""
    credits = [c for _, c in files]
    while True:
        ask = [i for i, (d, _) in enumerate(files) if credits[i] < d]
        if not ask or len(ask) > budget and any(c > 0 for c in credits):
            return [min(d, max(0, c)) for (d, _), c in zip(files, credits)]
        for i in ask:
            credits[i] += 1
        budget -= len(ask)


@pytest.mark.parametrize("seed", range(40))
def test_level_equals_round_robin(seed):
    rng = random.Random(seed)
    files = [(rng.randint(1, 60), rng.choice([0, 0, rng.randint(-40, 40)])) for _ in range(rng.randint(1, 12))]
    budget = rng.randint(1, 200)
    level = fair_level(files, budget)
    got = [d if level is None else allowed_at(level, d, c) for d, c in files]
    assert got == rounds(files, budget) and sum(got) > 0
    assert (level is None) == (sum(max(0, d - c) for d, c in files) <= budget)


def test_level_by_aggregates(spark):
    rng = random.Random(5)
    for case in range(6):
        files = [(rng.choice([0, rng.randint(1, 10 ** rng.randint(1, 7))]), rng.choice([0, rng.randint(-5000, 5000)]))
                 for _ in range(rng.randint(1, 60))]
        rows = [("n", f"f{i}", None, "appended", d, 0, 0, d, "", 1, c, c, None) for i, (d, c) in enumerate(files)]
        planned = spark.createDataFrame(rows, PLAN_SCHEMA)
        budget = rng.randint(1, max(2, sum(d for d, _ in files)))
        level = fair_level(files, budget)
        assert fair_level_of(planned, budget) == level, case
        cut = admit(planned, budget)
        assert (cut is None) == (level is None)
        if cut is not None:
            ends = {r.name: r.end_offset for r in cut.collect()}
            assert ends == {f"f{i}": allowed_at(level, d, c) if d else 0 for i, (d, c) in enumerate(files)}


def test_a_hot_file_does_not_starve_small_ones(tmp):
    """A file with a third of all bytes beside 1,000 small ones: the small ones
    are read whole in the first batches, and the hot one goes on every time."""
    for i in range(1000):
        write(f"{tmp}/logs/s{i}.log", b"".join(b"small%03d\n" % k for k in range(4)))
    write(f"{tmp}/logs/hot.log", b"".join(b"hot-%011d\n" % k for k in range(1125)))
    tail = Tail(cfg(f"{tmp}/logs/.*\\.log", **{"bytes.batch": 9000}))
    hot, small, batches = [], [], []
    for _ in range(400):
        rows = tail.batch()
        if not rows:
            break
        batches.append(sum(len(r) + 1 for r in rows))
        hot.append(sum(r.startswith("hot") for r in rows))
        small.append(sum(r.startswith("small") for r in rows))
    assert sum(hot) == 1125 and sum(small) == 4000
    # equal shares: while the small files last, each gets about its 1/1001 of every batch
    assert all(n > 800 for n in small[:4]) and sum(small[:6]) == 4000
    assert max(batches) <= 9000 + 1001 * 16 and sum(batches[:8]) <= 8 * 9000 + 1001 * 16


def test_shares_are_equal_over_time(tmp):
    """Files of long and of short lines get equal bytes over many batches."""
    write(f"{tmp}/logs/long.log", b"".join(b"L" * 299 + b"\n" for _ in range(400)))
    write(f"{tmp}/logs/short.log", b"".join(b"S" * 9 + b"\n" for _ in range(12000)))
    tail = Tail(cfg(f"{tmp}/logs/.*\\.log", **{"bytes.batch": 200}))
    for _ in range(300):
        tail.batch()
    a, b = tail.offset("long.log"), tail.offset("short.log")
    assert abs(a - b) <= 300 and abs(a + b - 300 * 200) <= 600


def test_stream_and_batches_admit_alike(spark, tmp):
    rng = random.Random(8)
    names = [f"{tmp}/logs/h{i % 2}/{c}.log" for i, c in enumerate("abcde")]
    for n in names:
        write(n, b"".join(b"x" * rng.randint(0, 40) + b"\n" for _ in range(rng.randint(1, 25))))
    write(names[0], b"no newline yet" * 40, "ab")
    path, opts = f"{tmp}/logs/{{node}}/[a-e]\\.log", {"md5.sample.length": 8, "bytes.batch": 150, "bytes.max": 400}
    tail = Tail(cfg(path, **opts))
    for step in range(9):
        tail.batch()
        run_increment(spark, path, f"{tmp}/state", f"{tmp}/out", **opts)
        saved = {(r.node, r.name): (r.offset, r.md5, r.credit) for r in offset_log(f"{tmp}/state").rows(spark).collect() if r.name}
        want = {(n, f): (fo["offset"], fo["md5"], fo.get("credit", 0)) for n, files in tail.pos["offsets"].items()
                for f, fo in files.items()}
        assert saved == want, step
        if step % 3 == 2:
            write(names[step % 5], b"more" * rng.randint(1, 30) + b"\n", "ab")


def test_held_tails_take_no_share(spark, tmp):
    write(f"{tmp}/logs/held.log", b"h" * 5000)
    write(f"{tmp}/logs/a.log", b"a\n" * 100)
    c = cfg(f"{tmp}/logs/.*\\.log", **{"bytes.batch": 60})
    step = plan_step(spark, c, offset_log(f"{tmp}/state"))
    ends = {r.name: r.end_offset for r in step.planned.collect() if r.name}
    assert ends == {"held.log": 0, "a.log": 60}


def test_credit_of_a_finished_file_is_dropped():
    assert next_credit(share=50, demand=50, sent=50) == 0
    assert next_credit(share=50, demand=80, sent=40) == 10
    assert next_credit(share=50, demand=900, sent=300) == -250
