"""Rotation by rename: files go on under their new names, opt in."""

import os

import pytest

from appendlog.operators.increment import last_state, read_output, settle
from tests.helpers import write

OPTS = {"md5.sample.length": 8}


def lines(tag, n, first=0):
    return b"".join(b"%s %03d\n" % (tag, i) for i in range(first, first + n))


@pytest.mark.parametrize("on", [True, False])
def test_a_chain_of_renames(spark, tmp, on):
    d, path, state, out = f"{tmp}/logs/n", f"{tmp}/logs/{{node}}/app\\.log.*", f"{tmp}/state", f"{tmp}/out"
    opts = {**OPTS, "identity.check": str(on).lower()}
    write(f"{d}/app.log", lines(b"one", 30))
    write(f"{d}/app.log.1", lines(b"old", 20))
    settle(spark, path, state, out, **opts)
    write(f"{d}/app.log", lines(b"one", 5, 30), "ab")  # written just before the rotation
    os.rename(f"{d}/app.log.1", f"{d}/app.log.2")
    os.rename(f"{d}/app.log", f"{d}/app.log.1")
    write(f"{d}/app.log", lines(b"two", 4))
    settle(spark, path, state, out, **opts)
    got = sorted(r.value.encode() for r in read_output(spark, out, state).collect())
    want = lines(b"one", 35) + lines(b"old", 20) + lines(b"two", 4)
    if not on:  # by name: the new names are read from their beginnings
        want += lines(b"one", 30) + lines(b"old", 20)
    assert got == sorted(want.splitlines())
    saved = {r.name: r.offset for r in last_state(spark, state)[1].collect()}
    assert saved == {"app.log": 32, "app.log.1": 35 * 8, "app.log.2": 160}
    # the last one falls out of the pattern's folder, the others move on
    os.remove(f"{d}/app.log.2")
    os.rename(f"{d}/app.log.1", f"{d}/app.log.9")
    settle(spark, path, state, out, **opts)
    assert read_output(spark, out, state).count() == len(want.splitlines()) + (0 if on else 35)
    assert {r.name for r in last_state(spark, state)[1].collect()} == {"app.log", "app.log.9"}


def test_copies_and_short_files_are_not_followed(spark, tmp):
    d, path, state, out = f"{tmp}/logs", f"{tmp}/logs/.*\\.log", f"{tmp}/state", f"{tmp}/out"
    opts = {**OPTS, "identity.check": "true"}
    write(f"{d}/a.log", lines(b"aa", 10))
    write(f"{d}/s.log", b"short\n")
    settle(spark, path, state, out, **opts)
    write(f"{d}/copy.log", lines(b"aa", 10))  # same bytes, another file
    os.rename(f"{d}/s.log", f"{d}/t.log")
    settle(spark, path, state, out, **opts)
    got = [r.value for r in read_output(spark, out, state).collect()]
    assert len(got) == 22 and got.count("short") == 2 and got.count("aa 003") == 2


def test_a_renamed_file_that_was_cut_is_read_again(spark, tmp):
    d, path, state, out = f"{tmp}/logs", f"{tmp}/logs/.*\\.log", f"{tmp}/state", f"{tmp}/out"
    opts = {**OPTS, "identity.check": "true"}
    write(f"{d}/a.log", lines(b"aa", 10))
    settle(spark, path, state, out, **opts)
    os.truncate(f"{d}/a.log", 21)
    os.rename(f"{d}/a.log", f"{d}/b.log")
    settle(spark, path, state, out, **opts)
    assert read_output(spark, out, state).count() == 13
    assert {r.name: r.offset for r in last_state(spark, state)[1].collect()} == {"b.log": 21}
