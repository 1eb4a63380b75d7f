"""Hand-made edge files through the stream's planner and reader (FIXTURES §5)."""

import hashlib
import os

import pytest

from appendlog.functions.bytescan import aligned_end, head_md5
from appendlog.functions.linescan import iter_line_arrays
from appendlog.plans import rules as R
from tests.helpers import Tail, cfg, write


def lines_of(path, start, end, lo=None, hi=None):
    fd = os.open(path, os.O_RDONLY)
    try:
        out = []
        for a in iter_line_arrays(fd, start if lo is None else lo, end if hi is None else hi, start, end, path):
            out += a.to_pylist()
        return out
    finally:
        os.close(fd)


def test_empty_file(tmp):
    write(f"{tmp}/a.log", b"")
    t = Tail(cfg(f"{tmp}/a\\.log"))
    assert t.drain() == []
    assert t.offset("a.log") == 0


def test_no_newline_is_held_then_completed(tmp):
    write(f"{tmp}/a.log", b"abc")
    t = Tail(cfg(f"{tmp}/a\\.log"))
    assert t.drain() == []
    assert t.offset("a.log") == 0
    write(f"{tmp}/a.log", b"\n", "ab")
    assert t.drain() == ["abc"]
    assert t.offset("a.log") == 4


def test_blank_lines_and_crlf(tmp):
    write(f"{tmp}/a.log", b"a\n\nb\n")
    write(f"{tmp}/b.log", b"a\r\nb\r\n")
    t = Tail(cfg(f"{tmp}/[ab]\\.log"))
    assert sorted(t.drain()) == sorted(["a", "", "b", "a\r", "b\r"])


def _ten_byte_lines(n):
    return b"".join(b"%09d\n" % i for i in range(n))


@pytest.mark.parametrize("cap, first_end", [(15, 10), (20, 20)])
def test_cap_inside_and_on_newline(tmp, cap, first_end):
    write(f"{tmp}/a.log", _ten_byte_lines(5))
    t = Tail(cfg(f"{tmp}/a\\.log", **{"bytes.max": cap}))
    t.batch()
    assert t.offset("a.log") == first_end
    rest = t.drain()
    assert len(rest) + first_end // 10 == 5


def test_line_longer_than_cap(tmp):
    write(f"{tmp}/a.log", b"x" * 99 + b"\n")
    t = Tail(cfg(f"{tmp}/a\\.log", **{"bytes.max": 10}))
    assert t.batch() == ["x" * 99]
    assert t.offset("a.log") == 100


def test_multibyte_at_cap(tmp):
    write(f"{tmp}/a.log", "ää\nb\n".encode())
    t = Tail(cfg(f"{tmp}/a\\.log", **{"bytes.max": 3}))
    assert t.batch() == ["ää"]
    assert t.offset("a.log") == 5
    assert t.drain() == ["b"]


@pytest.mark.parametrize("size, expect_set", [(63, False), (64, True), (65, True)])
def test_sample_boundary(tmp, size, expect_set):
    body = (b"y" * (size - 1)) + b"\n"
    write(f"{tmp}/a.log", body)
    fd = os.open(f"{tmp}/a.log", os.O_RDONLY)
    try:
        m = head_md5(fd, size, 64)
    finally:
        os.close(fd)
    assert (m != "") == expect_set
    if expect_set:
        assert m == hashlib.md5(body[:64]).hexdigest()


def test_grew_past_sample_is_appended(tmp):
    write(f"{tmp}/a.log", b"z" * 62 + b"\n")  # 63 bytes: no checksum yet
    t = Tail(cfg(f"{tmp}/a\\.log", **{"md5.sample.length": 64}))
    assert t.drain() == ["z" * 62]
    write(f"{tmp}/a.log", b"12345\n", "ab")  # 69 bytes now
    d = R.decide(63, "", 69, "abc", node_listed=True, first_run=False, policy="earliest",
                 cap=1 << 30, check=True)
    assert d.status == R.APPENDED
    assert t.drain() == ["12345"]


def test_shrank_below_sample_is_replaced(tmp):
    write(f"{tmp}/a.log", b"q" * 68 + b"\n")
    t = Tail(cfg(f"{tmp}/a\\.log", **{"md5.sample.length": 64}))
    t.drain()
    kmd5 = t.pos["offsets"]["local"]["a.log"]["md5"]
    assert kmd5
    write(f"{tmp}/a.log", b"r" * 62 + b"\n")
    d = R.decide(69, kmd5, 63, "", node_listed=True, first_run=False, policy="earliest",
                 cap=1 << 30, check=True)
    assert d.status == R.REPLACED
    assert t.batch() == []  # registers the new incarnation at 0
    assert t.offset("a.log") == 0
    assert t.drain() == ["r" * 62]


def test_unchanged_file(tmp):
    write(f"{tmp}/a.log", b"one\n")
    t = Tail(cfg(f"{tmp}/a\\.log"))
    assert t.drain() == ["one"]
    d = R.decide(4, "", 4, "", node_listed=True, first_run=False, policy="earliest", cap=9, check=True)
    assert (d.status, d.start, d.end) == (R.UNCHANGED, 4, 4)
    assert t.batch() == []


def test_invalid_utf8_replaced(tmp):
    write(f"{tmp}/a.log", b"\xff\nok\n")
    t = Tail(cfg(f"{tmp}/a\\.log"))
    assert t.drain() == ["�", "ok"]


def test_sub_ranges_own_lines_starting_in_them(tmp):
    body = b"".join((b"L%d-" % i) + b"x" * (i % 17) + b"\n" for i in range(300))
    write(f"{tmp}/a.log", body)
    p = f"{tmp}/a.log"
    whole = lines_of(p, 0, len(body))
    assert whole == body.decode().split("\n")[:-1]
    for step in (1, 7, 64, 1000):
        got = []
        lo = 0
        while lo < len(body):
            hi = min(len(body), lo + step)
            got += lines_of(p, 0, len(body), lo, hi)
            lo = hi
        assert got == whole, step


def test_aligned_end_rules(tmp):
    write(f"{tmp}/a.log", b"aaaa\nbbbb\ncc")
    fd = os.open(f"{tmp}/a.log", os.O_RDONLY)
    try:
        assert aligned_end(fd, 0, 7, 12) == 5  # back to the last newline
        assert aligned_end(fd, 5, 7, 12) == 10  # cap inside a line: extend
        assert aligned_end(fd, 10, 12, 12) == 10  # half-written tail: hold
        assert aligned_end(fd, 0, 0, 12) == 0
    finally:
        os.close(fd)


def test_truncate_then_reread(tmp):
    write(f"{tmp}/a.log", b"1\n2\n3\n")
    t = Tail(cfg(f"{tmp}/a\\.log", **{"md5.check.enabled": "false"}))
    assert t.drain() == ["1", "2", "3"]
    with open(f"{tmp}/a.log", "r+b") as f:
        f.truncate(2)
    assert t.batch() == []
    assert t.offset("a.log") == 0
    assert t.drain() == ["1"]


def test_delete_and_recreate_is_new(tmp):
    write(f"{tmp}/a.log", b"old\n")
    write(f"{tmp}/b.log", b"keep\n")
    t = Tail(cfg(f"{tmp}/[ab]\\.log"))
    assert sorted(t.drain()) == ["keep", "old"]
    os.remove(f"{tmp}/a.log")
    t.batch()
    assert t.offset("a.log") is None
    write(f"{tmp}/a.log", b"new\n")
    assert t.batch() == []  # registered at 0 first
    assert t.drain() == ["new"]


def test_latest_starts_at_tail_and_reads_completed_half_line(tmp):
    write(f"{tmp}/a.log", b"old1\nold2\nhal")
    t = Tail(cfg(f"{tmp}/a\\.log", **{"starting.offsets": "latest"}))
    assert t.drain() == []
    assert t.offset("a.log") == 10
    write(f"{tmp}/a.log", b"f\nnew\n", "ab")
    assert t.drain() == ["half", "new"]


def test_unlisted_node_is_carried(tmp):
    write(f"{tmp}/n1/a.log", b"x\n")
    write(f"{tmp}/n2/a.log", b"y\n")
    t = Tail(cfg(f"{tmp}/{{node}}/a\\.log"))
    assert sorted(t.drain()) == ["x", "y"]
    os.chmod(f"{tmp}/n2", 0)
    try:
        if os.access(f"{tmp}/n2", os.R_OK):  # root reads anyway: fake the I/O error
            from appendlog.streaming import source

            orig = source.list_dir
            source.list_dir = lambda spec, node: None if node == "n2" else orig(spec, node)
            try:
                t.batch()
            finally:
                source.list_dir = orig
        else:
            t.batch()
        assert t.offset("a.log", "n2") == 2
    finally:
        os.chmod(f"{tmp}/n2", 0o755)


def test_hidden_and_directories_not_selected(tmp):
    write(f"{tmp}/.a.log", b"h\n")
    write(f"{tmp}/_a.log", b"u\n")
    os.makedirs(f"{tmp}/d.log")
    write(f"{tmp}/a.log", b"v\n")
    t = Tail(cfg(f"{tmp}/.*\\.log"))
    assert t.drain() == ["v"]


def test_chunk_offsets_two_levels(spark):
    from checks.corpus import chunk_offsets

    rows = [("n", "f", c, (c * 7) % 13 + 1) for c in range(50)] + [("n", "g", c, 5) for c in range(3)]
    df = spark.createDataFrame(rows, "node string, name string, chunk long, chunk_bytes long")
    got = {(r.name, r.chunk): r.base for r in chunk_offsets(df, fanout=4).collect()}
    for f in ("f", "g"):
        acc = 0
        for n, name, c, b in [r for r in rows if r[1] == f]:
            assert got[(f, c)] == acc
            acc += b


def test_replaced_after_planning_fails_clearly(tmp):
    from appendlog.sources.pathspec import AppendLogError
    from appendlog.streaming.source import FileRange, read_range

    write(f"{tmp}/a.log", b"A" * 20 + b"\n")
    t = Tail(cfg(f"{tmp}/a\\.log", **{"md5.sample.length": 8}))
    end = t.planner.plan(t.pos)
    md5 = end["offsets"]["local"]["a.log"]["md5"]
    write(f"{tmp}/a.log", b"B" * 20 + b"\n")  # replaced between planning and reading
    with pytest.raises(AppendLogError, match="replaced after range"):
        list(read_range(FileRange("local", f"{tmp}/a.log", 0, 21, 0, 21, md5, 8)))


def test_short_read_names_the_file(tmp):
    from appendlog.streaming.source import FileRange, read_range

    write(f"{tmp}/a.log", b"abc\n")
    with pytest.raises(IOError, match="short read in .*a.log"):
        list(read_range(FileRange("local", f"{tmp}/a.log", 0, 40, 0, 40, "", 0)))


def test_line_longer_than_chunk(tmp):
    body = b"a\n" + b"x" * 50 + b"\n" + b"y" * 7 + b"\nlast\n"
    write(f"{tmp}/a.log", body)
    fd = os.open(f"{tmp}/a.log", os.O_RDONLY)
    try:
        for chunk in (1, 3, 8, 64):
            for hi in range(1, len(body) + 1):
                got = []
                for a in iter_line_arrays(fd, 0, hi, 0, len(body), chunk=chunk):
                    got += a.to_pylist()
                for a in iter_line_arrays(fd, hi, len(body), 0, len(body), chunk=chunk):
                    got += a.to_pylist()
                assert got == ["a", "x" * 50, "y" * 7, "last"], (chunk, hi)
    finally:
        os.close(fd)


def test_pack_bounds_bytes_and_files():
    from appendlog.streaming.source import FileRange, pack

    pieces = [FileRange("n", f"/p{i}", 0, s, 0, s, "", 0) for i, s in enumerate([100, 60, 50, 40] + [1] * 600)]
    bins = pack(pieces, target=100, max_files=256)
    assert all(sum(p.hi - p.lo for p in b.pieces) <= 100 for b in bins)
    assert all(len(b.pieces) <= 256 for b in bins)
    assert sorted(p.path for b in bins for p in b.pieces) == sorted(p.path for p in pieces)


def test_file_unreadable_after_listing_keeps_its_position(tmp):
    from appendlog.streaming import source

    write(f"{tmp}/a.log", b"x\n")
    write(f"{tmp}/b.log", b"b1\n")
    t = Tail(cfg(f"{tmp}/[ab]\\.log"))
    assert sorted(t.batch()) == ["b1", "x"]
    os.remove(f"{tmp}/b.log")
    orig = source.list_dir
    # the listing still has b.log
    source.list_dir = lambda spec, node: orig(spec, node) + [("b.log", 10, 1, 1)]
    try:
        assert t.batch() == []
    finally:
        source.list_dir = orig
    assert t.offset("b.log") == 3 and t.offset("a.log") == 2
    t.batch()  # a listing without it: now it is deleted
    assert t.offset("b.log") is None


def test_unreadable_head_is_carried_not_deleted(spark, tmp, monkeypatch):
    """ENOENT, a shrunk file and an I/O error on the head read keep the offset."""
    from appendlog.operators.state import state_from_plan
    from appendlog.plans.planner import align, plan
    from appendlog.sources import catalog
    from appendlog.sources.pathspec import parse_path

    for n in ("gone", "shrunk", "fine"):
        write(f"{tmp}/{n}.log", b"0123456789abcdef\nmore\n")
    spec = parse_path(f"{tmp}/[a-z]+\\.log")
    before = catalog.snapshot(spark, spec, 16)
    state = spark.createDataFrame([(r.node, r.name, r.size, r.md5) for r in before.collect()],
                                  "node string, name string, offset long, md5 string")
    files = catalog.list_files(spark, spec)
    listed = spark.createDataFrame(files.collect(), files.schema)
    os.remove(f"{tmp}/gone.log")
    write(f"{tmp}/shrunk.log", b"01")
    monkeypatch.setattr(catalog, "list_files", lambda *_: listed)
    now = catalog.snapshot(spark, spec, 16)
    assert {r.name: r.md5 is None for r in now.collect()} == {"gone.log": True, "shrunk.log": True, "fine.log": False}
    p = align(plan(now, state, catalog.list_nodes(spark, spec)))
    assert {r.name: r.status for r in p.collect()} == {
        "gone.log": "carried", "shrunk.log": "carried", "fine.log": "unchanged"}
    assert sorted((r.name, r.offset, r.md5) for r in state_from_plan(p).collect()) == sorted(
        (r.name, r.offset, r.md5) for r in state.collect())
    # unknown and unreadable: registers only once it can be read
    fresh = plan(now, state.where("name <> 'gone.log'"), catalog.list_nodes(spark, spec))
    assert {r.name for r in fresh.collect()} == {"shrunk.log", "fine.log"}


@pytest.mark.parametrize("lo_hi", [256 << 10, 4 << 20, 100])
def test_subranges_read_little_beyond_their_own_bytes(tmp, monkeypatch, lo_hi):
    from appendlog.functions import bytescan, linescan

    long = b"L" * (3 * lo_hi) + b"\n"
    body = (b"x" * 70 + b"\n") * (4 * lo_hi // 71) + long + (b"y" * 50 + b"\n") * (4 * lo_hi // 51)
    write(f"{tmp}/a.log", body)
    fd, reads = os.open(f"{tmp}/a.log", os.O_RDONLY), []
    real = bytescan.read_exact

    def counted(fd, offset, length, path="?"):
        reads.append(length)
        return real(fd, offset, length, path)

    monkeypatch.setattr(linescan, "read_exact", counted)
    monkeypatch.setattr(bytescan, "read_exact", counted)
    try:
        got = []
        for lo in range(0, len(body), lo_hi):
            for arr in linescan.iter_line_arrays(fd, lo, min(len(body), lo + lo_hi), 0, len(body)):
                got += arr.to_pylist()
    finally:
        os.close(fd)
    assert got == body.decode().split("\n")[:-1]
    # each sub-range: its bytes, two short searches, and the rest of its last line once
    n = -(-len(body) // lo_hi)
    assert sum(reads) <= 1.1 * len(body) + 1.5 * len(long) + n * 2 * bytescan.FIRST_BLOCK * 1.1


def test_other_stores_are_refused(spark, tmp):
    from appendlog.operators.increment import run_increment
    from appendlog.sources.pathspec import AppendLogError, parse_path
    from appendlog.streaming.backup import TableBackup

    with pytest.raises(AppendLogError, match="POSIX"):
        parse_path("hdfs://nn/logs/a\\.log")
    assert parse_path(f"file://{tmp}/a\\.log").directory == tmp
    with pytest.raises(ValueError, match="POSIX"):
        TableBackup("hdfs://nn/backup")
    assert TableBackup(f"file://{tmp}/b").path == f"{tmp}/b"
    with pytest.raises(ValueError, match="POSIX"):
        run_increment(spark, f"{tmp}/a\\.log", "s3a://b/state", f"{tmp}/out")


def test_task_counts_follow_the_bytes(spark):
    from appendlog.operators.ranges import LEAST_SPLIT_BYTES, SPLIT_BYTES, read_ranges, split_size

    assert split_size(0) == LEAST_SPLIT_BYTES and split_size(1 << 50) == SPLIT_BYTES
    rows = [("n", f"f{i}", "p", 0, 10 << 20) for i in range(7)]
    df = spark.createDataFrame(rows, "node string, name string, path string, start_offset long, end_offset long")
    assert read_ranges(df).rdd.getNumPartitions() == 18  # 70 MiB in splits of 4
    assert read_ranges(df, split_bytes=35 << 20).rdd.getNumPartitions() == 2
    assert read_ranges(df, work=(0, 1000)).rdd.getNumPartitions() == 4


def test_warnings_for_replaced_and_truncated_files(tmp, caplog):
    write(f"{tmp}/r.log", b"first head of it\nx\n")
    write(f"{tmp}/t.log", b"one\ntwo\nthree\n")
    t = Tail(cfg(f"{tmp}/[rt]\\.log", **{"md5.sample.length": 8}))
    t.drain()
    write(f"{tmp}/r.log", b"other head of it\nxyz\n")
    with open(f"{tmp}/t.log", "r+b") as f:
        f.truncate(8)
    with caplog.at_level("WARNING", logger="appendlog"):
        t.drain()
    said = [r.getMessage() for r in caplog.records]
    assert sum("r.log was replaced" in m for m in said) == 1 and sum("t.log was truncated" in m for m in said) == 1


def test_node_appearing_later_is_read_from_start(tmp):
    write(f"{tmp}/n1/a.log", b"one\n")
    t = Tail(cfg(f"{tmp}/{{node}}/a\\.log", **{"starting.offsets": "latest"}))
    assert t.drain() == []  # latest: existing content skipped
    write(f"{tmp}/n2/a.log", b"early\nlater\n")  # a new host folder after the start
    assert t.batch() == []  # registered at 0 (not a first run any more)
    assert t.offset("a.log", "n2") == 0
    assert t.drain() == ["early", "later"]


def test_alignment_across_growing_blocks(tmp):
    long = b"L" * 300_000
    body = b"head\n" + long + b"\n" + b"tail\n"
    write(f"{tmp}/a.log", body)
    fd = os.open(f"{tmp}/a.log", os.O_RDONLY)
    try:
        n = len(body)
        assert aligned_end(fd, 0, 5 + 200_000, n) == 5  # back across several blocks
        assert aligned_end(fd, 5, 5 + 10, n) == 5 + len(long) + 1  # forward across several blocks
        assert aligned_end(fd, 5 + len(long) + 1, n, n) == n
    finally:
        os.close(fd)
    t = Tail(cfg(f"{tmp}/a\\.log", **{"bytes.max": 1000}))
    assert t.drain() == ["head", "L" * 300_000, "tail"]
