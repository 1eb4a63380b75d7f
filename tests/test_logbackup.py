"""Offset backup as a run log: rows per batch, late events, per-node recovery."""

import json

from appendlog.operators.state import from_offset_lines, merge_by_node, to_offset_lines
from appendlog.streaming.backup import LogBackup, recover_by_node

S = "/logs/{node}/.*"


def doc(**nodes):
    return json.dumps({"directory": "/logs/{node}", "offsets": {
        n: {f: {"offset": o, "md5": m} for f, (o, m) in files.items()} for n, files in nodes.items()}}, sort_keys=True)


def test_a_batch_adds_the_rows_it_moved(spark, tmp):
    store = LogBackup(spark, f"{tmp}/b")
    assert store.fetch(spark, S) is None
    files = {f"f{i:04d}": (i, "m") for i in range(2000)}
    store.store(S, 100, doc(n1=files, n2={}))
    moved = {**files, "f0001": (70, "m"), "f0002": (71, "x")}
    del moved["f0003"]
    store.store(S, 200, doc(n1=moved, n2={}))
    log = store.log(S)
    assert [r.rows for r in log.runs(log.version())] == [2002, 3]
    assert store.fetch(spark, S) == (200, doc(n1=moved, n2={}))
    store.store(S, 300, doc(n1=moved, n2={}))  # nothing moved
    assert log.version() == 1
    store.store(S, 150, doc(n1=files, n2={}))  # an event that comes late
    assert store.fetch(spark, S) == (200, doc(n1=moved, n2={}))
    # another application goes on from what is kept
    other = LogBackup(spark, f"{tmp}/b")
    other.store(S, 400, doc(n1={"f0001": (80, "m")}, n2={"a": (1, "")}))
    assert other.fetch(spark, S) == (400, doc(n1={"f0001": (80, "m")}, n2={"a": (1, "")}))
    assert other.fetch(spark, S + "#name") is None


def test_credits_are_kept(spark, tmp):
    store = LogBackup(spark, f"{tmp}/b")
    text = json.dumps({"directory": "d", "offsets": {"n": {"a": {"credit": -7, "md5": "", "offset": 9}}}}, sort_keys=True)
    store.store(S, 1, text)
    assert store.fetch(spark, S) == (1, text)


def test_two_backups_ahead_on_different_nodes(spark, tmp):
    one, two = LogBackup(spark, f"{tmp}/1"), LogBackup(spark, f"{tmp}/2")
    assert recover_by_node(spark, one, two, S) is None
    for s in (one, two):
        s.store(S, 100, doc(a={"x": (1, "m")}, b={"y": (1, "m")}, c={"z": (1, "m")}))
    one.store(S, 200, doc(a={"x": (5, "m")}, b={"y": (1, "m")}, c={"z": (1, "m")}))
    two.store(S, 300, doc(a={"x": (1, "m")}, b={"y": (6, "m"), "new": (2, "")}, c={}))  # z was deleted
    want = {"a": {"x": {"offset": 5, "md5": "m"}}, "b": {"y": {"offset": 6, "md5": "m"}, "new": {"offset": 2, "md5": ""}}, "c": {}}
    for pair in ((one, two), (two, one)):
        assert json.loads(recover_by_node(spark, *pair, S))["offsets"] == want
    empty = LogBackup(spark, f"{tmp}/3")
    assert json.loads(recover_by_node(spark, empty, two, S)) == json.loads(two.fetch(spark, S)[1])


def test_merge_ties_keep_the_local_store(spark):
    schema = "node string, name string, offset bigint, md5 string, version bigint"
    local = spark.createDataFrame([("a", "x", 1, "", 5), ("b", "x", 1, "", 4)], schema)
    shared = spark.createDataFrame([("a", "x", 2, "", 5), ("b", "x", 2, "", 9), ("c", "x", 2, "", 0)], schema)
    got = {(r.node, r.name): r.offset for r in merge_by_node(local, shared).collect()}
    assert got == {("a", "x"): 1, ("b", "x"): 2, ("c", "x"): 2}


def test_offset_lines_round_trip(spark):
    rows = [("n", "a\"b\\c", 5, "m"), ("n", "é\n", 0, ""), ("m", None, None, None)]
    state = spark.createDataFrame(rows, "node string, name string, offset bigint, md5 string")
    back = from_offset_lines(to_offset_lines(state, "/d/{node}")).collect()
    assert sorted(((r.node, r.name, r.offset, r.md5) for r in back), key=str) == sorted(rows, key=str)
    assert {r.directory for r in back} == {"/d/{node}"}
