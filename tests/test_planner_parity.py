"""The Column planner and the Python twin agree row for row (decision table)."""

import itertools


from appendlog.plans import rules as R
from appendlog.plans.planner import plan
from appendlog.sources.catalog import node_frame

CAP = 10


def grid():
    rows = []
    i = 0
    for known, kmd5, size, md5 in itertools.product(
        [None, 0, 5, 20, 25], ["", "A", None], [None, 0, 20], ["", "A", "B"],
    ):
        if known is None and kmd5 is not None:
            continue
        if known is not None and kmd5 is None:
            continue
        if size is None and md5 != "":
            continue
        if known is None and size is None:
            continue
        for listed in (True, False):
            if not listed and known is None:
                continue
            rows.append((f"n{i}", f"f{i}", known, kmd5, size, md5, listed))
            i += 1
    return rows


def test_parity(spark):
    rows = grid()
    listing = spark.createDataFrame(
        [(n, f, s, m, None) for n, f, k, km, s, m, l in rows if s is not None],
        "node string, name string, size bigint, md5 string, path string")
    state = spark.createDataFrame(
        [(n, f, k, km) for n, f, k, km, s, m, l in rows if k is not None],
        "node string, name string, offset bigint, md5 string")
    nodes = node_frame(spark, [n for n, f, k, km, s, m, l in rows if l])
    for first_run, policy, check in itertools.product([True, False], ["earliest", "latest"], [True, False]):
        got = {
            (r.node, r.name): (r.status, r.start_offset, r.end_offset, r.md5, r.align)
            for r in plan(listing, state, nodes, policy=policy, cap=CAP, check=check,
                          first_run=first_run).collect()
        }
        for n, f, k, km, s, m, listed in rows:
            d = R.decide(k, km, s, m if s is not None else None, node_listed=listed,
                         first_run=first_run, policy=policy, cap=CAP, check=check)
            want = (d.status, d.start, d.end, d.md5, d.align)
            assert got[(n, f)] == want, (n, k, km, s, m, listed, first_run, policy, check)


def test_decision_table_rows():
    kw = dict(first_run=False, policy="earliest", cap=CAP, check=True)
    assert R.decide(5, "A", None, None, node_listed=True, **kw).status == R.DELETED
    assert R.decide(5, "A", None, None, node_listed=False, **kw)[:3] == (R.CARRIED, 5, 5)
    assert R.decide(None, None, 30, "A", node_listed=True, first_run=True, policy="earliest",
                    cap=CAP, check=True)[:3] == (R.NEW, 0, 10)
    assert R.decide(None, None, 30, "A", node_listed=True, first_run=True, policy="latest",
                    cap=CAP, check=True)[:3] == (R.NEW, 30, 30)
    assert R.decide(None, None, 30, "A", node_listed=True, **kw)[:3] == (R.NEW, 0, 0)
    assert R.decide(5, "A", 30, "B", node_listed=True, **kw)[:3] == (R.REPLACED, 0, 0)
    assert R.decide(5, "A", 30, "B", node_listed=True, first_run=False, policy="earliest",
                    cap=CAP, check=False)[:3] == (R.APPENDED, 5, 15)
    assert R.decide(31, "A", 30, "A", node_listed=True, **kw)[:3] == (R.TRUNCATED, 0, 0)
    assert R.decide(30, "A", 30, "A", node_listed=True, **kw)[:3] == (R.UNCHANGED, 30, 30)
    assert R.decide(25, "A", 30, "A", node_listed=True, **kw)[:3] == (R.APPENDED, 25, 30)
    assert R.decide(5, "", 30, "A", node_listed=True, **kw)[:3] == (R.APPENDED, 5, 15)


def test_empty_state_skips_the_join_with_same_result(spark):
    from appendlog.operators.state import empty_state

    listing = spark.createDataFrame(
        [("a", "f1", 30, "x", None), ("b", "f2", 0, "", None)],
        "node string, name string, size bigint, md5 string, path string")
    nodes = node_frame(spark, ["a", "b", "c"])
    unregistered = spark.createDataFrame([], "node string, name string, offset bigint, md5 string")
    for policy in ("earliest", "latest"):
        fast = plan(listing, empty_state(spark), nodes, policy=policy, cap=CAP)
        assert "SortMergeJoin" not in fast._jdf.queryExecution().executedPlan().toString()
        slow = plan(listing, unregistered, nodes, policy=policy, cap=CAP)
        assert sorted(fast.collect()) == sorted(slow.collect())
