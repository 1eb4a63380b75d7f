"""Structured Streaming runs of the appendlog source."""

import json
import os

import pytest

from appendlog.operators.state import newer_of
from appendlog.streaming.backup import TableBackup, get_backup
from appendlog.streaming.job import end_offset, read_stream, start_stream, stop_stream
from appendlog.sources.options import ReadConfig
from appendlog.sources.pathspec import AppendLogError
from tests.helpers import write


def values(spark, out):
    if not os.path.exists(out):
        return []
    return [r.value for r in spark.read.parquet(out).collect()]


def run(spark, path, out, ck, **opts):
    q = start_stream(spark, path, output=out, checkpoint=ck, trigger="0 seconds", **opts)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert q.exception() is None
    return q


def test_live_append_half_line_and_cap(spark, tmp):
    log = f"{tmp}/logs/n1/app.log"
    write(log, b"a1\na2\npart")
    q = start_stream(spark, f"{tmp}/logs/{{node}}/app\\.log", output=f"{tmp}/out", checkpoint=f"{tmp}/ck",
                     backup=False, trigger="0 seconds", **{"bytes.max": 4})
    try:
        q.processAllAvailable()
        assert sorted(values(spark, f"{tmp}/out")) == ["a1", "a2"]
        write(log, b"ial\n" + b"z" * 20 + b"\n", "ab")
        q.processAllAvailable()
        assert sorted(values(spark, f"{tmp}/out")) == ["a1", "a2", "partial", "z" * 20]
    finally:
        q.stop()


def test_restart_from_checkpoint_reads_each_line_once(spark, tmp):
    log = f"{tmp}/logs/app.log"
    write(log, b"".join(b"line%03d\n" % i for i in range(50)))
    path = f"{tmp}/logs/app\\.log"
    run(spark, path, f"{tmp}/out", f"{tmp}/ck", backup=False, **{"bytes.max": 64})
    write(log, b"".join(b"line%03d\n" % i for i in range(50, 80)), "ab")
    run(spark, path, f"{tmp}/out", f"{tmp}/ck", backup=False, **{"bytes.max": 64})
    assert sorted(values(spark, f"{tmp}/out")) == ["line%03d" % i for i in range(80)]


def test_replace_truncate_delete_recreate(spark, tmp):
    d = f"{tmp}/logs"
    write(f"{d}/r.log", b"r-old-" + b"x" * 80 + b"\n")
    write(f"{d}/t.log", b"t1\nt2\nt3\n")
    write(f"{d}/g.log", b"gone\n")
    path = f"{d}/[rtg]\\.log"
    opts = dict(backup=False, **{"md5.sample.length": 16})
    run(spark, path, f"{tmp}/out", f"{tmp}/ck", **opts)
    write(f"{d}/r.log", b"r-new-" + b"y" * 90 + b"\n")  # new head: replaced
    with open(f"{d}/t.log", "r+b") as f:  # same head, smaller: truncated
        f.truncate(3)
    os.remove(f"{d}/g.log")
    run(spark, path, f"{tmp}/out", f"{tmp}/ck", **opts)
    write(f"{d}/g.log", b"again\n")  # re-created: new
    run(spark, path, f"{tmp}/out", f"{tmp}/ck", **opts)
    assert sorted(values(spark, f"{tmp}/out")) == sorted([
        "r-old-" + "x" * 80, "t1", "t2", "t3", "gone",  # first incarnations
        "r-new-" + "y" * 90, "t1", "again",  # once per incarnation
    ])


def test_backup_then_start_without_checkpoint(spark, tmp):
    log = f"{tmp}/logs/app.log"
    write(log, b"one\ntwo\n")
    path = f"{tmp}/logs/app\\.log"
    bk = f"{tmp}/backup"
    q = start_stream(spark, path, output=f"{tmp}/out1", checkpoint=f"{tmp}/ck1", trigger="0 seconds",
                     **{"offset.backup.path": bk})
    q.processAllAvailable()
    stop_stream(q)  # stores the last offset before it returns
    _, newest = TableBackup(bk).fetch(spark, path)
    assert json.loads(newest)["offsets"]["local"]["app.log"]["offset"] == 8
    assert json.loads(newest) == end_offset(q)
    write(log, b"three\n", "ab")
    # a new checkpoint: starts from the backup, so only the new line is read
    run(spark, path, f"{tmp}/out2", f"{tmp}/ck2", **{"offset.backup.path": bk})
    assert values(spark, f"{tmp}/out2") == ["three"]


def test_fixed_schema(spark, tmp):
    write(f"{tmp}/a.log", b"x\n")
    from appendlog.streaming.job import register

    register(spark)
    df = spark.readStream.format("appendlog").schema("other int").option("path", f"{tmp}/a\\.log").load()
    with pytest.raises(Exception, match="fixed schema"):
        q = df.writeStream.format("noop").option("checkpointLocation", f"{tmp}/ck").start()
        try:
            q.processAllAvailable()
        finally:
            q.stop()


def test_unknown_provider_and_failed_construction(spark):
    from appendlog.streaming.backup import register_backup

    c = ReadConfig.from_options({"path": "/x/y", "offset.backup.provider": "nope"})
    with pytest.raises(AppendLogError, match="not registered"):
        get_backup(spark, c)

    def broken(spark, cfg):
        raise RuntimeError("boom")

    register_backup("broken", broken)
    c = ReadConfig.from_options({"path": "/x/y", "offset.backup.provider": "broken"})
    with pytest.raises(AppendLogError, match="could not be created: boom"):
        get_backup(spark, c)


def test_newer_of_prefers_newest_and_local_on_tie(spark):
    local = spark.createDataFrame([("d1", 5, "L5"), ("d2", 7, "L7")], "directory string, ts bigint, offset_json string")
    shared = spark.createDataFrame([("d1", 9, "S9"), ("d2", 7, "S7")], "directory string, ts bigint, offset_json string")
    got = {r.directory: r.offset_json for r in newer_of(local, shared).collect()}
    assert got == {"d1": "S9", "d2": "L7"}


def test_failed_batch_is_replayed_with_same_ranges(spark, tmp):
    log = f"{tmp}/logs/app.log"
    write(log, b"".join(b"r%02d\n" % i for i in range(30)))
    marker = f"{tmp}/failed-once"
    out = f"{tmp}/fb"

    def sink(df, batch_id):
        if batch_id == 1 and not os.path.exists(marker):
            open(marker, "w").close()
            raise RuntimeError("sink failure")
        df.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    def start():
        return (read_stream(spark, f"{tmp}/logs/app\\.log", **{"bytes.max": 40, "offset.backup.provider": "none"})
                .writeStream.foreachBatch(sink).option("checkpointLocation", f"{tmp}/ck")
                .trigger(processingTime="0 seconds").start())

    q = start()
    with pytest.raises(Exception):
        q.processAllAvailable()
    q.stop()
    q = start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = sorted(r.value for r in spark.read.parquet(out).collect())
    assert got == ["r%02d" % i for i in range(30)]


def test_recover_picks_newer_store(spark, tmp):
    from appendlog.streaming.backup import recover

    a, b = TableBackup(f"{tmp}/a"), TableBackup(f"{tmp}/b")
    a.store("/d", 10, '{"directory": "/d", "offsets": {"x": {}}}')
    b.store("/d", 20, '{"directory": "/d", "offsets": {"y": {}}}')
    b.store("/e", 99, '{"directory": "/e", "offsets": {}}')
    assert json.loads(recover(spark, a, b, "/d"))["offsets"] == {"y": {}}
    a.store("/d", 20, '{"directory": "/d", "offsets": {"z": {}}}')
    assert json.loads(recover(spark, a, b, "/d"))["offsets"] == {"z": {}}


def test_stream_lag_and_snapshot_reuse(spark, tmp):
    from appendlog.sources.catalog import snapshot
    from appendlog.sources.pathspec import parse_path
    from appendlog.streaming.job import stream_lag

    write(f"{tmp}/logs/a.log", b"x" * 99 + b"\n")
    write(f"{tmp}/logs/b.log", b"y\n")
    path = f"{tmp}/logs/[ab]\\.log"
    offset = {"directory": f"{tmp}/logs", "offsets": {"local": {"a.log": {"offset": 40, "md5": ""}}}}
    lag = {r.name: (r.status, r.bytes_behind) for r in stream_lag(spark, offset, path).collect()}
    assert lag == {"a.log": ("appended", 60), "b.log": ("new", 2)}

    spec = parse_path(path)
    first = snapshot(spark, spec, 16).cache()
    assert first.count() == 2
    write(f"{tmp}/logs/b.log", b"z" * 30 + b"\n", "ab")
    again = {r.name: r for r in snapshot(spark, spec, 16, previous=first).collect()}
    old = {r.name: r for r in first.collect()}
    assert again["a.log"].md5 == old["a.log"].md5 != ""
    assert again["b.log"].size == 33 and again["b.log"].md5 != ""


def test_console_query(spark, tmp):
    from appendlog.streaming.job import console_query

    write(f"{tmp}/logs/app.log", b"hello console\n")
    q = console_query(spark, f"{tmp}/logs/app\\.log", f"{tmp}/ck", trigger="0 seconds",
                      **{"offset.backup.path": f"{tmp}/bk"})
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert q.exception() is None
    assert sum(p["numInputRows"] for p in q.recentProgress) == 1


def test_offset_json_keeps_empty_nodes_and_parses_stream_offsets(spark):
    from appendlog.operators.state import from_offset_json, to_offset_json
    from appendlog.streaming.source import normalize

    rows = [("n1", "a.log", 10, "m1"), ("n1", "b.log", 0, ""), ("n2", None, None, None)]
    state = spark.createDataFrame(rows, "node string, name string, offset bigint, md5 string")
    docs = to_offset_json(state, "/d")
    doc = json.loads(docs.first().offset_json)
    assert doc == {"directory": "/d", "offsets": {"n1": {"a.log": {"offset": 10, "md5": "m1"},
                                                          "b.log": {"offset": 0, "md5": ""}}, "n2": {}}}
    back = sorted(tuple(r) for r in from_offset_json(docs).select("node", "name", "offset", "md5").collect())
    assert back == sorted(rows, key=lambda r: (r[0], r[1] or ""))
    # the stream's own offset dict reads the same way
    stream_doc = json.dumps(normalize(doc))
    again = from_offset_json(spark.createDataFrame([(stream_doc,)], "offset_json string"))
    assert sorted(tuple(r) for r in again.select("node", "name", "offset", "md5").collect()) == back


def test_table_backup_keeps_newest_records(spark, tmp):
    t = TableBackup(f"{tmp}/bk")
    for ts in range(1, 21):
        t.store("/d", ts, json.dumps({"directory": "/d", "offsets": {"n": {"f": {"offset": ts, "md5": ""}}}}))
    t.store("/other", 5, json.dumps({"directory": "/other", "offsets": {}}))
    files = [n for n in os.listdir(f"{tmp}/bk") if n.endswith(".json")]
    assert len(files) == 16 + 1
    ts, doc = t.fetch(spark, "/d")
    assert ts == 20 and json.loads(doc)["offsets"]["n"]["f"]["offset"] == 20
    assert t.fetch(spark, "/missing") is None
    # a clock that stepped back: the record just written stays, the newest by time wins
    for ts in (3, 2, 1):
        t.store("/d", ts, "{}")
    assert t.fetch(spark, "/d")[0] == 20
    assert {1, 2, 3} <= {r.ts for r in t.rows(spark).where("directory = '/d'").collect()}


def test_recover_takes_the_newer_of_two_stores(spark, tmp):
    from appendlog.streaming.backup import OffsetBackup, recover

    class Fixed(OffsetBackup):
        def __init__(self, record):
            self.record = record

        def store(self, stream, ts, offset_json):
            self.record = (ts, offset_json)

        def fetch(self, spark, stream):
            return self.record

    table = TableBackup(f"{tmp}/bk")
    table.store("s", 50, "table")
    assert recover(spark, Fixed((1, "old")), Fixed((99, "new")), "s") == "new"
    assert recover(spark, Fixed((99, "custom")), table, "s") == "custom"
    assert recover(spark, Fixed((7, "custom")), table, "s") == "table"
    assert recover(spark, Fixed((50, "local")), table, "s") == "local"  # a tie keeps the local one
    assert recover(spark, Fixed(None), Fixed(None), "s") is None


def test_streams_over_one_folder_keep_their_own_offsets(spark, tmp):
    write(f"{tmp}/logs/a.log", b"a1\n")
    write(f"{tmp}/logs/b.log", b"b1\n")
    opts = {"offset.backup.path": f"{tmp}/bk"}
    for n in ("a", "b"):
        q = start_stream(spark, f"{tmp}/logs/{n}\\.log", output=f"{tmp}/{n}", checkpoint=f"{tmp}/ck-{n}",
                         trigger="0 seconds", **opts)
        q.processAllAvailable()
        stop_stream(q)
        assert values(spark, f"{tmp}/{n}") == [f"{n}1"]
    # the same path under another name, from a new checkpoint, starts at the beginning
    q = start_stream(spark, f"{tmp}/logs/a\\.log", output=f"{tmp}/again", checkpoint=f"{tmp}/ck-again",
                     trigger="0 seconds", **opts, **{"stream.name": "second"})
    q.processAllAvailable()
    stop_stream(q)
    assert values(spark, f"{tmp}/again") == ["a1"]


def test_many_small_files_packed_exactly_once(spark, tmp):
    from pyspark.sql import functions as F

    from checks.corpus import write_lines

    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    lines = ev.select(
        F.concat(F.lit("h"), (F.col("event_id") % 49).cast("string")).alias("node"),
        F.concat(F.lit("svc.log."), "event_type", F.expr("char(97 + event_id % 2)")).alias("name"),
        "event_id", F.concat_ws("|", F.col("event_id").cast("string"), "props").alias("line"))
    write_lines(spark, lines, f"{tmp}/logs", key="event_id")
    n_files = sum(len(fs) for _, _, fs in os.walk(f"{tmp}/logs"))
    assert n_files > 300
    q = run(spark, f"{tmp}/logs/{{node}}/svc\\.log\\.[a-z]+", f"{tmp}/out", f"{tmp}/ck", backup=False,
            **{"bytes.max": 40})
    assert sum(1 for p in q.recentProgress if p["numInputRows"] > 0) > 1
    want = sorted(r.line for r in lines.collect())
    assert sorted(values(spark, f"{tmp}/out")) == want


def test_batch_read_is_refused_clearly(spark, tmp):
    from appendlog.streaming.job import register

    register(spark)
    with pytest.raises(Exception, match="reads streams only"):
        spark.read.format("appendlog").option("path", f"{tmp}/x\\.log").load().collect()


def test_random_appends_through_spark_stream(spark, tmp):
    import random

    rnd = random.Random(7)
    alphabet = "ab é€😀\r"
    files = [f"{tmp}/logs/n{i % 2}/f{i}.log" for i in range(3)]
    for f in files:
        write(f, b"")
    pending = {f: "" for f in files}  # unterminated tail per file
    expected = []
    q = start_stream(spark, f"{tmp}/logs/{{node}}/f[0-9]\\.log", output=f"{tmp}/out", checkpoint=f"{tmp}/ck",
                     backup=False, trigger="0 seconds",
                     **{"bytes.max": 23, "split.bytes": 11, "md5.sample.length": 8})
    try:
        for _ in range(5):
            for f in files:
                chunk = "".join(rnd.choice(alphabet + "\n\n") for _ in range(rnd.randint(0, 40)))
                write(f, chunk.encode(), "ab")
                text = pending[f] + chunk
                *done, pending[f] = text.split("\n")
                expected += done
            q.processAllAvailable()
    finally:
        q.stop()
    assert q.exception() is None
    assert sorted(values(spark, f"{tmp}/out")) == sorted(expected)


def test_listeners_of_ended_queries_are_removed(spark, tmp):
    import time

    from appendlog.streaming import job

    write(f"{tmp}/logs/a.log", b"x\n")
    for i in range(3):
        run(spark, f"{tmp}/logs/a\\.log", f"{tmp}/out{i}", f"{tmp}/ck{i}", **{"offset.backup.path": f"{tmp}/bk"})
        for _ in range(300):  # termination events arrive on the listener bus
            if all(x.done for x in job._LISTENERS):
                break
            time.sleep(0.1)
    assert len(job._LISTENERS) <= 2


def test_stream_lag_of_a_running_query(spark, tmp):
    from appendlog.streaming.job import end_offset, stream_lag

    write(f"{tmp}/logs/a.log", b"x" * 9 + b"\n")
    path = f"{tmp}/logs/a\\.log"
    q = start_stream(spark, path, output=f"{tmp}/out", checkpoint=f"{tmp}/ck", backup=False, trigger="0 seconds")
    try:
        q.processAllAvailable()
        assert end_offset(q)["offsets"]["local"]["a.log"]["offset"] == 10
        write(f"{tmp}/logs/a.log", b"more\n", "ab")
        assert [(r.name, r.bytes_behind) for r in stream_lag(spark, q, path).collect()] == [("a.log", 5)]
    finally:
        q.stop()
