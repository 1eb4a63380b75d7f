"""The registered checks: each reads ``events`` of a scale folder, writes the
log corpus from it with Spark, and runs one part of appendlog over the files.

Settings are the fixed ones of the corpus: checksum sample 64 bytes, cap 200
bytes where the cap itself is checked (range planning); streams and incremental
batches take an eighth of the largest file they find, at every scale, so the
number of batches stays the same.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from appendlog.operators.increment import read_output, settle
from appendlog.operators.lineindex import extend, index_log, read_numbered
from appendlog.operators.manifest import NODE_ROW, offset_log, plan_step
from appendlog.operators.ranges import read_ranges
from appendlog.operators.runlog import RunLog
from appendlog.operators.state import (
    empty_state,
    bytes_behind as _bytes_behind,
    carry_forward as _carry_forward,
    from_offset_json,
    from_offset_lines,
    merge_by_node,
    to_offset_lines,
)
from appendlog.plans import rules as R
from appendlog.plans.planner import align, plan
from appendlog.session import materialize, scratch_dir, ship_package
from appendlog.sources.catalog import list_files, list_nodes, snapshot
from appendlog.sources.options import ReadConfig
from appendlog.sources.pathspec import parse_path
from appendlog.streaming.backup import LogBackup, TableBackup, latest_backup
from appendlog.streaming.job import drain, run_available, start_stream, stop_stream
from checks.corpus import write_lines, write_snapshot

# Fixed values of the checks.
PATTERN = r"service\.log\.[a-z]+"
SAMPLE = 64
CAP = 200
CAP_SHARE = 8
UNLISTED_NODE = "node3"
SNAPSHOTS = (0, 1, 2)

_CORPORA: dict[tuple[str, str], tuple[str, int]] = {}


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, "events.parquet"))


_COUNTS: dict[tuple[str, str], int] = {}


def _n_events(spark: SparkSession, sf_dir: str) -> int:
    """Row count of ``events`` (the snapshot rule needs it), once per app."""
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    if key not in _COUNTS:
        _COUNTS[key] = _events(spark, sf_dir).count()
    return _COUNTS[key]


def corpus(spark: SparkSession, sf_dir: str) -> tuple[str, int]:
    """The snapshots on disk, as ``<root>/s0`` to ``s2`` (once per app)."""
    ship_package(spark)
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    if key not in _CORPORA:
        events = _events(spark, sf_dir)
        n = _n_events(spark, sf_dir)
        root = scratch_dir(spark, "corpus")
        for v in SNAPSHOTS:
            write_snapshot(spark, events, f"{root}/s{v}", v, n_events=n)
        _CORPORA[key] = (root, n)
    return _CORPORA[key]


def _spec(root: str, v: int):
    return parse_path(f"{root}/s{v}/{{node}}/{PATTERN}")


def _state(snap: DataFrame) -> DataFrame:
    return snap.select("node", "name", F.col("size").alias("offset"), "md5")


def _planned(spark, sf_dir, *, unlisted: str | None = None, aligned: bool = True, cap: int = CAP,
             v: int = 1) -> DataFrame:
    """Snapshot ``v`` planned against the state after the snapshot before it."""
    root, _ = corpus(spark, sf_dir)
    listing = snapshot(spark, _spec(root, v), SAMPLE)
    state = _state(snapshot(spark, _spec(root, v - 1), SAMPLE))
    nodes = list_nodes(spark, _spec(root, v))
    if unlisted is not None:
        listing = listing.where(F.col("node") != unlisted)
        nodes = nodes.where(F.col("node") != unlisted)
    p = plan(listing, state, nodes, policy="earliest", cap=cap, check=True, first_run=False)
    return align(p) if aligned else p


def file_select(spark, sf_dir):
    root, _ = corpus(spark, sf_dir)
    names = list_files(spark, _spec(root, 0)).select("name").unionByName(
        list_files(spark, _spec(root, 1)).select("name"))
    return names.distinct()


def file_meta(spark, sf_dir):
    root, _ = corpus(spark, sf_dir)
    parts = [snapshot(spark, _spec(root, v), SAMPLE).select(
        F.lit(v).alias("v"), "node", "name", "size", "md5") for v in SNAPSHOTS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def file_status(spark, sf_dir):
    parts = [_planned(spark, sf_dir, aligned=False, v=v).select(F.lit(v).alias("v"), "node", "name", "status")
             for v in SNAPSHOTS[1:]]
    return parts[0].unionByName(parts[1])


def range_plan(spark, sf_dir):
    return _planned(spark, sf_dir).where(F.col("status") != R.DELETED).select(
        "node", "name", "status", "start_offset", "end_offset", "md5")


def range_plan_first(spark, sf_dir):
    root, _ = corpus(spark, sf_dir)
    spec = _spec(root, 1)
    listing = snapshot(spark, spec, SAMPLE)
    empty = empty_state(spark)
    nodes = list_nodes(spark, spec)
    out = []
    for policy in ("earliest", "latest"):
        p = align(plan(listing, empty, nodes, policy=policy, cap=CAP, check=True, first_run=True))
        out.append(p.select(F.lit(policy).alias("policy"), "node", "name", "start_offset", "end_offset"))
    return out[0].unionByName(out[1])


def range_lines(spark, sf_dir):
    """Every line of the last snapshot, whole files as ranges of one plan, and
    every line that snapshot 1 appended since snapshot 0, ranges that start
    inside their files."""
    root, _ = corpus(spark, sf_dir)
    spec = _spec(root, SNAPSHOTS[-1])
    p = align(plan(snapshot(spark, spec, SAMPLE), empty_state(spark), list_nodes(spark, spec), first_run=True))
    grown = _planned(spark, sf_dir, cap=largest(spark, _spec(root, 1)))
    return read_ranges(p, verify_sample=SAMPLE).unionByName(read_ranges(grown, verify_sample=SAMPLE))


def bytes_behind(spark, sf_dir):
    """Every file listed in snapshots 1 and 2, against the position after the one before."""
    parts = [_bytes_behind(_planned(spark, sf_dir, aligned=False, v=v)).select(
        F.lit(v).alias("v"), "node", "name", "status", "bytes_behind") for v in SNAPSHOTS[1:]]
    return parts[0].unionByName(parts[1])


def carry_forward(spark, sf_dir):
    return _carry_forward(_planned(spark, sf_dir, unlisted=UNLISTED_NODE))


def offset_roundtrip(spark, sf_dir):
    """Offsets of the last snapshot to JSON lines on disk, and back by a second job."""
    root, _ = corpus(spark, sf_dir)
    spec = _spec(root, SNAPSHOTS[-1])
    path = f"{scratch_dir(spark, 'offset-json')}/json"
    to_offset_lines(_state(snapshot(spark, spec, SAMPLE)), spec.directory).write.text(path)
    # a second job reads the text back, so encoding and decoding cannot cancel out
    docs = spark.read.schema("value string").text(path, wholetext=False)
    return from_offset_lines(docs, column="value").select("node", "name", "offset", "md5")


def _offset_store(spark, tag: str) -> RunLog:
    return RunLog(scratch_dir(spark, tag), ["node", "name"], "offset bigint, md5 string")


def offset_backup(spark, sf_dir):
    """The offsets of each snapshot are backed up as what changed since the one
    before (ts = v); the newest backup is read back and summed per node."""
    root, _ = corpus(spark, sf_dir)
    log = _offset_store(spark, "offset-backup")
    for v in SNAPSHOTS:
        log.sync(spark, _state(snapshot(spark, _spec(root, v), SAMPLE)), {"ts": v})
    ts = log.meta(log.version())["ts"]
    return log.rows(spark).groupBy(F.col("node").alias("directory")).agg(
        F.lit(ts).cast("bigint").alias("ts"), F.sum("offset").cast("bigint").alias("total_offset"))


def offset_newer(spark, sf_dir):
    """Two stores of backups: the local one holds snapshot 0 (a node's version =
    its file count there), the shared one snapshot 1; the newer wins for each
    node, ties keep the local one."""
    root, _ = corpus(spark, sf_dir)
    stores = []
    for v in (0, 1):
        log = _offset_store(spark, f"offset-newer-{v}")
        log.sync(spark, _state(snapshot(spark, _spec(root, v), SAMPLE)))
        rows = log.rows(spark)
        stores.append(rows.join(rows.groupBy("node").agg(F.count("name").alias("version")), "node"))
    return merge_by_node(*stores).groupBy(F.col("node").alias("directory")).agg(
        F.max("version").alias("ts"), F.sum("offset").cast("bigint").alias("total_offset"))


def offset_merge(spark, sf_dir):
    """Two backups of one stream that went ahead on different nodes: node0 and
    node1 reached snapshot 1 in the local one, node2 and node3 snapshot 2 in the
    shared one.  Merged, each node is where it was last seen."""
    root, _ = corpus(spark, sf_dir)
    states = {v: _state(snapshot(spark, _spec(root, v), SAMPLE)) for v in SNAPSHOTS}
    stores = []
    for v, ahead in ((1, ("node0", "node1")), (2, ("node2", "node3"))):
        log = _offset_store(spark, f"offset-merge-{v}")
        log.sync(spark, states[0])
        log.sync(spark, states[v].where(F.col("node").isin(*ahead)).unionByName(states[0].where(~F.col("node").isin(*ahead))))
        stores.append(log.stamped(spark))
    return merge_by_node(*stores).select("node", "name", "offset", "md5")


def largest(spark: SparkSession, spec) -> int:
    """Size of the largest listed file."""
    return list_files(spark, spec).agg(F.max("size")).first()[0] or 1


def _stream_cap(spark: SparkSession, spec) -> int:
    return max(1, largest(spark, spec) // CAP_SHARE)


def _run_stream(spark, path, out, ck, **options) -> None:
    q = start_stream(spark, path, output=out, checkpoint=ck, backup=False, trigger="0 seconds",
                     **{"md5.sample.length": SAMPLE, "offset.backup.provider": "none", **options})
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    if q.exception() is not None:
        raise q.exception()


def stream_drain(spark, sf_dir):
    """The last snapshot drained by a stream under the cap (the files are only read)."""
    root, _ = corpus(spark, sf_dir)
    base = scratch_dir(spark, "stream-drain")
    spec = _spec(root, SNAPSHOTS[-1])
    _run_stream(spark, spec.path, f"{base}/out", f"{base}/ck", **{"bytes.max": _stream_cap(spark, spec)})
    return spark.read.parquet(f"{base}/out")


def stream_backup(spark, sf_dir):
    """The last snapshot drained with offsets backed up by the query listener (table
    provider); the newest backed-up offset, read back, sums to the file sizes."""
    root, _ = corpus(spark, sf_dir)
    base = scratch_dir(spark, "stream-backup")
    path = _spec(root, SNAPSHOTS[-1]).path
    opts = {"md5.sample.length": SAMPLE, "bytes.max": _stream_cap(spark, _spec(root, SNAPSHOTS[-1])),
            "offset.backup.path": f"{base}/backup"}
    q = start_stream(spark, path, output=f"{base}/out", checkpoint=f"{base}/ck", trigger="0 seconds", **opts)
    try:
        q.processAllAvailable()
    finally:
        stop_stream(q)
    rows = from_offset_json(latest_backup(TableBackup(f"{base}/backup").rows(spark)))
    return rows.groupBy("node").agg(F.sum("offset").cast("bigint").alias("total_offset"))


def _grown(spark, sf_dir, tag, step, **options):
    """Each snapshot written in place over the one before and read by ``step``."""
    events = _events(spark, sf_dir)
    n = _n_events(spark, sf_dir)
    base = scratch_dir(spark, tag)
    spec = parse_path(f"{base}/logs/{{node}}/{PATTERN}")
    for v in SNAPSHOTS:
        write_snapshot(spark, events, f"{base}/logs", v, n_events=n)
        step(spec.path, base, **{"bytes.max": _stream_cap(spark, spec), **options})
    return base


def stream_increment(spark, sf_dir):
    """All files of all snapshots through one stream, restarted from its
    checkpoint after each: appended tails, replaced, truncated, new, deleted
    and re-created files."""
    base = _grown(spark, sf_dir, "stream-increment", lambda path, base, **o: _run_stream(
        spark, path, f"{base}/out", f"{base}/ck", **o))
    return spark.read.parquet(f"{base}/out")


def stream_latest(spark, sf_dir):
    """The same from the end of what is there at first."""
    base = _grown(spark, sf_dir, "stream-latest", lambda path, base, **o: _run_stream(
        spark, path, f"{base}/out", f"{base}/ck", **o), **{"starting.offsets": "latest"})
    return spark.read.parquet(f"{base}/out")


def batch_increment(spark, sf_dir):
    """The stream_increment scenario with DataFrame batches instead of a stream."""
    base = _grown(spark, sf_dir, "batch-increment", lambda path, base, **o: settle(
        spark, path, f"{base}/state", f"{base}/out", **o), **{"md5.sample.length": SAMPLE})
    return read_output(spark, f"{base}/out", f"{base}/state")


def stream_log_backup(spark, sf_dir):
    """All snapshots through one stream with the log provider: after each
    batch the rows of the files that it moved; read back, they are the positions."""
    backup = {}

    def step(path, base, **o):
        backup["store"] = LogBackup(spark, f"{base}/backup")
        backup["stream"] = path
        q = start_stream(spark, path, output=f"{base}/out", checkpoint=f"{base}/ck", trigger="0 seconds",
                         **{"md5.sample.length": SAMPLE, "offset.backup.provider": "log",
                            "offset.backup.path": f"{base}/backup", **o})
        try:
            q.processAllAvailable()
        finally:
            stop_stream(q)

    _grown(spark, sf_dir, "stream-log-backup", step)
    rows = backup["store"].rows(spark, backup["stream"])
    return rows.where(~F.col("gone") & (F.col("name") != "")).select("node", "name", "offset", "md5")


def _run_manifest(spark, path, base, **options) -> None:
    q = start_stream(spark, path, output=f"{base}/out", checkpoint=f"{base}/ck", backup=False, trigger="0 seconds",
                     **{"md5.sample.length": SAMPLE, "offset.backup.provider": "none", "catalog": "manifest",
                        "catalog.path": f"{base}/manifest", **options})
    try:
        drain(q)
    finally:
        stop_stream(q)
    if q.exception() is not None:
        raise q.exception()


def manifest_stream(spark, sf_dir):
    """The stream_increment scenario with the listing and planning done by Spark
    jobs over the manifest: the stream's offset is a version number."""
    base = _grown(spark, sf_dir, "manifest-stream", lambda path, base, **o: _run_manifest(spark, path, base, **o))
    return spark.read.parquet(f"{base}/out")


def manifest_offsets(spark, sf_dir):
    """Positions in the manifest after incremental batches over all snapshots."""
    base = _grown(spark, sf_dir, "manifest-offsets", lambda path, base, **o: settle(
        spark, path, f"{base}/state", f"{base}/out", **o), **{"md5.sample.length": SAMPLE})
    return offset_log(f"{base}/state").rows(spark).where(F.col("name") != NODE_ROW).select("node", "name", "offset", "md5")


def offset_delta(spark, sf_dir):
    """Which files the manifest wrote rows for between the snapshots: all but the unchanged ones."""
    parts = []

    def step(path, base, **o):
        log = offset_log(f"{base}/state")
        before = log.version()
        settle(spark, path, f"{base}/state", f"{base}/out", **{**o, "bytes.max": 1 << 30})
        if before >= 0:
            parts.append(log.changes(spark, before, log.version()).where(F.col("name") != NODE_ROW).select(
                F.lit(len(parts) + 1).alias("v"), "node", "name", "gone"))

    _grown(spark, sf_dir, "offset-delta", step, **{"md5.sample.length": SAMPLE})
    return parts[0].unionByName(parts[1])


def batch_budget(spark, sf_dir):
    """First step over the last snapshot under a byte budget of a quarter of it,
    shared by all files: the planned ranges, and what each file keeps of its share."""
    root, _ = corpus(spark, sf_dir)
    spec = _spec(root, SNAPSHOTS[-1])
    total = list_files(spark, spec).agg(F.sum("size")).first()[0] or 0
    cfg = ReadConfig.from_options({"path": spec.path, "md5.sample.length": SAMPLE, "bytes.batch": max(1, total // 4)})
    step = plan_step(spark, cfg, offset_log(scratch_dir(spark, "batch-budget")))
    return step.planned.where(F.col("name") != NODE_ROW).select("node", "name", "start_offset", "end_offset", "credit")


def prefix_check(spark, sf_dir):
    """All files of the last snapshot read, then the ``click`` files rewritten behind
    their heads without changing size: what the next step makes of each file."""
    base = scratch_dir(spark, "prefix-check")
    spec = parse_path(f"{base}/logs/{{node}}/{PATTERN}")
    write_snapshot(spark, _events(spark, sf_dir), f"{base}/logs", SNAPSHOTS[-1], n_events=_n_events(spark, sf_dir))
    options = {"md5.sample.length": SAMPLE, "prefix.check.block": 256}
    settle(spark, spec.path, f"{base}/state", f"{base}/out", **options)

    def overwrite(it):
        import os

        for pdf in it:
            for path, size in zip(pdf["path"], pdf["size"]):
                fd = os.open(path, os.O_WRONLY)
                os.pwrite(fd, b"#", int(size) - 2)
                os.close(fd)
                os.utime(path, (1, 1))
            yield pdf

    list_files(spark, spec).where("name like '%click'").select("path", "size").mapInPandas(
        overwrite, "path string, size bigint").write.format("noop").mode("overwrite").save()
    cfg = ReadConfig.from_options({"path": spec.path, **options})
    step = plan_step(spark, cfg, offset_log(f"{base}/state"))
    return step.planned.where(F.col("name") != NODE_ROW).select("node", "name", "status", "end_offset")


def rotation(spark, sf_dir):
    """The second snapshot read, then every file renamed (``x`` appended): positions
    follow the files, and no line is read again."""
    base = scratch_dir(spark, "rotation")
    spec = parse_path(f"{base}/logs/{{node}}/{PATTERN}")
    events, n = _events(spark, sf_dir), _n_events(spark, sf_dir)
    options = {"md5.sample.length": SAMPLE, "identity.check": "true"}
    write_snapshot(spark, events, f"{base}/logs", 1, n_events=n)
    settle(spark, spec.path, f"{base}/state", f"{base}/out", **options)

    def rename(it):
        import os

        for pdf in it:
            for path in pdf["path"]:
                os.rename(path, path + "x")
            yield pdf

    pinned, _ = materialize(list_files(spark, spec).select("path"))
    pinned.mapInPandas(rename, "path string").write.format("noop").mode("overwrite").save()
    settle(spark, spec.path, f"{base}/state", f"{base}/out", **options)
    rows = offset_log(f"{base}/state").rows(spark).where(F.col("name") != NODE_ROW)
    lines = read_output(spark, f"{base}/out", f"{base}/state").count()
    return rows.select("node", "name", "offset", "md5", F.lit(lines).cast("bigint").alias("lines_read"))


def line_ranges(spark, sf_dir):
    """Lines asked for by number, the middle third of every file of the last
    snapshot, read through the newline index of 512-byte blocks."""
    base = scratch_dir(spark, "line-ranges")
    root, _ = corpus(spark, sf_dir)
    spec = _spec(root, SNAPSHOTS[-1])
    options = {"md5.sample.length": SAMPLE}
    settle(spark, spec.path, f"{base}/state", f"{base}/out", **options)
    cfg, log, index = ReadConfig.from_options({"path": spec.path, **options}), offset_log(f"{base}/state"), index_log(f"{base}/index")
    extend(spark, cfg, log, index, 512)
    counts = line_counts_at(spark, f"{root}/s{SNAPSHOTS[-1]}")
    third = F.floor(F.col("lines") / 3).cast("bigint")
    return read_numbered(spark, cfg, log, index, counts.select("node", "name", third.alias("first"), (2 * third).alias("last")))


def stream_available(spark, sf_dir):
    """All snapshots through bounded runs: each freezes its end, reads up to it in
    capped batches and ends by itself."""
    base = _grown(spark, sf_dir, "stream-available", lambda path, base, **o: run_available(
        spark, path, output=f"{base}/out", checkpoint=f"{base}/ck", backup=False,
        **{"md5.sample.length": SAMPLE, "offset.backup.provider": "none", **o}))
    return spark.read.parquet(f"{base}/out")


DOC_NAME = "documents.log"
DOC_SPLIT = 1 << 18  # small sub-ranges so that every file is read by several tasks


_DOCS: dict[tuple[str, str], str] = {}


def _documents(spark, sf_dir) -> str:
    """Every document text as lines of ``<root>/<lang>/documents.log``, in
    doc_id order (written once per app; the checks only read it)."""
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    if key not in _DOCS:
        root = scratch_dir(spark, "documents")
        docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
        lines = docs.where(F.col("text").isNotNull()).select(
            F.col("lang").alias("node"), F.lit(DOC_NAME).alias("name"), "doc_id", F.col("text").alias("line"))
        write_lines(spark, lines, root, key="doc_id")
        _DOCS[key] = root
    return _DOCS[key]


def document_lines(spark, sf_dir):
    """Whole document texts (multi-byte, long lines) read in one batch, split into sub-ranges."""
    root = _documents(spark, sf_dir)
    spec = parse_path(f"{root}/{{node}}/documents\\.log")
    empty = empty_state(spark)
    p = align(plan(snapshot(spark, spec, SAMPLE), empty, list_nodes(spark, spec),
                   policy="earliest", first_run=True))
    return read_ranges(p, split_bytes=DOC_SPLIT, verify_sample=SAMPLE)


def document_stream(spark, sf_dir):
    """The same texts through the stream under the cap."""
    root = _documents(spark, sf_dir)
    base = scratch_dir(spark, "documents-stream")
    cap = _stream_cap(spark, parse_path(f"{root}/{{node}}/documents\\.log"))
    _run_stream(spark, f"{root}/{{node}}/documents\\.log", f"{base}/out", f"{base}/ck",
                **{"bytes.max": cap, "split.bytes": DOC_SPLIT})
    return spark.read.parquet(f"{base}/out")


def line_counts_at(spark, folder):
    """Every line under ``folder`` (``<node>/<name>``) read in one batch, counted per file."""
    spec = parse_path(f"{folder}/{{node}}/{PATTERN}")
    empty = empty_state(spark)
    p = align(plan(snapshot(spark, spec, SAMPLE), empty, list_nodes(spark, spec),
                   policy="earliest", first_run=True))
    return read_ranges(p).groupBy("node", "name").agg(F.count("*").alias("lines"))


def line_counts(spark, sf_dir):
    """Flagship: every line of snapshot 1 read in one batch, counted per file."""
    root, _ = corpus(spark, sf_dir)
    return line_counts_at(spark, f"{root}/s1")


CHECKS = {
    "file_select": file_select,
    "file_meta": file_meta,
    "file_status": file_status,
    "range_plan": range_plan,
    "range_plan_first": range_plan_first,
    "range_lines": range_lines,
    "bytes_behind": bytes_behind,
    "carry_forward": carry_forward,
    "offset_roundtrip": offset_roundtrip,
    "offset_backup": offset_backup,
    "offset_newer": offset_newer,
    "stream_drain": stream_drain,
    "stream_increment": stream_increment,
    "stream_latest": stream_latest,
    "stream_backup": stream_backup,
    "stream_log_backup": stream_log_backup,
    "stream_available": stream_available,
    "batch_increment": batch_increment,
    "batch_budget": batch_budget,
    "manifest_stream": manifest_stream,
    "manifest_offsets": manifest_offsets,
    "offset_delta": offset_delta,
    "offset_merge": offset_merge,
    "prefix_check": prefix_check,
    "rotation": rotation,
    "line_ranges": line_ranges,
    "document_lines": document_lines,
    "document_stream": document_stream,
}
