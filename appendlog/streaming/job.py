"""Stream helpers: ``read_stream``, ``start_stream``, ``run_available``, ``drain`` and the console job."""

from __future__ import annotations

import shutil
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from appendlog.operators.manifest import freeze, manifest_path, offset_log
from appendlog.session import posix_path, ship_package
from appendlog.sources.options import ReadConfig, resolve
from appendlog.streaming.backup import BackupListener, get_backup, parse_offset, stream_key
from appendlog.streaming.catalogjob import CatalogThread
from appendlog.streaming.source import FORMAT, AppendLogDataSource


def _pickle_by_value() -> None:
    """Ship appendlog's code inside the pickled source.

    The source's planner runs in a Python process on the driver that does not
    see files added with ``addPyFile``; pickling the package by value makes the
    source independent of how the package was installed.
    """
    from pyspark import cloudpickle

    for name, mod in list(sys.modules.items()):
        if mod is not None and (name == "appendlog" or name.startswith("appendlog.")):
            cloudpickle.register_pickle_by_value(mod)


_LISTENERS: list[BackupListener] = []
_CATALOGS: dict[str, CatalogThread] = {}  # by query id


def register(spark: SparkSession) -> None:
    ship_package(spark)
    _pickle_by_value()
    spark.dataSource.register(AppendLogDataSource)


def read_stream(spark: SparkSession, path: str | None = None, **options) -> DataFrame:
    """``spark.readStream.format("appendlog")`` with options resolved on the driver.

    Conf entries ``spark.appendlog.<key>`` override options.  Without a
    checkpoint the stream starts from the newest backed-up offset, if any.
    """
    if path is not None:
        options["path"] = path
    opts = resolve(spark, **options)
    cfg = ReadConfig.from_options(opts)
    if not opts.get("initial.offset.json"):
        backup = get_backup(spark, cfg).fetch(spark, stream_key(cfg))
        if backup:
            opts["initial.offset.json"] = backup[1]
    if cfg.catalog == "manifest":
        opts["catalog.path"] = manifest_path(spark, cfg, stream_key(cfg))
    register(spark)
    return spark.readStream.format(FORMAT).options(**opts).load()


def prepare_backup(spark: SparkSession, **options) -> BackupListener:
    """A listener, added before its query starts; ``bind`` it to the query."""
    cfg = ReadConfig.from_options(resolve(spark, **options))
    for old in [x for x in _LISTENERS if x.done]:  # listeners of ended queries
        spark.streams.removeListener(old)
        _LISTENERS.remove(old)
    listener = BackupListener(get_backup(spark, cfg), cfg.spec.directory, stream_key(cfg))
    spark.streams.addListener(listener)
    _LISTENERS.append(listener)
    return listener


def attach_backup(spark: SparkSession, query: StreamingQuery, **options) -> BackupListener:
    """Back up the offsets of a running ``query`` after every completed batch,
    the last one it completed included."""
    listener = prepare_backup(spark, **options)
    listener.bind(str(query.id))
    listener.save(query.lastProgress)
    return listener


def start_catalog(spark: SparkSession, query: StreamingQuery, interval: float = 1.0, target=None, **options) -> CatalogThread:
    """Advance the manifest of a ``catalog=manifest`` stream from this
    application until ``stop_stream`` (``start_stream`` does so by itself)."""
    cfg = ReadConfig.from_options(resolve(spark, **options))
    thread = CatalogThread(spark, cfg, offset_log(manifest_path(spark, cfg, stream_key(cfg))), interval, target)
    thread.query = query
    _CATALOGS[str(query.id)] = thread
    thread.start()
    return thread


def _started(spark: SparkSession, writer, output: str | None, backup: bool, options: dict, target=None) -> StreamingQuery:
    listener = prepare_backup(spark, **options) if backup else None
    try:
        query = writer.start(output) if output else writer.start()
    except BaseException:
        if listener is not None:
            listener.close()
        raise
    if listener is not None:
        listener.bind(str(query.id))
    if ReadConfig.from_options(resolve(spark, **options)).catalog == "manifest":
        start_catalog(spark, query, target=target, **options)
    return query


def stop_stream(query: StreamingQuery) -> None:
    """Stop ``query`` and store its last completed offset before returning,
    whether or not the listener's events have been delivered (T14)."""
    catalog = _CATALOGS.pop(str(query.id), None)
    if catalog is not None:
        catalog.stop()
    query.stop()
    for listener in [x for x in _LISTENERS if x.query_id == str(query.id)]:
        if not listener.done:
            listener.save(query.lastProgress)
            listener.close()


def start_stream(
    spark: SparkSession,
    path: str,
    *,
    sink: str = "parquet",
    output: str | None = None,
    checkpoint: str,
    trigger: str = "1 second",
    backup: bool = True,
    **options,
) -> StreamingQuery:
    """Read ``path`` with the appendlog source into ``sink``; offsets backed up.

    Every trigger lists the folders, so an idle stream with a zero trigger
    would poll shared storage continuously; the default waits a second.
    """
    df = read_stream(spark, path, **options)
    writer = (
        df.writeStream.format(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=trigger)
    )
    return _started(spark, writer, output, backup, {"path": path, **options})


def drain(query: StreamingQuery) -> None:
    """Block until every byte on disk now is read (capped backlogs take many batches)."""
    catalog = _CATALOGS.get(str(query.id))
    if catalog is not None:
        catalog.settle()
    query.processAllAvailable()


def run_available(
    spark: SparkSession,
    path: str,
    *,
    output: str,
    checkpoint: str,
    sink: str = "parquet",
    backup: bool = True,
    **options,
) -> int:
    """Read what is on disk now in batches under the caps, then end (T8).

    The end is frozen at the start, as one row per file beside the checkpoint:
    lines and files that come later are left to the next run, however fast they
    come, and a run that died is started again towards the end it had.  Returns the
    number of batches that the checkpoint holds by then.
    """
    cfg = ReadConfig.from_options(resolve(spark, path=path, **options))
    end = f"{posix_path(checkpoint).rstrip('/')}.target"
    target = freeze(spark, cfg, end)
    options = {**options, "path": path}
    if cfg.catalog == "driver":
        options["target.path"] = end
    writer = (
        read_stream(spark, **options)
        .writeStream.format(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime="0 seconds")
    )
    query = _started(spark, writer, output, backup, options, target=target)
    try:
        drain(query)
        batches = query.lastProgress.batchId + 1 if query.lastProgress is not None else 0
    finally:
        stop_stream(query)
    if query.exception() is not None:
        raise query.exception()
    shutil.rmtree(end, ignore_errors=True)  # reached: the next run freezes its own
    return batches


def console_query(spark: SparkSession, path: str, checkpoint: str,
                  trigger: str = "3 seconds", **options) -> StreamingQuery:
    """The sample job's query: new lines to the console, untruncated, 100 rows."""
    writer = (
        read_stream(spark, path, **options)
        .writeStream.format("console")
        .option("truncate", False)
        .option("numRows", 100)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=trigger)
    )
    return _started(spark, writer, None, True, {"path": path, **options})


def console_job(path: str, checkpoint: str) -> None:
    """Print every new line to the console every 3 seconds (the sample job)."""
    spark = SparkSession.builder.appName("appendlog-console").getOrCreate()
    console_query(spark, path, checkpoint).awaitTermination()


def end_offset(query: StreamingQuery) -> dict | None:
    """The appendlog source's end offset in the query's last progress, as a dict."""
    progress = query.lastProgress
    if progress is None or not progress.sources:
        return None
    return parse_offset(progress.sources[0].endOffset)


def stream_lag(spark: SparkSession, offset_json, path: str, **options) -> DataFrame:
    """Bytes each file is behind a stream's position (T13): ``node, name, status, bytes_behind``.

    ``offset_json`` is a running ``StreamingQuery``, a stream offset (dict or
    JSON) or a backed-up one; the files are listed now, with the stream's own
    options.
    """
    import json

    if isinstance(offset_json, StreamingQuery):
        offset_json = end_offset(offset_json)

    from pyspark.sql import functions as F

    from appendlog.operators.state import bytes_behind, from_offset_json
    from appendlog.plans.planner import plan
    from appendlog.sources.catalog import list_nodes, snapshot

    if isinstance(offset_json, dict):
        offset_json = json.dumps(offset_json)
    cfg = ReadConfig.from_options(resolve(spark, path=path, **options))
    doc = spark.createDataFrame([(offset_json,)], "offset_json string")
    state = from_offset_json(doc).select("node", "name", "offset", "md5")
    listing = snapshot(spark, cfg.spec, cfg.md5_sample, cfg.md5_check)
    planned = plan(listing, state, list_nodes(spark, cfg.spec), policy=cfg.starting_offsets,
                   cap=cfg.max_bytes, check=cfg.md5_check)
    return bytes_behind(planned).where(F.col("bytes_behind") > 0)


if __name__ == "__main__":
    if len(sys.argv) != 3:
        sys.exit("usage: python -m appendlog.streaming.job <path> <checkpoint>")
    console_job(sys.argv[1], sys.argv[2])
