"""Session and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
import weakref

from pyspark.sql import SparkSession


def local_session(cpus: int = 8, app: str = "appendlog", **conf) -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    builder = SparkSession.builder
    for k, v in conf.items():
        builder = builder.config(k, v)
    return (
        builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def posix_path(path: str) -> str:
    """``path`` without a ``file:`` scheme; other schemes are an error."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    if "://" in path:
        raise ValueError(
            f"{path!r} is not a mounted POSIX path; growing log files and their "
            "byte ranges are read with POSIX calls on every executor"
        )
    return path


def checkpoint_root(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: the session's
    ``spark.checkpoint.dir``, else the checkpoint dir the user set.

    Only where neither is set and the master is local (tests, local runs), a
    new local folder is created and registered as the checkpoint dir.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    root = root or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="appendlog-ck-")
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def shared_root(spark: SparkSession) -> str:
    """``checkpoint_root`` as a mounted POSIX path (an error for other stores)."""
    return posix_path(checkpoint_root(spark))


def scratch_dir(spark: SparkSession, tag: str) -> str:
    """A new, empty folder under the shared root."""
    path = os.path.join(shared_root(spark), "appendlog", f"{tag}-{uuid.uuid4().hex[:12]}")
    os.makedirs(path, exist_ok=False)
    return path


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``appendlog`` importable in executor Python workers (once per app).

    The package is zipped next to the shared root and added with
    ``addPyFile``, as for any Python dependency of a Spark job.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import hashlib
    import logging
    import zipfile

    try:
        root = shared_root(spark)
    except ValueError:
        # the checkpoint dir is not a mounted path (e.g. HDFS): the package is
        # then expected on the executors like any other dependency
        logging.getLogger("appendlog").warning(
            "spark.checkpoint.dir is not a mounted path; install appendlog on the executors")
        _SHIPPED.add(app)
        return

    pkg = os.path.dirname(os.path.abspath(__file__))
    files = []
    for base, dirs, names in os.walk(pkg):
        dirs[:] = [d for d in dirs if d != "__pycache__"]
        files += [os.path.join(base, n) for n in names if n.endswith(".py")]
    h = hashlib.md5()
    for f in sorted(files):
        h.update(f.encode())
        with open(f, "rb") as fh:
            h.update(fh.read())
    out_dir = os.path.join(root, "appendlog-pkg", h.hexdigest()[:16])
    out = os.path.join(out_dir, "appendlog.zip")
    if not os.path.exists(out):
        os.makedirs(out_dir, exist_ok=True)
        tmp = f"{out}.{uuid.uuid4().hex[:8]}"
        with zipfile.ZipFile(tmp, "w", zipfile.ZIP_DEFLATED) as z:
            for f in sorted(files):
                z.write(f, os.path.join("appendlog", os.path.relpath(f, pkg)))
        os.replace(tmp, out)
    sc.addPyFile(out)
    _SHIPPED.add(app)


_PINNED: "weakref.WeakKeyDictionary" = weakref.WeakKeyDictionary()


def pin(df, tag: str = "pin"):
    """``df`` written once as Parquet under ``spark.checkpoint.dir`` and read
    back: every later read, a retried task's too, sees the same rows."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/appendlog/{tag}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _PINNED[out] = path
    return out


def unpin(df) -> None:
    """Delete a pinned table that nothing reads any more."""
    path = _PINNED.pop(df, None)
    if path is not None:
        spark = df.sparkSession
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def materialize(df):
    """Pin a small, point-in-time table (a listing, a plan), and return it with
    its row count (from the files' footers).

    A listing or plan must not be recomputed after files moved on: a lost
    executor would otherwise re-list or re-align and give other ranges.
    """
    pinned = pin(df, "table")
    n = pinned.count()
    KNOWN_ROWS[pinned] = n
    return pinned, n


# Row counts of small frames built on the driver, known without running a job.
KNOWN_ROWS: "weakref.WeakKeyDictionary" = weakref.WeakKeyDictionary()


def local_frame(spark: SparkSession, rows: list, schema: str):
    """A small frame from driver-side rows, with its row count recorded."""
    df = spark.createDataFrame(rows, schema)
    KNOWN_ROWS[df] = len(rows)
    return df
