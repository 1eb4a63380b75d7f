"""File selection and metadata with Spark's file index."""

import hashlib
import os

from appendlog.sources.catalog import list_files, list_nodes, snapshot
from appendlog.sources.pathspec import parse_path
from tests.helpers import Tail, cfg, write


def test_node_segment_with_suffix(spark, tmp):
    for node in ("h1", "h2"):
        write(f"{tmp}/{node}/app/svc.log", f"{node}-a\n".encode())
        write(f"{tmp}/{node}/app/svc.log.1", b"rotated\n")
        write(f"{tmp}/{node}/other/svc.log", b"elsewhere\n")
    os.makedirs(f"{tmp}/h3/app")  # listed, no files
    spec = parse_path(f"{tmp}/{{node}}/app/svc\\.log")
    got = sorted((r.node, r.name, r.size) for r in list_files(spark, spec).collect())
    assert got == [("h1", "svc.log", 5), ("h2", "svc.log", 5)]
    assert sorted(r.node for r in list_nodes(spark, spec).collect()) == ["h1", "h2", "h3"]
    t = Tail(cfg(f"{tmp}/{{node}}/app/svc\\.log"))
    assert sorted(t.drain()) == ["h1-a", "h2-a"]
    assert t.pos["offsets"]["h3"] == {}


def test_missing_directory_is_empty(spark, tmp):
    spec = parse_path(f"{tmp}/nothing/here/{{node}}/x\\.log")
    assert list_files(spark, spec).count() == 0
    assert list_nodes(spark, spec).count() == 0
    assert Tail(cfg(f"{tmp}/nothing/x\\.log")).drain() == []


def test_snapshot_checksums(spark, tmp):
    body = b"0123456789" * 10 + b"\n"
    write(f"{tmp}/a.log", body)
    write(f"{tmp}/b.log", b"short\n")
    spec = parse_path(f"{tmp}/[ab]\\.log")
    got = {r.name: (r.size, r.md5) for r in snapshot(spark, spec, 64).collect()}
    assert got == {"a.log": (101, hashlib.md5(body[:64]).hexdigest()), "b.log": (6, "")}
    off = {r.name: r.md5 for r in snapshot(spark, spec, 64, check=False).collect()}
    assert off == {"a.log": "", "b.log": ""}


def test_positional_writer_many_chunks_one_file(spark, tmp):
    """One hot file written by many tasks at their offsets equals the sequential body."""
    from pyspark.sql import functions as F

    from checks.corpus import write_lines

    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    lines = ev.select(F.lit("n0").alias("node"), F.lit("hot.log").alias("name"), "event_id",
                      F.concat_ws("|", F.col("event_id").cast("string"), "event_type", "props").alias("line"))
    write_lines(spark, lines.repartition(7), tmp, key="event_id", chunk_rows=13)
    rows = sorted((r.event_id, r.line) for r in lines.collect())
    with open(f"{tmp}/n0/hot.log", "rb") as f:
        assert f.read() == "".join(l + "\n" for _, l in rows).encode()
    # shrink in place: a smaller body replaces the file exactly
    write_lines(spark, lines.where("event_id < 100"), tmp, key="event_id", chunk_rows=13)
    with open(f"{tmp}/n0/hot.log", "rb") as f:
        assert f.read() == "".join(l + "\n" for i, l in rows if i < 100).encode()


def test_file_removed_after_listing_is_skipped(spark, tmp):
    for i in range(3):
        write(f"{tmp}/f{i}.log", b"z" * 100 + b"\n")
    spec = parse_path(f"{tmp}/f[0-9]\\.log")
    snap = snapshot(spark, spec, 16)  # the index is built here
    os.remove(f"{tmp}/f1.log")
    assert sorted(r.name for r in snap.collect()) == ["f0.log", "f2.log"]


def test_glob_characters_in_folder_names(spark, tmp):
    write(f"{tmp}/logs[a]{{b}}/h1/x.log", b"1\n")
    write(f"{tmp}/logsa{{b}}/h1/x.log", b"decoy\n")
    spec = parse_path(f"{tmp}/logs[a]{{b}}/{{node}}/x\\.log")
    assert [(r.node, r.size) for r in list_files(spark, spec).collect()] == [("h1", 2)]


def test_regex_dialects_agree(spark, tmp):
    """Spark's rlike (Java) in the batch listing and Python's re in the stream
    select the same names for the shared regex subset."""
    from appendlog.streaming.source import list_dir

    names = ["app.log", "app.log.1", "app-2024.log", "xapp.log", "a.txt", "b.txt", "c.txt",
             "service.log.click", "service.log.Click", "svc_01.log"]
    for n in names:
        write(f"{tmp}/{n}", b"x\n")
    for pattern in [r"app\.log", r".*\.log", r"app-\d{4}\.log", r"(a|b)\.txt", r"service\.log\.[a-z]+",
                    r"[^x].*\.log", r"svc_\d+\.log", r"app\.log(\.\d+)?"]:
        spec = parse_path(f"{tmp}/{pattern}")
        spark_names = sorted(r.name for r in list_files(spark, spec).collect())
        py_names = sorted(n for n, *_ in list_dir(spec, "local"))
        assert spark_names == py_names, pattern
