"""Document texts as file bodies: multi-byte UTF-8, no final newline."""

import os

import pandas as pd
from pyspark.sql import functions as F

from appendlog.operators.ranges import read_ranges
from appendlog.plans.planner import align, plan
from appendlog.sources.catalog import list_nodes, snapshot
from appendlog.sources.pathspec import parse_path

SF = "/root/testdata/sf0.001"


def _writer(root):
    def fn(it):
        for pdf in it:
            for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
                with open(os.path.join(root, f"doc-{doc_id}.txt"), "wb") as f:
                    f.write((text or "").encode("utf-8"))
            yield pd.DataFrame({"n": [len(pdf)]})
    return fn


def test_document_bodies(spark, tmp):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    docs.mapInPandas(_writer(tmp), "n long").write.format("noop").mode("overwrite").save()
    spec = parse_path(f"{tmp}/doc-[0-9]+\\.txt")
    empty = spark.createDataFrame([], "node string, name string, offset bigint, md5 string")
    p = align(plan(snapshot(spark, spec, 64), empty, list_nodes(spark, spec), first_run=True,
                   cap=1 << 12))
    got = read_ranges(p, split_bytes=1 << 14).groupBy("name").agg(F.count("*").alias("n"))
    got = {r.name: r.n for r in got.collect()}
    # the first capped batch of each file: whole lines up to the aligned end
    want = {}
    for r in docs.collect():
        body = (r.text or "").encode("utf-8")
        end = body.rfind(b"\n", 0, 1 << 12) + 1
        if end == 0 and len(body) > 1 << 12:
            end = body.find(b"\n", 1 << 12) + 1
        n = body[:end].count(b"\n")
        if n:
            want[f"doc-{r.doc_id}.txt"] = n
    assert got == want


def test_document_bodies_whole(spark, tmp):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    docs.mapInPandas(_writer(tmp), "n long").write.format("noop").mode("overwrite").save()
    spec = parse_path(f"{tmp}/doc-[0-9]+\\.txt")
    empty = spark.createDataFrame([], "node string, name string, offset bigint, md5 string")
    p = align(plan(snapshot(spark, spec, 64), empty, list_nodes(spark, spec), first_run=True))
    got = sorted((r.name, r.value) for r in read_ranges(p, split_bytes=997).collect())
    want = []
    for r in docs.collect():
        pieces = (r.text or "").split("\n")[:-1]  # the unterminated last piece is held
        want += [(f"doc-{r.doc_id}.txt", s) for s in pieces]
    assert got == sorted(want)
