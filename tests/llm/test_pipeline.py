"""The pipeline: stage contracts, planted cases, registered queries."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from appendlog.llm import packing, pii, quality, queries
from appendlog.llm.tokenizers_io import library, vocabulary

from .test_copies import brute_components, brute_removed
from .texts import prose

ORDER = ["quality_rules", "one_of_near_copies", "cut_repeated_passages", "redact_pii", "pack_sequences"]


def planted():
    rng = random.Random(21)
    good = [prose(rng, rng.randint(60, 160)) for _ in range(60)]
    shared = prose(rng, 80)
    rows = good + [good[0], good[1].replace("river", "brook", 1)]
    rows += [prose(rng, 50) + " " + shared + " " + prose(rng, 50) for _ in range(3)]
    rows += ["write to " + "me.you@host.org " + prose(rng, 60), " ".join(w + "%%%" for w in good[2].split()), None, "few words"]
    return list(enumerate(rows, 100))


def test_stages(spark, table):
    assert [n for n, _ in corpus_pipeline.STAGES] == ORDER
    rows = planted()
    docs, columns = table(rows, ["spans"]), table(rows, ["spans"]).columns
    state = rows
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "")
        if name == ORDER[-1]:
            break
        assert out.columns == columns
        got = [(r.doc_id, r.text) for r in out.orderBy("doc_id").collect()]
        if name == ORDER[0]:
            verdict = {r.doc_id: r.kept for r in quality.score(docs).collect()}
            assert got == [x for x in state if verdict[x[0]]]
            assert {100 + k for k in range(66)} == {i for i, _ in got}  # junk, null and short ones go
        elif name == ORDER[1]:
            groups = brute_components(state, 5, 80)
            assert got == [x for x in state if groups[x[0]][1] == x[0]] and len(got) == 64
        elif name == ORDER[2]:
            gone = brute_removed(state, 400)
            assert all(t == u if not gone[i][1] else len(u.encode()) == gone[i][0] - gone[i][1]
                       for (i, t), (_, u) in zip(state, got, strict=True))
            assert sum(gone[i][1] > 0 for i, _ in state) == 3
        else:
            assert got == [(i, pii.redacted(t)) for i, t in state] and any("[EMAIL]" in t for _, t in got)
        if name in ORDER[2:]:
            assert out.where(F.col("n_chars") != F.length("text")).count() == 0
        docs, state = table(got, ["spans"]), got
    lib = library(vocabulary("byte_bpe_50k.json"))
    lengths = {r.doc_id: r.n for r in out.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert lengths == {i: len(lib.encode(t, add_special_tokens=False).ids) + 1 for i, t in state}
    assert out.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0] <= packing.SIZE


def test_short_passages_of_many_words(spark, table):
    """Over 50 words go although they have fewer than 400 bytes; 50 words stay."""
    rng = random.Random(34)
    short = lambda n: " ".join(rng.choice("ab of ti re on st".split()) + rng.choice("klmnop") for _ in range(n))
    many, few = short(51), short(50)
    assert len(many.encode()) < 400
    rows = [(k, f"{prose(rng, 40)} {p} {prose(rng, 40)}") for k, p in enumerate([many, many.replace(" ", "\n"), few, few])]
    out = {r.doc_id: r.text for r in corpus_pipeline.cut_repeated_passages(spark, table(rows), "").collect()}
    assert [out[k] for k in (2, 3)] == [t for _, t in rows[2:]]
    assert out[0] == rows[0][1].replace(many, "") and out[1] == rows[1][1].replace(many.replace(" ", "\n"), "")


def test_run_and_queries(spark, folder):
    path = folder(planted(), [(i, int(i % 3 == 0)) for i, _ in planted()])
    assert corpus_pipeline.run(spark, path).count() >= 64
    n = len(planted())
    for name, query in queries.QUERIES.items():
        if name.startswith(("op12", "op13")):
            continue  # they read embeddings
        df = query(spark, path)
        assert df.select("doc_id").distinct().count() == n, name
        if not name.startswith("op9"):
            assert df.count() == n, name


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, ""), (1, "")]])
def test_run_on_next_to_nothing(spark, folder, rows):
    assert corpus_pipeline.run(spark, folder(rows)).count() == 0


def test_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in names if k.startswith("op") and k[2].isdigit()}
