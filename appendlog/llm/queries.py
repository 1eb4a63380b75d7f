"""The registered queries of the text operators, with production parameters."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from appendlog.llm import infill, minhash, ngramjoin, packing, pii, quality, spm, suffixdedup, tokencount, topk, toxicity, wavelet, whiten
from appendlog.llm.common import documents
from appendlog.llm.tokenizers_io import vocabulary
from appendlog.session import checkpoint_root


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(documents(spark, sf_dir, "doc_id", "text"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(documents(spark, sf_dir, "doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(documents(spark, sf_dir, "doc_id", "text"), vocabulary("word_bpe_49k.json"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return toxicity.score(documents(spark, sf_dir, "doc_id", "text"), labels)


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spm.encode_decode(documents(spark, sf_dir, "doc_id", "text"), vocabulary("piece_bpe_32k.model"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.report(documents(spark, sf_dir, "doc_id", "text"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.compare_edits(documents(spark, sf_dir, "doc_id", "text"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.link_components(documents(spark, sf_dir, "doc_id", "text"), size=3, percent=90)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir, "doc_id", "text"), vocabulary("byte_bpe_50k.json"),
                        vocabulary("byte_bpe_50k.tiktoken"))


def op10_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{checkpoint_root(spark)}/llm/wavelet-{uuid.uuid4().hex[:12]}"
    wavelet.write(documents(spark, sf_dir, "doc_id", "text"), path, vocabulary("byte_bpe_50k.json"),
                  vocabulary("byte_bpe_50k.tiktoken"))
    return wavelet.read(spark, path)


def op11_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = infill.fill_in_middle(documents(spark, sf_dir, "doc_id", "text"))
    return infill.restored(done, "restored").select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"))


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")


def op12_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(embeddings(spark, sf_dir), F.col("vec_id") % 20 == 0, k=20)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten.whiten(embeddings(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_pii, op2_quality, op3_token_counts, op4_toxicity, op5_sentencepiece, op6_suffix_dedup,
                            op7_fingerprints, op8_ngram_join, op9_packing, op10_wavelet, op11_infill, op12_top_k,
                            op13_whitening)}
#: DuckDB twins, where SQL states the whole result.
ORACLES: dict[str, str] = {
    "op11_infill": r"""
with d as (select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') as u,
                  sha256('7:' || coalesce(doc_id::varchar, '')) as h from documents),
c as (select *, len(u) as n, ('0x' || h[1:8])::bigint % (len(u) + 1) as a, ('0x' || h[9:16])::bigint % (len(u) + 1) as b,
             case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') then 'plain'
                  when ('0x' || h[25:32])::bigint % 100 < 50 then 'spm' else 'psm' end as form from d),
p as (select doc_id, t, n, form, array_to_string(u[1:least(a, b)], '') as prefix,
             array_to_string(u[least(a, b) + 1:greatest(a, b)], '') as middle,
             array_to_string(u[greatest(a, b) + 1:], '') as suffix from c)
select doc_id, n::bigint as n, form, case when form <> 'plain' then length(prefix) end::bigint as prefix_chars,
       case when form <> 'plain' then length(middle) end::bigint as middle_chars,
       sha256(case form when 'plain' then t when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
       sha256(t) as restored_sha256
from p""",
    "op12_top_k": r"""
with v as (select row_number() over () as r, vec_id, list_transform(embedding, lambda c: floor(64 * c::double)) as x
           from embeddings where embedding is not null
             and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0),
s as (select q.r, q.vec_id as query_id, c.vec_id, list_inner_product(q.x, c.x)::bigint as score
      from v q join v c on q.r <> c.r and len(q.x) = len(c.x) where q.vec_id % 20 = 0),
k as (select *, row_number() over (partition by r order by score desc, vec_id nulls last) as rank from s)
select query_id, rank::int as rank, vec_id, score from k where rank <= 20""",
}
