"""The training-text pipeline: five stages, each one of the text operators.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read back as the next one's
``docs``.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from appendlog.llm import ngramjoin, packing, pii, quality, suffixdedup
from appendlog.llm.common import documents, pinned
from appendlog.llm.tokenizers_io import vocabulary


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-supervision verdict keeps."""
    return quality.keep_good(docs)


def _recounted(docs: DataFrame, new: DataFrame) -> DataFrame:
    """``new`` with ``n_chars`` following its changed texts."""
    if "n_chars" in docs.columns:
        new = new.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return new.select(*docs.columns)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group that shares 80 % of its five-word shingles."""
    return ngramjoin.keep_one(docs, size=5, percent=80)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 400 bytes or more, or of over 50 words, that occur elsewhere too."""
    return _recounted(docs, suffixdedup.without_repeats(docs, words=51))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by kind markers."""
    return _recounted(docs, pii.redact(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens, packed best-fit into sequences."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"), vocabulary("byte_bpe_50k.tiktoken"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("one_of_near_copies", one_of_near_copies),
    ("cut_repeated_passages", cut_repeated_passages),
    ("redact_pii", redact_pii),
    ("pack_sequences", pack_sequences),
]

#: No SQL: latent-model fits, suffix arrays and tokenizers; tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = pinned(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
