"""The corpus pipeline: language, near copies, benchmark passages, source mix, token files.

Each stage takes ``(spark, docs, sf_dir)`` and works on every row its predecessor kept. All
but the last return the columns of ``documents``; ``run`` stores each stage's result as
Parquet below the shared folder and reads it back for the next one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm import decontaminate, langid, mixing, ngram_join, token_output
from helixframe.llm.common import table, written
from helixframe.session import new_scratch_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
VOCABULARY = "byte_bpe_50k.json"


def _as_documents(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a language (``und``); ``lang`` becomes the predicted one.

    Profiles are learnt from the documents that carry a language, as in the operator.
    """
    profiles = langid.fit_profiles(docs)
    labelled = langid.identify(docs, profiles).where(F.col("lang_pred") != langid.UNKNOWN)
    return _as_documents(labelled.withColumn("lang", F.col("lang_pred")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each linked group stays: the one with the smallest id (one row of it)."""
    kept = ngram_join.group_heads(docs)
    return _as_documents(kept)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents that are mostly benchmark text go."""
    cleaned = decontaminate.decontaminate(_as_documents(docs), table(spark, sf_dir, "benchmark"))
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in training order, repeated or left out as the source targets demand."""
    return _as_documents(mixing.mix(docs))


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, and what is read back from them."""
    folder = new_scratch_path(spark, "pipeline-tokens")
    token_output.write_tokens(docs, folder, public_tokenizers.path(VOCABULARY))
    return token_output.read_tokens(spark, folder)


STAGES = [
    ("language_id", identify_language),
    ("ngram_join", drop_near_copies),
    ("decontamination", remove_benchmark),
    ("mixing", mix_sources),
    ("token_output", write_token_files),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return written(STAGES[-1][1](spark, docs, sf_dir), "pipeline-result")


# Language profiles and tokenizer ids have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None
