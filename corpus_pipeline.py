"""The corpus pipeline: from raw documents to packed token sequences.

Each stage is a function of (session, documents, folder of the given tables) and
works on all that its predecessor kept. Between stages the documents are written
as Parquet to the shared folder and read back, so a lost executor costs one
stage at most.

Defined results: a null text, and one without a letter, goes in the first stage, so
the later ones see neither; a null id is an id like others but stays behind any of
them where copies are dropped; of equal or similar texts one row stays (the largest
id of equal ones, the least of similar ones, then the least hash of the text), also
where rows repeat id and text; other columns pass through all stages but the last,
whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm import decontaminate, exact_dedup, jaccard_join, language_id, packing
from ledgerlake.llm.common import mark, only_last

VOCABULARY = "byte_bpe_50k.json"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts whose language cannot be told (no text, or no letter in it) go."""
    labelled = language_id.sample(docs, "text", "lang")
    return language_id.keep_identified(docs, labelled)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id stays."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every class of similar texts the one with the least id stays."""
    return jaccard_join.keep_one_per_class(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in a sequence."""
    return packing.pack(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("jaccard_join", drop_near_copies),
    ("decontaminate", drop_benchmark_leaks),
    ("packing", pack_sequences),
]

# Automata, minhash paths and byte-pair tokens are beyond SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    begun = mark()
    for name, stage in STAGES[:-1]:  # a stage's own tables, and its input, go once its output is written
        docs = only_last(stage(spark, docs, sf_dir), f"stage-{name}", begun)
    return STAGES[-1][1](spark, docs, sf_dir)
