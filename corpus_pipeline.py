"""A corpus from raw documents to token files: quality, near-dedup, decontamination, mixing, tokens.

All stages but the last return the columns of the documents; further columns come along, whatever their
names.  Rows with null ids or repeated ids are documents like others, empty tables pass through empty, and
very long texts are read whole.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gridloom.llm import decontaminate, mixing, near_dedup, quality, token_file
from gridloom.llm.common import materialise, table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
REPETITION_LIMIT = 1.5


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones among the documents, accepts.

    A null or empty text has the score of the end mark alone; a score at the threshold is accepted.
    """
    return quality.keep(docs, table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the least id; a null id only where the group has no other.

    Null and empty texts are copies of one another; rows equal in id and text are one document.
    """
    return near_dedup.dedupe(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; null and empty texts hold none."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in their mixture: each once at least, those of small sources up to the repetition limit.

    A null source is a source of its own; null and empty texts count one token.
    """
    return mixing.mix(docs, repetition_limit=REPETITION_LIMIT)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mixture; a row for each document as read back from them, null texts as the end id alone."""
    return token_file.token_files(docs, TOKENIZER)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("token_output", token_output),
]

#: No stage but the joins between them can be said in SQL: a trained model, SimHash, a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and reread for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
