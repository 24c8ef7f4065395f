"""The corpus pipeline: toxicity, language, near-duplicates, benchmark
decontamination, tokens.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before
it kept; all but the last return the columns of ``documents``.  Cases (nulls,
empty and long texts, repeated rows, empty tables) are those of the operators
that the stages call: documents with a null or empty text end at the language
stage, which cannot tell their language.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kpiloom.llm import byte_bpe, decontamination, language_id, simhash, toxicity
from kpiloom.llm.common import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under the toxicity threshold."""
    return toxicity.without_toxic(spark, docs, table(spark, sf_dir, "labels"))


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language of the corpus; those that have no letter go."""
    return language_id.with_known_language(spark, docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near-duplicates."""
    return simhash.deduplicated(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of the ids, and of the bytes they decode to, of each document."""
    return byte_bpe.round_trip(docs)


STAGES = [("toxicity", drop_toxic), ("language_id", keep_known_language), ("simhash_near_dedup", drop_near_duplicates),
          ("benchmark_decontamination", drop_contaminated), ("byte_level_bpe", tokenize)]

# SQL expresses neither the trained stages nor the tokenizer; tests/llm/test_pipeline.py holds the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
