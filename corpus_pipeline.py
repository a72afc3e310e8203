"""A training corpus from documents: five stages, each one an operator of ``quayside.llm``.

Each stage is written as Parquet to the shared folder and read again as the next one's
documents, so a lost executor repeats at most part of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quayside.llm import decontaminate, language, mixing, simhash, token_files
from quayside.llm.queries import table, tokenizer_path
from quayside.session import stage

def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go."""
    return language.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share 0.8 of their five-word shingles with one that stays go."""
    return simhash.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated to their source's target weight and shuffled."""
    return mixing.mix(docs).select(*docs.columns)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in doc_id order; a row per copy of a document, read back from them."""
    return token_files.token_table(docs, tokenizer_path())


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontaminate", drop_leaks),
    ("mix", mix_sources),
    ("tokens", write_tokens),
]

#: No stage but mixing can be said in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
