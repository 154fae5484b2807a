"""A training-data pipeline over ``documents``: language, toxicity, near-duplicates, personal data, packing.

Each stage works on all that its predecessor kept. Stages but the last return the columns of ``documents``; the last
returns the pieces of the packed sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orderflume.llm import langid, packing, pii, simhash, toxicity
from orderflume.llm.common import stage, table
from orderflume.llm.queries import packing_tokenizer


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned stay; those without letters, or unlike all of them, go."""
    return langid.keep_known(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not judged toxic stay."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def first_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.keep_first(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by the name of its kind."""
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces with their sequence and place in it."""
    return packing.pack_documents(docs, packing_tokenizer())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", known_language),
    ("toxicity", clean),
    ("near_duplicates", first_of_group),
    ("personal_data", without_personal_data),
    ("packing", packed),
]

#: Learned models and tokenization have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
