"""The text operators as one pipeline: documents in, token ids out.

Each stage is a function of (spark, docs, sf_dir) that returns a DataFrame; ``run`` writes what a stage
returns as Parquet to the shared folder and gives the next one the table read back, so that a lost
executor repeats no earlier stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from herdloom.llm import bpe, decontamination, jaccard, language, pii
from herdloom.llm.base import read, stored

#: Least probability of the language a document is kept with.
LANGUAGE_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model is at least half sure of; others and ``und`` go."""
    return language.keep_identified(docs, language.train(language.training_rows(docs)), LANGUAGE_SCORE)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the least id."""
    return jaccard.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a twentieth of their words from benchmark passages."""
    return decontamination.without_contaminated(docs, read(spark, sf_dir, "benchmark"))


def remove_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and terms that reveal it replaced in their texts."""
    return pii.sanitise(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents."""
    return bpe.encode_texts(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id),
    ("deduplicate", deduplicate),
    ("decontaminate", decontaminate),
    ("remove_personal", remove_personal),
    ("encode", encode),
]

#: No SQL trains a language model or applies merges; a brute-force version checks the pipeline.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
