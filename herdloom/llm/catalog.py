"""Queries over the whole text tables, one per operator, with the contract's columns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from herdloom.llm import (
    bpe,
    collocations,
    conversations,
    decontamination,
    host_rules,
    html_text,
    jaccard,
    language,
    oracles,
    pii,
    quality_model,
    secrets,
    sharding,
    token_files,
)
from herdloom.llm.base import id_remainder, query, read
from herdloom.sources.tables import shared_path

SHARDS = 24
BPE_FILE = "byte_bpe_50k.json"


@query("op1_shards")
def op1_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(read(spark, sf_dir, "documents"), SHARDS)


@query("op2_language")
def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    model = language.train(language.training_rows(documents))
    return language.identify(documents, model).select(
        "doc_id", (id_remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score"
    )


@query("op3_secrets")
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(read(spark, sf_dir, "documents"))


@query("op4_bpe")
def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(read(spark, sf_dir, "documents"), public_tokenizers.path(BPE_FILE))


@query("op5_ngram_join", oracles.NGRAM_JOIN)
def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link(read(spark, sf_dir, "documents"))


@query("op6_quality")
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_model.score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return scored.select("doc_id", (id_remainder("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


@query("op7_pii")
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal(read(spark, sf_dir, "documents"))


@query("op8_decontamination", oracles.DECONTAMINATION)
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query("op9_main_text")
def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(read(spark, sf_dir, "pages"))


@query("op10_host_rules", oracles.HOST_RULES)
def op10_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.judge(read(spark, sf_dir, "documents"))


@query("op11_collocations", oracles.COLLOCATIONS)
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(read(spark, sf_dir, "documents"))


@query("op12_conversations")
def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_damaged(read(spark, sf_dir, "conversations"))


@query("op13_token_files")
def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, out = read(spark, sf_dir, "documents"), shared_path(spark, "token-files")
    token_files.write_ids(documents, public_tokenizers.path(BPE_FILE), out)
    return token_files.read_ids(spark, out).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
