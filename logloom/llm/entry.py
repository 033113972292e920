"""Registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.llm import oracle
from logloom.llm.decontamination import benchmark_matches
from logloom.llm.embeddings import near_duplicate_embeddings
from logloom.llm.html import extract_text
from logloom.llm.idfile import read_token_ids, token_checksums, write_token_ids
from logloom.llm.language import fit_languages, held_out, labelled, predict_languages
from logloom.llm.packing import pack_documents
from logloom.llm.privacy import replace_personal_data
from logloom.llm.repair import repair_damaged
from logloom.llm.secrets import scan_secrets
from logloom.llm.shards import shard_documents
from logloom.llm.simhash import near_duplicates
from logloom.llm.store import table
from logloom.llm.substrings import remove_repeats
from logloom.llm.variants import group_variants
from logloom.shared import shared_folder


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = predict_languages(docs, fit_languages(labelled(docs)))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "ambiguous")


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_embeddings(table(spark, sf_dir, "embeddings"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def op6_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_personal_data(table(spark, sf_dir, "documents"), b"registered query")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.selectExpr("doc_id", "lower(lpad(hex(fp), 16, '0')) AS fingerprint", "component_id")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    findings, _ = scan_secrets(table(spark, sf_dir, "documents"))
    listed = "array_join(transform(spans, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"
    return findings.selectExpr(
        "doc_id",
        *(f"CAST(size(filter(spans, s -> s.kind = '{k}')) AS BIGINT) AS n_{k}" for k in ("assign", "access", "hex")),
        f"sha2({listed}, 256) AS base_sha256",
        f"{listed} AS spans",
    )


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_damaged(table(spark, sf_dir, "conversations"))


def op12_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "token-ids")
    write_token_ids(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return token_checksums(read_token_ids(spark, path))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_variants(table(spark, sf_dir, "documents"), damage=97)


OPERATORS = (
    op1_best_fit_packing,
    op2_language_id,
    op3_benchmark_decontamination,
    op4_embedding_near_dedup,
    op5_html_extraction,
    op6_pii_surrogates,
    op7_simhash_near_dedup,
    op8_sharding,
    op9_substring_dedup,
    op10_secret_scans,
    op11_conversation_repair,
    op12_token_id_output,
    op13_spelling_variants,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in OPERATORS}


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
