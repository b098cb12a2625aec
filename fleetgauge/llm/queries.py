"""The operators as queries over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fleetgauge.llm import (
    alignment,
    bpe,
    embedding_dedup,
    extract,
    language,
    lines,
    manifest,
    mixing,
    ngram_join,
    pii,
    secret_scan,
    token_counts,
    topk,
)

#: Vocabularies of the encoding and the counting query; the second one of the aligning query, whose first is TOKENIZER.
TOKENIZER, COUNTED, OTHER = "byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract_pages(_table(spark, sf_dir, "pages"))


def _op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan_pii(_table(spark, sf_dir, "documents"))


def _op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_inner_products(_table(spark, sf_dir, "embeddings"))


def _op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.linked_vectors(_table(spark, sf_dir, "embeddings"))


def _op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(_table(spark, sf_dir, "documents")).select("doc_id", "text", "n_removed")


def _op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def _op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(_table(spark, sf_dir, "documents"))


def _op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(_table(spark, sf_dir, "documents"))


def _op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_tables(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "pages"))


def _op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(_table(spark, sf_dir, "documents"))


def _op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path(COUNTED))


def _op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.prove_documents(_table(spark, sf_dir, "documents"))


def _op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return alignment.align_documents(docs, public_tokenizers.path(TOKENIZER), public_tokenizers.path(OTHER))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_html_extraction": _op1,
        "op2_pii": _op2,
        "op3_exact_topk": _op3,
        "op4_embedding_neardup": _op4,
        "op5_line_dedup": _op5,
        "op6_bpe": _op6,
        "op7_ngram_jaccard_join": _op7,
        "op8_mixing": _op8,
        "op9_language_id": _op9,
        "op10_secret_scan": _op10,
        "op11_token_counts": _op11,
        "op12_merkle_manifest": _op12,
        "op13_tokenizer_alignment": _op13,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_exact_topk": topk.SQL,
        "op4_embedding_neardup": embedding_dedup.SQL,
        "op7_ngram_jaccard_join": ngram_join.SQL,
        "op12_merkle_manifest": manifest.SQL,
    }
