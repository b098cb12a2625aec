"""A corpus pipeline: reject unknown languages, drop repeated lines and near copies, mix sources, encode."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.llm.bpe import token_digests
from fleetgauge.llm.language import kept_documents
from fleetgauge.llm.lines import dedup_lines
from fleetgauge.llm.mixing import mix_plan
from fleetgauge.llm.ngram_join import near_duplicates
from fleetgauge.llm.shared import cut


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known."""
    return kept_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier one repeats; those that lose all their words go.

    A document that had no words before stays as it is. n_chars follows the text.
    """
    out = dedup_lines(docs).filter(r"n_removed = 0 or text rlike '[^\\x20\\x09-\\x0D]'")
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(kind))
    return out.select(*docs.columns)


def near_duplicate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest id."""
    found = cut(near_duplicates(docs))
    copies = cut(found.filter("doc_id <> component_id").select("doc_id").distinct())
    rest = docs.join(copies, "doc_id", "left_anti")
    repeated = cut(found.groupBy("doc_id").count().filter("count > 1 and doc_id is not null").select("doc_id"))
    once = rest.join(repeated, "doc_id", "left_anti")
    return once.unionByName(rest.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"]))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it; ids are unique after the stage before."""
    copies = cut(mix_plan(docs).filter("copies > 0 and taken > 0").select(F.col("doc_id").alias("mix_id"), "copies"))
    taken = docs.join(copies, docs["doc_id"].eqNullSafe(copies["mix_id"]))
    return taken.withColumn("mix_id", F.explode(F.expr("sequence(1L, copies)"))).select(*docs.columns)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text."""
    return token_digests(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicate_documents),
    ("source_mix", source_mix),
    ("bpe", bpe),
]

#: No SQL: language models, dependent rounding and merge lists are beyond it. Tests hold brute force against it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written as Parquet in the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
