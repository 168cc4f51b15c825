"""Corpus pipeline: five operators in turn over the documents, each stage written and read again before the next."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lakeloom.llm import decontaminate, mixing, quality_model, simhash, token_files
from lakeloom.llm.common import cut, shared_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    return quality_model.drop_junk(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: by fingerprints of 5-word shingles, and of those that stay, by a Jaccard similarity of 0.8 or more."""
    return simhash.keep_first(docs, k=5, similarity=0.8)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of the benchmark occurs."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mixed documents; one row for each, read back from the files: doc_id, start, n_tokens, ids_crc32."""
    path = shared_dir(spark)
    token_files.write_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), path)
    return token_files.read_digests(spark, path)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixture", mixture),
    ("token_output", token_output),
]

#: EM, hashed fingerprints, Newton iterations and tokenizers are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = shared_dir(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), top, name)
    return docs
