"""From raw documents to packed training sequences, stage by stage."""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanveil.llm import decontaminate, jaccard, packing, quality, secret_scan
from spanveil.llm.text import free_name, shared_path

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
#: Documents whose probability of good quality is lower go.
LEAST_QUALITY = 0.3


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject; it learns from the labels beside the table."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    before = free_name("score", docs.columns)
    scored = quality.score_quality(docs.withColumnRenamed("score", before), quality.fit(docs, labels))
    return scored.where(F.col("score") >= LEAST_QUALITY).select(
        *[F.col(before if c == "score" else c).alias(c) for c in docs.columns])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates."""
    return jaccard.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark; those that consist of them go."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark."""
    return secret_scan.redact_secrets(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of 2048 ids: where each document's ids go, the ids and their checksum."""
    return packing.pack(docs, VOCABULARY)


STAGES = [("quality", good_quality), ("near_duplicates", one_of_each_group), ("decontaminate", without_benchmark),
          ("secrets", without_secrets), ("pack", packed)]

#: Trained models, automata and tokenizers can't be expressed in SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written to the shared folder and read again.

    Rows with a null text or id go through all stages: an empty text is judged as such, links with
    nothing and packs as one id. Of rows with the same text one stays, also if they share an id; of
    near duplicates, that with the smallest id. An empty table gives an empty result.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        path = shared_path(spark)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
