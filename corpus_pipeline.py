"""A training corpus from documents: toxic out, low quality out, one of each near copy, packed sequences.

Each stage works on everything its predecessor kept, and its result is written as Parquet and read
again, so a lost executor never costs more than the running stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kalends.llm import packing, severity, simhash, weak_quality
from kalends.llm.common import scratch, table
from kalends.llm.entries import tokenizer_path


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return severity.drop_toxic(docs, severity.train(docs, table(spark, sf_dir, "labels")))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return weak_quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [("toxicity", toxicity), ("quality", quality), ("near_dedup", near_dedup), ("packing", pack)]

#: Tokenizers, trained weights and fingerprints are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
