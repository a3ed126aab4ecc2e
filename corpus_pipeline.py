"""Corpus pipeline: toxicity, line dedup, SimHash near-dedup, benchmark decontamination, best-fit packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gradeloom.llm import decontamination, line_dedup, packing, simhash, toxicity
from gradeloom.llm.common import written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 1: documents that the classifier rejects go."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), threshold=0.7)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 2: lines that repeat over a source go, documents stay."""
    return line_dedup.clean_documents(docs, host="source", ratio=0.05, least_pages=3)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 3: one document of each group of exact and near copies stays."""
    return simhash.one_of_each_group(docs, shingle=5, least=0.8)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 4: documents that hold a benchmark item go."""
    return decontamination.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), least=0.8)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 5: what is left, as token sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=2048)


STAGES = [("toxicity", drop_toxic), ("line dedup", drop_boilerplate), ("SimHash near-dedup", drop_near_copies),
          ("benchmark decontamination", drop_leaks), ("best-fit packing", pack)]

#: Compression, near copies, alignment and the genetic search are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
