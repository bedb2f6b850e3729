"""A corpus pipeline: stages over `documents`, each written as Parquet and read again by the next."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from minekit.llm import decontaminate, lines, packing, simhash, toxicity
from minekit.llm.common import crc_mod, intermediates_removed, remove
from minekit.plans.bounds import shared_dir


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored toxic (0.5 or more) go. The model learns from labelled documents outside the held-out fifth."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels.where(crc_mod(F.col("doc_id"), 5) != 0))
    return toxicity.without_toxic(docs, model)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of at least 40 code points found in at least 5 documents stay in one of them; `n_chars` follows the text."""
    kept = lines.without_repeated_lines(docs)
    length = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.withColumn("n_chars", length)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one with the smallest id. Texts without words,
    which line dedup may leave, are near-duplicates of each other. Shingles and distance are the operator's."""
    return simhash.without_near_duplicates(docs)


def contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words a twentieth or more lie in windows of a benchmark item go."""
    return decontaminate.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of at most 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxic),
    ("line_dedup", repeated_lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", contaminated),
    ("packing", packed),
]

#: SQL has neither the classifier nor XXH64 nor the tokenizer; tests/llm holds the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order. Every result is written to the shared folder, so each stage starts from files; when
    it is there, what came before is removed. Only the last result stays."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{shared_dir(spark).rstrip('/')}/minekit-pipeline-{uuid.uuid4().hex}"
    last = None
    for name, stage in STAGES:
        with intermediates_removed(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        if last:
            remove(spark, last)
        last = f"{base}/{name}"
        docs = spark.read.parquet(last)
    return docs
