"""From raw documents to a tokenised training corpus: the stages in order, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tollgate.llm import decontaminate, kneser_ney, queries, secrets_scan, sentencepiece_codec, simhash
from tollgate.llm.frames import saved, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that read like trusted text stay."""
    return kneser_ney.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays, the one with the smallest id."""
    return simhash.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold too much of a benchmark go."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets in its text are masked."""
    return secrets_scan.redact(docs)


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's token ids, with their number, digest and checks."""
    return sentencepiece_codec.encode(docs, queries.MODEL_FILE).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality classifier", quality_classifier),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scan", secret_scan),
    ("sentencepiece encoding", sentencepiece_encoding),
]

#: The stages hold trained models, hashes and compression, which DuckDB SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
