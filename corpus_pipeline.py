"""The corpus pipeline: quality, near duplicates, benchmark passages, secrets, mixing.

Each stage takes (spark, docs, sf_dir) and works on every document its predecessor kept. All but
the last return the columns of ``documents``; the last returns the training schedule, one row per
document and pass. A stage that changes a text sets ``n_chars`` to its new length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import mixing, rule_ensemble, secrets, suffix, token_groups
from plumbline.workspace import Workspace

SHINGLE_WORDS, SIMILARITY_PERCENT = 5, 80


def _measured(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    Workspace.of(spark).release(executors=True)
    return rule_ensemble.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    Workspace.of(spark).release(executors=True)
    return token_groups.one_of_each(docs, size=SHINGLE_WORDS, percent=SIMILARITY_PERCENT)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    Workspace.of(spark).release(executors=True)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _measured(suffix.remove_spans(docs, benchmark))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    Workspace.of(spark).release(executors=True)
    return _measured(secrets.redact_secrets(docs))


def temperature_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    Workspace.of(spark).release(executors=True)
    return mixing.mix_sources(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secret_scan),
    ("temperature_mixing", temperature_mixing),
]

# Trained rules and forests and the budgeted permutation are not expressible in SQL; the tests
# compare every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = Workspace.of(spark).stage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
