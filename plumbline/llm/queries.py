"""One query per operator, over its whole table, with the columns that the queries promise."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import (
    alignment,
    factorization,
    host_rules,
    line_dedup,
    mixing,
    mixture,
    rule_ensemble,
    secrets,
    suffix,
    token_groups,
    variants,
    warc,
    wrapper,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def external_index_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = warc.capture_history(_table(spark, sf_dir, "pages"))
    return captures.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key"
    )


def temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf_dir, "documents"))


def language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.predict_languages(_table(spark, sf_dir, "documents"))


def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = suffix.contaminated_spans(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )
    return hits.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        suffix.items_digest("items").alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.judged_findings(_table(spark, sf_dir, "documents"))


def ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_groups.near_duplicates(
        _table(spark, sf_dir, "documents"), size=4, percent=85
    )


def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = wrapper.main_text(_table(spark, sf_dir, "pages"))
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))


def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return factorization.toxicity_scores(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    )


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_ensemble.quality_scores(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    )


def host_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = host_rules.host_verdicts(_table(spark, sf_dir, "documents"))
    return verdicts.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(_table(spark, sf_dir, "documents"))


def line_dedup_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = line_dedup.drop_common_lines(_table(spark, sf_dir, "documents"))
    return lines.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_tokenizers(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_external_index_merge": external_index_merge,
    "op2_temperature_mixing": temperature_mixing,
    "op3_language_mixture": language_mixture,
    "op4_benchmark_decontamination": benchmark_decontamination,
    "op5_secret_scan": secret_scan,
    "op6_ngram_jaccard_join": ngram_jaccard_join,
    "op7_html_extraction": html_extraction,
    "op8_toxicity": toxicity,
    "op9_quality_classifier": quality_classifier,
    "op10_host_rules": host_quality_rules,
    "op11_spelling_variants": spelling_variants,
    "op12_line_dedup": line_dedup_documents,
    "op13_tokenizer_alignment": tokenizer_alignment,
}
