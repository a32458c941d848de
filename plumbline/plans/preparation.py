"""From the trusted table to model inputs: drop indicators, split, fit on train, apply to both."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.contract import FRAUD_POLICIES
from plumbline.operators.features import (
    Preprocessor,
    drop_indicators,
    fit_preprocessor,
    stratified_split,
    transform,
)
from plumbline.sources.readers import scan_trusted
from plumbline.sources.sinks import feature_metadata, write_processed


@dataclass(frozen=True)
class PreparedData:
    processed_path: str
    parameters_path: str
    fitted: Preprocessor
    metadata_path: str


def split_trusted(validated: DataFrame, key: str, label: str) -> DataFrame:
    return stratified_split(drop_indicators(validated, FRAUD_POLICIES), key, label)


def run_preparation(
    spark: SparkSession, validated_path: str, processed_path: str, parameters_path: str, key: str, label: str
) -> PreparedData:
    """The whole stage: data of both splits, the fitted parameters, and beside those the metadata of
    the features they make. The split is a projection, so re-reading it per fit costs no shuffle."""
    split = split_trusted(scan_trusted(spark, validated_path, "validation"), key, label)
    fitted = fit_preprocessor(split.where(F.col("split") == "train"))
    write_processed(transform(split, fitted, [key, label, "split"]), processed_path)
    fitted.table(spark).coalesce(1).write.mode("overwrite").parquet(parameters_path)
    metadata_path = f"{parameters_path.rstrip('/')}-metadata"
    feature_metadata(spark, fitted).coalesce(1).write.mode("overwrite").json(metadata_path)
    return PreparedData(processed_path, parameters_path, fitted, metadata_path)


def load_processed(spark: SparkSession, path: str) -> DataFrame:
    return scan_trusted(spark, path, "preparation")
