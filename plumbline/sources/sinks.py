"""What jobs leave behind: audit reports, trusted tables, parameters, metrics and run history."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.contract import SEED, TEST_SHARE
from plumbline.operators.features import Preprocessor

REPORT_SCHEMA = (
    "run_id string, timestamp_utc timestamp, source string, row_count bigint, column_count int, "
    "report_passed boolean, position int, rule_name string, category string, passed boolean, "
    "n_invalid bigint, errors array<string>, run_date date"
)
RUN_SCHEMA = "run_id string, kind string, key string, value string, ts timestamp"


def append_report(results: DataFrame, path: str, run_id: str, source: str, row_count: int, column_count: int, passed: bool) -> None:
    """One JSON row per rule, partitioned by the day of the run."""
    (
        results.select(
            F.lit(run_id).alias("run_id"),
            F.current_timestamp().alias("timestamp_utc"),
            F.lit(source).alias("source"),
            F.lit(row_count).cast("bigint").alias("row_count"),
            F.lit(column_count).alias("column_count"),
            F.lit(passed).alias("report_passed"),
            "position",
            "rule_name",
            "category",
            "passed",
            "n_invalid",
            "errors",
            F.current_date().alias("run_date"),
        )
        .coalesce(1)
        .write.mode("append")
        .partitionBy("run_date")
        .json(path)
    )


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REPORT_SCHEMA).json(path)


def write_processed(df: DataFrame, path: str) -> None:
    """Features, label and key of both splits, one folder per split."""
    df.write.partitionBy("split").parquet(path)


def feature_metadata(spark: SparkSession, fitted: Preprocessor) -> DataFrame:
    """One row per model input with the settings the features were made under."""
    rows = [
        (slot, name, feature, block, len(fitted.feature_names), SEED, TEST_SHARE)
        for slot, block, feature, _level, _fill, _mean, _scale, name in fitted.rows()
    ]
    return spark.createDataFrame(
        rows,
        "slot int, feature_name string, feature string, block string, n_features_out int, "
        "random_seed int, test_size double",
    )


def append_run(spark: SparkSession, path: str, run_id: str, entries: Mapping[str, Mapping[str, object]]) -> None:
    """Record parameters, metrics and artifact references of a run: {kind: {key: value}}."""
    rows = [(run_id, kind, k, str(v)) for kind, pairs in entries.items() for k, v in pairs.items()]
    frame = spark.createDataFrame(rows, "run_id string, kind string, key string, value string")
    frame.withColumn("ts", F.current_timestamp()).coalesce(1).write.mode("append").parquet(path)


def compare_runs(runs: DataFrame, keys: Sequence[str], kind: str = "metric") -> DataFrame:
    """One row per run with the chosen keys side by side."""
    return (
        runs.where((F.col("kind") == kind) & F.col("key").isin(list(keys)))
        .groupBy("run_id")
        .pivot("key", list(keys))
        .agg(F.max_by("value", "ts"))
    )


def best_run(runs: DataFrame, key: str) -> DataFrame:
    """The run with the largest value of a metric; the lower run id on a tie."""
    value = F.col("value").cast("double")
    return (
        runs.where((F.col("kind") == "metric") & (F.col("key") == key))
        .groupBy("run_id")
        .agg(F.max_by(value, "ts").alias("metric_value"))
        .agg(
            F.min_by("run_id", F.struct(-F.col("metric_value"), "run_id")).alias("run_id"),
            F.max("metric_value").alias("metric_value"),
        )
    )
