"""Fit and evaluate the forest on prepared data, and bind model and parameters by fingerprint."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import pyspark
from pyspark.errors import AnalysisException
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.contract import SEED
from plumbline.functions import sqltext as sql
from plumbline.operators.features import Preprocessor
from plumbline.operators.fingerprint import artifact_fingerprint
from plumbline.operators.forest import fit
from plumbline.operators.metrics import binary_metrics, class_weights, ranking_metrics, target_contract
from plumbline.operators.scoring import predict, with_features
from plumbline.plans.preparation import load_processed
from plumbline.sources.readers import MissingInput, scan_trusted
from plumbline.sources.sinks import append_run
from plumbline.workspace import Workspace

TREES = 100
MAX_DEPTH = 10
# Parts that the training rows are dealt to. The forest draws its samples part by part, so the same
# number gives the same forest on any cluster.
PARTS = 16
MANIFEST_SCHEMA = "model_hash string, preprocessor_hash string, engine_version string, trained_at timestamp"


class ManifestMismatch(RuntimeError):
    """A stored model or parameter table is not the one its manifest was written for."""


@dataclass(frozen=True)
class TrainedModel:
    model_path: str
    manifest_path: str
    report_path: str
    runs_path: str
    run_id: str


def check_targets(processed: DataFrame, label: str) -> None:
    found = target_contract(processed, label).first()
    if not found["passed"]:
        raise ValueError(
            f"labels must be 0 or 1: {found['n_missing']} missing, {found['n_invalid']} other values"
        )


def dealt(df: DataFrame, parts: int, key: str | None = None) -> DataFrame:
    """The rows in ``parts`` parts by the hash of the key, or of the whole row, and in its order:
    the same parts whatever files the table lies in."""
    order = [F.col(sql.name(c)) for c in ([key] if key else df.columns)]
    return df.repartition(parts, *order).sortWithinPartitions(*order)


def fit_forest(
    train: DataFrame,
    names: list[str],
    label: str,
    trees: int = TREES,
    max_depth: int = MAX_DEPTH,
    seed: int = SEED,
    key: str | None = None,
    parts: int = PARTS,
) -> RandomForestClassificationModel:
    """Class-balanced random forest, the one that Spark would fit with these settings, grown by
    ``operators.forest``. Depth is bounded because every level costs passes over the data and doubles
    what the driver keeps per tree; raise ``max_depth`` up to Spark's 30."""
    found = class_weights(train, label).collect()
    forest = RandomForestClassifier(
        labelCol=label, featuresCol="features", weightCol="weight", numTrees=trees, maxDepth=max_depth, seed=seed,
        cacheNodeIds=True, checkpointInterval=-1,
    )
    weights, counts = ({r["label"]: r[c] for r in found} for c in ("weight", "n"))
    return fit(dealt(train, parts, key), names, label, weights, counts, forest)


def evaluate(scored: DataFrame, label: str) -> dict[str, float]:
    """The six reported metrics; both classes must occur in the scored rows, which are scored once."""
    workspace = Workspace.of(scored.sparkSession)
    kept = workspace.stage(scored.select(label, "hard_prediction", "fraud_probability"), "scored")
    hard = binary_metrics(kept, label, "hard_prediction").first()
    if hard["tp"] + hard["fn"] == 0 or hard["fp"] + hard["tn"] == 0:
        raise ValueError("ranking metrics need both classes in the scored rows")
    ranking = ranking_metrics(kept, label, "fraud_probability").first()
    workspace.discard(kept)
    metrics = {m: hard[m] for m in ("accuracy", "precision", "recall", "f1")}
    return {**metrics, "roc_auc": ranking["roc_auc"], "pr_auc": ranking["pr_auc"]}


def write_manifest(spark: SparkSession, model_path: str, parameters_path: str, manifest_path: str) -> None:
    row = (artifact_fingerprint(spark, model_path), artifact_fingerprint(spark, parameters_path), pyspark.__version__)
    frame = spark.createDataFrame([row], "model_hash string, preprocessor_hash string, engine_version string")
    frame.withColumn("trained_at", F.current_timestamp()).coalesce(1).write.mode("overwrite").json(manifest_path)


def read_manifest(spark: SparkSession, manifest_path: str) -> DataFrame:
    try:
        return spark.read.schema(MANIFEST_SCHEMA).json(manifest_path)
    except AnalysisException as error:
        raise MissingInput(f"no manifest at {manifest_path}; run the training stage first") from error


def verify_manifest(spark: SparkSession, model_path: str, parameters_path: str, manifest_path: str) -> list[tuple]:
    """(artifact, recorded, found, matches) for both artifacts."""
    recorded = read_manifest(spark, manifest_path).first()
    pairs = (
        ("model", recorded["model_hash"], artifact_fingerprint(spark, model_path)),
        ("preprocessor", recorded["preprocessor_hash"], artifact_fingerprint(spark, parameters_path)),
    )
    return [(name, was, now, was == now) for name, was, now in pairs]


def load_verified(
    spark: SparkSession, model_path: str, parameters_path: str, manifest_path: str
) -> tuple[RandomForestClassificationModel, Preprocessor]:
    """Model and parameters, only if both are what the manifest recorded."""
    for name, was, now, matches in verify_manifest(spark, model_path, parameters_path, manifest_path):
        if not matches:
            raise ManifestMismatch(f"the {name} does not match its manifest: recorded {was}, found {now}")
    parameters = scan_trusted(spark, parameters_path, "preparation")
    return RandomForestClassificationModel.load(model_path), Preprocessor.from_table(parameters)


def run_training(
    spark: SparkSession,
    processed_path: str,
    parameters_path: str,
    output_path: str,
    key: str,
    label: str,
    trees: int = TREES,
    max_depth: int = MAX_DEPTH,
    parts: int = PARTS,
) -> TrainedModel:
    """The whole stage; inputs are checked before anything is written. The run is added to the
    history of runs under the output path: its parameters, metrics and where its artifacts are."""
    processed = load_processed(spark, processed_path)
    fitted = Preprocessor.from_table(scan_trusted(spark, parameters_path, "preparation"))
    check_targets(processed, label)
    train = processed.where(F.col("split") == "train")
    model = fit_forest(train, fitted.feature_names, label, trees, max_depth, key=key, parts=parts)
    paths = TrainedModel(
        f"{output_path}/model", f"{output_path}/manifest", f"{output_path}/evaluation", f"{output_path}/runs",
        uuid.uuid4().hex,
    )
    model.write().overwrite().save(paths.model_path)
    metrics = evaluate(score_split(processed, model, fitted, key, label, "test"), label)
    report = spark.createDataFrame(
        [tuple(metrics.values())], ", ".join(f"{m} double" for m in metrics)
    )
    report.coalesce(1).write.mode("overwrite").json(paths.report_path)
    write_manifest(spark, paths.model_path, parameters_path, paths.manifest_path)
    settings = {p.name: value for p, value in model.extractParamMap().items()}
    artifacts = {"model": paths.model_path, "evaluation": paths.report_path, "manifest": paths.manifest_path}
    entries = {"param": settings | {"parts": parts}, "metric": metrics, "artifact": artifacts}
    append_run(spark, paths.runs_path, paths.run_id, entries)
    return paths


def score_split(
    processed: DataFrame, model: RandomForestClassificationModel, fitted: Preprocessor, key: str, label: str, split: str
) -> DataFrame:
    rows = processed.where(F.col("split") == split)
    return predict(model, with_features(rows, fitted.feature_names, [key, label]), [key, label])


def feature_importance(
    spark: SparkSession, model: RandomForestClassificationModel, fitted: Preprocessor
) -> DataFrame:
    rows = [
        (slot, name, float(model.featureImportances[slot])) for slot, name in enumerate(fitted.feature_names)
    ]
    return spark.createDataFrame(rows, "slot int, feature_name string, importance double")
