import os

import pytest
from conftest import to_spark, valid_pandas

from plumbline.operators import rules, scoring
from plumbline.operators.fingerprint import artifact_fingerprint, table_fingerprint
from plumbline.plans import preparation, training, validation
from plumbline.sources import readers, sinks


def keyed(spark, n=400):
    return to_spark(spark, valid_pandas(n).assign(tx_id=range(n)))


@pytest.fixture(scope="module")
def stage(spark, tmp_path_factory):
    """The whole chain on a small table."""
    root = str(tmp_path_factory.mktemp("stage"))
    outcome = validation.run_validation(
        keyed(spark), rules.rule_book(), f"{root}/reports", f"{root}/validated", "unit", keys=["tx_id"]
    )
    data = preparation.run_preparation(
        spark, outcome.validated_path, f"{root}/processed", f"{root}/parameters", "tx_id", "is_fraud"
    )
    model = training.run_training(
        spark, data.processed_path, data.parameters_path, f"{root}/training", "tx_id", "is_fraud", trees=5, max_depth=3
    )
    return outcome, data, model


def test_stages_record_what_they_did(spark, stage):
    _, data, model = stage
    metadata = spark.read.json(data.metadata_path).collect()
    assert {r["feature_name"] for r in metadata} == set(data.fitted.feature_names)
    runs = spark.read.schema(sinks.RUN_SCHEMA).parquet(model.runs_path).where(f"run_id = '{model.run_id}'").collect()
    entries = {(r["kind"], r["key"]): r["value"] for r in runs}
    assert entries["param", "numTrees"] == "5" and entries["param", "maxDepth"] == "3"
    report = spark.read.json(model.report_path).first().asDict()
    assert {k: float(v) for (kind, k), v in entries.items() if kind == "metric"} == report
    assert entries["artifact", "model"] == model.model_path


def test_forest_does_not_depend_on_files(spark, stage):
    _, data, _ = stage
    train = preparation.load_processed(spark, data.processed_path).where("split = 'train'")
    names = data.fitted.feature_names
    one, other = (
        training.fit_forest(df, names, "is_fraud", trees=3, max_depth=4, key="tx_id").toDebugString.split("\n", 1)[1]
        for df in (train.coalesce(1), train.repartition(7))
    )
    assert one == other


def test_all_offending_values_are_written(spark, tmp_path):
    frame = valid_pandas(200)
    frame["device_type"] = [100.0 + i for i in range(200)]
    outcome = validation.run_validation(
        to_spark(spark, frame), rules.rule_book(), f"{tmp_path}/reports", f"{tmp_path}/validated", "unit"
    )
    assert not outcome.passed
    written = spark.read.parquet(outcome.offenders_path).where("rule_name LIKE '%device%'")
    assert sorted(r["value"] for r in written.collect()) == [100.0 + i for i in range(200)]
    assert sinks.read_reports(spark, outcome.report_path).count() == len(outcome.results)


def test_passing_table_is_filled_and_reported(spark, stage):
    outcome, _, _ = stage
    assert outcome.passed and outcome.row_count == 400 and outcome.column_count == 13
    written = spark.read.parquet(outcome.validated_path)
    assert len(written.columns) == 1 + 13 + 12 and written.count() == 400
    report = sinks.read_reports(spark, outcome.report_path).collect()
    assert len(report) == 31 and all(r["report_passed"] for r in report)


def test_failing_table_is_reported_but_not_written(spark, tmp_path):
    bad = keyed(spark).withColumn("customer_age", validation.F.lit(999.0))
    outcome = validation.run_validation(
        bad, rules.rule_book(), f"{tmp_path}/reports", f"{tmp_path}/validated", "unit", keys=["tx_id"]
    )
    assert not outcome.passed and outcome.validated_path is None
    assert not os.path.exists(f"{tmp_path}/validated")
    failed = sinks.read_reports(spark, outcome.report_path).where("NOT passed").collect()
    assert {r["rule_name"] for r in failed} == {"customer_age_valid", "expectation_suite"}


def test_suite_runs_even_when_the_schema_fails(spark, tmp_path):
    outcome = validation.run_validation(
        keyed(spark).drop("device_type"), rules.rule_book(), f"{tmp_path}/r", f"{tmp_path}/v", "unit", keys=["tx_id"]
    )
    assert [r["rule_name"] for r in outcome.results][-1] == "expectation_suite"
    assert len(outcome.results) == 4


def test_reports_are_appended(spark, tmp_path):
    for _ in range(2):
        validation.run_validation(
            keyed(spark), rules.rule_book(), f"{tmp_path}/r", f"{tmp_path}/v", "unit", suite=None, keys=["tx_id"]
        )
    assert sinks.read_reports(spark, f"{tmp_path}/r").select("run_id").distinct().count() == 2


def test_model_metrics_and_manifest(spark, stage):
    _, data, model = stage
    report = spark.read.json(model.report_path).first().asDict()
    assert set(report) == {"accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc"}
    assert all(row[3] for row in training.verify_manifest(spark, model.model_path, data.parameters_path, model.manifest_path))


def test_changed_parameters_are_refused(spark, stage, tmp_path):
    _, data, model = stage
    other = f"{tmp_path}/parameters"
    spark.read.parquet(data.parameters_path).withColumn("mean", training.F.col("mean") + 1).write.parquet(other)
    with pytest.raises(training.ManifestMismatch, match="preprocessor"):
        training.load_verified(spark, model.model_path, other, model.manifest_path)
    with pytest.raises(readers.MissingInput):
        training.load_verified(spark, model.model_path, data.parameters_path, f"{tmp_path}/nowhere")


def test_missing_inputs_leave_nothing_behind(spark, tmp_path):
    with pytest.raises(readers.MissingInput, match="preparation"):
        training.run_training(spark, f"{tmp_path}/x", f"{tmp_path}/y", f"{tmp_path}/out", "tx_id", "is_fraud")
    with pytest.raises(readers.MissingInput, match="validation"):
        preparation.run_preparation(spark, f"{tmp_path}/x", f"{tmp_path}/p", f"{tmp_path}/q", "tx_id", "is_fraud")
    assert os.listdir(tmp_path) == []


def test_training_repeats_itself(spark, stage):
    _, data, _ = stage
    train = preparation.load_processed(spark, data.processed_path).where("split = 'train'")
    a, b = (training.fit_forest(train, data.fitted.feature_names, "is_fraud", 4, 3) for _ in range(2))
    assert a.toDebugString == b.toDebugString.replace(b.uid, a.uid)


def test_kept_nodes_give_the_trees_of_spark(spark, stage):
    _, data, _ = stage
    train = preparation.load_processed(spark, data.processed_path).where("split = 'train'")
    names = data.fitted.feature_names
    forest = training.fit_forest(train, names, "is_fraud", 5, 12, key="tx_id")
    assert forest.getCacheNodeIds()
    weights = {r["label"]: r["weight"] for r in training.class_weights(train, "is_fraud").collect()}
    weight = training.F.when(training.F.col("is_fraud") == 1, weights[1]).otherwise(weights[0])
    vectors = scoring.with_features(training.dealt(train, training.PARTS, "tx_id"), names, ["is_fraud"])
    plain = training.RandomForestClassifier(
        labelCol="is_fraud", weightCol="weight", numTrees=5, maxDepth=12, seed=training.SEED, cacheNodeIds=False
    ).fit(vectors.withColumn("weight", weight))
    assert forest.toDebugString.replace(forest.uid, plain.uid) == plain.toDebugString


def test_rows_are_scored_once_for_all_metrics(spark):
    scorings = spark.sparkContext.accumulator(0)

    def score(x):
        scorings.add(1)
        return x

    rows = [(i % 2, i % 3 % 2, i / 20) for i in range(20)]
    frame = spark.createDataFrame(rows, "y int, hard_prediction int, p double")
    scored = frame.withColumn("fraud_probability", training.F.udf(score, "double")("p"))
    found = training.evaluate(scored, "y")
    assert scorings.value == 20
    assert found["accuracy"] == sum(y == h for y, h, _ in rows) / 20
    pairs = [(a, b) for y, _, a in rows if y for z, _, b in rows if not z]
    assert found["roc_auc"] == pytest.approx(sum(a > b for a, b in pairs) / len(pairs))


def test_requests_are_checked_before_scoring(spark, stage):
    _, data, model = stage
    forest, fitted = training.load_verified(spark, model.model_path, data.parameters_path, model.manifest_path)
    frame = valid_pandas(120, {c: 0 for c in valid_pandas(1).columns}).assign(tx_id=range(120))
    frame.loc[5, "customer_age"] = 250.0
    frame.loc[6, "transaction_amount"] = None
    frame.loc[7, "device_type"] = 77.0
    requests = to_spark(spark, frame)
    refused = {r["tx_id"]: r["violations"] for r in scoring.check_requests(requests).where("size(violations) > 0").collect()}
    assert refused == {5: ["customer_age_valid"], 6: ["transaction_amount_required"]}
    scored = scoring.score(requests, fitted, forest, ["tx_id"]).toPandas()
    assert len(scored) == 118 and scored["fraud_probability"].between(0, 1).all()
    assert (scored["is_fraud_prediction"] == (scored["fraud_probability"] >= 0.5)).all()


def test_evaluation_needs_both_classes(spark):
    scored = spark.createDataFrame([(0, 0, 0.1), (0, 0, 0.2)], "y int, hard_prediction int, fraud_probability double")
    with pytest.raises(ValueError, match="both classes"):
        training.evaluate(scored, "y")


def test_fingerprints(spark, tmp_path):
    df = keyed(spark)
    same = table_fingerprint(df).first()
    assert same == table_fingerprint(df.repartition(7)).first()
    assert same != table_fingerprint(df.withColumn("num_items", validation.F.lit(1.0))).first()
    assert same != table_fingerprint(df.unionByName(df.limit(1))).first()
    df.coalesce(1).write.parquet(f"{tmp_path}/a")
    assert artifact_fingerprint(spark, f"{tmp_path}/a") == artifact_fingerprint(spark, f"{tmp_path}/a")


def test_text_scan_and_label_scan(spark, tmp_path):
    with open(tmp_path / "raw.csv", "w") as f:
        f.write("customer_age,is_fraud\n30,0\nNA,1\nold,x\n,1\nNaN,0\n")
    typed = readers.typed(readers.scan_text(spark, f"{tmp_path}/raw.csv"))
    assert typed.dtypes == [("customer_age", "double"), ("is_fraud", "bigint")]
    assert [tuple(r) for r in typed.collect()] == [(30.0, 0), (None, 1), (None, None), (None, 1), (None, 0)]
    with pytest.raises(readers.MissingInput):
        readers.scan_text(spark, f"{tmp_path}/none.csv")
    with pytest.raises(ValueError, match="exactly one column"):
        readers.scan_label(typed)


def test_run_history(spark, tmp_path):
    path = f"{tmp_path}/runs"
    sinks.append_run(spark, path, "a", {"metric": {"f1": 0.1, "recall": 0.5}, "param": {"trees": 10}})
    sinks.append_run(spark, path, "b", {"metric": {"f1": 0.3, "recall": 0.2}})
    runs = spark.read.parquet(path)
    assert sinks.best_run(runs, "f1").first()["run_id"] == "b"
    table = {r["run_id"]: r["recall"] for r in sinks.compare_runs(runs, ["f1", "recall"]).collect()}
    assert table == {"a": "0.5", "b": "0.2"}
