"""The forest that is grown with numpy against Spark's, node by node, and its random numbers."""

import numpy as np
import pandas as pd
import pytest
from conftest import to_spark
from pyspark.ml.classification import RandomForestClassifier

from plumbline.functions import draws
from plumbline.operators import forest, scoring
from plumbline.plans import training


@pytest.mark.parametrize(("seed", "samples"), [(43, 5_000), (-7, 150_000)])
def test_counts_are_those_of_the_generator(spark, seed, samples):
    plain = spark.sparkContext._jvm.org.apache.commons.math3.distribution.PoissonDistribution(1.0)
    plain.reseedRandomGenerator(seed)
    found = np.concatenate(list(draws.poisson_counts(seed, samples)))
    assert found.tolist() == list(plain.sample(samples))


def test_counts_go_on_after_all_lanes_are_used(spark, monkeypatch):
    monkeypatch.setattr(draws, "LANES", 3)
    monkeypatch.setattr(draws, "LANE", 1 << 13)
    plain = spark.sparkContext._jvm.org.apache.commons.math3.distribution.PoissonDistribution(1.0)
    plain.reseedRandomGenerator(9)
    found = np.concatenate(list(draws.poisson_counts(9, 20_000)))
    assert found.tolist() == list(plain.sample(20_000))


def table(n: int, classes: int = 2) -> pd.DataFrame:
    rng = np.random.default_rng(4)
    frame = pd.DataFrame(
        {
            "key": np.arange(n),
            "smooth": rng.normal(size=n),
            "whole": rng.integers(0, 50, n) - 10.0,
            "few": rng.integers(0, 3, n) * 1.0,
            "flag": rng.integers(0, 2, n) * 1.0,
            "unflag": 0.0,
            "constant": 2.5,
            "rare": (rng.random(n) < 0.01) * 7.0,
        }
    )
    frame["unflag"] = 1 - frame["flag"]
    frame["y"] = ((frame["smooth"] + rng.normal(size=n) > 0.5).astype(int) + (frame["whole"] > 30)).clip(0, classes - 1)
    return frame


def nodes(spark, model, path) -> dict:
    model.write().save(str(path))
    saved = spark.read.parquet(f"{path}/data").collect()
    return {(r["treeID"], r["nodeData"]["id"]): r["nodeData"] for r in saved}


# Rows with and without sampling for thresholds, and groups of nodes that do not hold a whole level.
@pytest.mark.parametrize(
    ("rows", "trees", "depth", "memory", "classes"),
    [(700, 12, 13, 256, 2), (12_000, 7, 6, 256, 3), (30_000, 6, 9, 1, 2), (300, 1, 4, 256, 2)],
)
def test_every_node_is_that_of_spark(spark, tmp_path, monkeypatch, rows, trees, depth, memory, classes):
    monkeypatch.setattr(forest, "CHUNK", 500)
    frame = table(rows, classes)
    names = [c for c in frame if c not in ("key", "y")]
    dealt = training.dealt(to_spark(spark, frame), 3, "key")
    found = training.class_weights(dealt, "y").collect()
    weights, counts = ({r["label"]: r[c] for r in found} for c in ("weight", "n"))
    settings = RandomForestClassifier(
        labelCol="y", weightCol="weight", numTrees=trees, maxDepth=depth, seed=11, maxMemoryInMB=memory
    )
    own = forest.fit(dealt, names, "y", weights, counts, settings)
    weight = training.F.lit(None).cast("double")
    for value, w in weights.items():
        weight = training.F.when(training.F.col("y") == value, w).otherwise(weight)
    plain = settings.fit(scoring.with_features(dealt, names, ["y"]).withColumn("weight", weight))
    assert nodes(spark, own, tmp_path / "own") == nodes(spark, plain, tmp_path / "plain")
    assert own.numClasses == plain.numClasses and own.featureImportances == plain.featureImportances


def test_missing_features_are_refused(spark):
    frame = table(100)
    frame.loc[3, "smooth"] = np.nan
    settings = RandomForestClassifier(labelCol="y", weightCol="weight", numTrees=2)
    with pytest.raises(Exception, match="must be present and finite"):
        forest.fit(to_spark(spark, frame), ["smooth", "few"], "y", {0: 1.0, 1: 1.0}, {0: 50, 1: 50}, settings)


@pytest.mark.parametrize("classes", [2, 3])
def test_scores_are_those_of_the_model(spark, classes):
    frame = table(900, classes)
    names = [c for c in frame if c not in ("key", "y")]
    vectors = scoring.with_features(to_spark(spark, frame), names, ["key", "y"])
    model = RandomForestClassifier(labelCol="y", numTrees=9, maxDepth=7, seed=3).fit(vectors)
    found = scoring.predict(model, vectors, ["key"])
    assert "MapInArrow" in found._jdf.queryExecution().toString()
    plain = {r["key"]: (r["probability"][1], int(r["prediction"])) for r in model.transform(vectors).collect()}
    rows = found.collect()
    assert {r["key"]: (r["fraud_probability"], r["hard_prediction"]) for r in rows} == plain
    assert all(r["is_fraud_prediction"] == (r["fraud_probability"] >= 0.5) for r in rows)
