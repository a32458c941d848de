import numpy as np
import pandas as pd
import pytest

from plumbline.operators import metrics


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(2)
    y = (rng.random(600) < 0.2).astype(int)
    score = np.round(rng.random(600) * 0.8 + y * 0.2, 2)
    return pd.DataFrame({"y": y, "score": score, "p": (score > 0.5).astype(int)})


@pytest.fixture(scope="module")
def table(spark, frame):
    return spark.createDataFrame(frame).repartition(5)


def test_auc_counts_ties_half(table, frame):
    pos, neg = frame[frame.y == 1].score.values, frame[frame.y == 0].score.values
    won = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    assert metrics.roc_auc(table, "y", "score").first()["roc_auc"] == pytest.approx(won / len(pos) / len(neg))


def test_average_precision_steps_once_per_distinct_score(table, frame):
    total, previous, expected = frame.y.sum(), 0, 0.0
    for s in sorted(frame.score.unique(), reverse=True):
        above = frame[frame.score >= s]
        tp = above.y.sum()
        expected += (tp - previous) / total * tp / len(above)
        previous = tp
    assert metrics.average_precision(table, "y", "score").first()["average_precision"] == pytest.approx(expected)
    both = metrics.ranking_metrics(table, "y", "score").first()
    assert both["pr_auc"] == pytest.approx(expected)


def test_known_small_case(spark):
    df = spark.createDataFrame([(0, 0.9), (1, 0.8), (0, 0.8), (1, 0.4), (1, 0.95)], "y int, score double")
    got = metrics.ranking_metrics(df, "y", "score").first()
    assert got["roc_auc"] == pytest.approx((2 + 0.5 + 0) / 6)
    assert got["pr_auc"] == pytest.approx(1 / 3 + 2 / 4 / 3 + 3 / 5 / 3)


def test_one_class_has_no_ranking_metric(spark):
    df = spark.createDataFrame([(0, 0.9), (0, 0.1)], "y int, score double")
    got = metrics.ranking_metrics(df, "y", "score").first()
    assert got["roc_auc"] is None and got["pr_auc"] is None


def test_undefined_hard_metrics_are_zero(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], "y int, p int")
    got = metrics.binary_metrics(df, "y", "p").first()
    assert (got["precision"], got["recall"], got["f1"]) == (0.0, 0.0, 0.0)
    assert got["accuracy"] == pytest.approx(2 / 3)


def test_weighted_f1_hides_a_useless_positive_class(spark):
    df = spark.createDataFrame([(0, 0)] * 90 + [(1, 0)] * 10, "y int, p int")
    got = metrics.weighted_f1(df, "y", "p").first()
    assert got["f1_positive"] == 0.0 and got["f1_weighted"] > 0.85


def test_class_weights_are_balanced(spark):
    df = spark.createDataFrame([(0,)] * 9 + [(1,)], "y int")
    got = {r["label"]: r["weight"] for r in metrics.class_weights(df, "y").collect()}
    assert got == {0: pytest.approx(10 / 18), 1: pytest.approx(5.0)}


def test_target_contract(spark):
    df = spark.createDataFrame([(0,), (1,), (2,), (None,)], "y int")
    got = metrics.target_contract(df, "y").first()
    assert (got["n_rows"], got["n_missing"], got["n_invalid"], got["passed"]) == (4, 1, 1, False)
