import hashlib
import math

import numpy as np
import pytest
from conftest import to_spark, valid_pandas

from plumbline.contract import CATEGORICAL_FEATURES, FRAUD_POLICIES, NUMERIC_FEATURES
from plumbline.operators import features


@pytest.fixture(scope="module")
def frame():
    return valid_pandas(400).assign(tx_id=range(400))


@pytest.fixture(scope="module")
def split(spark, frame):
    return features.stratified_split(to_spark(spark, frame), "tx_id", "is_fraud")


def test_quotas_sum_to_the_rounded_up_share():
    assert features.class_quotas({0: 7, 1: 3}, 0.2) == {0: 1, 1: 1}
    for counts in ({0: 895, 1: 105}, {0: 1, 1: 13}, {0: 333, 1: 333, 2: 335}):
        quotas = features.class_quotas(counts, 0.2)
        assert sum(quotas.values()) == math.ceil(0.2 * sum(counts.values()))
        assert all(abs(q - 0.2 * counts[c]) < 1.5 for c, q in quotas.items())


def test_split_takes_the_smallest_digests_of_each_class(split, frame):
    got = {r["tx_id"] for r in split.where("split = 'test'").collect()}
    digest = frame["tx_id"].map(lambda k: hashlib.md5(f"42:{k}".encode()).hexdigest())
    expected = set()
    for label, quota in features.class_quotas(frame["is_fraud"].value_counts().to_dict(), 0.2).items():
        part = frame.assign(d=digest)[frame["is_fraud"] == label].sort_values("d")
        expected |= set(part["tx_id"].iloc[:quota])
    assert got == expected


def test_split_does_not_depend_on_partitioning(spark, split, frame):
    again = features.stratified_split(to_spark(spark, frame).repartition(7), "tx_id", "is_fraud")
    assert sorted(split.select("tx_id", "split").collect()) == sorted(again.select("tx_id", "split").collect())


def test_split_keeps_its_quota_when_digests_collide(spark, frame, monkeypatch):
    monkeypatch.setattr(features, "split_digest", lambda key, seed: features.F.md5((key % 3).cast("string")))
    got = features.stratified_split(to_spark(spark, frame), "tx_id", "is_fraud")
    counts = {(r["is_fraud"], r["split"]): r["count"] for r in got.groupBy("is_fraud", "split").count().collect()}
    assert counts[0, "test"] == 72 and counts[1, "test"] == 8 and sum(counts.values()) == 400


def test_missing_label_cannot_be_split(spark):
    df = spark.createDataFrame([(1, 0), (2, None)], "k long, y int")
    with pytest.raises(ValueError):
        features.stratified_split(df, "k", "y")


def test_fit_uses_only_what_it_is_given(split, frame):
    train = split.where("split = 'train'")
    rows = train.toPandas()
    for p in features.fit_numeric(train):
        filled = rows[p.feature].fillna(rows[p.feature].median())
        assert p.fill == pytest.approx(rows[p.feature].median())
        assert p.mean == pytest.approx(filled.mean()) and p.scale == pytest.approx(filled.std(ddof=0))
    gaps = features.parameter_gap(train, split)
    assert any(abs(g[3] - g[4]) > 1e-9 for g in gaps)


def test_constant_column_scales_by_one(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (None,)], "a double")
    assert features.fit_numeric(df, ["a"]) == [features.NumericParameters("a", 5.0, 5.0, 1.0)]


def test_unseen_level_sets_no_column_and_missing_takes_the_mode(spark):
    train = spark.createDataFrame([(10.0,), (2.0,), (2.0,)], "a double")
    fitted = features.fit_categories(train, ["a"])
    assert fitted == [features.CategoryParameters("a", 2.0, (2.0, 10.0))]
    test = spark.createDataFrame([(5.0,), (None,), (10.0,)], "a double")
    got = test.selectExpr(*features.onehot_columns(fitted))
    assert got.columns == ["categorical__a_2.0", "categorical__a_10.0"]
    assert [tuple(r) for r in got.collect()] == [(0.0, 0.0), (1.0, 0.0), (0.0, 1.0)]


def test_too_many_levels_are_refused(spark):
    with pytest.raises(ValueError, match="levels"):
        features.fit_categories(spark.range(30).selectExpr("CAST(id AS DOUBLE) AS a"), ["a"], max_levels=20)


def test_transform_shape_names_and_parameter_table(spark, split):
    fitted = features.fit_preprocessor(split.where("split = 'train'"))
    assert features.Preprocessor.from_table(fitted.table(spark)) == fitted
    got = features.transform(split, fitted, ["tx_id", "split"])
    assert got.columns == ["tx_id", "split", *fitted.feature_names]
    assert fitted.feature_names[: len(NUMERIC_FEATURES)] == [f"numeric__{c}" for c in NUMERIC_FEATURES]
    assert len(fitted.feature_names) == 19
    frame = got.toPandas()
    assert not frame.isna().any().any()
    train = frame[frame["split"] == "train"]
    assert np.allclose(train[[f"numeric__{c}" for c in NUMERIC_FEATURES]].mean(), 0, atol=1e-9)
    for c in CATEGORICAL_FEATURES:
        block = [n for n in fitted.feature_names if n.startswith(f"categorical__{c}_")]
        assert (frame[block].sum(axis=1) == 1).all()


def test_indicators_are_dropped_and_absent_ones_ignored(spark, frame):
    df = to_spark(spark, frame).selectExpr("*", "1 AS customer_age_was_missing")
    assert features.drop_indicators(df, FRAUD_POLICIES).columns == list(frame.columns)


def test_alignment_counts_rows_without_a_partner(spark, split):
    labels = split.select("tx_id", "is_fraud", "split").where("tx_id NOT IN (3, 4)")
    rows = features.split_alignment(split.where("tx_id <> 9"), labels, "tx_id").collect()
    assert sum(r["features_without_label"] for r in rows) == 2
    assert sum(r["labels_without_features"] for r in rows) == 1


def test_split_keeps_its_quota_when_one_key_holds_a_third_of_the_rows(spark):
    rows = spark.range(900).selectExpr("if(id % 3 = 0, 17, id) AS k", "CAST(0 AS INT) AS y")
    got = features.stratified_split(rows, "k", "y", share=0.5)
    counts = {r["split"]: r["count"] for r in got.groupBy("split").count().collect()}
    assert counts == {"test": 450, "train": 450}
    beyond = {s: {r["k"] for r in got.where(f"split = '{s}'").collect()} for s in counts}
    assert beyond["test"] & beyond["train"] <= {17}


def test_quotas_of_three_classes_tie_exactly():
    assert features.class_quotas({0: 1, 1: 2, 2: 22}, 0.2) == {0: 0, 1: 1, 2: 4}
    assert features.class_quotas({0: 5, 1: 5, 2: 5}, 0.2) == {0: 1, 1: 1, 2: 1}
