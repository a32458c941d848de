import pytest
from conftest import to_spark, valid_pandas

from plumbline.contract import FRAUD_POLICIES, FillPolicy
from plumbline.operators import imputation


@pytest.fixture(scope="module")
def filled(spark):
    frame = valid_pandas()
    return frame, imputation.impute_guarded(to_spark(spark, frame), FRAUD_POLICIES).toPandas()


@pytest.mark.parametrize("policy", FRAUD_POLICIES, ids=lambda p: p.column)
def test_fill_value_indicator_and_untouched_cells(filled, policy):
    before, after = filled
    missing = before[policy.column].isna()
    expected = before[policy.column].median() if policy.strategy == "median" else before[policy.column].mode().iloc[0]
    assert after[policy.indicator].tolist() == missing.astype(int).tolist()
    assert after.loc[missing, policy.column].round(9).eq(round(expected, 9)).all()
    assert after.loc[~missing, policy.column].equals(before.loc[~missing, policy.column])


def test_indicators_follow_the_columns_in_policy_order(filled):
    before, after = filled
    assert list(after.columns) == [*before.columns, *[p.indicator for p in FRAUD_POLICIES]]
    assert not after.isna().any().any()


@pytest.mark.parametrize("policy", FRAUD_POLICIES, ids=lambda p: p.column)
def test_rate_above_the_ceiling_stops_the_job(spark, policy):
    frame = valid_pandas(rates={policy.column: policy.ceiling + 0.15})
    with pytest.raises(imputation.MissingRateExceeded, match=policy.column):
        imputation.impute_guarded(to_spark(spark, frame), FRAUD_POLICIES)


def test_absent_column_and_first_violation_in_policy_order(spark):
    df = to_spark(spark, valid_pandas(rates={"store_type": 0.9, "customer_age": 0.9}))
    with pytest.raises(imputation.MissingRateExceeded, match="customer_age"):
        imputation.impute_guarded(df, FRAUD_POLICIES)
    with pytest.raises(imputation.MissingRateExceeded, match="velocity_score not found"):
        imputation.impute_guarded(df.drop("velocity_score"), FRAUD_POLICIES)


def test_unknown_strategy_is_refused(spark):
    with pytest.raises(NotImplementedError):
        imputation.impute(to_spark(spark, valid_pandas()), [FillPolicy("num_items", "mean", 0.5, 0.1)])


def test_mode_tie_takes_the_smallest(spark):
    df = spark.createDataFrame([(2.0,), (2.0,), (1.0,), (1.0,), (5.0,), (None,)], "v double")
    assert imputation.modes(df, ["v"]) == {"v": 1.0}


def test_proposed_ceilings_equal_the_declared_ones(spark):
    rows = [(p.column, p.validated_rate, p.ceiling) for p in FRAUD_POLICIES]
    df = spark.createDataFrame(rows, "c string, rate double, ceiling double")
    for r in imputation.proposed_ceilings(df, "rate").collect():
        assert r["proposed_ceiling"] == pytest.approx(r["ceiling"]), r["c"]


def test_median_of_integers_is_not_cut(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (10,), (None,)], "num_items int")
    found = imputation.impute(df, [FillPolicy("num_items", "median", 0.5, 0.1)])
    assert sorted(r["num_items"] for r in found.collect()) == [1.0, 2.0, 2.5, 3.0, 10.0]
