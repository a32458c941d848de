import math

import numpy as np
import pandas as pd
import pytest
from conftest import to_spark, valid_pandas

from plumbline.contract import CATEGORICAL_DRIVERS, CONTINUOUS_DRIVERS, FRAUD_POLICIES
from plumbline.operators import missingness

COLUMNS = [p.column for p in FRAUD_POLICIES]


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(3)
    data = valid_pandas(3000, {c: 0 for c in COLUMNS})
    for policy in FRAUD_POLICIES:
        data.loc[rng.random(len(data)) < policy.validated_rate, policy.column] = np.nan
    data.loc[(data["store_type"] == 1) & (rng.random(len(data)) < 0.4), "customer_age"] = np.nan
    data.loc[data["customer_age"].isna() & (rng.random(len(data)) < 0.5), "is_fraud"] = 1
    return data


@pytest.fixture(scope="module")
def table(spark, frame):
    return to_spark(spark, frame)


def test_label_split_equals_the_two_proportion_test(table, frame):
    found = missingness.label_rate_split(missingness.missing_patterns(table, COLUMNS, "is_fraud"), COLUMNS)
    rows = {r["column_name"]: r for r in found.collect()}
    for column in COLUMNS:
        gone = frame[column].isna()
        n1, n0 = gone.sum(), (~gone).sum()
        x1, x0 = frame.loc[gone, "is_fraud"].sum(), frame.loc[~gone, "is_fraud"].sum()
        pool = (x1 + x0) / (n1 + n0)
        z = (x1 / n1 - x0 / n0) / math.sqrt(pool * (1 - pool) * (1 / n1 + 1 / n0))
        assert rows[column]["z"] == pytest.approx(z)
        assert rows[column]["p_value"] == pytest.approx(math.erfc(abs(z) / math.sqrt(2)), abs=1e-6)
    assert rows["customer_age"]["flagged"]


def test_columns_without_missing_rows_have_no_label_split(spark):
    df = to_spark(spark, valid_pandas(rates={"num_items": 0.0}))
    found = missingness.label_rate_split(missingness.missing_patterns(df, COLUMNS, "is_fraud"), COLUMNS)
    assert "num_items" not in {r["column_name"] for r in found.collect()}


def test_driver_spreads_equal_pandas(table, frame):
    by_category = {(r["column_name"], r["driver"]): r for r in missingness.missing_by_category(table, COLUMNS).collect()}
    by_quartile = {(r["column_name"], r["driver"]): r for r in missingness.missing_by_quartile(table, COLUMNS).collect()}
    for column in COLUMNS:
        for driver in CATEGORICAL_DRIVERS:
            if driver != column:
                rates = frame[column].isna().groupby(frame[driver]).mean()
                assert by_category[column, driver]["spread"] == pytest.approx(rates.max() - rates.min())
        for driver in CONTINUOUS_DRIVERS:
            if driver != column:
                bins = pd.qcut(frame[driver], 4, duplicates="drop")
                rates = frame[column].isna().groupby(bins, observed=True).mean()
                assert by_quartile[column, driver]["spread"] == pytest.approx(rates.max() - rates.min())
    assert by_category["customer_age", "store_type"]["flagged"]


def test_indicator_correlation_equals_pandas(table, frame):
    expected = frame[COLUMNS].isna().astype(float).corr().abs()
    found = missingness.missingness_correlation(missingness.missing_patterns(table, COLUMNS, "is_fraud"), COLUMNS)
    for r in found.collect():
        others = expected[r["column_name"]].drop(r["column_name"])
        assert r["max_abs_correlation"] == pytest.approx(others.max())


def test_constant_indicators_and_constant_drivers_are_left_out(spark):
    frame = valid_pandas(rates={"num_items": 0.0}).assign(velocity_score=4.0)
    df = to_spark(spark, frame)
    patterns = missingness.missing_patterns(df, ["num_items", "velocity_score"], "is_fraud")
    assert [r["max_abs_correlation"] for r in missingness.missingness_correlation(patterns, ["num_items", "velocity_score"]).collect()] == [None, None]
    spreads = missingness.missing_by_quartile(df, ["customer_age"], ["velocity_score", "transaction_amount"]).collect()
    assert [r["driver"] for r in spreads] == ["transaction_amount"]


def test_report_names_unknown_columns_and_gives_verdicts(table):
    report = missingness.missingness_report(table, ["customer_age", "nowhere"], "is_fraud")
    checks = {(r["column_name"], r["check_name"]) for r in report.collect()}
    assert ("nowhere", "column_not_found") in checks and ("customer_age", "missing_rate") in checks
    hints = {r["column_name"]: r["verdict_hint"] for r in missingness.verdict_hints(report).collect()}
    assert hints["customer_age"] == "INVESTIGATE"


def test_guard_per_batch(table):
    found = missingness.missing_rate_guards(table, by=[missingness.F.col("is_fraud")])
    assert found.count() == 24 and found.columns[0] == "is_fraud"


def test_patterns_of_two_hundred_columns(spark):
    rng = np.random.default_rng(3)
    columns = [f"c{i}" for i in range(200)]
    gone = rng.random((120, 200)) < rng.uniform(0, 0.6, 200)
    gone[:, 5], gone[:, 6], gone[:, 130] = False, True, gone[:, 64]
    frame = pd.DataFrame(np.where(gone, np.nan, 1.0), columns=columns).assign(is_fraud=rng.integers(0, 2, 120))
    df = to_spark(spark, frame)
    patterns = missingness.missing_patterns(df, columns, "is_fraud")
    rates = {r["column_name"]: r["n_missing"] for r in missingness.missing_rates(patterns, columns).collect()}
    assert rates == dict(zip(columns, gone.sum(axis=0).tolist()))
    found = missingness.missingness_correlation(patterns, columns).collect()
    expected = pd.DataFrame(gone.astype(float), columns=columns).corr().abs()
    expected = expected.mask(np.eye(200, dtype=bool)).max()
    assert len(found) == 200
    for r in found:
        value = expected[r["column_name"]]
        assert (r["max_abs_correlation"] is None) if np.isnan(value) else abs(r["max_abs_correlation"] - value) < 1e-9
    assert next(r for r in found if r["column_name"] == "c130")["flagged"]
