import numpy as np
import pandas as pd
import pytest
from conftest import to_spark

from plumbline.operators import signal


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(5)
    n = 3000
    data = pd.DataFrame(
        {
            "k": rng.permutation(n),
            "strong": rng.normal(size=n),
            "ushape": rng.uniform(-1, 1, n),
            "noise": rng.integers(0, 50, n) * 1.0,
            "fixed": np.full(n, 2.0),
            "kind": rng.integers(0, 4, n) * 1.0,
            "place": rng.integers(0, 3, n) * 1.0,
        }
    )
    p = 0.15 + 0.3 * (data["strong"] > 1) + 0.3 * (data["ushape"].abs() > 0.8)
    data["y"] = (rng.random(n) < p).astype("int64")
    for c in ("strong", "noise", "kind"):
        data.loc[rng.random(n) < 0.1, c] = np.nan
    return data


@pytest.fixture(scope="module")
def table(spark, frame):
    return to_spark(spark, frame)


def rows(df, key="feature"):
    return {r[key]: r for r in df.collect()}


def test_roles(table):
    roles = signal.infer_roles(table.drop("k"), "y")
    assert roles == {
        "strong": "numeric", "ushape": "numeric", "noise": "numeric", "fixed": "categorical",
        "kind": "categorical", "place": "categorical",
    }


def test_correlation_is_pairwise_complete_and_null_for_constants(table, frame):
    found = rows(signal.label_correlation(table, "y", ["strong", "ushape", "noise", "fixed"]))
    for c in ("strong", "ushape", "noise"):
        assert found[c]["correlation"] == pytest.approx(frame[c].corr(frame["y"]))
    assert found["fixed"]["correlation"] is None and not found["fixed"]["flagged"]
    assert found["strong"]["flagged"] and not found["ushape"]["flagged"]


def test_decile_spread_equals_qcut(table, frame):
    found = rows(signal.decile_spread(table, "y", ["strong", "ushape", "noise"]))
    for c in ("strong", "ushape", "noise"):
        subset = frame[[c, "y"]].dropna()
        rates = subset["y"].groupby(pd.qcut(subset[c], 10, duplicates="drop"), observed=True).mean()
        assert found[c]["min_rate"] == pytest.approx(rates.min())
        assert found[c]["spread"] == pytest.approx(rates.max() - rates.min())


def test_category_spread_and_map(table, frame):
    found = rows(signal.category_spread(table, "y", ["kind", "place"]))
    rates = frame.groupby("kind")["y"].mean()
    assert found["kind"]["spread"] == pytest.approx(rates.max() - rates.min())
    assert found["kind"]["rates_by_level"] == pytest.approx({str(k): v for k, v in rates.items()})


def test_interactions(table, frame):
    cells = signal.interaction_cells(table, "y", ["kind", "place"]).collect()
    expected = frame.dropna(subset=["kind"]).groupby(["kind", "place"])["y"].agg(["mean", "size"])
    assert len(cells) == len(expected)
    for r in cells:
        mean, size = expected.loc[(float(r["level_a"]), float(r["level_b"]))]
        assert (r["label_rate"], r["n"]) == (pytest.approx(mean), size)


def test_mutual_information_equals_brute_force_and_sees_the_u_shape(table, frame):
    roles = {"ushape": "numeric", "kind": "categorical"}
    found = rows(signal.mutual_information(table, "y", roles))
    for c, level in (
        ("ushape", pd.qcut(frame["ushape"], 10)),
        ("kind", frame["kind"].fillna(frame["kind"].median())),
    ):
        joint = pd.crosstab(level, frame["y"]) / len(frame)
        independent = np.outer(joint.sum(axis=1), joint.sum(axis=0))
        mi = np.nansum(joint.values * np.log(joint.values / independent))
        assert found[c]["mutual_information"] == pytest.approx(mi)
    assert found["ushape"]["flagged"] and not found["kind"]["flagged"]


def test_row_order_gaps_equal_pandas_in_key_order(table, frame):
    y = frame.sort_values("k")["y"].reset_index(drop=True)
    gaps = pd.Series(y.index[y == 1]).diff().dropna()
    half = len(y) // 2
    r = signal.row_order_gaps(table, "y", "k").first()
    assert r["gap_mean"] == pytest.approx(gaps.mean())
    assert r["gap_std"] == pytest.approx(gaps.std())
    assert r["expected_gap_mean"] == pytest.approx(1 / y.mean())
    assert r["label_rate_first_half"] == pytest.approx(y[:half].mean())
    assert r["label_rate_second_half"] == pytest.approx(y[half:].mean())
    assert r["consistent_with_iid"]


def test_row_order_without_positives(spark):
    df = spark.createDataFrame([(i, 0) for i in range(20)], "k long, y int")
    r = signal.row_order_gaps(df, "y", "k").first()
    assert r["label_rate"] == 0 and r["gap_mean"] is None and not r["consistent_with_iid"]


def test_verdict_and_report(table, frame):
    assert signal.verdict(signal.signal_checks(table.drop("k"), "y")).first()["verdict"] == "SIGNAL_DETECTED"
    quiet = table.select("k", "noise", "place", (signal.F.col("k") % 7 == 0).cast("int").alias("y"))
    report = signal.signal_report(quiet, "y", "k").first()
    assert report["verdict"] == "NO_SIGNAL_DETECTED"
    assert report["row_count"] == len(frame) and len(report["checks"]) == 5
    assert report["row_order"]["gap_mean"] == pytest.approx(7.0)


def test_row_order_with_a_shared_key(spark):
    rows = [(5 if i < 100 else i, 1 if i >= 100 and i % 4 == 0 else 0) for i in range(300)]
    r = signal.row_order_gaps(spark.createDataFrame(rows, "k long, y int").repartition(6), "y", "k").first()
    assert r["gap_mean"] == 4.0 and r["gap_std"] == 0.0 and r["label_rate"] == pytest.approx(50 / 300)
