import sys

import numpy as np
import pandas as pd
import pytest

from plumbline.operators import quantiles

RNG = np.random.default_rng(11)
SHAPES = {
    "uniform": RNG.uniform(-50, 50, 4000),
    "ties": RNG.integers(0, 4, 4000) * 1.0,
    "hot": np.where(np.arange(4000) % 3 == 0, 7.0, RNG.normal(0, 100, 4000)),
    "tail": np.exp(RNG.normal(0, 12, 4000)),
    "outlier": np.append(RNG.uniform(0, 1, 3999), 1e300),
    "extremes": np.append(RNG.uniform(-1, 1, 3998), [np.inf, -np.inf]),
    "constant": np.full(4000, 3.25),
}
PROBABILITIES = [0.0, 0.1, 0.25, 1 / 3, 0.5, 0.75, 0.9, 1.0]


@pytest.fixture(scope="module")
def table(spark):
    frame = pd.DataFrame(SHAPES)
    cells = [f"if(id % 11 = 5, NULL, {c}) AS {c}" for c in SHAPES]
    return spark.createDataFrame(frame.assign(id=range(len(frame)))).selectExpr(*cells)


@pytest.mark.parametrize("bits", [11, 3])
def test_quantiles_equal_linear_interpolation(table, monkeypatch, bits):
    monkeypatch.setattr(quantiles, "BUCKET_BITS", bits)
    found = quantiles.exact_quantiles(table, {c: PROBABILITIES for c in SHAPES})
    keep = np.arange(4000) % 11 != 5
    for column, values in SHAPES.items():
        # NumPy itself interpolates an infinite end to NaN, so the ends are stated.
        present = values[keep]
        expected = [present.min(), *np.quantile(present, PROBABILITIES[1:-1]), present.max()]
        assert np.allclose(found[column], expected, rtol=1e-12, atol=1e-12, equal_nan=True), column


def test_column_without_values_has_no_quantiles(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "a double, b double")
    assert quantiles.exact_quantiles(df, {"a": [0.5], "b": [0.5]}) == {"a": None, "b": [1.5]}


def test_keys_keep_order_and_round_trip(spark):
    edges = [0.0, 5e-324, 2.0**-1023, 2.0**-1022, 1 / 3, 1.0, np.nextafter(2.0, 1), 2.0, 1e300, sys.float_info.max, np.inf]
    values = [-v for v in reversed(edges[1:])] + edges
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "id int, x double")
    # Rows keep their order: the keys of a sorted column rise.
    keys = [r["k0"] for r in quantiles._keyed(df.coalesce(1), ["x"]).collect()]
    assert keys == [quantiles.key_of(v) for v in values] == sorted(set(keys))
    assert [quantiles.value_of(k) for k in keys] == values


def test_values_over_many_decades_take_at_most_six_rounds(spark, monkeypatch):
    rounds = []
    histogram = quantiles._histogram
    monkeypatch.setattr(quantiles, "_histogram", lambda *args: rounds.append(1) or histogram(*args))
    df = spark.range(20001).selectExpr("pow(10D, id / 50D - 200) AS x")
    found = quantiles.exact_quantiles(df, {"x": [0.1, 0.5, 0.9]})["x"]
    assert np.allclose(found, [1e-160, 1.0, 1e160], rtol=1e-9) and len(rounds) <= 6


def test_infinities_and_missing_values(spark):
    rows = [(1.0,), (2.0,), (np.inf,), (np.inf,), (None,), (float("nan"),)]
    df = spark.createDataFrame(rows, "x double")
    assert quantiles.exact_quantiles(df, {"x": [0.0, 0.4, 0.5, 1.0]}) == {"x": [1.0, np.inf, np.inf, np.inf]}
    largest = spark.createDataFrame([(sys.float_info.max,)], "x double")
    assert quantiles.exact_quantiles(largest, {"x": [1.0]}) == {"x": [sys.float_info.max]}


def test_edges_are_distinct(table):
    edges = quantiles.quantile_edges(table, ["ties", "constant"], 10)
    assert edges["constant"] == [3.25]
    assert edges["ties"] == sorted(set(edges["ties"]))


@pytest.mark.parametrize("missing", [0, 1, 7, 400])
@pytest.mark.parametrize("rows", [401, 402, 1])
def test_quantiles_of_a_filled_column_come_from_its_present_values(spark, rows, missing):
    values = RNG.integers(0, 60, rows) * 1.5
    frame = pd.DataFrame({"x": np.append(values, np.full(missing, np.nan)), "void": np.nan})
    df = spark.createDataFrame(frame).selectExpr("nanvl(x, null) AS x", "nanvl(void, null) AS void")
    tenths = {"x": [i / 10 for i in range(11)]}
    found = quantiles.quantiles_around_median(df, quantiles.profile(df, ["x", "void"]), tenths, tenths | {"void": [0.5]})
    median = np.median(values)
    assert found.medians == {"x": median, "void": None} and found.filled["void"] is None
    filled = frame["x"].fillna(median)
    assert np.allclose(found.present["x"], np.quantile(values, tenths["x"]), rtol=0, atol=1e-9)
    assert np.allclose(found.filled["x"], np.quantile(filled, tenths["x"]), rtol=0, atol=1e-9)
