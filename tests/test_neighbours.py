"""Nearest-neighbour information against a brute force over all rows, and on known shapes."""

import math

import numpy as np
import pandas as pd
import pytest
from conftest import to_spark
from plumbline.operators import neighbours
from plumbline.operators.neighbours import FEATURE_STEP, FIRST_STEP, GRID_BITS, NOISE_BITS, PRIME, SECOND_STEP


def psi(n: int) -> float:
    return sum(1 / i for i in range(1, int(n))) - 0.57721566490153286


def brute(frame: pd.DataFrame, label: str, columns: list[str], k: int = 3) -> dict:
    frame = frame[frame[label].notna()]
    out = {}
    for i, c in enumerate(columns):
        x = frame[c].fillna(frame[c].median()).to_numpy()
        y = frame[label].to_numpy()
        key = frame["key"].to_numpy().astype(object)
        drawn = [((((v % PRIME) * FIRST_STEP + i * FEATURE_STEP) % PRIME) * SECOND_STEP % PRIME) >> (31 - NOISE_BITS) for v in key]
        scaled = (x - x.mean()) / x.std() if x.std() else np.zeros(len(x))
        place = np.round(scaled * 2**GRID_BITS).astype(np.int64) * 2**NOISE_BITS + np.array(drawn, dtype=np.int64)
        counts = {v: (y == v).sum() for v in set(y)}
        known = np.array([counts[v] > 1 for v in y])
        place, y = place[known], y[known]
        terms = []
        for p, v in zip(place, y):
            own = np.sort(np.abs(place[y == v] - p))
            near = min(k, counts[v] - 1)
            radius = max(own[near], 1)
            terms.append(psi(near) - psi(counts[v]) - psi((np.abs(place - p) < radius).sum()))
        out[c] = max(0.0, psi(len(place)) + np.mean(terms))
    return out


def sample(n: int) -> pd.DataFrame:
    rng = np.random.default_rng(8)
    y = rng.integers(0, 3, n).astype(float)
    frame = pd.DataFrame(
        {
            "key": np.arange(n) * 7 + 2**40,
            "shifted": rng.normal(size=n) + y,
            "noise": rng.lognormal(size=n),
            "levels": rng.integers(0, 4, n).astype(float),
            "constant": 1.0,
            "same": y,
            "y": y,
        }
    )
    frame.loc[::11, "shifted"] = np.nan
    frame.loc[5::50, "y"] = np.nan
    frame.loc[3, "y"] = 9.0
    return frame


COLUMNS = ["shifted", "noise", "levels", "constant", "same"]


@pytest.mark.parametrize("slices", [1, 9])
def test_neighbour_information_equals_brute_force(spark, slices):
    frame = sample(400)
    spark.conf.set("spark.sql.shuffle.partitions", str(slices))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = neighbours.neighbour_information(to_spark(spark, frame), "y", COLUMNS, "key").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    found = {r["feature"]: r["mutual_information"] for r in rows}
    expected = brute(frame, "y", COLUMNS)
    assert found.keys() == expected.keys()
    for c in COLUMNS:
        assert math.isclose(found[c], expected[c], abs_tol=1e-9), c
    assert found["same"] > 0.9 > found["shifted"] > 0.1 > found["constant"]


def test_labels_of_few_rows(spark):
    frame = sample(40)
    frame["y"] = [0.0] * 37 + [1.0, 1.0, 2.0]
    rows = neighbours.neighbour_information(to_spark(spark, frame), "y", ["noise", "levels"], "key").collect()
    expected = brute(frame, "y", ["noise", "levels"])
    assert all(math.isclose(r["mutual_information"], expected[r["feature"]], abs_tol=1e-9) for r in rows)


def test_without_rows_there_is_no_information(spark):
    rows = neighbours.neighbour_information(to_spark(spark, sample(30)).where("y > 100"), "y", ["noise"], "key").collect()
    assert [(r["feature"], r["mutual_information"], r["flagged"]) for r in rows] == [("noise", None, False)]


def test_digamma(spark):
    values = spark.range(1, 200).selectExpr("id", f"{neighbours.digamma('id')} AS d").collect()
    assert all(math.isclose(r["d"], psi(r["id"]), abs_tol=1e-10) for r in values)


def test_only_points_near_borders_are_counted_across_slices(spark, monkeypatch):
    counted = []
    totals = neighbours.running_totals

    def counting(df, *rest):
        counted.append(df.count())
        return totals(df, *rest)

    monkeypatch.setattr(neighbours, "running_totals", counting)
    frame = sample(20_000)
    rows = neighbours.neighbour_information(to_spark(spark, frame), "y", ["shifted", "noise"], "key").collect()
    assert all(r["mutual_information"] is not None for r in rows)
    # Of 40,000 points.
    assert 0 < sum(counted) < 2_000


def test_labels_in_far_slices(spark):
    frame = sample(300)
    frame["y"] = [float(i % 100) if i < 200 else 200.0 for i in range(300)]
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = neighbours.neighbour_information(to_spark(spark, frame), "y", COLUMNS[:4], "key").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    expected = brute(frame, "y", COLUMNS[:4])
    assert all(math.isclose(r["mutual_information"], expected[r["feature"]], abs_tol=1e-9) for r in rows)


@pytest.mark.parametrize("missing", [False, True])
def test_labels_share_a_pass_over_small_slices(spark, monkeypatch, missing):
    frame = sample(600)
    frame["y"] = frame["y"].fillna(0.0)
    frame["z"] = [float(i % 7 == 0) for i in range(600)]
    if missing:
        frame.loc[::13, "z"] = np.nan
    # Few keys: most points are equal to others, also at the ends of slices.
    frame["key"] = frame["key"] % 4
    passes = []
    quantiles = neighbours.exact_quantiles
    monkeypatch.setattr(neighbours, "exact_quantiles", lambda *given: passes.append(1) or quantiles(*given))
    monkeypatch.setattr(neighbours, "SLICE", 40)
    monkeypatch.setattr(neighbours, "SORTED_ROWS", 100)
    found = neighbours.neighbour_information_of(to_spark(spark, frame), ["y", "z"], COLUMNS, "key")
    for label, of_label in zip(["y", "z"], found):
        expected = brute(frame, label, COLUMNS)
        rows = {r["feature"]: r["mutual_information"] for r in of_label.collect()}
        assert rows.keys() == expected.keys()
        assert all(math.isclose(rows[c], expected[c], abs_tol=1e-9) for c in COLUMNS)
    assert len(passes) == (2 if missing else 1)


def test_slices_hold_equal_points_once(spark, monkeypatch):
    held = []
    nearer = neighbours._nearer

    def looking(slices, *rest):
        held.extend(slices.where("label IS NULL").selectExpr("octet_length(places) / 8 AS n").collect())
        return nearer(slices, *rest)

    monkeypatch.setattr(neighbours, "_nearer", looking)
    frame = sample(5_000)
    frame["key"] = 5
    rows = neighbours.neighbour_information(to_spark(spark, frame), "y", ["levels", "constant"], "key").collect()
    expected = brute(frame, "y", ["levels", "constant"])
    assert all(math.isclose(r["mutual_information"], expected[r["feature"]], abs_tol=1e-9) for r in rows)
    # Four labels (three, and a row of its own) with four values and one.
    assert sum(r["n"] for r in held) <= 20
