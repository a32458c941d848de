"""Rates of sampled counters, against a loop over each range's samples."""

import math
import random

import pytest
from plumbline.operators import counters


def looped(samples, width, step):
    by_series = {}
    for series, t, v in samples:
        by_series.setdefault(series, []).append((t, v))
    out = {}
    for series, points in by_series.items():
        points.sort()
        last = points[-1][0]
        for at in range(points[0][0] // step * step, last + width + step, step):
            inside = [(t, v) for t, v in points if at - width < t <= at]
            if len(inside) < 2:
                continue
            growth = inside[-1][1] - inside[0][1]
            growth += sum(a for (_, a), (_, b) in zip(inside, inside[1:]) if b < a)
            covered = inside[-1][0] - inside[0][0]
            spacing = covered / (len(inside) - 1)
            head, tail = inside[0][0] - (at - width), at - inside[-1][0]
            head = spacing / 2 if head >= 1.1 * spacing else head
            tail = spacing / 2 if tail >= 1.1 * spacing else tail
            if growth > 0:
                head = min(head, covered * inside[0][1] / growth)
            out[series, at] = (len(inside), growth * (covered + head + tail) / covered / width)
    return out


@pytest.mark.parametrize("width, step, slices", [(60, 60, 1), (60, 15, 9), (300, 60, 7), (45, 30, 11)])
def test_rates_equal_a_loop(spark, width, step, slices):
    rng = random.Random(width + step)
    samples, v = [], {1: 0, 2: 0}
    for i in range(300):
        for series in v:
            v[series] = 0 if rng.random() < 0.05 else v[series] + rng.choice([0, 0, 1, 3, 40])
            if rng.random() < 0.9:
                samples.append((series, 1000 + 15 * i, v[series]))
    spark.conf.set("spark.sql.shuffle.partitions", str(slices))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(samples, "series int, t long, v long").repartition(3)
        rows = counters.counter_rates(df, width, step).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    found = {(r["series"], r["t"]): (r["n"], r["rate"]) for r in rows}
    expected = looped(samples, width, step)
    assert found.keys() == expected.keys()
    assert all(n == found[k][0] and math.isclose(rate, found[k][1], abs_tol=1e-12) for k, (n, rate) in expected.items())


def test_no_requests_have_no_samples(spark):
    log = spark.createDataFrame([], "event_id long, ts timestamp_ntz, user_id long, served boolean, latency double")
    assert counters.sampled_counters(log).count() == 0
