"""Windows that begin at a client's requests, against a walk through each client's requests."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from plumbline.operators import limits

START = dt.datetime(2024, 1, 1)
SCHEMA = "event_id long, ts timestamp_ntz, user_id long"


def walked(rows, quota: int, width: dt.timedelta) -> set:
    by_client = defaultdict(list)
    for event, ts, user in rows:
        if ts is not None:
            by_client[user].append((ts, event))
    out = {(event, None, None) for event, ts, _ in rows if ts is None}
    for requests in by_client.values():
        start = None
        for ts, event in sorted(requests):
            if start is None or ts >= start + width:
                start, seen = ts, 0
            seen += 1
            out.add((event, start, seen <= quota))
    return out


def found(spark, rows, quota, width, slices, session_zone=None):
    spark.conf.set("spark.sql.shuffle.partitions", str(slices))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = limits.rate_limit_anchored(spark.createDataFrame(rows, SCHEMA).repartition(3), quota, width)
        return {(r["event_id"], r["window_start"], r["admitted"]) for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def log(rng, n: int, clients: int, seconds: float) -> list:
    """Half of the requests are of client 7; times are in steps that make ties and exact ends."""
    rows = []
    for i in range(n):
        user = 7 if rng.random() < 0.5 else rng.randrange(clients)
        rows.append((i, START + dt.timedelta(seconds=15 * rng.randrange(int(seconds / 15))), user))
    return rows


@pytest.mark.parametrize("slices, n, seconds, quota", [(1, 200, 3000, 1), (13, 400, 9000, 2), (7, 300, 600, 3), (16, 300, 90_000, 1)])
def test_anchored_windows_equal_a_walk(spark, slices, n, seconds, quota):
    rng = random.Random(slices)
    rows = log(rng, n, 20, seconds) + [(n, None, 3), (n + 1, START, None), (n + 2, START + dt.timedelta(seconds=30), None)]
    rows.append(rows[0])
    expected = walked(rows, quota, dt.timedelta(minutes=1))
    got = found(spark, rows, quota, "1 minute", slices)
    if quota == 1:
        # A repeated row is a second request of the same time.
        assert {(e, w) for e, w, _ in got} == {(e, w) for e, w, _ in expected}
    assert got == expected


def test_one_client_in_many_slices(spark):
    """Every window of the client crosses borders of slices, and some hold whole slices."""
    rows = [(i, START + dt.timedelta(seconds=i * 7 % 1009 + (i % 3) * 1000), 1) for i in range(500)]
    for width, minutes in (("1 minute", 1), ("20 minutes", 20)):
        assert found(spark, rows, 2, width, 15) == walked(rows, 2, dt.timedelta(minutes=minutes))


def test_no_requests(spark):
    assert limits.rate_limit_anchored(spark.createDataFrame([], SCHEMA)).count() == 0
