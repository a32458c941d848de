import datetime as dt
import random

import pytest

from plumbline.operators import monitoring
from plumbline.streaming import jobs

SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"
START = dt.datetime(2024, 1, 1)


def events(spark, ids):
    rows = [
        (i, START + dt.timedelta(seconds=20 * i), 0 if i % 3 else i % 7, "error" if i % 10 == 0 else "view", float(i % 500))
        for i in ids
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def log(spark):
    return events(spark, range(600))


def test_limits_in_a_stream_equal_the_batch_over_several_arrivals(spark, log, tmp_path):
    source, state = f"{tmp_path}/in", f"{tmp_path}/state"
    batch = monitoring.rate_limit_summary(monitoring.request_log(log), quota=2)
    expected = sorted(tuple(r) for r in batch.collect())
    assert sum(r[-1] for r in expected) > 0
    for part in (range(0, 250), range(250, 600)):
        events(spark, part).coalesce(1).write.mode("append").parquet(source)
        stream = jobs.file_stream(spark, source, log.schema)
        found = jobs.rate_limit_stream(stream, quota=2, state=state)
    assert sorted(tuple(r) for r in found.collect()) == expected


def test_served_counter_stream_equals_batch(spark, log, tmp_path):
    log.coalesce(1).write.parquet(f"{tmp_path}/in")
    found = jobs.served_counter_stream(jobs.file_stream(spark, f"{tmp_path}/in", log.schema), "1 hour")
    batch = monitoring.served_per_window(monitoring.request_log(log), "1 hour")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, batch.collect()))


def test_first_request_per_window_is_admitted(spark, log, tmp_path):
    expected = monitoring.rate_limit(monitoring.request_log(log)).where("admitted")
    expected = sorted((r["event_id"], r["user_id"], r["window_start"]) for r in expected.collect())
    state = f"{tmp_path}/state"
    # The later half arrives first, within the delay.
    for part in (range(300, 600), range(0, 300)):
        events(spark, part).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = jobs.file_stream(spark, f"{tmp_path}/in", log.schema)
        rows = jobs.admitted_stream(stream, delay="4 hours", state=state).collect()
    assert sorted((r["event_id"], r["user_id"], r["window_start"]) for r in rows) == expected


def test_first_requests_of_any_quota_equal_the_batch(spark, log, tmp_path):
    ids = list(range(600))
    random.Random(4).shuffle(ids)
    batch = monitoring.rate_limit(monitoring.request_log(log), quota=3, width="5 minutes").where("admitted")
    expected = sorted((r["event_id"], r["ts"], r["user_id"], r["window_start"]) for r in batch.collect())
    assert len(expected) > 3 * 20
    # Each arrival goes on in the folder of the one before, as after a restart.
    for part in (ids[:200], ids[200:201], ids[201:450], ids[450:]):
        events(spark, part).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = jobs.file_stream(spark, f"{tmp_path}/in", log.schema)
        rows = jobs.admitted_stream(stream, "5 minutes", "6 hours", f"{tmp_path}/state", quota=3).collect()
    assert sorted((r["event_id"], r["ts"], r["user_id"], r["window_start"]) for r in rows) == expected


def first_three(stream, state):
    return jobs.admitted_stream(stream, state=state, quota=3)


@pytest.mark.parametrize("job", [jobs.rate_limit_stream, jobs.admitted_stream, first_three])
def test_state_forgets_passed_windows_and_reports_late_rows(spark, log, tmp_path, caplog, job):
    seen = []
    for n, part in enumerate((range(0, 200), range(4000, 4200), range(8000, 8200), range(0, 10))):
        events(spark, part).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = jobs.file_stream(spark, f"{tmp_path}/in", log.schema)
        rows = job(stream, state=f"{tmp_path}/state")
        seen.append(rows.count())
    # Four hours and more between arrivals, an hour of delay: the last one is late and changes nothing.
    assert seen[0] < seen[1] < seen[2] == seen[3]
    assert "came after the watermark" in caplog.text
    state = spark.read.format("statestore").load(f"{tmp_path}/state/checkpoint")
    assert 0 < state.count() <= seen[2] - seen[1]


def test_first_requests_of_many_users_share_the_state_of_a_window(spark, tmp_path):
    # Ids that a double cannot tell apart, and users and requests without one.
    big = 2**60
    rows = [(big + i, START + dt.timedelta(seconds=i % 50), i % 400 or None, "view", 1.0) for i in range(1600)]
    rows += [(None, START + dt.timedelta(seconds=9), 5, "view", 1.0), (None, START, None, "view", 1.0)]
    log = spark.createDataFrame(rows, SCHEMA)
    for part in (rows[800:], rows[:800]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = jobs.file_stream(spark, f"{tmp_path}/in", log.schema)
        found = jobs.admitted_stream(stream, state=f"{tmp_path}/state", quota=3).collect()
    batch = monitoring.rate_limit(monitoring.request_log(log), quota=3).where("admitted").collect()

    def known(rows):
        columns = ("event_id", "ts", "user_id", "window_start")
        return sorted((tuple(str(r[c]) for c in columns) for r in rows))

    assert known(found) == known(batch) and len(batch) == 1200
    # 400 users in one window: no more groups than the window has parts.
    assert spark.read.format("statestore").load(f"{tmp_path}/state/checkpoint").count() <= monitoring.SALTS


def test_row_limit_admits_the_earliest(log):
    rows = monitoring.rate_limit(monitoring.request_log(log), quota=2).collect()
    groups = {}
    for r in sorted(rows, key=lambda r: (r["ts"], r["event_id"])):
        groups.setdefault((r["user_id"], r["window_start"]), []).append(r["admitted"])
    assert len(rows) == 600
    assert all(g == [i < 2 for i in range(len(g))] for g in groups.values())


def test_served_total_runs_over_all_windows(log):
    rows = monitoring.served_counter(monitoring.request_log(log), "5 minutes").orderBy("window_start").collect()
    total = 0
    for r in rows:
        total += r["n_served"]
        assert r["served_total"] == total
    assert total == 540


def test_bucket_quantile_interpolates(spark):
    rows = [(i, START, 1, "view", v) for i, v in enumerate([1.0, 2.0, 30.0, 40.0])]
    rows += [(9, START + dt.timedelta(minutes=5), 1, "view", 99999.0)]
    log = monitoring.request_log(spark.createDataFrame(rows, SCHEMA))
    found = [r["latency_quantile"] for r in monitoring.bucket_quantile(log, 0.5, "1 minute").orderBy("window_start").collect()]
    assert found == [pytest.approx(0.005), 10.0]
    third = monitoring.bucket_quantile(log.where("event_id < 9"), 0.75, "1 minute").first()
    assert third["latency_quantile"] == pytest.approx(0.025 + 0.025 * 0.5)


def test_histogram_is_cumulative_and_counts_failures(log):
    rows = monitoring.latency_histogram(monitoring.request_log(log)).orderBy("le").collect()
    counts = [r["cumulative"] for r in rows]
    assert counts == sorted(counts) and counts[-1] == 600 and len(rows) == 15


def test_wall_clock_survives_other_time_zones(spark, tmp_path):
    log = events(spark, range(30))
    log.coalesce(1).write.parquet(f"{tmp_path}/in")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        stream = jobs.file_stream(spark, f"{tmp_path}/in", log.schema)
        found = jobs.served_counter_stream(stream, "1 hour").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert {r["window_start"] for r in found} == {START}


@pytest.mark.parametrize("quota", [1, 3])
def test_row_limit_with_one_busy_window_and_copies(spark, quota):
    rows = [(i % 50, START + dt.timedelta(seconds=i % 7), 1, "view", 1.0) for i in range(900)]
    rows += [(1000 + i, START, i, "view", 1.0) for i in range(2, 40)]
    log = monitoring.request_log(spark.createDataFrame(rows, SCHEMA).repartition(5))
    found = monitoring.rate_limit(log, quota=quota)
    busy = found.where("user_id = 1 AND admitted").collect()
    assert found.count() == len(rows) and len(busy) == quota
    assert all(r["ts"] == START for r in busy)
    assert found.where("user_id > 1 AND admitted").count() == 38
