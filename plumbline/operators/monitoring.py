"""Counters, latency histograms and request limits over a request log.

A request log has a user, a time, an event type and a latency. Everything is counted per time
window with map-side combining, so a user or window with a large share of all rows is no hot spot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions import sqltext as sql
from plumbline.operators.ordering import running_totals

# Histogram bucket boundaries in seconds; the last bucket is unbounded.
LATENCY_EDGES = (0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0)
REQUESTS_PER_WINDOW = 1
LIMIT_WINDOW = "1 minute"
SALTS = 32


def request_log(events: DataFrame) -> DataFrame:
    """Events as requests: ``value`` is a latency in milliseconds, errors were not served."""
    return events.select(
        "event_id",
        "ts",
        "user_id",
        (F.col("event_type") != "error").alias("served"),
        (F.col("value") / 1000).alias("latency"),
    )


def window_start(width: str, ts: str = "ts") -> Column:
    return F.window(ts, width).getField("start").alias("window_start")


def per_window(log: DataFrame, width: str, aggregates: list[Column], keys: tuple[str, ...] = (), ts: str = "ts") -> DataFrame:
    """Aggregates per key and window. Rows are grouped by the window as a whole: it carries the
    watermark, its start does not, and a stream forgets a window only by the watermark."""
    counted = log.groupBy(*keys, F.window(ts, width).alias("window")).agg(*aggregates)
    values = [c for c in counted.columns if c not in (*keys, "window")]
    return counted.select(*keys, F.col("window.start").alias("window_start"), *values)


def served_per_window(log: DataFrame, width: str) -> DataFrame:
    return per_window(log, width, [F.count("*").alias("n_requests"), F.count_if("served").alias("n_served")])


def served_counter(log: DataFrame, width: str) -> DataFrame:
    """Requests served per window and the counter's value at its end."""
    return running_totals(
        served_per_window(log, width), [F.col("window_start")], {"served_total": "n_served"}, "served_counter"
    )


def _bucket_counts(log: DataFrame, keys: list[Column]) -> DataFrame:
    """Observations per group, and how many of them lie at or below each boundary."""
    below = [F.expr(f"count_if(latency <= {sql.number(edge)}) AS le{i}") for i, edge in enumerate(LATENCY_EDGES)]
    return log.groupBy(*keys).agg(F.count("latency").alias("n"), *below)


def latency_histogram(log: DataFrame, width: str | None = None) -> DataFrame:
    """Cumulative bucket counts; failed requests are observed too. Per window, or over all rows."""
    keys = [window_start(width)] if width else []
    buckets = [sql.struct(le=sql.number(edge), cumulative=f"le{i}") for i, edge in enumerate(LATENCY_EDGES)]
    buckets.append(sql.struct(le=sql.number(float("inf")), cumulative="n"))
    names = ["window_start"] if width else []
    return _bucket_counts(log, keys).selectExpr(*names, sql.rows(buckets))


def bucket_quantile(log: DataFrame, quantile: float, width: str) -> DataFrame:
    """The latency quantile per window as read from the buckets.

    The rank is found in the first bucket whose cumulative count reaches it, and interpolated
    linearly inside that bucket, which starts at 0 for the first one. In the unbounded bucket the
    highest finite boundary is returned. A window without observations has no quantile.
    """
    value = bucket_quantile_sql(quantile)
    return _bucket_counts(log, [window_start(width)]).selectExpr("window_start", "n", f"{value} AS latency_quantile")


def bucket_quantile_sql(quantile: float) -> str:
    """The quantile from ``n`` observations, of which ``le0``, ``le1``, ... are at or below the
    boundaries."""
    rank = f"(n * {sql.number(quantile)})"
    branches, low, before = [], 0.0, "0"
    for i, high in enumerate(LATENCY_EDGES):
        share = sql.ratio(f"{rank} - {before}", f"le{i} - {before}")
        branches.append((f"le{i} >= {rank}", f"{sql.number(low)} + {sql.number(high - low)} * {share}"))
        low, before = high, f"le{i}"
    return sql.case([("n = 0", "NULL"), *branches], sql.number(LATENCY_EDGES[-1]))


def rate_limit_summary(
    log: DataFrame, quota: int = REQUESTS_PER_WINDOW, width: str = LIMIT_WINDOW
) -> DataFrame:
    """Requests, admitted and rejected per user and clock-aligned window, for any quota."""
    n = F.col("n_requests")
    return per_window(log, width, [F.count("*").alias("n_requests")], ("user_id",)).select(
        "user_id",
        "window_start",
        n,
        F.least(n, F.lit(quota)).alias("n_admitted"),
        F.greatest(n - quota, F.lit(0)).alias("n_rejected"),
    )


def first_requests(log: DataFrame, width: str = LIMIT_WINDOW) -> DataFrame:
    """The earliest request of each user and window: the one let through at a quota of one."""
    earliest = F.min(F.struct("ts", "event_id")).alias("first")
    rows = per_window(log, width, [earliest], ("user_id",))
    return rows.select("user_id", "window_start", "first.ts", "first.event_id")


def admit_first(windows: DataFrame, quota: int) -> DataFrame:
    """Requests of known windows with ``admitted``: the first ``quota`` of a user's window are.

    Ranked twice: first inside ``SALTS`` arbitrary parts of each user's window, then only the
    first ``quota`` of every part against each other. A window with very many requests is thus
    never sorted in one task.
    """
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).alias("salt")
    keyed = windows.select("event_id", "ts", "user_id", "window_start", salt)
    order = [F.col("ts"), F.col("event_id")]
    group = ["user_id", "window_start"]
    in_part = F.row_number().over(Window.partitionBy(*group, "salt").orderBy(*order))
    # Candidates share part -1; all others stay in the part where they already lost.
    ranked = keyed.withColumn("candidate", in_part <= quota).withColumn(
        "part", F.when(F.col("candidate"), F.lit(-1)).otherwise(F.col("salt"))
    )
    overall = F.row_number().over(Window.partitionBy(*group, "part").orderBy(*order))
    return ranked.withColumn("admitted", F.col("candidate") & (overall <= quota)).drop("salt", "part", "candidate")


def rate_limit(log: DataFrame, quota: int = REQUESTS_PER_WINDOW, width: str = LIMIT_WINDOW) -> DataFrame:
    """Each request with ``admitted``: the first ``quota`` of a user's clock-aligned window."""
    return admit_first(log.select("event_id", "ts", "user_id", window_start(width)), quota)
