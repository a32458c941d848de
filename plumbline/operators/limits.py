"""Request limits whose windows begin at a client's own requests.

A client's first request opens a window; the first request at or after its end opens the next one.
Which requests open windows is a chain that runs through the whole log of a client, so a client
with a third of the log must not be walked by one task.

The log is dealt to slices of the order (client, time). What happens in a slice depends only on
when the window that is open at its border ends. Each slice therefore tells, for every one of its
requests that such a window can end before, when the window that is open at its own end closes:
its steps. A step of one slice leads to a step of a later one; steps that are really taken are
found by pointer doubling, so a client in n slices takes log2(n) rounds over the steps, which are
requests of the first window's width of each slice. Slices are then labelled side by side.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.operators.monitoring import LIMIT_WINDOW, REQUESTS_PER_WINDOW, admit_first
from plumbline.operators.ordering import BUCKET, TIE, range_bucketed
from plumbline.workspace import Workspace

EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"

# Stands for a null client.
NO_CLIENT = -(1 << 63)


def _micros(df: DataFrame, column: str):
    """A time as microseconds; wall-clock times are taken as they are written."""
    if isinstance(df.schema[column].dataType, T.TimestampType):
        return F.unix_micros(column)
    return F.expr(f"timestampdiff(MICROSECOND, {EPOCH}, {column})")


def _time(df: DataFrame, column: str, micros: str):
    if isinstance(df.schema[column].dataType, T.TimestampType):
        return F.timestamp_micros(micros)
    return F.expr(f"timestampadd(MICROSECOND, {micros}, {EPOCH})")


def _clients(table: pa.Table) -> list[tuple[int, int]]:
    """First and end row of each client's requests in a sorted slice."""
    codes = np.asarray(table["client"])
    borders = np.flatnonzero(codes[1:] != codes[:-1]) + 1
    edges = [0, *borders.tolist(), len(codes)]
    return list(zip(edges[:-1], edges[1:]))


def _closings(times: np.ndarray, width: int) -> np.ndarray:
    """For each request, if it opened a window: the end of the last window opened from there on."""
    following = np.searchsorted(times, times + width)
    ends = times + width
    n = len(times)
    for i in range(n - 1, -1, -1):
        if following[i] < n:
            ends[i] = ends[following[i]]
    return ends


def _steps(sliced: DataFrame, width: int, continuing: set[int]) -> DataFrame:
    """(bucket, at, closes): a window opened by the request at time ``at`` is followed in its slice
    by others, the last of which closes at ``closes``. For a slice that begins inside a client's
    requests all that a window from before can lead to; ``at`` is null for a client who comes later
    in the slice, of whom the last one matters."""

    def walked(table: pa.Table) -> pa.Table:
        table = table.sort_by([("client", "ascending"), ("t", "ascending")])
        bucket, times = table[BUCKET][0].as_py(), np.asarray(table["t"])
        clients = _clients(table)
        first, end = clients[0]
        closes = _closings(times[first:end], width)
        reach = np.searchsorted(times[first:end], times[first] + width, side="right") + 1
        at, ends = times[first : first + 1], closes[:1]
        if bucket in continuing:
            at, ends = np.unique(times[first:end][:reach], return_index=True)
            ends = closes[ends]
        at, ends = at.tolist(), ends.tolist()
        if len(clients) > 1:
            first, end = clients[-1]
            at.append(None)
            ends.append(int(_closings(times[first:end], width)[0]))
        return pa.table(
            {
                "bucket": pa.array([bucket] * len(at), pa.int32()),
                "at": pa.array(at, pa.int64()),
                "closes": pa.array(ends, pa.int64()),
            }
        )

    return sliced.select(BUCKET, "client", "t").groupBy(BUCKET).applyInArrow(
        walked, "bucket int, at long, closes long"
    )


def _taken(steps: DataFrame, slices: list, spark) -> list:
    """The steps that are taken, at most two per slice: where a client begins in the slice, and
    all that follow from there."""
    # Of each slice the client it ends with, if the next slice goes on with that client.
    runs = [0]
    rows = []
    for one, other in zip(slices, [*slices[1:], None]):
        goes_on = other is not None and other["first"] == one["last"]
        runs.append(runs[-1] + 1 if goes_on else 0)
        rows.append((one[BUCKET], one["first"] == one["last"], goes_on))
    known = {r[0]: r for r in rows}
    continuing = {b for (a, _, goes_on), (b, _, _) in zip(rows, rows[1:]) if goes_on}
    # (from, to, low, high]: a window of slice ``from`` that closes in that range ends before a
    # request of slice ``to``, the first slice of the client that has one.
    targets = []
    for i, (bucket, _, goes_on) in enumerate(rows):
        low, j = None, i
        while goes_on:
            j += 1
            high = slices[j]["first_end"]
            targets.append((bucket, rows[j][0], low, high))
            low, goes_on = high, rows[j][1] and rows[j][2]
            if low - slices[i]["last_end"] > 0 and low >= slices[i]["last_end"] + slices[i]["width"]:
                break
    workspace = Workspace.of(spark)
    leads = spark.createDataFrame(targets, "_bucket int, _to int, _low long, _high long")
    # Only what a slice ends with goes on: its last client's steps.
    ends = spark.createDataFrame(
        [(b, known[b][1]) for b in known], "_of int, _whole boolean"
    )
    last = steps.join(F.broadcast(ends), F.col("bucket") == F.col("_of")).where(
        "_whole OR at IS NULL"
    )
    led = last.join(
        F.broadcast(leads),
        F.expr("bucket = _bucket AND (_low IS NULL OR closes > _low) AND closes <= _high"),
    ).select("bucket", "at", F.col("_to").alias("to"), F.col("closes"))
    # The first request of that slice at or after the close: both in one order, slice by slice.
    marks = steps.where("at IS NOT NULL").select(
        F.col("bucket").alias("to"), F.col("at").alias("when"), F.lit(1).alias("is_step"),
        F.lit(None).cast("int").alias("from"), F.lit(None).cast("long").alias("from_at"),
    )
    asked = led.select(
        "to", F.col("closes").alias("when"), F.lit(0).alias("is_step"),
        F.col("bucket").alias("from"), F.col("at").alias("from_at"),
    )
    following = F.expr(
        "min(CASE WHEN is_step = 1 THEN when END) OVER (PARTITION BY to ORDER BY when, is_step "
        "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    )
    jumps = (
        marks.unionByName(asked).withColumn("to_at", following)
        .where("is_step = 0").select("from", "from_at", "to", "to_at")
    )
    jumps = workspace.stage(jumps, "limit-jumps")
    begun = [(b,) for b in known if b not in continuing]
    begins = spark.createDataFrame(begun, "_first int")
    reached = steps.join(F.broadcast(begins), F.col("bucket") == F.col("_first"), "left").where(
        "_first IS NOT NULL OR at IS NULL"
    )
    reached = workspace.stage(reached.select("bucket", "at"), "limit-reached")
    for _ in range(math.ceil(math.log2(max(runs) + 1))):
        hop = F.expr("bucket = from AND at <=> from_at")
        wider = reached.unionByName(
            reached.join(jumps, hop).select(F.col("to").alias("bucket"), F.col("to_at").alias("at"))
        ).distinct()
        onward = jumps.select(
            F.col("from").alias("_f"), F.col("from_at").alias("_fa"),
            F.col("to").alias("_t"), F.col("to_at").alias("_ta"),
        )
        twice = jumps.join(onward, F.expr("to = _f AND to_at <=> _fa")).select(
            "from", "from_at", F.col("_t").alias("to"), F.col("_ta").alias("to_at")
        )
        old = reached, jumps
        reached = workspace.stage(wider, "limit-reached")
        jumps = workspace.stage(twice, "limit-jumps")
        workspace.discard(*old)
    taken = steps.alias("s").join(
        reached.alias("r"), F.expr("s.bucket = r.bucket AND s.at <=> r.at"), "left_semi"
    )
    return taken.collect()


def anchored_windows(log: DataFrame, width: str = LIMIT_WINDOW) -> DataFrame:
    """The requests with ``window_start``, the time of the request that opened their window.

    Requests without a time have no window. A null client is a client like any other, and clients
    that are not whole numbers are told apart by a 64-bit hash. Requests of one client at the same
    time are in the same window."""
    spark = log.sparkSession
    spacing = spark.range(1).selectExpr(
        f"timestampdiff(MICROSECOND, {EPOCH}, {EPOCH} + INTERVAL {width}) AS w"
    ).first()["w"]
    timed = log.select("event_id", "ts", "user_id", _micros(log, "ts").alias("t"))
    if isinstance(log.schema["user_id"].dataType, T.IntegralType):
        client = F.coalesce(F.col("user_id").cast("long"), F.lit(NO_CLIENT))
    else:
        client = F.when(F.col("user_id").isNull(), F.lit(NO_CLIENT)).otherwise(F.xxhash64("user_id"))
    placed = timed.where("t IS NOT NULL").withColumn("client", client)
    sliced = range_bucketed(placed, [F.col("client"), F.col("t")], "limit-slices")
    ends = sliced.groupBy(BUCKET).agg(
        F.min("client").alias("first"), F.max("client").alias("last"), F.max("t").alias("_t"),
        F.max_by("t", F.struct("client", "t")).alias("last_end"),
    )
    firsts = sliced.join(ends.select(F.col(BUCKET).alias("_b"), "first"), F.expr(f"{BUCKET} = _b AND client = first"))
    firsts = firsts.groupBy(BUCKET).agg(F.max("t").alias("first_end"))
    # One row per slice, at most as many as there are shuffle partitions.
    slices = [
        r.asDict() | {"width": spacing} for r in ends.join(firsts, BUCKET).orderBy(BUCKET).collect()
    ]
    continuing = {
        b[BUCKET] for a, b in zip(slices, slices[1:]) if a["last"] == b["first"]
    }
    carried: dict[int, int] = {}
    if continuing:
        steps = Workspace.of(spark).stage(_steps(sliced, spacing, continuing), "limit-steps")
        taken = sorted(_taken(steps, slices, spark), key=lambda r: (r["bucket"], r["at"] is None))
        open_until, at = None, 0
        for one in slices:
            # What is open when the slice begins: the close of the last step taken before it.
            while at < len(taken) and taken[at]["bucket"] < one[BUCKET]:
                open_until = taken[at]["closes"]
                at += 1
            if one[BUCKET] in continuing:
                carried[one[BUCKET]] = open_until

    def labelled(table: pa.Table) -> pa.Table:
        table = table.sort_by([("client", "ascending"), ("t", "ascending")])
        times = np.asarray(table["t"]).tolist()
        closes = carried.get(table[BUCKET][0].as_py())
        starts = []
        for first, end in _clients(table):
            for t in times[first:end]:
                if closes is None or t >= closes:
                    closes = t + spacing
                starts.append(closes - spacing)
            closes = None
        return table.drop_columns([BUCKET, TIE, "client", "t"]).append_column(
            "opened", pa.array(starts, pa.int64())
        )

    kinds = ", ".join(f"{c} {log.schema[c].dataType.simpleString()}" for c in ("event_id", "ts", "user_id"))
    windows = sliced.groupBy(BUCKET).applyInArrow(labelled, f"{kinds}, opened long")
    windows = windows.select("event_id", "ts", "user_id", _time(log, "ts", "opened").alias("window_start"))
    timeless = timed.where("t IS NULL").select(
        "event_id", "ts", "user_id", F.col("ts").alias("window_start")
    )
    return windows.unionByName(timeless)


def rate_limit_anchored(
    log: DataFrame, quota: int = REQUESTS_PER_WINDOW, width: str = LIMIT_WINDOW
) -> DataFrame:
    """Each request with ``window_start`` and ``admitted``: the first ``quota`` requests of a window
    that a request of the client opened are, the rest are not. Null for a request without a time."""
    admitted = admit_first(anchored_windows(log, width), quota)
    return admitted.withColumn("admitted", F.when(F.col("ts").isNotNull(), F.col("admitted")))
