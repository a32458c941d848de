"""Streams over arriving files: guards, counters, limits and scoring.

Aggregating streams run in update mode and write each micro-batch's changed rows into its own
folder; the newest row per key is the current state. A replayed batch overwrites its folder, so a
restart after a failure changes nothing. Windows that the watermark has passed leave the state;
rows that arrive for them are dropped by all these streams alike, and a warning says in how many
per-key groups. Replaying a backlog takes all files as one batch, in which no row is late.
"""

from __future__ import annotations

import bisect
import logging
from collections.abc import Sequence

import pandas as pd
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from plumbline.contract import FRAUD_POLICIES, FillPolicy
from plumbline.functions import sqltext as sql
from plumbline.operators import monitoring
from plumbline.operators.features import Preprocessor
from plumbline.operators.scoring import score
from plumbline.workspace import Workspace

logger = logging.getLogger(__name__)

EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def file_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files under ``path`` as they arrive. A path that may be one file is given as a
    pattern, because a stream's base path has to be a folder."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def as_instant(column: str):
    """A wall-clock time as an instant, whatever the session time zone: watermarks need one."""
    return F.expr(f"timestamp_micros(timestampdiff(MICROSECOND, {EPOCH}, {column}))")


def as_wall_clock(column: str):
    return F.expr(f"timestampadd(MICROSECOND, unix_micros({column}), {EPOCH})")


def with_event_time(stream: DataFrame, column: str, delay: str) -> DataFrame:
    if isinstance(stream.schema[column].dataType, T.TimestampNTZType):
        stream = stream.withColumn(column, as_instant(column))
    return stream.withWatermark(column, delay)


def run_to_table(aggregated: DataFrame, name: str, keys: Sequence[str], state: str | None = None) -> DataFrame:
    """Run an aggregating stream over what has arrived and return its current rows.

    ``state`` names a folder to continue in; without it a new one is taken.
    """
    spark = aggregated.sparkSession
    root = state or Workspace.of(spark).new_path(name)

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/rows/batch_id={batch_id}")

    query = (
        aggregated.writeStream.outputMode("update")
        .foreachBatch(keep)
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    late = sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
    if late:
        logger.warning("%s: %d groups of rows came after the watermark and were dropped", name, late)
    schema = T.StructType([*aggregated.schema.fields, T.StructField("batch_id", T.LongType())])
    rows = spark.read.schema(schema).option("basePath", f"{root}/rows").parquet(f"{root}/rows")
    values = [c for c in aggregated.columns if c not in keys]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("row"))
    return newest.select(*keys, "row.*")


def append_to_table(stream: DataFrame, name: str, state: str | None = None) -> DataFrame:
    """Run a stateless stream over what has arrived into a Parquet table."""
    spark = stream.sparkSession
    root = state or Workspace.of(spark).new_path(name)
    query = (
        stream.writeStream.format("parquet")
        .option("path", f"{root}/rows")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/rows")


def missing_rate_stream(
    transactions: DataFrame,
    width: str = "7 days",
    delay: str = "1 day",
    policies: Sequence[FillPolicy] = FRAUD_POLICIES,
    state: str | None = None,
) -> DataFrame:
    """Missing-rate guards per time window of arriving transactions."""
    timed = with_event_time(transactions, "tx_ts", delay)
    missing = [
        F.expr(f"count_if({sql.name(p.column)} IS NULL OR isnan({sql.name(p.column)})) AS {sql.name(p.column)}")
        for p in policies
    ]
    counted = monitoring.per_window(timed, width, [F.count("*").alias("n_rows"), *missing], ts="tx_ts")
    current = run_to_table(counted, "missing_rate_stream", ["window_start"], state)
    guards = sql.rows(
        sql.struct(
            rule_name=sql.text(p.guard_name),
            n_missing=sql.name(p.column),
            missing_rate=sql.ratio(sql.name(p.column), "n_rows"),
            passed=f"{sql.ratio(sql.name(p.column), 'n_rows')} <= {sql.number(p.ceiling)}",
        )
        for p in policies
    )
    return current.select(as_wall_clock("window_start").alias("window_start"), "n_rows", F.expr(guards))


def served_counter_stream(events: DataFrame, width: str, delay: str = "1 hour", state: str | None = None) -> DataFrame:
    log = with_event_time(monitoring.request_log(events), "ts", delay)
    current = run_to_table(monitoring.served_per_window(log, width), "served_stream", ["window_start"], state)
    return current.withColumn("window_start", as_wall_clock("window_start"))


def rate_limit_stream(
    events: DataFrame,
    quota: int = monitoring.REQUESTS_PER_WINDOW,
    width: str = monitoring.LIMIT_WINDOW,
    delay: str = "1 hour",
    state: str | None = None,
) -> DataFrame:
    """Admitted and rejected requests per user and window; only counts are kept as state, so one
    busy user is combined before the shuffle like any other."""
    log = with_event_time(monitoring.request_log(events), "ts", delay)
    limited = monitoring.rate_limit_summary(log, quota, width)
    current = run_to_table(limited, "rate_limit_stream", ["user_id", "window_start"], state)
    return current.withColumn("window_start", as_wall_clock("window_start"))


def admitted_stream(
    events: DataFrame,
    width: str = monitoring.LIMIT_WINDOW,
    delay: str = "1 hour",
    state: str | None = None,
    quota: int = monitoring.REQUESTS_PER_WINDOW,
) -> DataFrame:
    """The requests let through, the first ``quota`` of a user and window, as rows. Until the
    watermark passes a window, an earlier request that arrives later takes the place of the last."""
    log = with_event_time(monitoring.request_log(events), "ts", delay)
    if quota == 1:
        admitted = monitoring.first_requests(log, width)
        rows = run_to_table(admitted, "admitted_stream", ["user_id", "window_start"], state)
        shown = as_wall_clock("ts"), as_wall_clock("window_start")
    else:
        first = run_to_table(first_of_parts(log, quota, width), "admitted_stream", PART_KEYS, state)
        # At most quota requests of each of the window's parts.
        order = Window.partitionBy("user_id", "opens").orderBy("t", "event_id")
        rows = first.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= quota)
        shown = (F.expr(f"timestampadd(MICROSECOND, {c}, {EPOCH})") for c in ("t", "opens"))
    ts, start = shown
    return rows.select("event_id", ts.alias("ts"), "user_id", start.alias("window_start"))


PART_KEYS = ["user_id", "opens", "part", "place"]


def first_of_parts(log: DataFrame, quota: int, width: str, parts: int = monitoring.SALTS) -> DataFrame:
    """The first ``quota`` requests of each user in every part of a window, as a stream of changes.

    A window is dealt to ``parts`` parts by request, so that no task sees all of it or all of a
    busy user's. Most users have few requests in a window: the state is kept per part, for all its
    users at once, and it goes when the watermark passes the window. Requests without an id come
    before those with one."""
    kinds = {c: log.schema[c].dataType.simpleString() for c in ("user_id", "event_id")}
    part = F.pmod(F.xxhash64("event_id"), F.lit(parts)).cast("int")
    window = F.window("ts", width)
    # Nulls are told by a flag: in pandas they would make whole numbers floating.
    known = [F.col(c).isNotNull().alias(f"{c}_known") for c in kinds]
    ids = [F.coalesce(F.col(c), F.lit(0).cast(kind)).alias(c) for c, kind in kinds.items()]
    keyed = log.where("ts IS NOT NULL").select(
        F.unix_micros(window["start"]).alias("opens"),
        F.unix_millis(window["end"]).alias("closes"),
        part.alias("part"),
        "ts",
        F.unix_micros("ts").alias("t"),
        *ids,
        *known,
    )
    fields = ["user_id_known", "user_id", "t", "event_id_known", "event_id"]

    def kept(key, arrived, state):
        if state.hasTimedOut:
            state.remove()
            return
        opens, closes, part = key
        if int(closes) <= state.getCurrentWatermarkMs():
            return
        first, changed = {}, set()
        if state.exists:
            for has_user, user, *request in zip(*state.get):
                first.setdefault((has_user, user), []).append(tuple(request))
        for rows in arrived:
            for has_user, user, *request in zip(*(rows[f].tolist() for f in fields)):
                mine = first.setdefault((has_user, user), [])
                bisect.insort(mine, tuple(request))
                del mine[quota:]
                changed.add((has_user, user))
        held = [(*user, *request) for user, mine in first.items() for request in mine]
        state.update(tuple(map(list, zip(*held))))
        state.setTimeoutTimestamp(int(closes))
        out = [
            (user if has_user else None, place, t, event if has_event else None)
            for has_user, user in changed
            for place, (t, has_event, event) in enumerate(first[has_user, user])
        ]
        users, places, times, events = map(list, zip(*out))
        yield pd.DataFrame(
            {
                "user_id": pd.Series(users, dtype=object), "opens": opens, "part": part, "place": places,
                "t": times, "event_id": pd.Series(events, dtype=object),
            }
        )

    return keyed.groupBy("opens", "closes", "part").applyInPandasWithState(
        kept,
        f"user_id {kinds['user_id']}, opens long, part int, place int, t long, event_id {kinds['event_id']}",
        f"user_known array<boolean>, user array<{kinds['user_id']}>, t array<long>, "
        f"event_known array<boolean>, event array<{kinds['event_id']}>",
        "update",
        GroupStateTimeout.EventTimeTimeout,
    )


def score_stream(
    requests: DataFrame,
    fitted: Preprocessor,
    model: RandomForestClassificationModel,
    keep: Sequence[str],
    state: str | None = None,
) -> DataFrame:
    return append_to_table(score(requests, fitted, model, keep), "score_stream", state)
