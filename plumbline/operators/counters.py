"""Sampled counters and their rates over sliding ranges.

A service shows counters that only grow and start again at zero when it restarts; what is stored are
samples of them at a fixed interval. The rate over a range is read from the samples inside it:
growth from the first to the last one, with the value before each restart added, extended to the
ends of the range as far as the samples' spacing allows.

Samples of a series are put in order over range slices. The sample before a slice's first one comes
from a table with the last sample of each series and slice, so a series of any length is no single
task. Each sample goes to the few evaluations whose range holds it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions import sqltext as sql
from plumbline.operators.monitoring import LATENCY_EDGES, bucket_quantile_sql
from plumbline.operators.ordering import BUCKET, range_bucketed, running_totals

# Seconds between samples, and seconds that a rate looks back.
SCRAPE_SECONDS, RANGE_SECONDS = 15, 60
RESTART_SECONDS = 86_400
EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
# A gap at an end of the range is filled up to this share of the samples' mean spacing, else half.
REACH = 1.1


def sampled_counters(log: DataFrame, scrape: int = SCRAPE_SECONDS, restart: int = RESTART_SECONDS) -> DataFrame:
    """(series, t, v): every ``scrape`` seconds the requests served (series -1) and the observations
    at or below each latency boundary (its number; the last series counts all), since the service's
    last restart at a multiple of ``restart`` seconds. Requests without a time are in no sample."""
    spark = log.sparkSession
    ending = F.expr(f"CAST(ceil(timestampdiff(MICROSECOND, {EPOCH}, CAST(ts AS TIMESTAMP_NTZ)) / {scrape * 1_000_000}D) AS BIGINT)")
    below = [f"count_if(latency <= {sql.number(edge)}) AS c{i}" for i, edge in enumerate(LATENCY_EDGES)]
    names = [f"c{i}" for i in range(-1, len(LATENCY_EDGES) + 1)]
    counted = (
        log.where("ts IS NOT NULL")
        .groupBy(ending.alias("slot"))
        .agg(F.count_if("served").alias("c-1"), *[F.expr(b) for b in below], F.count("latency").alias(names[-1]))
    )
    ends = counted.agg(F.min("slot").alias("first"), F.max("slot").alias("last")).first()
    if ends["first"] is None:
        return spark.createDataFrame([], "series int, t bigint, v bigint")
    slots = spark.range(ends["first"], ends["last"] + 1).withColumnRenamed("id", "slot")
    filled = slots.join(counted, "slot", "left").na.fill(0)
    totals = running_totals(filled, [F.col("slot")], {f"t{c}": c for c in names}, "counter-slots")
    totals = totals.withColumn("life", F.expr(f"slot * {scrape} div {restart}"))
    # One row per restart; what had been counted before it.
    bases = totals.groupBy("life").agg(*[F.min(F.col(f"t{c}") - F.col(c)).alias(f"b{c}") for c in names])
    cells = sql.rows(
        sql.struct(series=str(i), v=f"CAST(`tc{i}` - `bc{i}` AS BIGINT)") for i in range(-1, len(LATENCY_EDGES) + 1)
    )
    return totals.join(bases, "life").selectExpr(f"slot * {scrape}L AS t", cells).select("series", "t", "v")


def _with_resets(samples: DataFrame) -> DataFrame:
    """Adds ``lost``: the value before, if the counter started again since."""
    sliced = range_bucketed(samples, [F.col("series"), F.col("t")], "counter-samples")
    inside = Window.partitionBy(BUCKET, "series").orderBy("t")
    before = F.lag("v").over(inside)
    # One row per series and slice.
    last = sliced.groupBy("series", BUCKET).agg(F.max_by("v", "t").alias("final"))
    across = Window.partitionBy("series").orderBy(BUCKET)
    carried = last.select(F.col("series").alias("_s"), F.col(BUCKET).alias("_b"), F.lag("final").over(across).alias("carried"))
    known = sliced.withColumn("before", before).join(
        carried, (F.col("series") == F.col("_s")) & (F.col(BUCKET) == F.col("_b"))
    )
    previous = F.coalesce("before", "carried")
    return known.select("series", "t", "v", F.when(previous > F.col("v"), previous).otherwise(0).alias("lost"))


def counter_rates(samples: DataFrame, width: int = RANGE_SECONDS, step: int = RANGE_SECONDS) -> DataFrame:
    """(series, t, n, rate) every ``step`` seconds: growth a second over the ``width`` seconds up to
    and with t, from two samples on."""
    reached = samples if "lost" in samples.columns else _with_resets(samples)
    evaluations = f"explode(sequence(CAST(ceil(t / {step}D) AS BIGINT), CAST(ceil((t + {width}) / {step}D) AS BIGINT) - 1)) AS at"
    in_range = reached.selectExpr("series", "t", "v", "lost", evaluations).groupBy("series", "at").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.struct("t", "v", "lost")).alias("first"),
        F.max(F.struct("t", "v")).alias("last"),
        F.sum("lost").alias("lost"),
    )
    # The first sample's own restart lies before the range.
    grown = in_range.where(f"n > 1 AND at * {step} >= last.t").selectExpr(
        "series", f"at * {step}L AS t", "n", "first.v AS begun",
        "CAST(last.v - first.v + lost - first.lost AS DOUBLE) AS growth",
        "CAST(last.t - first.t AS DOUBLE) AS covered",
        f"CAST(first.t - (at * {step} - {width}) AS DOUBLE) AS head",
        f"CAST(at * {step} - last.t AS DOUBLE) AS tail",
    )
    spacing = "(covered / (n - 1))"
    head = f"if(head >= {REACH}D * {spacing}, {spacing} / 2, head)"
    # A counter cannot have been below zero.
    head = f"least({head}, if(growth > 0, covered * begun / growth, {head}))"
    tail = f"if(tail >= {REACH}D * {spacing}, {spacing} / 2, tail)"
    return grown.selectExpr("series", "t", "n", f"growth * (covered + {head} + {tail}) / covered / {width} AS rate")


def rate_quantile(rates: DataFrame, quantile: float) -> DataFrame:
    """(t, quantile_of_rates): the latency quantile at each evaluation as read from the rates of the
    buckets; null where nothing was observed."""
    picked = [f"max(if(series = {i}, rate, NULL)) AS le{i}" for i in range(len(LATENCY_EDGES))]
    wide = rates.groupBy("t").agg(
        *[F.expr(p) for p in picked], F.expr(f"max(if(series = {len(LATENCY_EDGES)}, rate, NULL)) AS n")
    )
    return wide.where("n IS NOT NULL").selectExpr("t", f"{bucket_quantile_sql(quantile)} AS quantile_of_rates")
