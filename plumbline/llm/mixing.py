"""Mixing sources to target weights by temperature, natively in DataFrames.

A source's weight is its share of all tokens to the power alpha, normalised. Alpha 1 keeps the
shares, alpha 0 makes all sources equal. Alpha is bisected: the largest one whose weights reach a
target entropy, raised where needed until no source is repeated more often than allowed.

A weight times the token budget is a source's quota. A source's texts are hashed into blocks of
about ``block_tokens`` tokens; each pass over the source visits its blocks, and the texts of a
block, in another hashed order. Texts are taken until the quota is used up: those whose first
token lies below it.

Defined results: null or empty text has no tokens and is taken with the pass it falls into; null
is a source of its own; sources without tokens get no weight; repeated rows are separate texts
that take neighbouring places; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumbline.workspace import Workspace

TOKENS = r"[^\x20\x09-\x0D]+"
ENTROPY, REPEATS, BLOCK_TOKENS, SEED = 0.95, 4.0, 1 << 16, 29
# Each job looks at 2^LEVELS - 1 inner points of the interval, that is LEVELS halvings.
LEVELS, ROUNDS = 4, 8


def _look(sources: DataFrame, total: float, points: list[float]) -> list[tuple[float, float]]:
    """(entropy, largest weight over share) at each alpha, in one aggregation."""
    share = f"(tokens / {total!r}D)"
    exprs = []
    for i, a in enumerate(points):
        exprs.append(F.sum(F.expr(f"pow({share}, {a!r}D)")).alias(f"s{i}"))
        exprs.append(F.sum(F.expr(f"pow({share}, {a!r}D) * ln({share})")).alias(f"l{i}"))
        exprs.append(F.max(F.expr(f"pow({share}, {a!r}D) / {share}")).alias(f"m{i}"))
    row = sources.agg(*exprs).first()
    return [
        (math.log(row[f"s{i}"]) - a * row[f"l{i}"] / row[f"s{i}"], row[f"m{i}"] / row[f"s{i}"])
        for i, a in enumerate(points)
    ]


def _bisect(sources: DataFrame, total: float, low_side) -> float:
    """The alpha in 0..1 where ``low_side(entropy, stretch)`` turns from true to false."""
    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        steps = 1 << LEVELS
        points = [low + (high - low) * i / steps for i in range(1, steps)]
        sides = [low_side(*seen) for seen in _look(sources, total, points)]
        below = sum(1 for side in sides if side)
        edges = [low, *points, high]
        low, high = edges[below], edges[below + 1]
    return (low + high) / 2


def temperature(sources: DataFrame, entropy: float, repeats: float, budget: float | None):
    """(alpha, sum of powers, tokens): entropy as a share of the largest possible one, repeats as
    passes over one source. ``sources`` has a positive ``tokens`` per row."""
    head = sources.agg(F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("n")).first()
    total = float(head["t"] or 0)
    if not total:
        return 1.0, 1.0, 0.0
    goal = entropy * math.log(head["n"])
    stretch = repeats * total / (budget or total)
    (least, _), (natural, fixed) = _look(sources, total, [0.0, 1.0])
    alpha = 1.0
    if natural < goal:
        alpha = _bisect(sources, total, lambda h, _: h >= goal) if least > goal else 0.0
    if _look(sources, total, [alpha])[0][1] > stretch:
        # Flatter than the repetition limit allows: back up to the limit, at most to the shares.
        alpha = _bisect(sources, total, lambda _, m: m > stretch) if fixed <= stretch else 1.0
    powers = sources.agg(F.sum(F.expr(f"pow(tokens / {total!r}D, {alpha!r}D)"))).first()[0]
    return alpha, powers, total


def mix_sources(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    entropy: float = ENTROPY,
    repeats: float = REPEATS,
    budget: float | None = None,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """One row per text and pass: key, source, n_tokens, epoch, block, and start_token, the place
    of its first token in the source's stream. The budget is the tokens of ``df`` unless given."""
    workspace = Workspace.of(df.sparkSession)
    named = df.select(
        df[f"`{key}`"].alias("key"),
        df[f"`{source}`"].alias("source"),
        # A text value for every source, null included, so that keys can be joined.
        F.when(df[f"`{source}`"].isNull(), "n")
        .otherwise(F.concat(F.lit("s"), df[f"`{source}`"].cast("string")))
        .alias("name"),
        F.coalesce(F.regexp_count(df[f"`{text}`"], F.lit(TOKENS)), F.lit(0))
        .cast("long")
        .alias("n_tokens"),
        # Texts with equal keys are spread over blocks by what they say.
        F.xxhash64(df[f"`{text}`"]).alias("said"),
    )
    texts = workspace.stage(named, "mixing-texts")
    sources = texts.groupBy("name").agg(F.sum("n_tokens").alias("tokens")).where("tokens > 0")
    sources = workspace.stage(sources, "mixing-sources")
    alpha, powers, total = temperature(sources, entropy, repeats, budget)
    spend = budget or total
    quotas = sources.select(
        "name",
        "tokens",
        # Whole tokens: equal sources get their tokens exactly, however the powers add up.
        F.expr(f"round(pow(tokens / {total or 1.0!r}D, {alpha!r}D) / {powers!r}D * {spend!r}D)").alias(
            "quota"
        ),
        F.ceil(F.col("tokens") / block_tokens).alias("n_blocks"),
    )
    placed = texts.join(quotas.select("name", "n_blocks"), "name").select(
        "key", "source", "name", "n_tokens",
        F.pmod(F.xxhash64("key", "n_tokens", "said", F.lit(SEED)), "n_blocks").alias("block"),
    )
    placed = workspace.stage(placed, "mixing-blocks")
    # Blocks of each pass in hashed order, with the tokens before each. A source's blocks are
    # summed by ranges of the order first, so no task sorts all blocks of a busy source.
    blocks = placed.groupBy("name", "block").agg(F.sum("n_tokens").alias("block_tokens"))
    passes = blocks.join(quotas, "name").withColumn(
        "epoch",
        F.explode(F.expr("sequence(0L, greatest(cast(ceil(quota / tokens) as bigint), 1L) - 1L)")),
    )
    passes = passes.withColumn("order", F.xxhash64("name", "block", "epoch", F.lit(SEED)))
    passes = passes.withColumn("range", F.shiftright("order", 54))
    ranges = passes.groupBy("name", "epoch", "range").agg(
        F.sum("block_tokens").alias("range_tokens")
    )
    earlier = Window.partitionBy("name", "epoch").orderBy("range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    ranges = ranges.withColumn("before_range", F.coalesce(F.sum("range_tokens").over(earlier), F.lit(0)))
    within = Window.partitionBy("name", "epoch", "range").orderBy("order", "block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    passes = passes.join(ranges.drop("range_tokens"), ["name", "epoch", "range"]).withColumn(
        "block_start",
        F.col("epoch") * F.col("tokens")
        + F.col("before_range")
        + F.coalesce(F.sum("block_tokens").over(within), F.lit(0)),
    )
    # What has no tokens may begin where a whole pass ends.
    whole = (F.col("epoch") + 1) * F.col("tokens") <= F.col("quota")
    passes = passes.withColumn("whole", whole).where("whole OR block_start < quota").select(
        "name", "block", "epoch", "block_start", "quota", "whole"
    )
    inside = Window.partitionBy("name", "block", "epoch").orderBy(
        F.xxhash64("key", "epoch", F.lit(SEED)), "key", "n_tokens"
    ).rowsBetween(Window.unboundedPreceding, -1)
    drawn = placed.join(passes, ["name", "block"]).withColumn(
        "start_token",
        F.col("block_start") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)),
    )
    return drawn.where("whole OR start_token < quota").select(
        F.col("key").alias(key), F.col("source").alias(source), "n_tokens", "epoch", "block",
        "start_token",
    )
