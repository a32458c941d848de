"""Is there anything to learn? Relations between each feature and the label, and row order.

Every check returns a table. Per-feature group counts are taken on the map side, so what is
shuffled is a few counts per feature, whatever the table size.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.contract import CORRELATION_FLAG, LABEL_SPREAD_FLAG, MUTUAL_INFORMATION_FLAG
from plumbline.functions import sqltext as sql
from plumbline.functions.columns import nan_to_null, ratio
from plumbline.operators.ordering import BUCKET, TIE, range_bucketed
from plumbline.operators.quantiles import Quantiles, profile, quantile_edges, quantiles_around_median

CATEGORY_LIMIT = 10
SURE_ESTIMATE = 50


def level_text(df: DataFrame, column: str) -> str:
    """A categorical value as text; numbers all in the same notation."""
    if isinstance(df.schema[column].dataType, T.NumericType):
        return f"CAST(CAST({sql.name(column)} AS DOUBLE) + 0D AS STRING)"
    return f"CAST({sql.name(column)} AS STRING)"


def _features(df: DataFrame, label: str) -> list[str]:
    return [c for c in df.columns if c != label]


def category_sizes(df: DataFrame, columns: Sequence[str]) -> dict[str, int | None]:
    """Number of distinct present values where it is at most ``CATEGORY_LIMIT``, else None.

    A sketch settles the columns that are far from the limit; only the others are counted
    exactly, and those have so few values that the map side reduces them to almost nothing.
    """
    clean = nan_to_null(df.select(*columns))
    sketches = [
        f"hll_sketch_estimate(hll_sketch_agg(if({sql.name(c)} IS NULL, NULL, xxhash64({sql.name(c)})), 10)) AS {sql.name(c)}"
        for c in columns
    ]
    estimates = clean.agg(*[F.expr(s) for s in sketches]).first()
    close = [c for c in columns if (estimates[c] or 0) <= SURE_ESTIMATE]
    sizes: dict[str, int | None] = {c: None for c in columns}
    if close:
        cells = sql.rows(sql.struct(c=sql.text(c), v=level_text(clean, c)) for c in close)
        counts = clean.selectExpr(cells).where("v IS NOT NULL").distinct().groupBy("c").count()
        found = {r["c"]: r["count"] for r in counts.collect()}
        for c in close:
            n = found.get(c, 0)
            sizes[c] = n if n <= CATEGORY_LIMIT else None
    return sizes


def infer_roles(df: DataFrame, label: str) -> dict[str, str]:
    """``numeric`` for features with more than ten distinct values, else ``categorical``."""
    sizes = category_sizes(df, _features(df, label))
    return {c: "numeric" if n is None else "categorical" for c, n in sizes.items()}


def role_table(df: DataFrame, label: str) -> DataFrame:
    sizes = category_sizes(df, _features(df, label))
    rows = [(c, "numeric" if n is None else "categorical", n) for c, n in sizes.items()]
    return df.sparkSession.createDataFrame(rows, "feature string, role string, n_levels bigint")


def label_correlation(df: DataFrame, label: str, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation with the label over rows where both are present; null if constant."""
    clean = nan_to_null(df.select(*columns, label))
    y = f"CAST({sql.name(label)} AS DOUBLE)"
    measured = []
    for i, c in enumerate(columns):
        x = f"if({y} IS NULL, NULL, CAST({sql.name(c)} AS DOUBLE))"
        seen = f"if({sql.name(c)} IS NULL, NULL, {y})"
        measured.append(f"try_divide(covar_pop({x}, {seen}), stddev_pop({x}) * stddev_pop({seen})) AS r{i}")
    return (
        clean.agg(*[F.expr(m) for m in measured])
        .selectExpr(sql.rows(sql.struct(feature=sql.text(c), correlation=f"r{i}") for i, c in enumerate(columns)))
        .withColumn("flagged", F.expr(f"coalesce(abs(correlation) >= {CORRELATION_FLAG}, false)"))
    )


def _named(index: str, names: Sequence[str]) -> str:
    return f"element_at(array({', '.join(sql.text(n) for n in names)}), {index} + 1)"


def _labelled(df: DataFrame, label: str, columns: Iterable[str]) -> DataFrame:
    return nan_to_null(df.select(*columns, label)).where(F.col(label).isNotNull())


def _bin_quantiles(
    clean: DataFrame, features: Sequence[str], present: Mapping[str, int], filled: Mapping[str, int]
) -> Quantiles:
    """Medians, and edges of so many equal-frequency bins of present and of filled values."""
    steps = [{c: [i / n for i in range(n + 1)] for c, n in bins.items()} for bins in (present, filled)]
    return quantiles_around_median(clean, profile(clean, features), *steps)


def mutual_information(
    df: DataFrame,
    label: str,
    roles: Mapping[str, str],
    bins: int = 10,
    quantiles: Quantiles | None = None,
) -> DataFrame:
    """Mutual information with the label in nats, from counts.

    Missing values are filled with the median; numeric features are cut into equal-frequency
    bins, categorical ones keep their values. ``corrected`` subtracts the expected value under
    independence, (bins-1)(classes-1)/2n, and is what the flag looks at.
    """
    features = list(roles)
    numeric = [c for c in features if roles[c] == "numeric"]
    clean = _labelled(df, label, features)
    if quantiles is None:
        quantiles = _bin_quantiles(clean, features, {}, {c: bins for c in numeric})
    medians = quantiles.medians
    edges = {c: sorted(set(quantiles.filled[c] or [])) for c in numeric}
    filled = clean.selectExpr(
        f"{sql.name(label)} AS y",
        *[
            f"coalesce(CAST({sql.name(c)} AS DOUBLE), {sql.number(medians[c] or 0.0)}) AS {sql.name(c)}"
            for c in features
        ],
    )
    # Features travel as small numbers until they are counted.
    cells = sql.rows(
        sql.struct(
            feature=str(i),
            level=f"CAST(coalesce({sql.bin_index(sql.name(c), edges[c])}, 0) AS DOUBLE)" if c in edges else sql.name(c),
        )
        for i, c in enumerate(features)
    )
    counts = (
        filled.selectExpr("y", cells)
        .groupBy("feature", "level", "y")
        .agg(F.count("*").alias("n"))
        .withColumn("feature", F.expr(_named("feature", features)))
    )
    # From here on there are a few dozen rows per feature.
    shares = counts.selectExpr(
        "feature",
        "level",
        "y",
        "CAST(n AS DOUBLE) AS n",
        "CAST(sum(n) OVER (PARTITION BY feature) AS DOUBLE) AS total",
        "CAST(sum(n) OVER (PARTITION BY feature, level) AS DOUBLE) AS nx",
        "CAST(sum(n) OVER (PARTITION BY feature, y) AS DOUBLE) AS ny",
    )
    return (
        shares.groupBy("feature")
        .agg(
            F.expr("sum(n / total * ln(n * total / (nx * ny))) AS mi"),
            F.expr("count(DISTINCT level) AS n_bins"),
            F.expr("count(DISTINCT y) AS n_classes"),
            F.expr("max(total) AS total"),
        )
        .selectExpr(
            "feature",
            "n_bins",
            "greatest(mi, 0D) AS mutual_information",
            "greatest(mi - (n_bins - 1) * (n_classes - 1) / (2 * total), 0D) AS corrected",
        )
        .withColumn("flagged", F.expr(f"corrected >= {MUTUAL_INFORMATION_FLAG}"))
    )


def _label_spread(levels: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Lowest, highest and difference of label rates over the levels of each key."""
    rate = ratio(F.col("positives"), F.col("n"))
    return (
        levels.groupBy(*keys)
        .agg(F.count("*").alias("n_levels"), F.min(rate).alias("min_rate"), F.max(rate).alias("max_rate"))
        .withColumn("spread", F.col("max_rate") - F.col("min_rate"))
        .withColumn("flagged", F.coalesce(F.col("spread") >= LABEL_SPREAD_FLAG, F.lit(False)))
    )


def decile_rates(
    df: DataFrame,
    label: str,
    columns: Sequence[str],
    bins: int = 10,
    edges: Mapping[str, Sequence[float]] | None = None,
) -> DataFrame:
    """(feature, level, n, positives) per equal-frequency bin, rows missing either value left out."""
    clean = _labelled(df, label, columns)
    edges = edges or quantile_edges(clean, columns, bins)
    cells = sql.rows(
        sql.struct(feature=str(i), level=sql.bin_index(sql.name(c), edges[c])) for i, c in enumerate(columns)
    )
    return (
        clean.selectExpr(f"{sql.name(label)} AS y", cells)
        .where("level IS NOT NULL")
        .groupBy("feature", "level")
        .agg(F.count("*").alias("n"), F.sum("y").cast("bigint").alias("positives"))
        .withColumn("feature", F.expr(_named("feature", columns)))
    )


def decile_spread(
    df: DataFrame,
    label: str,
    columns: Sequence[str],
    bins: int = 10,
    edges: Mapping[str, Sequence[float]] | None = None,
) -> DataFrame:
    return _label_spread(decile_rates(df, label, columns, bins, edges), ["feature"])


def _category_counts(df: DataFrame, label: str, columns: Sequence[str]) -> DataFrame:
    """Label counts per combination of all categorical features: few rows for any table size."""
    clean = nan_to_null(df.select(*columns, label))
    return clean.groupBy(*columns).agg(
        F.count(label).alias("n"), F.coalesce(F.sum(label), F.lit(0)).cast("bigint").alias("positives")
    )


def category_rates(df: DataFrame, label: str, columns: Sequence[str]) -> DataFrame:
    """(feature, level, n, positives) per value of each categorical feature."""
    cells = sql.rows(sql.struct(feature=sql.text(c), level=level_text(df, c)) for c in columns)
    return (
        _category_counts(df, label, columns)
        .selectExpr("n", "positives", cells)
        .where("level IS NOT NULL")
        .groupBy("feature", "level")
        .agg(F.sum("n").alias("n"), F.sum("positives").alias("positives"))
    )


def category_spread(df: DataFrame, label: str, columns: Sequence[str]) -> DataFrame:
    rates = category_rates(df, label, columns)
    by_level = F.array_sort(
        F.collect_list(F.struct("level", ratio(F.col("positives"), F.col("n")).alias("rate")))
    )
    # Categorical features have at most ten levels, so the map stays small.
    groups = rates.groupBy("feature").agg(
        F.map_from_entries(
            F.transform(by_level, lambda e: F.struct(e["level"].alias("k"), e["rate"].alias("v")))
        ).alias("rates_by_level")
    )
    return _label_spread(rates, ["feature"]).join(groups, "feature")


def interaction_cells(df: DataFrame, label: str, columns: Sequence[str]) -> DataFrame:
    """Label counts per cell of every pair of categorical features."""
    cells = sql.rows(
        sql.struct(
            feature_a=sql.text(a), feature_b=sql.text(b), level_a=level_text(df, a), level_b=level_text(df, b)
        )
        for a, b in combinations(columns, 2)
    )
    return (
        _category_counts(df, label, columns)
        .selectExpr("n", "positives", cells)
        .where("level_a IS NOT NULL AND level_b IS NOT NULL")
        .groupBy("feature_a", "feature_b", "level_a", "level_b")
        .agg(F.sum("n").alias("n"), F.sum("positives").alias("positives"))
        .withColumn("label_rate", ratio(F.col("positives"), F.col("n")))
    )


def interaction_spread(df: DataFrame, label: str, columns: Sequence[str]) -> DataFrame:
    cells = interaction_cells(df, label, columns).drop("label_rate")
    return _label_spread(cells, ["feature_a", "feature_b"])


def row_order_gaps(df: DataFrame, label: str, order_key: str, name: str = "row_order") -> DataFrame:
    """One row: label rate overall and per half, and gaps between consecutive positive rows.

    Rows are sliced by ranges of the order key; positions and gaps are found inside each slice,
    and the gaps that cross slices come from one summary row per slice.
    """
    rows = df.select(F.col(order_key).alias("k"), F.col(label).alias("y"))
    sliced = range_bucketed(rows, [F.col("k")], name)
    # One row per slice, at most spark.sql.shuffle.partitions of them.
    before = Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sliced.groupBy(BUCKET).agg(F.count("*").alias("rows"))
    offsets = sizes.select(
        BUCKET,
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"),
        F.sum("rows").over(Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("total"),
    )
    inside = Window.partitionBy(BUCKET).orderBy("k", TIE)
    placed = (
        sliced.withColumn("i", F.row_number().over(inside))
        .join(F.broadcast(offsets), BUCKET)
        .withColumn("i", F.col("i") + F.col("offset") - 1)
    )
    position = F.when(F.col("y") == 1, F.col("i"))
    previous = F.last(position, ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, -1))
    gaps = placed.withColumn("gap", (position - previous).cast("double"))
    first_half = F.col("i") < F.floor(F.col("total") / 2)
    summaries = gaps.groupBy(BUCKET).agg(
        F.count("y").alias("n"),
        F.sum("y").alias("positives"),
        F.sum(F.when(first_half, F.col("y"))).alias("positives_first"),
        F.count(F.when(first_half, F.col("y"))).alias("n_first"),
        F.min(position).alias("first"),
        F.max(position).alias("last"),
        F.count("gap").alias("m"),
        F.coalesce(F.sum("gap"), F.lit(0.0)).alias("g"),
        F.coalesce(F.sum(F.col("gap") * F.col("gap")), F.lit(0.0)).alias("gg"),
    )
    last_before = F.last("last", ignorenulls=True).over(before)
    joined = summaries.withColumn("cross", (F.col("first") - last_before).cast("double"))
    cross = F.coalesce(F.col("cross"), F.lit(0.0))
    totals = joined.agg(
        F.sum("n").alias("n"),
        F.sum("positives").alias("positives"),
        F.sum("n_first").alias("n_first"),
        F.coalesce(F.sum("positives_first"), F.lit(0)).alias("positives_first"),
        F.sum(F.col("m") + F.col("cross").isNotNull().cast("int")).cast("double").alias("m"),
        F.sum(F.col("g") + cross).alias("g"),
        F.sum(F.col("gg") + cross * cross).alias("gg"),
    )
    rate = ratio(F.col("positives"), F.col("n"))
    mean = F.try_divide(F.col("g"), F.col("m"))
    variance = F.try_divide(F.col("gg") - F.col("g") * mean, F.col("m") - 1)
    expected = F.try_divide(F.lit(1.0), rate)
    std = F.sqrt(F.greatest(variance, F.lit(0.0)))
    return totals.select(
        rate.alias("label_rate"),
        ratio(F.col("positives_first"), F.col("n_first")).alias("label_rate_first_half"),
        ratio(F.col("positives") - F.col("positives_first"), F.col("n") - F.col("n_first")).alias("label_rate_second_half"),
        mean.alias("gap_mean"),
        F.when(F.col("m") > 1, std).alias("gap_std"),
        expected.alias("expected_gap_mean"),
        F.coalesce((F.abs(mean - expected) < std) & (F.col("m") > 1), F.lit(False)).alias("consistent_with_iid"),
    )


def signal_checks(df: DataFrame, label: str, roles: Mapping[str, str] | None = None) -> DataFrame:
    """All feature checks in long form: (feature, check_name, statistic, flagged)."""
    roles = roles or infer_roles(df, label)
    numeric = [c for c in roles if roles[c] == "numeric"]
    categorical = [c for c in roles if roles[c] == "categorical"]

    def shaped(part: DataFrame, check: str, statistic: str) -> DataFrame:
        return part.select(
            "feature", F.lit(check).alias("check_name"), F.col(statistic).alias("statistic"), "flagged"
        )

    clean = _labelled(df, label, roles)
    # Bins of all checks from one search.
    tenths = {c: 10 for c in numeric}
    quantiles = _bin_quantiles(clean, list(roles), tenths, tenths)
    edges = {c: sorted(set(quantiles.present[c] or [])) for c in numeric}
    information = mutual_information(df, label, roles, quantiles=quantiles)
    parts = [shaped(information, "mutual_information", "corrected")]
    if numeric:
        parts.append(shaped(label_correlation(df, label, numeric), "correlation", "correlation"))
        parts.append(shaped(decile_spread(df, label, numeric, edges=edges), "decile_spread", "spread"))
    if categorical:
        spread = _label_spread(category_rates(df, label, categorical), ["feature"])
        parts.append(shaped(spread, "category_spread", "spread"))
    return reduce(DataFrame.unionByName, parts)


def verdict(checks: DataFrame) -> DataFrame:
    """SIGNAL_DETECTED when any feature check is flagged; row order does not take part."""
    return checks.agg(
        F.count("*").alias("n_checks"),
        F.count_if("flagged").alias("n_flagged"),
        F.when(F.bool_or("flagged"), F.lit("SIGNAL_DETECTED")).otherwise(F.lit("NO_SIGNAL_DETECTED")).alias("verdict"),
    )


def signal_report(df: DataFrame, label: str, order_key: str) -> DataFrame:
    """The whole assessment as one nested row, ready to be written as JSON."""
    features = df.drop(order_key)
    checks = signal_checks(features, label)
    entries = F.array_sort(F.collect_list(F.struct("check_name", "feature", "statistic", "flagged")))
    summary = checks.agg(
        entries.alias("checks"),
        F.when(F.bool_or("flagged"), F.lit("SIGNAL_DETECTED")).otherwise(F.lit("NO_SIGNAL_DETECTED")).alias("verdict"),
    )
    order = row_order_gaps(df, label, order_key).select(F.struct("*").alias("row_order"))
    rows = df.agg(F.count("*").alias("row_count"))
    # Three one-row tables side by side.
    return (
        rows.unionByName(summary, allowMissingColumns=True)
        .unionByName(order, allowMissingColumns=True)
        .agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("row_count", "checks", "verdict", "row_order")])
    )
