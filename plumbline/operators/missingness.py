"""Do missing values look random? Evidence per column, as tables.

Everything about which cells are missing together is in the table of missing-value patterns: one
bit per column in as many words as it takes. One pass builds it; rates, label splits and indicator
correlations are then arithmetic over its rows. Driver checks take two more passes.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.contract import (
    CATEGORICAL_DRIVERS,
    CONTINUOUS_DRIVERS,
    FRAUD_POLICIES,
    MISSING_CORRELATION_FLAG,
    MISSING_SPREAD_FLAG,
    P_VALUE_FLAG,
    FillPolicy,
)
from plumbline.functions import sqltext as sql
from plumbline.functions.columns import nan_to_null, ratio, two_sided_p
from plumbline.operators.quantiles import quantile_edges

PATTERN = "_pattern"
WORD = 62


def missing_patterns(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """(pattern, n, positives): bit i of the pattern's words is set where columns[i] is missing."""
    words = []
    for first in range(0, len(columns), WORD):
        part = enumerate(columns[first : first + WORD])
        words.append(" + ".join(f"CAST({sql.name(c)} IS NULL AS BIGINT) * {1 << i}L" for i, c in part))
    bits = f"array({', '.join(words)})"
    return (
        nan_to_null(df.select(*columns, label))
        .groupBy(F.expr(bits).alias(PATTERN))
        .agg(F.count("*").alias("n"), F.expr(f"{sql.total(sql.name(label))} AS positives"))
    )


def _bit(i: int) -> str:
    return f"getbit({PATTERN}[{i // WORD}], {i % WORD}) = 1"


def _totals(patterns: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: rows, positives, and per column the missing rows and the positives among them."""
    counts = [f"{sql.total('n')} AS rows", f"{sql.total('positives')} AS positives"]
    for i in range(len(columns)):
        counts += [f"{sql.total('n', _bit(i))} AS m{i}", f"{sql.total('positives', _bit(i))} AS x{i}"]
    return patterns.agg(*[F.expr(c) for c in counts])


def missing_rates(patterns: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _totals(patterns, columns).selectExpr(
        sql.rows(
            sql.struct(
                column_name=sql.text(c), n_rows="rows", n_missing=f"m{i}", missing_rate=sql.ratio(f"m{i}", "rows")
            )
            for i, c in enumerate(columns)
        )
    )


def label_rate_split(patterns: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Label rate where the column is missing against where it is present, with a pooled
    two-proportion z-test. Columns without missing rows are left out."""
    counts = (
        _totals(patterns, columns)
        .selectExpr(
            sql.rows(
                sql.struct(
                    column_name=sql.text(c),
                    n_missing=f"m{i}",
                    n_present=f"rows - m{i}",
                    x_missing=f"x{i}",
                    x_present=f"positives - x{i}",
                )
                for i, c in enumerate(columns)
            )
        )
        .where("n_missing > 0")
    )
    pooled = sql.ratio("x_missing + x_present", "n_missing + n_present")
    se = f"sqrt({pooled} * (1 - {pooled}) * (1D / n_missing + try_divide(1D, CAST(n_present AS DOUBLE))))"
    return (
        counts.selectExpr(
            "*",
            f"{sql.ratio('x_missing', 'n_missing')} AS rate_missing",
            f"{sql.ratio('x_present', 'n_present')} AS rate_present",
            f"{se} AS se",
        )
        .selectExpr("*", "if(se > 0, try_divide(rate_missing - rate_present, se), 0D) AS z")
        .selectExpr(
            "column_name", "n_missing", "n_present", "rate_missing", "rate_present", "z", f"{two_sided_p('z')} AS p_value"
        )
        .withColumn("flagged", F.expr(f"coalesce(p_value < {P_VALUE_FLAG}, false)"))
    )


def missingness_correlation(patterns: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Largest absolute correlation of a column's missing indicator with any other column's.

    Pairs with a constant indicator have no correlation and do not count.
    """
    last = len(columns) - 1
    set_bits = f"filter(sequence(0, {last}), i -> getbit({PATTERN}[i div {WORD}], i % {WORD}) = 1)"
    # Pairs of set bits only; the pair (-1, -1) counts all rows, (i, i) those that lack column i.
    pairs = "flatten(transform(bits, i -> transform(filter(bits, j -> j >= i), j -> named_struct('i', i, 'j', j))))"
    counted = (
        patterns.selectExpr("n", f"{set_bits} AS bits")
        .selectExpr("n", f"inline(concat(array(named_struct('i', -1, 'j', -1)), {pairs}))")
        .groupBy("i", "j")
        .agg(F.sum("n").cast("double").alias("n"))
    )
    # From here on there is a row per pair of columns, and one number for all rows.
    rows = F.broadcast(counted.where("i < 0").select(F.lit(0).alias("_all"), F.col("n").alias("rows")))
    both = counted.where("i >= 0").selectExpr("i AS bi", "j AS bj", "n AS nij")
    own = counted.where("i >= 0 AND i = j")
    every = patterns.sparkSession.range(len(columns)).selectExpr(
        "CAST(id AS INT) AS i", f"explode(sequence(0, {last})) AS j", "0 AS _all"
    )
    grid = (
        every.join(rows, "_all")
        .join(F.broadcast(own.selectExpr("i", "n AS ni")), "i", "left")
        .join(F.broadcast(own.selectExpr("i AS j", "n AS nj")), "j", "left")
        .join(both, F.expr("i <> j AND bi = least(i, j) AND bj = greatest(i, j)"), "left")
        .selectExpr("i", "j", "coalesce(ni, 0D) / rows AS p", "coalesce(nj, 0D) / rows AS q", "coalesce(nij, 0D) / rows AS pq")
    )
    phi = "if(i = j, NULL, abs(try_divide(pq - p * q, sqrt(p * (1 - p) * q * (1 - q)))))"
    return (
        grid.groupBy("i")
        .agg(F.max(F.expr(phi)).alias("max_abs_correlation"))
        .selectExpr(f"array({', '.join(sql.text(c) for c in columns)})[i] AS column_name", "max_abs_correlation")
        .withColumn("flagged", F.expr(f"coalesce(max_abs_correlation > {MISSING_CORRELATION_FLAG}, false)"))
    )


def _rates_by_level(levels: DataFrame, drivers: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(column_name, driver, level, n_rows, n_missing) for every column and driver.

    ``levels`` holds each driver already cut to a few levels. Rows are first counted per
    combination of all drivers, so what is expanded per driver and column is small.
    """
    missing = [f"m{i}" for i in range(len(columns))]
    combined = levels.groupBy(*drivers).agg(
        F.count("*").alias("n"), *[F.expr(f"count_if({sql.name(f'_missing_{c}')}) AS m{i}") for i, c in enumerate(columns)]
    )
    sides = sql.rows(sql.struct(driver=sql.text(d), level=f"CAST({sql.name(d)} AS DOUBLE)") for d in drivers)
    by_level = (
        combined.selectExpr(sides, "n", *missing)
        .where("level IS NOT NULL")
        .groupBy("driver", "level")
        .agg(F.sum("n").alias("n_rows"), *[F.expr(f"sum({m}) AS {m}") for m in missing])
    )
    long = sql.rows(sql.struct(column_name=sql.text(c), n_missing=f"m{i}") for i, c in enumerate(columns))
    return by_level.selectExpr("driver", "level", "n_rows", long).where("driver <> column_name")


def _spreads(rates: DataFrame) -> DataFrame:
    rate = ratio(F.col("n_missing"), F.col("n_rows"))
    return (
        rates.groupBy("column_name", "driver")
        .agg(
            F.count("*").alias("n_levels"),
            F.min(rate).alias("min_rate"),
            F.max(rate).alias("max_rate"),
        )
        .withColumn("spread", F.col("max_rate") - F.col("min_rate"))
        .withColumn("flagged", F.col("spread") > MISSING_SPREAD_FLAG)
    )


def _missing_flags(columns: Sequence[str]) -> list[str]:
    return [f"{sql.name(c)} IS NULL AS {sql.name(f'_missing_{c}')}" for c in columns]


def missing_by_category(
    df: DataFrame, columns: Sequence[str], drivers: Sequence[str] = CATEGORICAL_DRIVERS
) -> DataFrame:
    """Spread of each column's missing rate over the levels of each categorical driver."""
    clean = nan_to_null(df.select(*dict.fromkeys([*columns, *drivers])))
    levels = clean.selectExpr(*[sql.name(d) for d in drivers], *_missing_flags(columns))
    return _spreads(_rates_by_level(levels, drivers, columns))


def missing_by_quartile(
    df: DataFrame, columns: Sequence[str], drivers: Sequence[str] = CONTINUOUS_DRIVERS
) -> DataFrame:
    """Spread of each column's missing rate over the quartiles of each continuous driver.

    A driver whose quartiles collapse to one value cannot be cut and yields no rows.
    """
    clean = nan_to_null(df.select(*dict.fromkeys([*columns, *drivers])))
    edges = quantile_edges(clean, drivers, 4)
    levels = clean.selectExpr(
        *[f"{sql.bin_index(sql.name(d), edges[d])} AS {sql.name(d)}" for d in drivers], *_missing_flags(columns)
    )
    return _spreads(_rates_by_level(levels, drivers, columns))


def missingness_report(
    df: DataFrame,
    columns: Sequence[str],
    label: str,
    categorical: Sequence[str] = CATEGORICAL_DRIVERS,
    continuous: Sequence[str] = CONTINUOUS_DRIVERS,
) -> DataFrame:
    """All evidence in long form, one row per (column, check, driver), for known columns.

    Columns that do not exist are reported with the check ``column_not_found``.
    """
    known = [c for c in columns if c in df.columns]
    unknown = [c for c in columns if c not in df.columns]
    none = F.lit(None)
    patterns = missing_patterns(df, known, label)

    def shaped(part: DataFrame, check: str, driver: Column, statistic: Column, flagged: Column) -> DataFrame:
        return part.select(
            "column_name",
            F.lit(check).alias("check_name"),
            driver.cast("string").alias("driver"),
            statistic.cast("double").alias("statistic"),
            flagged.alias("flagged"),
        )

    parts = [
        shaped(missing_rates(patterns, known), "missing_rate", none, F.col("missing_rate"), F.lit(False)),
        shaped(label_rate_split(patterns, known), "label_rate_p_value", none, F.col("p_value"), F.col("flagged")),
        shaped(
            missing_by_category(df, known, categorical), "category_spread", F.col("driver"), F.col("spread"), F.col("flagged")
        ),
        shaped(
            missing_by_quartile(df, known, continuous), "quartile_spread", F.col("driver"), F.col("spread"), F.col("flagged")
        ),
        shaped(
            missingness_correlation(patterns, known),
            "max_missing_correlation",
            none,
            F.col("max_abs_correlation"),
            F.col("flagged"),
        ),
    ]
    if unknown:
        absent = df.sparkSession.createDataFrame([(c,) for c in unknown], "column_name string")
        parts.append(shaped(absent, "column_not_found", none, none, F.lit(False)))
    return reduce(DataFrame.unionByName, parts)


def verdict_hints(report: DataFrame) -> DataFrame:
    """Per column: does any check point away from values missing at random?"""
    return report.groupBy("column_name").agg(
        F.count_if("flagged").alias("n_flags"),
        F.when(F.bool_or("flagged"), F.lit("INVESTIGATE")).otherwise(F.lit("NO_EVIDENCE_AGAINST_MCAR")).alias("verdict_hint"),
    )


def missing_rate_guards(
    df: DataFrame, policies: Sequence[FillPolicy] = FRAUD_POLICIES, by: Sequence[Column] = ()
) -> DataFrame:
    """Missing rate against the ceiling per policy column, for the table or per group."""
    counts = [F.expr(f"count_if({sql.name(p.column)} IS NULL) AS m{i}") for i, p in enumerate(policies)]
    grouped = nan_to_null(df).groupBy(*by).agg(F.count("*").alias("n_rows"), *counts)
    keys = grouped.columns[: len(by)]
    guards = sql.rows(
        sql.struct(
            rule_name=sql.text(p.guard_name),
            column_name=sql.text(p.column),
            n_missing=f"m{i}",
            missing_rate=sql.ratio(f"m{i}", "n_rows"),
            ceiling=sql.number(p.ceiling),
        )
        for i, p in enumerate(policies)
    )
    return grouped.selectExpr(*[sql.name(k) for k in keys], "n_rows", guards).withColumn(
        "passed", F.expr("coalesce(missing_rate <= ceiling, true)")
    )
