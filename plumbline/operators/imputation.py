"""Fill missing values under per-column policies, keeping an indicator of what was filled.

Columns do not depend on each other, so all rates and fill values are found first and all columns
are filled in one projection.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegralType

from plumbline.contract import FillPolicy
from plumbline.functions import sqltext as sql
from plumbline.functions.columns import nan_to_null
from plumbline.operators.quantiles import exact_quantiles, profile

logger = logging.getLogger(__name__)


class MissingRateExceeded(ValueError):
    """A column's missing rate is above what its policy was validated for."""


@dataclass(frozen=True)
class Fill:
    policy: FillPolicy
    n_rows: int
    n_missing: int
    value: float | None

    @property
    def rate(self) -> float:
        return self.n_missing / self.n_rows if self.n_rows else 0.0


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value, n) of present values, counted on the map side first."""
    cells = [sql.struct(column_name=sql.text(c), value=f"CAST({sql.name(c)} AS DOUBLE)") for c in columns]
    return (
        df.selectExpr(sql.rows(cells))
        .where("value IS NOT NULL")
        .groupBy("column_name", "value")
        .agg(F.count("*").alias("n"))
    )


def modes(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Most frequent present value per column, the smallest one on a tie."""
    if not columns:
        return {}
    best = F.max(F.struct("n", (-F.col("value")).alias("minus"))).alias("best")
    rows = value_counts(df, columns).groupBy("column_name").agg(best).collect()
    return {r["column_name"]: 0.0 - r["best"]["minus"] for r in rows}


def fit_fills(df: DataFrame, policies: Sequence[FillPolicy]) -> dict[str, Fill]:
    """Missing counts and fill values per policy column (a few small aggregations)."""
    for policy in policies:
        if policy.strategy not in ("median", "mode"):
            raise NotImplementedError(f"{policy.column}: unknown fill strategy {policy.strategy}")
    df = nan_to_null(df.select(*[p.column for p in policies]))
    profiles = profile(df, [p.column for p in policies])
    medians = exact_quantiles(
        df,
        {p.column: [0.5] for p in policies if p.strategy == "median"},
        profiles,
    )
    values = {c: q[0] if q else None for c, q in medians.items()}
    values.update(modes(df, [p.column for p in policies if p.strategy == "mode"]))
    return {
        p.column: Fill(p, profiles[p.column].rows, profiles[p.column].missing, values.get(p.column))
        for p in policies
    }


def check_ceilings(df: DataFrame, policies: Sequence[FillPolicy], fills: Mapping[str, Fill]) -> None:
    """Raise at the first policy, in order, whose column is absent or missing too often."""
    for policy in policies:
        if policy.column not in df.columns:
            raise MissingRateExceeded(f"column {policy.column} not found for the missing-rate check")
        fill = fills[policy.column]
        if fill.rate > policy.ceiling:
            raise MissingRateExceeded(
                f"{policy.column}: missing rate {fill.rate:.1%} is above the ceiling of "
                f"{policy.ceiling:.0%}; not filling on an unchecked assumption"
            )


def apply_fills(df: DataFrame, fills: Mapping[str, Fill]) -> DataFrame:
    """Fill in place and append one 0/1 indicator per policy, in policy order.

    A column filled with its median becomes double if it holds integers: the median of two of them
    may lie between.
    """
    clean = nan_to_null(df)
    cells = []
    for c in clean.columns:
        cell = sql.name(c)
        if c in fills:
            kind = clean.schema[c].dataType
            if fills[c].policy.strategy == "median" and isinstance(kind, IntegralType):
                kind = DoubleType()
            kind = kind.simpleString()
            cell = f"coalesce(CAST({cell} AS {kind}), CAST({sql.number(fills[c].value)} AS {kind})) AS {cell}"
        cells.append(cell)
    return clean.selectExpr(*cells, *_indicators([f.policy for f in fills.values()]))


def _indicators(policies: Sequence[FillPolicy]) -> list[str]:
    return [f"CAST({sql.name(p.column)} IS NULL AS INT) AS {sql.name(p.indicator)}" for p in policies]


def add_indicators(df: DataFrame, policies: Sequence[FillPolicy]) -> DataFrame:
    return nan_to_null(df).selectExpr("*", *_indicators(policies))


def impute(df: DataFrame, policies: Sequence[FillPolicy]) -> DataFrame:
    """Fill the policies' columns without checking their ceilings."""
    return apply_fills(df, fit_fills(df, policies))


def impute_guarded(df: DataFrame, policies: Sequence[FillPolicy]) -> DataFrame:
    """Check every ceiling in policy order, then fill all columns."""
    found = [p for p in policies if p.column in df.columns]
    fills = fit_fills(df, found)
    check_ceilings(df, policies, fills)
    for fill in fills.values():
        logger.info("%s: %d rows filled with %s %s", fill.policy.column, fill.n_missing, fill.policy.strategy, fill.value)
    return apply_fills(df, fills)


def fill_summary(df: DataFrame, policies: Sequence[FillPolicy]) -> DataFrame:
    """One row per policy: rows, rows filled, missing rate, and the value filled in."""
    fills = fit_fills(df, policies)
    rows = [
        (i, p.column, p.strategy, fills[p.column].n_rows, fills[p.column].n_missing, fills[p.column].rate, fills[p.column].value)
        for i, p in enumerate(policies)
    ]
    return df.sparkSession.createDataFrame(
        rows,
        "position int, column_name string, strategy string, n_rows bigint, n_filled bigint, "
        "missing_rate double, fill_value double",
    )


def proposed_ceilings(df: DataFrame, rate: str) -> DataFrame:
    """Smallest multiple of 5 percent that is at least twice the validated missing rate."""
    steps = f"ceil(round({sql.name(rate)} * 200 / 5, 9))"
    return df.withColumn("proposed_ceiling", F.expr(f"{steps} * 5 / 100"))
