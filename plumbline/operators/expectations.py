"""Expectations: a second, independent reading of the same facts, with a tolerance.

``mostly`` is the share of present values that must conform. All expectations share one scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions import sqltext as sql
from plumbline.functions.columns import nan_to_null

SUITE_NAME = "expectation_suite"


@dataclass(frozen=True)
class Expectation:
    """``kind`` is one of exists, not_null, between, in_set."""

    kind: str
    column: str
    minimum: float | None = None
    maximum: float | None = None
    allowed: tuple[float, ...] = ()
    mostly: float = 1.0


# The seven governance expectations of the fraud table, in suite order.
FRAUD_SUITE = (
    Expectation("exists", "is_fraud"),
    Expectation("not_null", "is_fraud"),
    Expectation("between", "customer_age", minimum=0, maximum=120),
    Expectation("between", "network_quality", minimum=0, maximum=100),
    Expectation("in_set", "device_type", allowed=(0.0, 1.0, 2.0)),
    Expectation("in_set", "store_type", allowed=(0.0, 1.0)),
    Expectation("in_set", "is_fraud", allowed=(0.0, 1.0)),
)


def _unexpected(e: Expectation) -> str:
    c = sql.name(e.column)
    if e.kind == "not_null":
        return f"{c} IS NULL"
    if e.kind == "in_set":
        return f"{c} NOT IN ({', '.join(f'{v:g}' for v in e.allowed)})"
    sides = [f"{c} < {e.minimum}"] if e.minimum is not None else []
    sides += [f"{c} > {e.maximum}"] if e.maximum is not None else []
    return " OR ".join(sides)


def expectation_results(df: DataFrame, suite: Sequence[Expectation]) -> DataFrame:
    """One row per expectation. An absent column fails every expectation on it."""
    present = [e for e in suite if e.column in df.columns]
    source = nan_to_null(df.select(*dict.fromkeys(e.column for e in present))) if present else df
    counts, results = ["count(*) AS rows"], []
    for i, e in enumerate(suite):
        bad = seen = "0L"
        success = "true" if e in present else "false"
        if e in present and e.kind != "exists":
            bad, seen = f"bad{i}", f"seen{i}"
            population = "*" if e.kind == "not_null" else sql.name(e.column)
            counts += [f"count_if({_unexpected(e)}) AS {bad}", f"count({population}) AS {seen}"]
            # No evaluated value means nothing contradicts the expectation.
            success = f"coalesce({sql.ratio(f'{seen} - {bad}', seen)} >= {sql.number(e.mostly)}, true)"
        results.append(
            sql.struct(
                position=str(i),
                expectation=sql.text(e.kind),
                column_name=sql.text(e.column),
                success=success,
                n_evaluated=seen,
                n_unexpected=bad,
            )
        )
    return source.agg(*[F.expr(c) for c in counts]).selectExpr(sql.rows(results))


def suite_result(results: DataFrame, position: int) -> DataFrame:
    """The suite folded into one rule-result row."""
    errors = F.array_sort(
        F.collect_list(
            F.when(
                ~F.col("success"),
                F.struct("position", F.concat_ws(" ", F.lit("expectation"), "expectation", F.lit("failed on"), "column_name").alias("text")),
            )
        )
    )
    return results.agg(
        F.lit(position).alias("position"),
        F.lit(SUITE_NAME).alias("rule_name"),
        F.lit(SUITE_NAME).alias("category"),
        F.every("success").alias("passed"),
        F.count_if(~F.col("success")).alias("n_invalid"),
        errors.getField("text").alias("errors"),
    )
