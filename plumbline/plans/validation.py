"""Validate a table, always leave a report, and write the trusted table only if it passed."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from plumbline.contract import FRAUD_POLICIES, FillPolicy
from plumbline.operators.expectations import (
    FRAUD_SUITE,
    SUITE_NAME,
    Expectation,
    expectation_results,
    suite_result,
)
from plumbline.operators.imputation import impute_guarded
from plumbline.operators.rules import (
    RESULT_SCHEMA,
    SCHEMA_RULES,
    MemberRule,
    RuleBook,
    data_results,
    offending_values,
    result_rows,
    schema_results,
)
from plumbline.sources.sinks import append_report

logger = logging.getLogger(__name__)

SHOWN_VALUES = 20


@dataclass(frozen=True)
class ValidationOutcome:
    run_id: str
    passed: bool
    row_count: int
    column_count: int
    results: list[Row]
    report_path: str
    validated_path: str | None
    offenders_path: str | None


def _isolated(df: DataFrame, book: RuleBook, keys: Sequence[str]) -> list[tuple]:
    """Rule by rule, so that a rule that cannot run is reported instead of ending the run."""
    rows: list[tuple] = []
    for i, name in enumerate(book.names()):
        position = len(SCHEMA_RULES) + i
        try:
            found = data_results(df, book.only(name), keys).first()
            rows.append((position, *found[1:]))
        except PySparkException as error:
            message = f"rule could not run: {type(error).__name__}: {str(error).splitlines()[0]}"
            rows.append((position, name, "core", False, 0, [message]))
    return rows


def _failed_members(book: RuleBook, rows: list[tuple]) -> list[MemberRule]:
    failed = {r[1] for r in rows if not r[3] and r[4]}
    return [r for r in book.rules if isinstance(r, MemberRule) and r.name in failed]


def _with_offenders(df: DataFrame, book: RuleBook, rows: list[tuple]) -> list[tuple]:
    """Add the smallest offending values to the message of each failed membership rule.

    The message shows up to ``SHOWN_VALUES`` of them; ``run_validation`` writes them all.
    """
    rules = _failed_members(book, rows)
    if not rules:
        return rows
    values = offending_values(df, rules)
    shown = values.groupBy("rule_name").agg(
        F.count("*").alias("n"), F.min_by("value", "value").alias("least")
    )
    sizes = {r["rule_name"]: r["n"] for r in shown.collect()}
    texts = {}
    for rule in rules:
        least = values.where(F.col("rule_name") == rule.name).orderBy("value").limit(SHOWN_VALUES).collect()
        listed = ", ".join(f"{r['value']:g}" for r in least)
        more = sizes[rule.name] - len(least)
        texts[rule.name] = f"offending values of {rule.column}: {listed}" + (f" and {more} more" if more > 0 else "")
    return [(*r[:5], [*r[5], texts[r[1]]]) if r[1] in texts else r for r in rows]


def core_results(
    df: DataFrame, book: RuleBook, integers_as_floats: bool = False, keys: Sequence[str] = ()
) -> list[tuple]:
    """Result rows of all core rules; only the three schema rules if one of those fails."""
    rows = schema_results(df.drop(*keys), book.contract, integers_as_floats)
    if not all(r[3] for r in rows):
        return rows
    try:
        found = [tuple(r) for r in data_results(df, book, keys).orderBy("position").collect()]
    except PySparkException:
        logger.warning("the fused check failed; running the rules one by one")
        found = _isolated(df, book, keys)
    return rows + _with_offenders(df, book, found)


def run_validation(
    df: DataFrame,
    book: RuleBook,
    report_path: str,
    validated_path: str,
    source: str,
    policies: Sequence[FillPolicy] = FRAUD_POLICIES,
    suite: Sequence[Expectation] | None = FRAUD_SUITE,
    keys: Sequence[str] = (),
) -> ValidationOutcome:
    """The whole stage.

    ``keys`` are row-identity columns that are not part of the contract: they are carried into
    the trusted table, and rows that differ in them are not duplicates. Every offending value of a
    failed membership rule, with its row count, is written beside the report.
    """
    spark = df.sparkSession
    table = df.drop(*keys)
    rows = core_results(df, book, keys=keys)
    if suite is not None:
        position = len(SCHEMA_RULES) + len(book.rules)
        try:
            rows.append(tuple(suite_result(expectation_results(table, suite), position).first()))
        except PySparkException as error:
            message = f"suite could not run: {type(error).__name__}: {str(error).splitlines()[0]}"
            rows.append((position, SUITE_NAME, SUITE_NAME, False, 0, [message]))
    passed = all(r[3] for r in rows)
    row_count, column_count = table.count(), len(table.columns)
    run_id = uuid.uuid4().hex
    results = result_rows(spark, rows)
    append_report(results, report_path, run_id, source, row_count, column_count, passed)
    members, offenders = _failed_members(book, rows), None
    if members:
        offenders = f"{report_path.rstrip('/')}-offenders/run_id={run_id}"
        offending_values(table, members).write.parquet(offenders)
    written = None
    if passed:
        impute_guarded(df, policies).write.mode("overwrite").parquet(validated_path)
        written = validated_path
    else:
        for row in rows:
            for error in row[5]:
                logger.error("%s: %s", row[1], error)
    names = [f.split()[0] for f in RESULT_SCHEMA.split(", ")]
    return ValidationOutcome(
        run_id, passed, row_count, column_count, [Row(*names)(*r) for r in rows], report_path, written, offenders
    )
