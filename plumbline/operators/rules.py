"""Validation rules as declarations, compiled into one aggregation.

A rule never runs on its own pass: row predicates become ``count_if``, rate guards become null
counts, the size rule becomes ``count(*)``, and all of them share a single scan. Only full-row
duplicates need a shuffle of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.contract import (
    FEATURE_RULE_ORDER,
    FRAUD_CONTRACT,
    FRAUD_POLICIES,
    LOGICAL_TYPES,
    SQL_TYPES,
    ColumnSpec,
    FillPolicy,
    TableContract,
)
from plumbline.functions import sqltext as sql
from plumbline.functions.columns import nan_to_null

RESULT_SCHEMA = (
    "position int, rule_name string, category string, passed boolean, n_invalid bigint, "
    "errors array<string>"
)
SCHEMA_RULES = ("required_columns", "datatypes", "no_unexpected_columns")


@dataclass(frozen=True)
class RowRule:
    """Fails when any row satisfies ``violation``; missing values never do unless it says so.

    The violation is SQL text, or a function from the column to a condition.
    """

    name: str
    column: str
    violation: str | Callable[[Column], Column]
    says: str

    def broken(self) -> Column:
        if callable(self.violation):
            return F.coalesce(self.violation(F.col(self.column)), F.lit(False))
        return F.expr(f"coalesce({self.violation}, false)")


@dataclass(frozen=True)
class MemberRule(RowRule):
    """A row rule whose evidence is the set of offending values."""


@dataclass(frozen=True)
class SizeRule:
    name: str
    min_rows: int


@dataclass(frozen=True)
class RateRule:
    """Fails when the missing rate is strictly above the policy's ceiling."""

    policy: FillPolicy

    @property
    def name(self) -> str:
        return self.policy.guard_name


@dataclass(frozen=True)
class DuplicateRule:
    name: str


Rule = RowRule | SizeRule | RateRule | DuplicateRule


def range_rule(spec: ColumnSpec) -> RowRule:
    low, high, c = spec.minimum, spec.maximum, sql.name(spec.name)
    sides = ([f"{c} < {low}"] if low is not None else []) + ([f"{c} > {high}"] if high is not None else [])
    bounds = f"below {low:g}" if high is None else f"outside {low:g} to {high:g}"
    return RowRule(spec.rule_name, spec.name, " OR ".join(sides), bounds)


def member_rule(spec: ColumnSpec) -> MemberRule:
    allowed = ", ".join(f"{v:g}" for v in spec.allowed)
    violation = f"{sql.name(spec.name)} NOT IN ({allowed})"
    return MemberRule(spec.rule_name, spec.name, violation, f"not one of {allowed}")


@dataclass
class RuleBook:
    """The ordered rules for one contract; callers may register more."""

    contract: TableContract
    rules: list[Rule] = field(default_factory=list)

    def register(self, rule: Rule) -> None:
        if rule.name in self.names() or rule.name in SCHEMA_RULES:
            raise ValueError(f"a rule named {rule.name} is already registered")
        self.rules.append(rule)

    def register_rule(
        self, name: str, column: str, violation: str | Callable[[Column], Column], says: str = "invalid"
    ) -> None:
        self.register(RowRule(name, column, violation, says))

    def names(self) -> list[str]:
        return [r.name for r in self.rules]

    def row_rules(self) -> list[RowRule]:
        return [r for r in self.rules if isinstance(r, RowRule)]

    def only(self, *names: str) -> "RuleBook":
        return RuleBook(self.contract, [r for r in self.rules if r.name in names])


def rule_book(
    contract: TableContract = FRAUD_CONTRACT,
    policies: Sequence[FillPolicy] = FRAUD_POLICIES,
    order: Sequence[str] | None = None,
    label_rule: str = "target_not_null",
) -> RuleBook:
    """All rules a contract implies: label present, size, missing-rate guards, ranges and value
    sets, duplicates."""
    if order is None:
        order = FEATURE_RULE_ORDER if contract is FRAUD_CONTRACT else contract.names
    book = RuleBook(contract)
    book.register(RowRule(label_rule, contract.label, f"{sql.name(contract.label)} IS NULL", "missing"))
    book.register(SizeRule("minimum_size", contract.min_rows))
    for policy in policies:
        book.register(RateRule(policy))
    for name in order:
        spec = contract.column(name)
        if spec.allowed is not None:
            book.register(member_rule(spec))
        elif spec.minimum is not None or spec.maximum is not None:
            book.register(range_rule(spec))
    book.register(DuplicateRule("no_duplicate_rows"))
    return book


# --- schema rules: metadata only -------------------------------------------------------------


def missing_columns(df: DataFrame, contract: TableContract) -> list[str]:
    return [c for c in contract.names if c not in df.columns]


def unexpected_columns(df: DataFrame, contract: TableContract) -> list[str]:
    return [c for c in df.columns if c not in contract.names]


def mistyped_columns(
    df: DataFrame, contract: TableContract, integers_as_floats: bool = False
) -> list[tuple[str, str, str]]:
    """(column, expected logical type, actual type) of present columns with the wrong type.

    ``integers_as_floats`` accepts integer columns where the contract says float; a column of
    whole numbers without gaps may be typed that way by its writer.
    """
    wrong = []
    for spec in contract.columns:
        if spec.name not in df.columns:
            continue
        actual = df.schema[spec.name].dataType
        accepted = LOGICAL_TYPES[spec.logical_type]
        if integers_as_floats and spec.logical_type == "float":
            accepted = accepted + LOGICAL_TYPES["integer"]
        if not isinstance(actual, accepted):
            wrong.append((spec.name, spec.logical_type, actual.simpleString()))
    return wrong


def schema_results(
    df: DataFrame, contract: TableContract, integers_as_floats: bool = False
) -> list[tuple]:
    """Result rows of the three schema rules, errors in contract or table order."""
    errors = (
        [f"required column {c} is missing" for c in missing_columns(df, contract)],
        [
            f"column {c} should be {expected} but is {actual}"
            for c, expected, actual in mistyped_columns(df, contract, integers_as_floats)
        ],
        [f"column {c} is not in the contract" for c in unexpected_columns(df, contract)],
    )
    return [
        (i, name, "core", not found, len(found), found)
        for i, (name, found) in enumerate(zip(SCHEMA_RULES, errors))
    ]


def result_rows(spark: SparkSession, rows: Iterable[tuple]) -> DataFrame:
    return spark.createDataFrame(list(rows), RESULT_SCHEMA)


# --- data rules: one fused aggregation -------------------------------------------------------


def _measure(rule: Rule) -> Column:
    if isinstance(rule, RowRule):
        return F.count_if(rule.broken())
    if isinstance(rule, RateRule):
        return F.expr(f"count_if({sql.name(rule.policy.column)} IS NULL)")
    return F.expr("count(*)")


def _result(rule: Rule, position: int, measured: str) -> str:
    """SQL text of a rule's result row, given the name of what was measured for it."""
    n_invalid, passed = measured, f"{measured} = 0"
    if isinstance(rule, SizeRule):
        n_invalid = f"greatest({rule.min_rows} - rows, 0)"
        passed = f"rows >= {rule.min_rows}"
        message = f"concat(rows, {sql.text(f' rows, at least {rule.min_rows} are required')})"
    elif isinstance(rule, RateRule):
        policy, rate = rule.policy, sql.ratio(measured, "rows")
        # Over an empty table the rate is undefined and the guard does not fire.
        passed = f"coalesce({rate} <= {sql.number(policy.ceiling)}, true)"
        says = (
            f"{policy.column}: missing rate %.1f%% is above the ceiling of {policy.ceiling * 100:.0f}%%; "
            f"{policy.strategy} filling was validated at about {policy.validated_rate * 100:.0f}%%"
        )
        message = f"format_string({sql.text(says)}, {rate} * 100)"
    elif isinstance(rule, DuplicateRule):
        message = f"concat({measured}, ' rows repeat an earlier row in full')"
    else:
        message = f"concat({measured}, {sql.text(f' rows where {rule.column} is {rule.says}')})"
    return sql.struct(
        position=str(position),
        rule_name=sql.text(rule.name),
        category="'core'",
        passed=passed,
        n_invalid=f"CAST({n_invalid} AS BIGINT)",
        errors=f"if({passed}, CAST(array() AS ARRAY<STRING>), array({message}))",
    )


def _positions(book: RuleBook) -> dict[str, int]:
    return {name: len(SCHEMA_RULES) + i for i, name in enumerate(book.names())}


def fused_results(df: DataFrame, book: RuleBook) -> DataFrame:
    """Results of every rule except duplicates, from one aggregation over one scan."""
    positions = _positions(book)
    fused = [r for r in book.rules if not isinstance(r, DuplicateRule)]
    measured = df.agg(
        F.expr("count(*) AS rows"), *[_measure(r).alias(f"m{i}") for i, r in enumerate(fused)]
    )
    return measured.selectExpr(
        sql.rows(_result(r, positions[r.name], f"m{i}") for i, r in enumerate(fused))
    )


def row_digest(df: DataFrame) -> tuple[Column, Column]:
    """128 bits of a row; rows that differ only in which columns are null differ in the second."""
    columns = [F.col(sql.name(c)) for c in df.columns]
    return F.xxhash64(*columns), F.xxhash64(F.lit(7), *[c.isNull() for c in columns], *columns)


def repeated_rows(df: DataFrame, digest: Callable[[DataFrame], tuple[Column, Column]] = row_digest) -> DataFrame:
    """(n_repeated): rows that equal an earlier one, with nulls equal.

    Digests are counted first, on the map side before the shuffle. Only rows whose digest occurs
    more than once are compared, again counted on the map side: a group of copies of any size is
    one entry per task, and rows that occur once are never shuffled as a whole.
    """
    high, low = digest(df)
    named = df.select(high.alias("_high"), low.alias("_low"), "*")
    several = named.groupBy("_high", "_low").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    suspects = named.join(several.select("_high", "_low"), ["_high", "_low"], "left_semi")
    copies = suspects.groupBy(*[F.col(sql.name(c)) for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))
    return copies.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("n_repeated"))


def duplicate_result(df: DataFrame, book: RuleBook, rule: DuplicateRule) -> DataFrame:
    position = _positions(book)[rule.name]
    return repeated_rows(df).selectExpr(sql.rows([_result(rule, position, "n_repeated")]))


def data_results(df: DataFrame, book: RuleBook, keys: Sequence[str] = ()) -> DataFrame:
    """Results of all data rules; assumes the schema rules passed.

    ``keys`` identify rows and are not part of the contract; rows with different keys are not
    duplicates of each other.
    """
    clean = nan_to_null(df.select(*keys, *book.contract.names))
    parts = []
    if any(not isinstance(r, DuplicateRule) for r in book.rules):
        parts.append(fused_results(clean, book))
    parts += [duplicate_result(clean, book, r) for r in book.rules if isinstance(r, DuplicateRule)]
    results = parts[0]
    for part in parts[1:]:
        results = results.unionByName(part)
    return results


def rule_results(df: DataFrame, book: RuleBook, integers_as_floats: bool = False) -> DataFrame:
    """All rule results. If a schema rule fails only the three schema results are returned."""
    rows = schema_results(df, book.contract, integers_as_floats)
    results = result_rows(df.sparkSession, rows)
    if all(passed for _, _, _, passed, _, _ in rows):
        results = results.unionByName(data_results(df, book))
    return results


def offending_values(df: DataFrame, rules: Sequence[RowRule]) -> DataFrame:
    """Every distinct offending value of the given rules with its row count (rule_name, value, n_rows)."""
    clean = nan_to_null(df.select(*dict.fromkeys(r.column for r in rules)))
    flagged = clean.select("*", *[r.broken().alias(f"_broken{i}") for i, r in enumerate(rules)])
    cells = [
        f"if(_broken{i}, {sql.struct(rule_name=sql.text(r.name), value=f'CAST({sql.name(r.column)} AS DOUBLE)')}, NULL)"
        for i, r in enumerate(rules)
    ]
    return (
        flagged.selectExpr(f"inline(array_compact(array({', '.join(cells)})))")
        .groupBy("rule_name", "value")
        .agg(F.count("*").alias("n_rows"))
    )


def with_violations(df: DataFrame, book: RuleBook, required: Sequence[str] = ()) -> DataFrame:
    """Adds the names of the row rules a row breaks, in rule order, then of missing required columns."""
    row_rules = book.row_rules()
    flagged = df.select("*", *[r.broken().alias(f"_broken{i}") for i, r in enumerate(row_rules)])
    names = [f"if(_broken{i}, {sql.text(r.name)}, NULL)" for i, r in enumerate(row_rules)]
    names += [f"if({sql.name(c)} IS NULL, {sql.text(f'{c}_required')}, NULL)" for c in required]
    kept = [sql.name(c) for c in df.columns]
    return flagged.selectExpr(*kept, f"array_compact(array({', '.join(names)})) AS violations")


def quarantine(df: DataFrame, book: RuleBook) -> DataFrame:
    """Every row with the rules it breaks; split on ``size(violations) = 0``."""
    return with_violations(nan_to_null(df), book)


# --- text-landed input -----------------------------------------------------------------------


def _token(column: str) -> str:
    return f"trim({sql.name(column)})"


def _absent(column: str, null_tokens: Sequence[str]) -> str:
    token = _token(column)
    return f"({token} IS NULL OR {token} IN ({', '.join(sql.text(t) for t in null_tokens)}))"


def typed_cell(spec: ColumnSpec, null_tokens: Sequence[str]) -> str:
    """SQL text of a text cell as its contract type: null for a null token or text that does not
    convert."""
    value = f"try_cast({_token(spec.name)} AS {SQL_TYPES[spec.logical_type]})"
    if spec.logical_type == "float":
        value = f"nanvl({value}, CAST(NULL AS DOUBLE))"
    return f"if({_absent(spec.name, null_tokens)}, NULL, {value})"


def type_conformance(df: DataFrame, contract: TableContract, null_tokens: Sequence[str]) -> DataFrame:
    """Per contract column of a text table: missing cells, and cells that do not convert."""
    counts, results = [], []
    for i, spec in enumerate(contract.columns):
        absent = _absent(spec.name, null_tokens)
        value = f"try_cast({_token(spec.name)} AS {SQL_TYPES[spec.logical_type]})"
        counts += [f"count_if({absent}) AS a{i}", f"count_if(NOT {absent} AND {value} IS NULL) AS b{i}"]
        results.append(
            sql.struct(
                column_name=sql.text(spec.name),
                expected_type=sql.text(spec.logical_type),
                n_missing=f"a{i}",
                n_nonconforming=f"b{i}",
                passed=f"b{i} = 0",
            )
        )
    return df.agg(*[F.expr(c) for c in counts]).selectExpr(sql.rows(results))
