"""Pieces of Spark SQL text.

Wide expressions (one term per column, per rule, per pair) are written as SQL text: building them
from Column objects costs one call into the JVM per operator, which for hundreds of terms takes
longer than the query.
"""

from __future__ import annotations

import math
from collections.abc import Iterable


def name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def number(value: float | None) -> str:
    """A double literal."""
    if value is None:
        return "CAST(NULL AS DOUBLE)"
    if not math.isfinite(value):
        return f"CAST('{value}' AS DOUBLE)"
    return f"({float(value)!r}D)"


def struct(**fields: str) -> str:
    return "named_struct(" + ", ".join(f"{text(k)}, {v}" for k, v in fields.items()) + ")"


def rows(structs: Iterable[str]) -> str:
    """One output row per struct."""
    return f"inline(array({', '.join(structs)}))"


def case(branches: Iterable[tuple[str, str]], otherwise: str = "NULL") -> str:
    whens = " ".join(f"WHEN {condition} THEN {value}" for condition, value in branches)
    return f"CASE {whens} ELSE {otherwise} END" if whens else otherwise


def ratio(numerator: str, denominator: str) -> str:
    """Division that yields null instead of failing on a zero denominator."""
    return f"try_divide(CAST({numerator} AS DOUBLE), CAST({denominator} AS DOUBLE))"


def total(value: str, condition: str | None = None) -> str:
    """Sum of counts as bigint, 0 over nothing."""
    picked = value if condition is None else f"if({condition}, {value}, 0)"
    return f"CAST(coalesce(sum({picked}), 0) AS BIGINT)"


def bin_index(value: str, edges: Iterable[float]) -> str:
    """1-based right-closed bin of ``value``; the lowest edge belongs to bin 1.

    Missing values and columns without two distinct edges have no bin.
    """
    cuts = sorted(set(edges))
    if len(cuts) < 2:
        return "CAST(NULL AS INT)"
    steps = "".join(f" + CAST({value} > {number(edge)} AS INT)" for edge in cuts[1:-1])
    return f"if({value} IS NULL, NULL, 1{steps})"
