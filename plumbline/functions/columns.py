"""Small Column builders. All of them stay inside Spark's generated code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions import sqltext as sql

# Abramowitz & Stegun 7.1.26, complementary error function for x >= 0.
ERFC_P = 0.3275911
ERFC_A = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN means missing, so make it null in every floating-point column."""
    cells = []
    for f in df.schema.fields:
        c = sql.name(f.name)
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            cells.append(f"nanvl({c}, CAST(NULL AS {f.dataType.simpleString()})) AS {c}")
        else:
            cells.append(c)
    return df.selectExpr(*cells)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields null instead of failing on a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def two_sided_p(z: str) -> str:
    """SQL text of the two-sided p-value of a standard-normal statistic, erfc(|z| / sqrt 2)."""
    x = f"(abs({z}) / sqrt(2D))"
    t = f"(1D / (1D + {sql.number(ERFC_P)} * {x}))"
    poly = "0D"
    for a in reversed(ERFC_A):
        poly = f"(({poly} + {sql.number(a)}) * {t})"
    return f"{poly} * exp(-{x} * {x})"
