"""Readers with the checks each stage needs before it starts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from plumbline.contract import FRAUD_CONTRACT, TableContract
from plumbline.functions import sqltext as sql
from plumbline.operators.rules import typed_cell

# Cell texts that mean "missing" in delimited text.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


class MissingInput(FileNotFoundError):
    """An input of a stage does not exist yet."""


def scan_text(spark: SparkSession, path: str) -> DataFrame:
    """Delimited text with a header; every column stays text until it is typed by contract."""
    try:
        return spark.read.option("header", "true").option("inferSchema", "false").csv(path)
    except AnalysisException as error:
        raise MissingInput(f"no raw table at {path}") from error


def typed(df: DataFrame, contract: TableContract = FRAUD_CONTRACT, tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Contract columns of a text table converted to their types; other columns are kept as text."""
    return df.selectExpr(
        *[
            f"{typed_cell(contract.column(c), tokens)} AS {sql.name(c)}" if c in contract.names else sql.name(c)
            for c in df.columns
        ]
    )


def scan_trusted(spark: SparkSession, path: str, stage: str) -> DataFrame:
    """A Parquet table written by an earlier stage."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        raise MissingInput(f"no table at {path}; run the {stage} stage first") from error


def scan_label(df: DataFrame) -> DataFrame:
    """A label table must have exactly one column."""
    if len(df.columns) != 1:
        raise ValueError(f"a label table has exactly one column, found {len(df.columns)}")
    return df
