"""Running totals and row positions over a global order without a single-task window.

Rows are range-partitioned by the order key and written once with their partition number, so the
numbers are fixed facts. Each partition's totals (one row per partition) give the offset that its
own running totals start from.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.workspace import Workspace

BUCKET = "_bucket"
TIE = "_tie"


def range_bucketed(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """The rows, staged, with the number of their slice of the global order.

    ``_tie`` numbers rows arbitrarily; ordering by it last lets a key that many rows share be
    spread over several slices. Without a fixed count the engine merges neighbouring slices of a
    small table, which keeps them in order.
    """
    sliced = df.withColumn(TIE, F.monotonically_increasing_id()).repartitionByRange(*order, F.col(TIE))
    return Workspace.of(df.sparkSession).stage(
        sliced.withColumn(BUCKET, F.spark_partition_id()), name
    )


def numbered(df: DataFrame, name: str) -> DataFrame:
    """The rows with consecutive numbers from 0 in no particular order (column ``_number``).

    Rows are counted per input partition, so equal rows are no harder than different ones.
    """
    staged = Workspace.of(df.sparkSession).stage(
        df.withColumn(BUCKET, F.spark_partition_id()).withColumn(TIE, F.monotonically_increasing_id()), name
    )
    # One row per partition of the input.
    before = Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = staged.groupBy(BUCKET).agg(F.count("*").alias("_rows")).select(
        BUCKET, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    )
    place = F.row_number().over(Window.partitionBy(BUCKET).orderBy(TIE))
    return (
        staged.withColumn("_place", place)
        .join(offsets, BUCKET)
        .select(*df.columns, (F.col("_place") + F.col("_offset") - 1).alias("_number"))
    )


def running_totals(
    df: DataFrame, order: list[Column], sums: Mapping[str, str], name: str
) -> DataFrame:
    """Adds, per output name, the sum of a column over all rows up to and including each row.

    Rows that are equal in ``order`` are taken in an arbitrary order.
    """
    sliced = range_bucketed(df, order, name)
    per_bucket = sliced.groupBy(BUCKET).agg(
        *[F.sum(source).alias(f"_sum_{out}") for out, source in sums.items()]
    )
    # One row per slice, at most spark.sql.shuffle.partitions of them.
    before = Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(
        BUCKET,
        *[F.coalesce(F.sum(f"_sum_{out}").over(before), F.lit(0)).alias(f"_off_{out}") for out in sums],
    )
    within = (
        Window.partitionBy(BUCKET)
        .orderBy(*order, TIE)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        sliced.join(F.broadcast(offsets), BUCKET)
        .select(
            *df.columns,
            *[(F.sum(source).over(within) + F.col(f"_off_{out}")).alias(out) for out, source in sums.items()],
        )
    )
