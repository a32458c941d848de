"""Content fingerprints that do not depend on row order, and of files an artifact consists of."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table_fingerprint(df: DataFrame) -> DataFrame:
    """(n_rows, hash_sum, hash_xor) over 64-bit row hashes: equal for equal multisets of rows."""
    return df.select(F.xxhash64(*df.columns).alias("h")).agg(
        F.count("*").alias("n_rows"),
        F.coalesce(F.sum(F.col("h").cast("decimal(38,0)")), F.lit(0)).alias("hash_sum"),
        F.coalesce(F.bit_xor("h"), F.lit(0)).alias("hash_xor"),
    )


def exact_cells(column: str) -> list[Column]:
    """A double as its sign and three whole numbers: what is before the point, and two times 52 bits
    after it. Exact from 2^-51 to 2^63; text of doubles differs between engines."""
    size, bits = F.abs(F.col(column)), F.lit(float(1 << 52))
    first = (size - F.floor(size)) * bits
    second = (first - F.floor(first)) * bits
    sign = F.when(F.col(column) < 0, 1).when(F.col(column) >= 0, 0)
    return [sign, *[F.floor(x).cast("bigint") for x in (size, first, second)]]


def portable_fingerprint(df: DataFrame, cells: Sequence[Column]) -> DataFrame:
    """The same idea from MD5 of the row's text, for comparison with other engines."""
    text = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("-")) for c in cells])
    digest = F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("bigint")
    return df.select(digest.alias("h")).agg(
        F.count("*").alias("n_rows"),
        F.coalesce(F.sum(F.col("h").cast("decimal(38,0)")), F.lit(0)).cast("string").alias("hash_sum"),
        F.coalesce(F.bit_xor("h"), F.lit(0)).alias("hash_xor"),
    )


def artifact_fingerprint(spark: SparkSession, path: str) -> str:
    """SHA-256 over the SHA-256 of each file of a saved artifact, in name order.

    Meant for models and parameter tables: a bounded number of small files.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(
            F.element_at(F.split("path", "/"), -1).alias("name"),
            F.sha2("content", 256).alias("digest"),
        )
    )
    listing = F.array_sort(F.collect_list(F.concat_ws(":", "digest", "name")))
    return files.agg(F.sha2(F.concat_ws("\n", listing), 256).alias("d")).first()["d"]
