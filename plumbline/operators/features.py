"""Leakage-free feature preparation: split first, fit on the training part, apply to both.

What is fitted is a small table of parameters; applying it is one projection.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.contract import CATEGORICAL_FEATURES, NUMERIC_FEATURES, SEED, TEST_SHARE, FillPolicy
from plumbline.functions import sqltext as sql
from plumbline.functions.columns import nan_to_null
from plumbline.operators.imputation import value_counts
from plumbline.operators.ordering import numbered
from plumbline.operators.quantiles import exact_quantiles, order_statistics, profile

MAX_LEVELS = 10_000

PARAMETER_SCHEMA = (
    "slot int, block string, feature string, level double, fill double, mean double, scale double, "
    "output_name string"
)


def drop_indicators(df: DataFrame, policies: Iterable[FillPolicy]) -> DataFrame:
    """Without the missing-value indicators; absent ones are ignored."""
    return df.drop(*[p.indicator for p in policies])


# --- stratified split ------------------------------------------------------------------------


def class_quotas(counts: Mapping[int, int], share: float) -> dict[int, int]:
    """Test rows per class: ceil(share * n) in all, by largest remainder, ties to the lower label."""
    total = sum(counts.values())
    wanted = math.ceil(share * total)
    # Whole-number remainders: equal ones must tie exactly.
    rest = {c: (n * wanted) % total for c, n in counts.items()}
    quotas = {c: n * wanted // total for c, n in counts.items()}
    left = wanted - sum(quotas.values())
    for c in sorted(counts, key=lambda c: (-rest[c], c))[:left]:
        quotas[c] += 1
    return quotas


def split_digest(key: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def stratified_split(
    df: DataFrame, key: str, label: str, share: float = TEST_SHARE, seed: int = SEED
) -> DataFrame:
    """Adds ``split``: per class, the rows with the smallest key digests form the test part.

    The cut-off digest of each class is found by counting, so the split itself is a filter and
    no class is ever ranked as a whole.
    """
    counts = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count("*").alias("n")).collect()}
    if None in counts:
        raise ValueError(f"{label} must not be missing when splitting by it")
    quotas = {c: q for c, q in class_quotas(counts, share).items() if q}
    digest = split_digest(F.col(key), seed)
    # 52 bits: exact as a double and fine enough that ties are rare.
    place = F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint")
    per_class = df.select(
        *[F.when(F.col(label) == F.lit(c), place).alias(f"c{i}") for i, c in enumerate(quotas)]
    )
    names = {c: f"c{i}" for i, c in enumerate(quotas)}
    profiles = profile(per_class, names.values())
    cuts = order_statistics(per_class, {names[c]: [q - 1] for c, q in quotas.items()}, profiles)
    limit = {c: int(cuts[names[c], q - 1]) for c, q in quotas.items()}
    tallies = per_class.agg(
        *[F.count_if(F.col(names[c]) < limit[c]).alias(f"below{names[c]}") for c in quotas],
        *[F.count_if(F.col(names[c]) == limit[c]).alias(f"at{names[c]}") for c in quotas],
    ).first() if quotas else None

    cut = F.lit(None).cast("bigint")
    for c in quotas:
        cut = F.when(F.col(label) == F.lit(c), F.lit(limit[c])).otherwise(cut)
    in_test = F.coalesce(place <= cut, F.lit(False))
    named = df.withColumn("split", F.when(in_test, F.lit("test")).otherwise(F.lit("train")))

    room = {c: quotas[c] - tallies[f"below{names[c]}"] for c in quotas}
    crowded = [c for c in quotas if tallies[f"at{names[c]}"] > room[c]]
    if not crowded:
        return named
    return _settle_ties(named, key, label, F.coalesce(place == cut, F.lit(False)), digest, {c: room[c] for c in crowded})


def _settle_ties(
    named: DataFrame, key: str, label: str, at_cut: Column, digest: Column, room: Mapping[int, int]
) -> DataFrame:
    """Exactly ``room`` of each crowded class's rows at the cut-off go to the test part.

    Keys that collide at the cut-off are taken in digest order. If one key's own rows straddle
    the quota, they are numbered and the first ones go to the test part.
    """
    tied = at_cut & F.col(label).isin(list(room))
    # Distinct keys whose digests agree in 52 bits: a handful at any table size.
    keys = named.where(tied).groupBy(F.col(label).alias("c"), digest.alias("d"), F.col(key).alias("k")).count()
    chosen: dict[int, list] = {c: [] for c in room}
    straddling: dict[int, tuple] = {}
    left = dict(room)
    for r in sorted(keys.collect(), key=lambda r: (r["c"], r["d"], r["k"])):
        c = r["c"]
        if r["count"] <= left[c]:
            chosen[c].append(r["k"])
            left[c] -= r["count"]
        elif left[c]:
            straddling[c] = (r["k"], left[c])
            left[c] = 0
    in_test = F.lit(False)
    for c, picked in chosen.items():
        in_test = in_test | ((F.col(label) == F.lit(c)) & F.col(key).isin(picked))
    part = F.when(tied, F.when(in_test, F.lit("test")).otherwise(F.lit("train"))).otherwise(F.col("split"))
    settled = named.withColumn("split", part)
    for c, (k, quota) in straddling.items():
        same_key = F.coalesce((F.col(label) == F.lit(c)) & (F.col(key) == F.lit(k)), F.lit(False))
        rows = numbered(settled.where(same_key).drop("split"), "split_ties")
        share = F.when(F.col("_number") < quota, F.lit("test")).otherwise(F.lit("train"))
        settled = settled.where(~same_key).unionByName(rows.withColumn("split", share).drop("_number"))
    return settled


# --- fitted parameters -----------------------------------------------------------------------


@dataclass(frozen=True)
class NumericParameters:
    feature: str
    fill: float
    mean: float
    scale: float


@dataclass(frozen=True)
class CategoryParameters:
    feature: str
    fill: float
    levels: tuple[float, ...]


@dataclass(frozen=True)
class Preprocessor:
    """Everything needed to turn raw features into model inputs."""

    numeric: tuple[NumericParameters, ...]
    categorical: tuple[CategoryParameters, ...]

    def rows(self) -> list[tuple]:
        rows = [
            ("numeric", p.feature, None, p.fill, p.mean, p.scale, f"numeric__{p.feature}") for p in self.numeric
        ]
        rows += [
            ("categorical", p.feature, level, p.fill, None, None, f"categorical__{p.feature}_{level}")
            for p in self.categorical
            for level in p.levels
        ]
        return [(i, *row) for i, row in enumerate(rows)]

    @property
    def feature_names(self) -> list[str]:
        return [row[-1] for row in self.rows()]

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows(), PARAMETER_SCHEMA)

    @classmethod
    def from_table(cls, table: DataFrame) -> "Preprocessor":
        # One row per model input.
        rows = sorted(table.collect(), key=lambda r: r["slot"])
        numeric = tuple(
            NumericParameters(r["feature"], r["fill"], r["mean"], r["scale"]) for r in rows if r["block"] == "numeric"
        )
        levels: dict[tuple[str, float], list[float]] = {}
        for r in rows:
            if r["block"] == "categorical":
                levels.setdefault((r["feature"], r["fill"]), []).append(r["level"])
        return cls(numeric, tuple(CategoryParameters(f, fill, tuple(v)) for (f, fill), v in levels.items()))


def fit_numeric(train: DataFrame, columns: Sequence[str] = NUMERIC_FEATURES) -> list[NumericParameters]:
    """Median, then mean and population deviation of the filled column; a constant scales by 1."""
    clean = nan_to_null(train.select(*columns))
    fills = {c: q[0] if q else 0.0 for c, q in exact_quantiles(clean, {c: [0.5] for c in columns}).items()}
    aggs = []
    for i, c in enumerate(columns):
        x = f"coalesce(CAST({sql.name(c)} AS DOUBLE), {sql.number(fills[c])})"
        aggs += [f"avg({x}) AS m{i}", f"stddev_pop({x}) AS s{i}"]
    row = clean.agg(*[F.expr(a) for a in aggs]).first()
    return [NumericParameters(c, fills[c], row[f"m{i}"], row[f"s{i}"] or 1.0) for i, c in enumerate(columns)]


def fit_categories(
    train: DataFrame, columns: Sequence[str] = CATEGORICAL_FEATURES, max_levels: int = MAX_LEVELS
) -> list[CategoryParameters]:
    """Mode (smallest on a tie) and sorted levels of each column.

    A column with more than ``max_levels`` levels is refused, not cut short.
    """
    counts = value_counts(nan_to_null(train.select(*columns)), columns)
    sizes = {r["column_name"]: r["count"] for r in counts.groupBy("column_name").count().collect()}
    for c, n in sizes.items():
        if n > max_levels:
            raise ValueError(f"{c} has {n} levels; one-hot encoding takes at most {max_levels}")
    found: dict[str, list[tuple[float, int]]] = {}
    for r in counts.collect():
        found.setdefault(r["column_name"], []).append((r["value"], r["n"]))
    fitted = []
    for c in columns:
        levels = sorted(found.get(c, []))
        fill = min(levels, key=lambda vn: (-vn[1], vn[0]))[0] if levels else 0.0
        fitted.append(CategoryParameters(c, fill, tuple(v for v, _ in levels)))
    return fitted


def fit_preprocessor(
    train: DataFrame,
    numeric: Sequence[str] = NUMERIC_FEATURES,
    categorical: Sequence[str] = CATEGORICAL_FEATURES,
) -> Preprocessor:
    return Preprocessor(tuple(fit_numeric(train, numeric)), tuple(fit_categories(train, categorical)))


def scaled_columns(parameters: Iterable[NumericParameters]) -> list[str]:
    """SQL text of the filled and standardised numeric features."""
    return [
        f"(coalesce(CAST({sql.name(p.feature)} AS DOUBLE), {sql.number(p.fill)}) - {sql.number(p.mean)}) "
        f"/ {sql.number(p.scale)} AS {sql.name(f'numeric__{p.feature}')}"
        for p in parameters
    ]


def onehot_columns(parameters: Iterable[CategoryParameters]) -> list[str]:
    """SQL text of one 0/1 column per training level; a level not seen in training sets none."""
    return [
        f"CAST(coalesce(CAST({sql.name(p.feature)} AS DOUBLE), {sql.number(p.fill)}) = {sql.number(level)} AS DOUBLE) "
        f"AS {sql.name(f'categorical__{p.feature}_{level}')}"
        for p in parameters
        for level in p.levels
    ]


def transform(df: DataFrame, fitted: Preprocessor, keep: Sequence[str]) -> DataFrame:
    """The kept columns, then the numeric block, then the categorical block; others are dropped."""
    kept = [sql.name(k) for k in keep]
    return nan_to_null(df).selectExpr(*kept, *scaled_columns(fitted.numeric), *onehot_columns(fitted.categorical))


def parameter_gap(
    train: DataFrame, full: DataFrame, columns: Sequence[str] = NUMERIC_FEATURES
) -> list[tuple[str, float, float, float, float, float, float]]:
    """Per numeric feature: fill, mean and scale fitted on the training part and on all rows."""
    on_train, on_all = fit_numeric(train, columns), fit_numeric(full, columns)
    return [(t.feature, t.fill, a.fill, t.mean, a.mean, t.scale, a.scale) for t, a in zip(on_train, on_all)]


def split_alignment(features: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Per split: feature rows, label rows, and rows on one side without a partner on the other.

    Both sides are counted per key instead of joined, so a repeated key cannot multiply.
    """
    x = features.select(key, "split", F.lit(1).alias("x"), F.lit(0).alias("y"))
    y = labels.select(key, "split", F.lit(0).alias("x"), F.lit(1).alias("y"))
    per_key = x.unionByName(y).groupBy("split", key).agg(F.sum("x").alias("x"), F.sum("y").alias("y"))
    return per_key.groupBy("split").agg(
        F.sum("x").alias("n_features"),
        F.sum("y").alias("n_labels"),
        F.sum(F.greatest(F.col("x") - F.col("y"), F.lit(0))).alias("features_without_label"),
        F.sum(F.greatest(F.col("y") - F.col("x"), F.lit(0))).alias("labels_without_features"),
    )
