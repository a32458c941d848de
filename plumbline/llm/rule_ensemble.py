"""Quality classifier as a sparse rule ensemble.

Trees are grown on statistics of labelled texts; every path from a root is a rule, a conjunction
of comparisons. A lasso logistic regression over the rules keeps few of them. The rules kept are
compiled into one Spark column expression over the statistics, which is all that scoring needs.

Defined results: a null or empty text has all statistics 0 and gets the score that the rules give
those; documents with a null key are scored, are not held out and never learned from; repeated
rows are scored one by one; without labels every score is 0.5, with one label value only it is
that value's rate; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.textkit import crc32_mod, label_sample, prefer_labels
from plumbline.llm.textstats import text_counts
from plumbline.workspace import Workspace

# Statistics of a text, as expressions over its counts; a ratio over nothing is 0.
STATISTICS = {
    "words": "cast(n_words as double)",
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbols": "n_symbols / greatest(n_words, 1)",
    "capitals": "n_capitals / greatest(word_chars, 1)",
    "digits": "n_digits / greatest(word_chars, 1)",
    "dup_lines": "n_dup_lines / greatest(n_lines, 1)",
    "repeats": "n_repeat_words / greatest(n_words, 1)",
    "distinct": "n_distinct_words / greatest(n_words, 1)",
    "stops": "n_stops / greatest(n_words, 1)",
    "shouts": "n_shouts / greatest(n_words, 1)",
    "bars": "n_bars / greatest(n_words, 1)",
    "line_words": "n_words / greatest(n_lines, 1)",
}
# Bound of the labelled rows that the rules are learned from.
MAX_LABELS = 30_000
TREES, DEPTH, LASSO, SEED = 16, 3, 0.0005, 7


@dataclass
class RuleModel:
    """Rules as SQL conditions over STATISTICS, each with its weight."""

    intercept: float
    rules: list[tuple[str, float]]

    def score(self) -> Column:
        terms = [
            F.when(F.expr(condition), F.lit(weight)).otherwise(F.lit(0.0))
            for condition, weight in self.rules
        ]
        logit = F.lit(self.intercept)
        for term in terms:
            logit = logit + term
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))


def tree_rules(model, names: list[str]) -> list[str]:
    """Every path of every tree as a condition, each condition once, in order of discovery."""
    found: dict[str, None] = {}

    def walk(node, path: dict[tuple[str, str], float]) -> None:
        if path:
            condition = " AND ".join(
                f"{name} {side} {limit!r}D" for (name, side), limit in sorted(path.items())
            )
            found.setdefault(condition)
        if node.subtreeDepth() == 0:
            return
        split = node.split()
        name, limit = names[split.featureIndex()], float(split.threshold())
        # Along one path only the tightest bound of each side matters.
        left = min(limit, path.get((name, "<="), limit))
        right = max(limit, path.get((name, ">"), limit))
        walk(node.leftChild(), {**path, (name, "<="): left})
        walk(node.rightChild(), {**path, (name, ">"): right})

    for tree in model.trees:
        walk(tree._call_java("rootNode"), {})
    return list(found)


def fit_rules(train: DataFrame, lasso: float = LASSO) -> RuleModel:
    """``train`` has the columns of STATISTICS and ``_label`` (0 or 1)."""
    classes = {r["_label"]: r["n"] for r in train.groupBy("_label").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    total = sum(classes.values())
    if not total:
        return RuleModel(0.0, [])
    rate = classes.get(1, 0) / total
    if rate in (0.0, 1.0):
        return RuleModel(40.0 * (2 * rate - 1), [])
    names = list(STATISTICS)
    table = VectorAssembler(inputCols=names, outputCol="_x").transform(train)
    forest = RandomForestClassifier(
        featuresCol="_x", labelCol="_label", numTrees=TREES, maxDepth=DEPTH, maxBins=64,
        minInstancesPerNode=5, featureSubsetStrategy="0.5", seed=SEED,
    ).fit(table)
    conditions = tree_rules(forest, names)
    if not conditions:
        return RuleModel(0.0, [])
    flags = [f"_r{i}" for i in range(len(conditions))]
    wide = train.select(
        F.col("_label").cast("double").alias("_label"),
        *[F.expr(c).cast("double").alias(r) for c, r in zip(conditions, flags)],
    )
    table = VectorAssembler(inputCols=flags, outputCol="_x").transform(wide).select("_label", "_x")
    table = table.persist()
    fitted = LogisticRegression(
        featuresCol="_x", labelCol="_label", elasticNetParam=1.0, regParam=lasso,
        standardization=False, maxIter=60,
    ).fit(table)
    table.unpersist()
    weights = fitted.coefficients.toArray().tolist()
    return RuleModel(
        float(fitted.intercept), [(c, w) for c, w in zip(conditions, weights) if abs(w) > 1e-9]
    )


def _described(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``keep`` columns and STATISTICS of every row."""
    counted = text_counts(df, text, keep)
    return counted.select(*keep, *[F.expr(e).alias(name) for name, e in STATISTICS.items()])


def learn_quality(
    df: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    fold: tuple[int, int] = (5, 0),
    max_labels: int = MAX_LABELS,
) -> RuleModel:
    """Rules from at most ``max_labels`` labelled texts; rows whose crc32(key) modulo ``fold[0]``
    is ``fold[1]`` are never learned from."""
    known = prefer_labels(labels, key, label)
    sample = label_sample(known, "_key", crc32_mod("_key", fold[0]) == fold[1], max_labels)
    texts = df.select(df[f"`{key}`"].alias("_id"), df[f"`{text}`"].alias("_text"))
    # Broadcast by hint: the sample is bounded by max_labels. Only its texts are described here.
    chosen = texts.join(F.broadcast(sample), F.col("_id") == F.col("_key"))
    train = _described(chosen, "_text", ["_label"])
    return fit_rules(Workspace.of(df.sparkSession).stage(train, "quality-train"))


def quality_scores(
    df: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    fold: tuple[int, int] = (5, 0),
    threshold: float = 0.3,
    **options,
) -> DataFrame:
    """key, held_out, score and predicted of every row, in one pass over the texts."""
    model = learn_quality(df, labels, key, text, fold=fold, **options)
    held_out = F.coalesce(crc32_mod(key, fold[0]) == fold[1], F.lit(False))
    scored = _described(df, text, [key]).select(
        key, held_out.alias("held_out"), model.score().alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def accepted(
    df: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    threshold: float = 0.3,
    **options,
) -> DataFrame:
    """The rows of ``df`` that the rules do not reject, with all their columns."""
    model = learn_quality(df, labels, key, text, **options)
    plain = [f"c{i}" for i in range(len(df.columns))]
    body = plain[df.columns.index(text)]
    described = _described(df.toDF(*plain), body, plain)
    return described.where(model.score() >= threshold).select(*plain).toDF(*df.columns)
