"""Exact evaluation of a binary classifier on a scored table.

Expects a 0/1 label, a 0/1 prediction where hard metrics are asked for, and a score where
ranking metrics are. Ranking metrics first count labels per distinct score, so ties are one row,
and then accumulate over slices of the score order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.columns import ratio
from plumbline.operators.ordering import running_totals


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    y, p = F.col(label) == 1, F.col(prediction) == 1
    return df.agg(
        F.count_if(y & p).alias("tp"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
        F.count_if(~y & ~p).alias("tn"),
    )


def _or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def binary_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Accuracy, and precision, recall and F1 of the positive class; 0 where undefined."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return confusion(df, label, prediction).select(
        tp, fp, fn, tn,
        ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        _or_zero(ratio(tp, tp + fp)).alias("precision"),
        _or_zero(ratio(tp, tp + fn)).alias("recall"),
        _or_zero(ratio(2 * tp, 2 * tp + fp + fn)).alias("f1"),
    )


def weighted_f1(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """F1 averaged over both classes by support, next to the positive-class F1 it can hide."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    positive = _or_zero(ratio(2 * tp, 2 * tp + fp + fn))
    negative = _or_zero(ratio(2 * tn, 2 * tn + fp + fn))
    return confusion(df, label, prediction).select(
        positive.alias("f1_positive"),
        negative.alias("f1_negative"),
        ratio(positive * (tp + fn) + negative * (tn + fp), tp + fp + fn + tn).alias("f1_weighted"),
    )


def _by_score(df: DataFrame, label: str, score: str, name: str) -> DataFrame:
    """Per distinct score, from high to low: its positives and negatives and those seen so far."""
    counts = (
        df.where(F.col(score).isNotNull())
        .groupBy(F.col(score).cast("double").alias("score"))
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    )
    return running_totals(counts, [F.desc("score")], {"tp": "pos", "fp": "neg"}, name)


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Probability that a positive outranks a negative, ties counting half; null for one class."""
    ranked = _by_score(df, label, score, "roc_auc")
    won = F.col("neg").cast("double") * (F.col("tp") - F.col("pos") / 2)
    return ranked.agg(
        F.sum("pos").alias("n_positive"),
        F.sum("neg").alias("n_negative"),
        F.try_divide(F.sum(won), F.sum("pos").cast("double") * F.sum("neg")).alias("roc_auc"),
    )


def average_precision(df: DataFrame, label: str, score: str) -> DataFrame:
    """Precision summed over recall steps, one step per distinct score."""
    ranked = _by_score(df, label, score, "average_precision")
    step = F.col("pos").cast("double") * ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    return ranked.agg(
        F.sum("pos").alias("n_positive"),
        F.try_divide(F.sum(step), F.sum("pos").cast("double")).alias("average_precision"),
    )


def ranking_metrics(df: DataFrame, label: str, score: str) -> DataFrame:
    """ROC-AUC and average precision from the same pass over the score order."""
    ranked = _by_score(df, label, score, "ranking")
    won = F.col("neg").cast("double") * (F.col("tp") - F.col("pos") / 2)
    step = F.col("pos").cast("double") * ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    positives, negatives = F.sum("pos").cast("double"), F.sum("neg").cast("double")
    return ranked.agg(
        F.try_divide(F.sum(won), positives * negatives).alias("roc_auc"),
        F.try_divide(F.sum(step), positives).alias("pr_auc"),
    )


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight of each class: n / (classes * n_class)."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n"))
    # One row per class is left, so a window over all of them is small.
    every = Window.partitionBy()
    total, classes = F.sum("n").over(every), F.count("*").over(every)
    return counts.select("label", "n", ratio(total, classes * F.col("n")).alias("weight"))


def target_contract(df: DataFrame, label: str) -> DataFrame:
    """Label rows, missing labels and labels other than 0 and 1."""
    y = F.col(label)
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count_if(y.isNull()).alias("n_missing"),
        F.count_if(F.coalesce(~y.isin(0, 1), F.lit(False))).alias("n_invalid"),
    ).withColumn("passed", (F.col("n_missing") == 0) & (F.col("n_invalid") == 0))
