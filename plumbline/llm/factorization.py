"""Toxicity by a factorization machine over hashed terms.

A text is the set of its words and word stems, each hashed into one of 2^bits buckets. Buckets whose presence
depends on the label (chi-square over the labelled sample, counted by Spark) become features. The
machine learns a weight per feature and a vector per feature whose products weigh pairs, so two
words that are harmless apart can be toxic together.

Defined results: null or empty text has no features and gets the base score; a null key is not
held out and never learned from; repeated rows are scored one by one; without labels every score
is 0.5, with one label value the base rate (within 0.1 percent); extra columns are ignored.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.textkit import (
    ALPHANUMERIC,
    Texts,
    crc32_mod,
    label_sample,
    lists,
    map_texts,
    mix,
    prefer_labels,
)
from plumbline.workspace import Workspace

BITS = 20
# Word beginnings of so many bytes are terms too: they stand for all endings of a stem.
STEMS = (4, 5, 6, 7, 8, 9, 10)
# Bounds of what is learned from and of the model.
MAX_LABELS, MAX_FEATURES = 20_000, 2_048
MIN_CHI2, MIN_DOCS = 8.0, 4
FACTORS, EPOCHS, BATCH, RATE, DECAY, SEED = 6, 30, 256, 0.02, 1e-3, 11


def buckets_of(texts: Texts, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, bucket) of every word and of the stems of longer words."""
    words = texts.words(ALPHANUMERIC, lower=True)
    owners, hashes = [words.text_of], [words.hashes]
    for size in STEMS:
        longer = words.ends - words.starts > size
        begins = words.starts[longer]
        owners.append(words.text_of[longer])
        hashes.append(texts.span_hash(words.data, begins, begins + size) ^ np.uint64(size))
    return np.concatenate(owners), (mix(np.concatenate(hashes)) >> np.uint64(64 - bits)).astype(
        np.int64
    )


def hashed_terms(texts: Texts, bits: int = BITS) -> dict[str, pa.Array]:
    owner, bucket = buckets_of(texts, bits)
    pairs = np.unique((owner << bits) | bucket)
    bounds = np.searchsorted(pairs >> bits, np.arange(texts.n + 1))
    return {"terms": lists(pairs & ((1 << bits) - 1), bounds, pa.int32())}


@dataclass
class FactorModel:
    """Features by bucket, their weights and vectors."""

    bits: int
    base: float
    buckets: np.ndarray
    weights: np.ndarray
    vectors: np.ndarray

    def logits(self, owner: np.ndarray, feature: np.ndarray, n: int) -> np.ndarray:
        """Logit per text from (text number, feature) pairs, each pair once."""
        out = np.full(n, self.base)
        out += np.bincount(owner, weights=self.weights[feature], minlength=n)
        for factor in self.vectors.T:
            values = factor[feature]
            total = np.bincount(owner, weights=values, minlength=n)
            out += 0.5 * (total**2 - np.bincount(owner, weights=values**2, minlength=n))
        return out

    def score(self, texts: Texts) -> dict[str, pa.Array]:
        owner, bucket = buckets_of(texts, self.bits)
        place = np.full(1 << self.bits, -1, dtype=np.int64)
        place[self.buckets] = np.arange(len(self.buckets))
        feature = place[bucket]
        known = feature >= 0
        size = max(len(self.buckets), 1)
        pairs = np.unique(owner[known] * size + feature[known])
        logits = self.logits(pairs // size, pairs % size, texts.n)
        return {"score": pa.array(1 / (1 + np.exp(-np.clip(logits, -40, 40))))}


def fit_factors(rows: list[tuple[int, list[int]]], buckets: np.ndarray, bits: int) -> FactorModel:
    """Adam over small batches of (label, buckets present); bounded by MAX_LABELS rows and
    MAX_FEATURES features, and the same for the same rows."""
    n, size = len(rows), len(buckets)
    labels = np.array([label for label, _ in rows], dtype=np.float64)
    rate = min(max(labels.mean(), 1e-3), 1 - 1e-3) if n else 0.5
    random = np.random.default_rng(SEED)
    model = FactorModel(
        bits, float(np.log(rate / (1 - rate))), buckets, np.zeros(size),
        random.normal(0, 0.05, (size, FACTORS)),
    )
    if not size or not n:
        return model
    place = {int(b): i for i, b in enumerate(buckets)}
    present = [np.array([place[b] for b in terms if b in place], dtype=np.int64) for _, terms in rows]
    state = [np.array([model.base]), model.weights, model.vectors]
    moments = [[np.zeros_like(s), np.zeros_like(s)] for s in state]
    step = 0
    for _ in range(EPOCHS):
        order = random.permutation(n)
        for first in range(0, n, BATCH):
            part = order[first : first + BATCH]
            x = np.zeros((len(part), size))
            for row, number in enumerate(part):
                x[row, present[number]] = 1.0
            base, weights, vectors = state
            total = x @ vectors
            logit = base + x @ weights + 0.5 * (total**2 - x @ vectors**2).sum(axis=1)
            error = (1 / (1 + np.exp(-np.clip(logit, -40, 40))) - labels[part]) / len(part)
            pull = x.T @ (error[:, None] * total) - (error @ x)[:, None] * vectors
            slopes = [
                np.array([error.sum()]),
                error @ x + DECAY * weights,
                pull + DECAY * vectors,
            ]
            step += 1
            for value, slope, (mean, square) in zip(state, slopes, moments):
                mean += 0.1 * (slope - mean)
                square += 0.001 * (slope**2 - square)
                value -= RATE * (mean / (1 - 0.9**step)) / (
                    np.sqrt(square / (1 - 0.999**step)) + 1e-8
                )
    model.base, model.weights, model.vectors = float(state[0][0]), state[1], state[2]
    return model


def dependent_buckets(train: DataFrame) -> list[int]:
    """Buckets whose presence depends on the label, strongest first, MAX_FEATURES at most."""
    sums = train.agg(F.count(F.lit(1)).alias("n"), F.sum("_label").alias("ones")).first()
    n, ones = sums["n"], sums["ones"] or 0
    if not n or ones in (0, n):
        return []
    seen = train.select("_label", F.explode("terms").alias("bucket")).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("docs"), F.sum("_label").alias("hits")
    )
    seen = seen.where(F.col("docs") >= MIN_DOCS).withColumn(
        "chi2",
        F.expr(
            f"pow(hits * {n}D - docs * {ones}D, 2) * {n}D"
            f" / (docs * greatest({n}D - docs, 1D) * {ones}D * ({n}D - {ones}D))"
        ),
    )
    best = seen.where(F.col("chi2") >= MIN_CHI2).orderBy(F.desc("chi2"), "bucket")
    return [r["bucket"] for r in best.limit(MAX_FEATURES).collect()]


def toxicity_scores(
    df: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    fold: tuple[int, int] = (4, 2),
    threshold: float = 0.3,
    max_labels: int = MAX_LABELS,
) -> DataFrame:
    """Score of every row. Rows whose crc32(key) modulo ``fold[0]`` is ``fold[1]`` are held out
    from learning."""
    spark = df.sparkSession
    known = prefer_labels(labels, key, label)
    sample = label_sample(known, "_key", crc32_mod("_key", fold[0]) == fold[1], max_labels)
    # Broadcast by hint: the sample is bounded by max_labels. Only its texts are looked at here.
    chosen = df.select(df[f"`{key}`"].alias("_id"), df[f"`{text}`"].alias("_text")).join(
        F.broadcast(sample), F.col("_id") == F.col("_key")
    )
    train = map_texts(chosen, "_text", ["_label"], "terms array<int>", hashed_terms)
    train = Workspace.of(spark).stage(train, "toxicity-train")
    buckets = np.array(sorted(dependent_buckets(train)), dtype=np.int64)
    wanted = F.array(*[F.lit(int(b)) for b in buckets]) if len(buckets) else F.lit(None)
    known_terms = F.array_intersect("terms", wanted) if len(buckets) else F.array().cast("array<int>")
    rows = [
        (r["_label"], r["terms"])
        for r in train.select("_label", known_terms.alias("terms")).collect()
    ]
    rows.sort()
    model = fit_factors(rows, buckets, BITS)
    shared = spark.sparkContext.broadcast(cloudpickle.dumps(model))
    cache: dict[str, FactorModel] = {}

    def score(texts: Texts) -> dict[str, pa.Array]:
        if "model" not in cache:
            cache["model"] = pickle.loads(shared.value)
        return cache["model"].score(texts)

    scored = map_texts(df, text, [key], "score double", score)
    held_out = F.coalesce(crc32_mod(key, fold[0]) == fold[1], F.lit(False))
    return scored.select(
        key, held_out.alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
