"""Score tables with stored parameters and a fitted forest, after checking each request."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructType

from plumbline.contract import CATEGORICAL_FEATURES, FRAUD_CONTRACT, NUMERIC_FEATURES
from plumbline.functions import sqltext as sql
from plumbline.functions.columns import nan_to_null
from plumbline.operators.features import Preprocessor, transform
from plumbline.operators.forest import flat_trees, votes_of
from plumbline.operators.rules import RuleBook, range_rule, with_violations

REQUEST_FIELDS = NUMERIC_FEATURES + CATEGORICAL_FEATURES
THRESHOLD = 0.5


def request_rules() -> RuleBook:
    """Bounds of the numeric request fields; category codes are not bounded in a request."""
    book = RuleBook(FRAUD_CONTRACT)
    for name in NUMERIC_FEATURES:
        spec = FRAUD_CONTRACT.column(name)
        if spec.minimum is not None:
            book.register(range_rule(spec))
    return book


def check_requests(df: DataFrame) -> DataFrame:
    """Every request with the rules it breaks; all twelve fields must be present."""
    return with_violations(nan_to_null(df), request_rules(), REQUEST_FIELDS)


def accepted(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("violations") == 0)


def feature_vector(names: Sequence[str]) -> Column:
    return array_to_vector(F.expr(f"array({', '.join(sql.name(n) for n in names)})"))


def with_features(processed: DataFrame, names: Sequence[str], keep: Sequence[str]) -> DataFrame:
    return processed.select(*keep, feature_vector(names).alias("features"))


def predict(model: RandomForestClassificationModel, vectors: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Class-1 probability, the forest's own decision, and the served decision (p >= 0.5): what the
    model's ``transform`` gives, with whole batches led through a tree at a time."""
    served = (F.col("fraud_probability") >= THRESHOLD).cast("int").alias("is_fraud_prediction")
    if model.numClasses < 2 or model.isSet(model.thresholds):
        probability = vector_to_array("probability")[1].alias("fraud_probability")
        hard = F.col("prediction").cast("int").alias("hard_prediction")
        return model.transform(vectors).select(*keep, probability, hard).select("*", served)
    flat = flat_trees(vectors.sparkSession, model)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, features = batch.columns[:-1], batch.columns[-1]
            votes = votes_of(flat, features.flatten().to_numpy(zero_copy_only=False), len(batch))
            total = np.zeros(len(batch))
            for of_class in votes:
                total = total + of_class
            probability = votes[1] / np.where(total != 0, total, 1.0)
            hard = np.argmax(votes, axis=0).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*kept, pa.array(probability), pa.array(hard)], names=names)

    rows = vectors.select(*keep, vector_to_array("features").alias("features"))
    schema = StructType([*rows.schema.fields[:-1]]).add("fraud_probability", DoubleType()).add("hard_prediction", IntegerType())
    names = schema.names
    return rows.mapInArrow(vote, schema).select("*", served)


def score(
    requests: DataFrame, fitted: Preprocessor, model: RandomForestClassificationModel, keep: Sequence[str]
) -> DataFrame:
    """Accepted requests with their probability. The same call works on a stream."""
    ready = transform(accepted(check_requests(requests)), fitted, keep)
    return predict(model, with_features(ready, fitted.feature_names, keep), keep)
