import os
import sys

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from plumbline.contract import FRAUD_CONTRACT, FRAUD_POLICIES  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def shared_folder(tmp_path_factory):
    return str(tmp_path_factory.mktemp("shared"))


@pytest.fixture(scope="session")
def spark(shared_folder):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", shared_folder)
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def valid_pandas(n: int = 200, rates: dict | None = None) -> pd.DataFrame:
    """A table that satisfies the contract, each column missing at its validated rate."""
    i = np.arange(n)
    frame = pd.DataFrame(
        {
            "transaction_amount": np.linspace(10, 200, n),
            "hour_of_day": i % 3 + 1.0,
            "is_weekend": i % 2 * 1.0,
            "num_items": i % 10 * 1.0,
            "customer_age": np.linspace(18, 80, n),
            "prev_transactions": i % 20 * 1.0,
            "distance_from_home": np.linspace(0, 100, n),
            "device_type": i % 3 * 1.0,
            "network_quality": np.linspace(1, 99, n),
            "is_first_transaction": i % 2 * 1.0,
            "store_type": i // 2 % 2 * 1.0,
            "velocity_score": np.linspace(1, 10, n),
            "is_fraud": (i % 10 == 3).astype("int64"),
        }
    )
    for j, policy in enumerate(FRAUD_POLICIES):
        rate = (rates or {}).get(policy.column, policy.validated_rate)
        # Staggered, so that no two rows lose the same cells.
        frame.loc[(np.arange(int(n * rate)) + j * n // 12) % n, policy.column] = np.nan
    return frame[FRAUD_CONTRACT.names]


def to_spark(spark, frame: pd.DataFrame):
    """Through Arrow, so NaN stays NaN where the column is floating point."""
    return spark.createDataFrame(frame)


def by_rule(results) -> dict:
    return {r["rule_name"]: r for r in results.collect()}
