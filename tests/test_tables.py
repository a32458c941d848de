"""The derived transaction table: equal to its definition, also when keys are badly skewed."""

import os

import duckdb
import pandas as pd
import pytest
from conftest import SMALL

from plumbline.plans.oracles import TX
from plumbline.sources import transactions as tx
from plumbline.workspace import Workspace, collect_executors, shared_root


def by_definition(folder: str) -> pd.DataFrame:
    connection = duckdb.connect()
    for table in tx.TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return connection.execute(f"WITH {TX} SELECT * FROM tx ORDER BY tx_id").df()


def same(found: pd.DataFrame, expected: pd.DataFrame) -> None:
    found = found.sort_values("tx_id").reset_index(drop=True)
    pd.testing.assert_frame_equal(
        found.drop(columns="tx_ts"), expected[found.columns].drop(columns="tx_ts"), check_dtype=False
    )
    assert (found["tx_ts"].astype("datetime64[us]") == expected["tx_ts"].astype("datetime64[us]")).all()


def test_equals_its_definition(spark):
    same(tx.transactions(spark, SMALL).toPandas(), by_definition(SMALL))


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    """A third of all orders belong to one customer, and keys are large."""
    folder = str(tmp_path_factory.mktemp("skewed"))
    shift = 3_000_000_000_000
    for table in tx.TABLES:
        frame = pd.read_parquet(f"{SMALL}/{table}.parquet")
        if table == "orders":
            frame.loc[frame.index % 3 == 0, "o_custkey"] = 7
            frame["o_orderkey"] += shift
        if table == "lineitem":
            frame["l_orderkey"] += shift
        frame.to_parquet(f"{folder}/{table}.parquet")
    return folder


def test_hot_customer_and_large_keys(spark, skewed):
    found = tx.transactions(spark, skewed).toPandas()
    same(found, by_definition(skewed))
    assert (found["customer_id"] == 7).mean() > 0.3


def test_written_once_per_input_version(spark, tmp_path):
    for table in tx.TABLES:
        pd.read_parquet(f"{SMALL}/{table}.parquet").to_parquet(f"{tmp_path}/{table}.parquet")
    first = tx.transaction_path(spark, str(tmp_path))
    assert tx.transaction_path(spark, str(tmp_path)) == first
    orders = pd.read_parquet(f"{SMALL}/orders.parquet").iloc[:500]
    orders.to_parquet(f"{tmp_path}/orders.parquet")
    os.utime(f"{tmp_path}/orders.parquet")
    second = tx.transaction_path(spark, str(tmp_path))
    assert second != first and spark.read.parquet(second).count() == 500


def test_staged_tables_lie_under_the_shared_folder(spark, shared_folder):
    assert shared_root(spark) == shared_folder
    assert Workspace.of(spark).new_path("x").startswith(shared_folder)
    assert tx.transaction_path(spark, SMALL).startswith(shared_folder)


def test_discarded_tables_are_gone(spark):
    workspace = Workspace.of(spark)
    kept, gone = workspace.stage(spark.range(5), "kept"), workspace.stage(spark.range(5), "gone")
    folder = gone.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
    workspace.discard(gone)
    workspace.release()
    assert kept.count() == 5 and not os.path.exists(folder)


def test_executors_are_collected(spark):
    """Here the executor is the driver's JVM."""
    beans = spark.sparkContext._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    before = sum(bean.getCollectionCount() for bean in beans)
    collect_executors(spark)
    assert sum(bean.getCollectionCount() for bean in beans) > before
