import pytest
from conftest import to_spark, valid_pandas
from pyspark.sql import functions as F

from plumbline.contract import FRAUD_CONTRACT
from plumbline.operators.fingerprint import portable_fingerprint
from plumbline.plans.catalog import KEY, contract_cells


@pytest.fixture(scope="module")
def table(spark):
    frame = valid_pandas().fillna(0.0)
    frame.insert(0, KEY, range(len(frame)))
    return to_spark(spark, frame)


@pytest.mark.parametrize("column", FRAUD_CONTRACT.names)
def test_a_change_in_any_column_changes_the_fingerprint(table, column):
    before = portable_fingerprint(table, contract_cells()).first()
    step = F.lit(1) if column == "is_fraud" else F.lit(1e-9)
    for other in (F.col(column) + step, F.lit(None).cast("double")):
        changed = table.withColumn(column, other)
        assert portable_fingerprint(changed, contract_cells()).first() != before
