"""What a table must look like: column types, bounds, value sets, and missing-value policies.

Everything specific to the fraud table is declared here; the operators only see the objects.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class ColumnSpec:
    """One contract column. Bounds and value sets only apply to present values."""

    name: str
    logical_type: str  # "integer", "float" or "string"
    nullable: bool = True
    minimum: float | None = None
    maximum: float | None = None
    allowed: tuple[float, ...] | None = None
    rule_name: str | None = None


@dataclass(frozen=True)
class TableContract:
    columns: tuple[ColumnSpec, ...]
    label: str
    min_rows: int = 100

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def column(self, name: str) -> ColumnSpec:
        for spec in self.columns:
            if spec.name == name:
                return spec
        raise KeyError(name)


@dataclass(frozen=True)
class FillPolicy:
    """How one column's missing values are filled, and up to which missing rate."""

    column: str
    strategy: str  # "median" or "mode"
    ceiling: float
    validated_rate: float

    @property
    def indicator(self) -> str:
        return f"{self.column}_was_missing"

    @property
    def guard_name(self) -> str:
        return f"{self.column}_missing_rate_within_ceiling"


LOGICAL_TYPES: dict[str, tuple[type[T.DataType], ...]] = {
    "integer": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "float": (T.FloatType, T.DoubleType),
    "string": (T.StringType,),
}

SQL_TYPES = {"integer": "bigint", "float": "double", "string": "string"}

# The 13 contract columns, their types, bounds and value sets, in table order.
FRAUD_CONTRACT = TableContract(
    label="is_fraud",
    columns=(
        ColumnSpec("transaction_amount", "float", minimum=0, rule_name="transaction_amount_non_negative"),
        ColumnSpec("hour_of_day", "float", allowed=(1.0, 2.0, 3.0), rule_name="hour_of_day_valid"),
        ColumnSpec("is_weekend", "float", allowed=(0.0, 1.0), rule_name="is_weekend_valid"),
        ColumnSpec("num_items", "float", minimum=0, rule_name="num_items_non_negative"),
        ColumnSpec("customer_age", "float", minimum=0, maximum=120, rule_name="customer_age_valid"),
        ColumnSpec("prev_transactions", "float", minimum=0, rule_name="prev_transactions_non_negative"),
        ColumnSpec("distance_from_home", "float", minimum=0, rule_name="distance_from_home_non_negative"),
        ColumnSpec("device_type", "float", allowed=(0.0, 1.0, 2.0), rule_name="device_type_valid"),
        ColumnSpec("network_quality", "float", minimum=0, maximum=100, rule_name="network_quality_valid"),
        ColumnSpec("is_first_transaction", "float", allowed=(0.0, 1.0), rule_name="is_first_transaction_valid"),
        ColumnSpec("store_type", "float", allowed=(0.0, 1.0), rule_name="store_type_valid"),
        ColumnSpec("velocity_score", "float"),
        ColumnSpec("is_fraud", "integer", nullable=False, allowed=(0.0, 1.0), rule_name="is_fraud_binary"),
    ),
)

# Order in which the range and membership rules are reported.
FEATURE_RULE_ORDER = (
    "transaction_amount",
    "num_items",
    "prev_transactions",
    "distance_from_home",
    "customer_age",
    "network_quality",
    "hour_of_day",
    "device_type",
    "store_type",
    "is_weekend",
    "is_first_transaction",
    "is_fraud",
)

# Strategy, ceiling and validated rate per column; the order fixes report and
# indicator-column order.
FRAUD_POLICIES = (
    FillPolicy("velocity_score", "median", 0.30, 0.15),
    FillPolicy("customer_age", "median", 0.25, 0.12),
    FillPolicy("distance_from_home", "median", 0.20, 0.10),
    FillPolicy("network_quality", "median", 0.20, 0.09),
    FillPolicy("transaction_amount", "median", 0.20, 0.08),
    FillPolicy("prev_transactions", "median", 0.15, 0.07),
    FillPolicy("num_items", "median", 0.10, 0.03),
    FillPolicy("hour_of_day", "mode", 0.10, 0.05),
    FillPolicy("device_type", "mode", 0.10, 0.04),
    FillPolicy("is_first_transaction", "mode", 0.10, 0.03),
    FillPolicy("is_weekend", "mode", 0.05, 0.02),
    FillPolicy("store_type", "mode", 0.05, 0.02),
)

# Column roles.
NUMERIC_FEATURES = (
    "transaction_amount",
    "num_items",
    "customer_age",
    "prev_transactions",
    "distance_from_home",
    "network_quality",
    "velocity_score",
)
CATEGORICAL_FEATURES = (
    "hour_of_day",
    "is_weekend",
    "device_type",
    "is_first_transaction",
    "store_type",
)
CATEGORICAL_DRIVERS = (
    "is_first_transaction",
    "device_type",
    "store_type",
    "is_weekend",
    "hour_of_day",
)
CONTINUOUS_DRIVERS = (
    "transaction_amount",
    "network_quality",
    "prev_transactions",
    "customer_age",
    "distance_from_home",
    "velocity_score",
)
TEST_SHARE = 0.2
SEED = 42

# Flag thresholds of the missingness and signal checks.
P_VALUE_FLAG = 0.05
MISSING_SPREAD_FLAG = 0.05
MISSING_CORRELATION_FLAG = 0.1
CORRELATION_FLAG = 0.10
MUTUAL_INFORMATION_FLAG = 0.01
LABEL_SPREAD_FLAG = 0.08


def policy_for(column: str, policies: tuple[FillPolicy, ...] = FRAUD_POLICIES) -> FillPolicy:
    for policy in policies:
        if policy.column == column:
            return policy
    raise KeyError(column)
