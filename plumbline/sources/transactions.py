"""The labelled transaction table, derived from orders, customer and lineitem.

One row per order. Which cells are missing, and which rows are positive, follows from integer
arithmetic on the order key, so every engine derives the same table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.contract import FRAUD_CONTRACT, FRAUD_POLICIES
from plumbline.workspace import Workspace, input_version

# Multiplier, increment and missing share (per mille) of each column's mask.
MASKS = {
    "transaction_amount": (2654435761, 11, 80),
    "hour_of_day": (2246822519, 23, 50),
    "is_weekend": (3266489917, 37, 20),
    "num_items": (668265263, 41, 30),
    "customer_age": (374761393, 53, 120),
    "prev_transactions": (1597334677, 67, 70),
    "distance_from_home": (3812015801, 71, 100),
    "device_type": (958282541, 83, 40),
    "network_quality": (2891336453, 97, 90),
    "is_first_transaction": (1103515245, 101, 30),
    "store_type": (1664525, 113, 20),
    "velocity_score": (69069, 127, 150),
}
LABEL_MASK = (134775813, 139)
LABEL_SHARE = 103
SIGNAL_AMOUNT = 400000
SIGNAL_SHARES = (300, 55)

KEY_COLUMNS = ("tx_id", "customer_id", "tx_ts")
TABLES = ("orders", "customer", "lineitem")

# Corruptions that break one rule each; the text is valid in Spark SQL and in other engines.
DIRTY_CELLS = {
    "transaction_amount": "CASE WHEN tx_id % 1000 = 1 THEN -transaction_amount - 1 ELSE transaction_amount END",
    "num_items": "CASE WHEN tx_id % 1000 = 2 THEN -num_items - 1 ELSE num_items END",
    "customer_age": "CASE WHEN tx_id % 1000 = 3 THEN 200 + tx_id % 7 ELSE customer_age END",
    "prev_transactions": "CASE WHEN tx_id % 1000 = 4 THEN -prev_transactions - 1 ELSE prev_transactions END",
    "distance_from_home": "CASE WHEN tx_id % 1000 = 5 THEN -distance_from_home - 1 ELSE distance_from_home END",
    "network_quality": "CASE WHEN tx_id % 1000 = 6 THEN 150 ELSE network_quality END",
    "hour_of_day": "CASE WHEN tx_id % 1000 = 7 THEN 9 WHEN tx_id % 1000 = 17 THEN 24 ELSE hour_of_day END",
    "device_type": "CASE WHEN tx_id % 1000 = 8 THEN 5 ELSE device_type END",
    "store_type": "CASE WHEN tx_id % 1000 = 9 THEN 7 ELSE store_type END",
    "is_weekend": "CASE WHEN tx_id % 1000 = 10 THEN 2 ELSE is_weekend END",
    "is_first_transaction": "CASE WHEN tx_id % 1000 = 11 THEN 2 ELSE is_first_transaction END",
    "is_fraud": "CASE WHEN tx_id % 1000 = 12 THEN 2 WHEN tx_id % 1000 = 13 THEN NULL ELSE is_fraud END",
}
REPEATED_ROWS = "tx_id % 500 = 0"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _mask(multiplier: int, increment: int) -> str:
    """((k * m + a) mod 2^32) >> 16, mod 1000, without overflowing for large keys."""
    word = "pmod(k, 4294967296)"
    return (
        f"((({word} % 65536) * {multiplier} + ((({word} div 65536) * {multiplier}) % 65536) * 65536"
        f" + {increment}) % 4294967296) div 65536 % 1000"
    )


def _previous_orders(orders: DataFrame) -> DataFrame:
    """Orders with the number of earlier orders of the same customer.

    Counting per (customer, day) first keeps every window small: a customer with a third of all
    orders is spread over its days, and the per-customer window only sees one row per day.
    """
    undated = F.lit("9999-12-31").cast("date")
    dated = orders.withColumn("day", F.coalesce(F.to_date("tx_ts"), undated))
    by_day = dated.groupBy("ck", "day").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("ck").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    before = by_day.select("ck", "day", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("ck", "day").orderBy(F.asc_nulls_last("tx_ts"), "k")
    return (
        dated.join(before, ["ck", "day"])
        .withColumn("prev", F.col("before") + F.row_number().over(within) - 1)
        .drop("day", "before")
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transaction table as a lazy DataFrame."""
    orders = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"),
        F.col("o_custkey").alias("ck"),
        F.col("o_orderdate").alias("tx_ts"),
        F.col("o_totalprice").alias("amt"),
        F.col("o_orderstatus").alias("st"),
    )
    customers = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("ck"), F.col("c_acctbal").alias("bal")
    )
    items = (
        read_table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("k"))
        .agg(F.count("*").alias("n_items"), F.sum("l_quantity").alias("qty"))
    )
    base = _previous_orders(orders).join(customers, "ck").join(items, "k", "left")

    values = {
        "transaction_amount": "amt",
        "hour_of_day": "1 + floor((month(tx_ts) - 1) / 4)",
        "is_weekend": "if(day(tx_ts) % 7 IN (0, 6), 1, 0)",
        "num_items": "coalesce(n_items, 0)",
        "customer_age": "18 + ck % 63",
        "prev_transactions": "prev",
        "distance_from_home": "abs(bal)",
        "device_type": "CASE st WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END",
        "network_quality": "(k * 31 + ck * 17) % 101",
        "is_first_transaction": "if(prev = 0, 1, 0)",
        "store_type": "ck % 2",
        "velocity_score": "coalesce(qty, 0) / 10",
    }
    label = _mask(*LABEL_MASK)
    share = f"if(amt > {SIGNAL_AMOUNT}, {SIGNAL_SHARES[0]}, {SIGNAL_SHARES[1]})"
    return base.selectExpr(
        "k AS tx_id",
        "ck AS customer_id",
        "tx_ts",
        *[
            f"if({_mask(m, a)} >= {share_missing}, CAST({values[c]} AS DOUBLE), NULL) AS {c}"
            for c, (m, a, share_missing) in MASKS.items()
        ],
        f"if({label} < {LABEL_SHARE}, 1, 0) AS is_fraud",
        f"if({label} < {share}, 1, 0) AS is_fraud_signal",
    )


def source_version(spark: SparkSession, sf_dir: str, tables: tuple[str, ...] = TABLES) -> str:
    return input_version(spark, [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in tables])


def transaction_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transaction table written once per application and input version, then re-read.

    The joins and the window run once; every later check is a pruned Parquet scan.
    """
    return spark.read.parquet(transaction_path(spark, sf_dir))


def transaction_path(spark: SparkSession, sf_dir: str) -> str:
    workspace = Workspace.of(spark)

    def build() -> str:
        path = workspace.new_path("transactions")
        transactions(spark, sf_dir).write.parquet(path)
        return path

    return workspace.once(("transactions", sf_dir, source_version(spark, sf_dir)), build)


def contract_columns(df: DataFrame, *extra: str) -> DataFrame:
    """Only the contract's columns (and the named extra ones), in contract order."""
    return df.select(*extra, *FRAUD_CONTRACT.names)


def dirty(df: DataFrame) -> DataFrame:
    """The table with cells that break each range, membership and label rule."""
    types = dict(df.dtypes)
    return df.selectExpr(
        *[f"CAST({DIRTY_CELLS[c]} AS {types[c]}) AS {c}" if c in DIRTY_CELLS else c for c in df.columns]
    )


def with_repeated_rows(df: DataFrame) -> DataFrame:
    """The table followed by second copies of some of its rows."""
    return df.unionByName(df.where(REPEATED_ROWS))


def with_breached_ceilings(df: DataFrame) -> DataFrame:
    """The table with every policy column pushed 15 points past its ceiling."""
    limits = {p.column: round(100 * (p.ceiling + 0.15)) for p in FRAUD_POLICIES}
    return df.selectExpr(
        *[f"if(tx_id % 100 >= {limits[c]}, {c}, NULL) AS {c}" if c in limits else c for c in df.columns]
    )
