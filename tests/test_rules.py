import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from conftest import by_rule, to_spark, valid_pandas

from plumbline.contract import FRAUD_CONTRACT, FRAUD_POLICIES
from plumbline.operators import expectations, rules
from plumbline.plans.validation import core_results


def results(spark, frame, **kw):
    return by_rule(rules.rule_results(to_spark(spark, frame), rules.rule_book(), **kw))


def test_valid_table_passes_all_thirty_rules_in_order(spark):
    found = rules.rule_results(to_spark(spark, valid_pandas()), rules.rule_book()).orderBy("position").collect()
    assert len(found) == 30
    assert all(r["passed"] and r["errors"] == [] for r in found)
    names = [r["rule_name"] for r in found]
    assert names[:5] == ["required_columns", "datatypes", "no_unexpected_columns", "target_not_null", "minimum_size"]
    assert names[5:17] == [p.guard_name for p in FRAUD_POLICIES]
    assert names[-2:] == ["is_fraud_binary", "no_duplicate_rows"]


@pytest.mark.parametrize(
    "column,value,rule",
    [
        ("transaction_amount", -1.0, "transaction_amount_non_negative"),
        ("num_items", -1.0, "num_items_non_negative"),
        ("prev_transactions", -0.5, "prev_transactions_non_negative"),
        ("distance_from_home", -3.0, "distance_from_home_non_negative"),
        ("customer_age", 121.0, "customer_age_valid"),
        ("customer_age", -1.0, "customer_age_valid"),
        ("network_quality", 100.5, "network_quality_valid"),
        ("hour_of_day", 0.0, "hour_of_day_valid"),
        ("device_type", 3.0, "device_type_valid"),
        ("store_type", 2.0, "store_type_valid"),
        ("is_weekend", 0.5, "is_weekend_valid"),
        ("is_first_transaction", 2.0, "is_first_transaction_valid"),
        ("is_fraud", 2, "is_fraud_binary"),
    ],
)
def test_one_bad_cell_fails_exactly_its_rule(spark, column, value, rule):
    frame = valid_pandas()
    frame.loc[150, column] = value
    found = results(spark, frame)
    assert [n for n, r in found.items() if not r["passed"]] == [rule]
    assert found[rule]["n_invalid"] == 1 and len(found[rule]["errors"]) == 1


@pytest.mark.parametrize("policy", FRAUD_POLICIES, ids=lambda p: p.column)
def test_missing_rate_above_ceiling_fails_its_guard(spark, policy):
    found = results(spark, valid_pandas(rates={policy.column: policy.ceiling + 0.2}))
    assert [n for n, r in found.items() if not r["passed"]] == [policy.guard_name]


def test_missing_rate_at_the_ceiling_passes(spark):
    found = results(spark, valid_pandas(200, {p.column: p.ceiling for p in FRAUD_POLICIES}))
    assert all(found[p.guard_name]["passed"] for p in FRAUD_POLICIES)


def test_schema_failure_returns_only_the_schema_rules(spark):
    frame = valid_pandas().drop(columns="network_quality").assign(extra=1.0, store_type="a")
    found = results(spark, frame)
    assert list(found) == ["required_columns", "datatypes", "no_unexpected_columns"]
    assert found["required_columns"]["errors"] == ["required column network_quality is missing"]
    assert found["datatypes"]["errors"] == ["column store_type should be float but is string"]
    assert found["no_unexpected_columns"]["errors"] == ["column extra is not in the contract"]


def test_integer_feature_needs_the_lenient_flag(spark):
    frame = valid_pandas(rates={"num_items": 0.0}).astype({"num_items": "int64"})
    assert not results(spark, frame)["datatypes"]["passed"]
    assert results(spark, frame, integers_as_floats=True)["datatypes"]["passed"]


def test_nan_is_missing_not_a_large_value(spark):
    schema = ", ".join(f"{c.name} {'bigint' if c.logical_type == 'integer' else 'double'}" for c in FRAUD_CONTRACT.columns)
    rows = valid_pandas().astype(object).values.tolist()
    nans = spark.createDataFrame([tuple(float("nan") if v != v else v for v in r) for r in rows], schema)
    nulls = spark.createDataFrame([tuple(None if v != v else v for v in r) for r in rows], schema)
    assert nans.where("isnan(customer_age)").count() and not nulls.where("isnan(customer_age)").count()
    book = rules.rule_book()
    assert by_rule(rules.rule_results(nans, book)) == by_rule(rules.rule_results(nulls, book))


def test_empty_table_fails_only_on_size(spark):
    empty = to_spark(spark, valid_pandas()).limit(0)
    found = by_rule(rules.rule_results(empty, rules.rule_book()))
    assert [n for n, r in found.items() if not r["passed"]] == ["minimum_size"]
    assert found["minimum_size"]["n_invalid"] == 100


def test_null_label_and_duplicates(spark):
    frame = valid_pandas()
    frame.loc[0] = frame.loc[1]
    assert results(spark, frame)["no_duplicate_rows"]["n_invalid"] == 1
    unlabelled = to_spark(spark, valid_pandas()).selectExpr(
        "* EXCEPT (is_fraud)", "if(network_quality = 99, NULL, is_fraud) AS is_fraud"
    )
    found = by_rule(rules.rule_results(unlabelled, rules.rule_book()))
    assert found["target_not_null"]["n_invalid"] == 1


def test_repeated_rows_match_pandas_with_nulls_zero_signs_and_a_hot_group(spark):
    rng = np.random.default_rng(7)
    frame = pd.DataFrame({"a": rng.integers(0, 40, 3000) * 1.0, "b": rng.integers(0, 30, 3000) * 1.0})
    frame.loc[frame.index % 3 == 0, ["a", "b"]] = [0.0, np.nan]
    frame.loc[frame.index % 6 == 0, "a"] = -0.0
    spark_frame = to_spark(spark, frame).selectExpr("a", "nanvl(b, null) AS b")
    assert rules.repeated_rows(spark_frame).first()["n_repeated"] == int(frame.duplicated().sum())


def test_rows_of_equal_digest_are_told_apart(spark):
    """Every digest collides: what differs is still not a repeat."""
    rows = [(i // 2 % 5, None if i % 3 else i % 7) for i in range(60)]
    df = spark.createDataFrame(rows, "a int, b int")
    same = rules.repeated_rows(df, lambda _: (F.lit(1), F.lit(1))).first()["n_repeated"]
    assert same == rules.repeated_rows(df).first()["n_repeated"] == 60 - len(set(rows))


def test_only_repeated_digests_are_shuffled_as_whole_rows(spark):
    high, low = rules.row_digest(spark.createDataFrame([(None, 1), (1, None)], "a int, b int"))
    found = spark.createDataFrame([(None, 1), (1, None)], "a int, b int").select(high.alias("h"), low.alias("l")).collect()
    assert found[0]["l"] != found[1]["l"]


def test_offending_values_are_complete(spark):
    frame = valid_pandas()
    frame.loc[100:160, "device_type"] = np.arange(61) + 10.0
    members = [r for r in rules.rule_book().rules if isinstance(r, rules.MemberRule)]
    found = rules.offending_values(to_spark(spark, frame), members).collect()
    assert sorted(r["value"] for r in found) == [float(v) for v in range(10, 71)]
    message = next(r for r in core_results(to_spark(spark, frame), rules.rule_book()) if r[1] == "device_type_valid")
    assert "and 41 more" in message[5][1]


def test_quarantine_names_every_broken_rule(spark):
    frame = valid_pandas()
    frame.loc[150, ["customer_age", "store_type"]] = [200.0, 9.0]
    found = rules.quarantine(to_spark(spark, frame), rules.rule_book()).where("size(violations) > 0").collect()
    assert [r["violations"] for r in found] == [["customer_age_valid", "store_type_valid"]]


def test_registered_rules_run_with_the_others_and_names_are_unique(spark):
    book = rules.rule_book()
    book.register_rule("amount_below_limit", "transaction_amount", "transaction_amount >= 150", "150 or more")
    book.register_rule("even_items", "num_items", lambda c: c % 2 != 0)
    found = by_rule(rules.rule_results(to_spark(spark, valid_pandas()), book))
    assert found["amount_below_limit"]["n_invalid"] > 0 and found["even_items"]["n_invalid"] > 0
    with pytest.raises(ValueError):
        book.register_rule("even_items", "num_items", "true")


def test_a_rule_that_cannot_run_is_reported_and_the_rest_still_run(spark):
    book = rules.rule_book()
    book.register_rule("broken", "num_items", "CAST('x' AS INT) > num_items")
    frame = valid_pandas()
    frame.loc[150, "customer_age"] = 200.0
    found = {r[1]: r for r in core_results(to_spark(spark, frame), book)}
    assert not found["broken"][3] and "could not run" in found["broken"][5][0]
    assert not found["customer_age_valid"][3] and found["store_type_valid"][3]


def test_type_conformance_counts_text_that_does_not_convert(spark):
    frame = valid_pandas(10, {p.column: 0 for p in FRAUD_POLICIES}).astype(str)
    frame.loc[0, "customer_age"] = "NA"
    frame.loc[1:3, "customer_age"] = ["old", "", " null "]
    found = {
        r["column_name"]: r
        for r in rules.type_conformance(to_spark(spark, frame), FRAUD_CONTRACT, ("", "NA", "null")).collect()
    }
    assert (found["customer_age"]["n_missing"], found["customer_age"]["n_nonconforming"]) == (3, 1)
    assert found["is_fraud"]["passed"] and not found["customer_age"]["passed"]


def test_expectations_tolerance_and_absent_columns(spark):
    frame = valid_pandas()
    frame.loc[150:151, "customer_age"] = 999.0
    df = to_spark(spark, frame)
    suite = [
        expectations.Expectation("between", "customer_age", minimum=0, maximum=120),
        expectations.Expectation("between", "customer_age", minimum=0, maximum=120, mostly=0.98),
        expectations.Expectation("exists", "nowhere"),
        expectations.Expectation("not_null", "nowhere"),
    ]
    found = [r["success"] for r in expectations.expectation_results(df, suite).orderBy("position").collect()]
    assert found == [False, True, False, False]
    whole = expectations.suite_result(expectations.expectation_results(df, expectations.FRAUD_SUITE), 30).first()
    assert not whole["passed"] and whole["errors"] == ["expectation between failed on customer_age"]
