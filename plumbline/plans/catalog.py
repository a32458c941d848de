"""The registered queries: one callable per operator, over the given tables.

Each takes (spark, sf_dir) and returns a DataFrame. Tables that several queries share (the
transaction table, the trusted table, the prepared data, the model) are built by Spark from the
given tables once per application and version of the input files, and then read back.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.contract import (
    CATEGORICAL_FEATURES,
    FRAUD_CONTRACT,
    FRAUD_POLICIES,
    NUMERIC_FEATURES,
    policy_for,
)
from plumbline.functions import sqltext as sql
from plumbline.operators import (
    counters,
    expectations,
    features,
    fingerprint,
    imputation,
    limits,
    metrics,
    missingness,
    monitoring,
    neighbours,
    rules,
    scoring,
    signal,
)
from plumbline.plans import preparation, training, validation
from plumbline.sources import sinks
from plumbline.sources import transactions as tx
from plumbline.sources.readers import NULL_TOKENS, scan_label, scan_text, scan_trusted, typed
from plumbline.streaming import jobs
from plumbline.workspace import Workspace

Query = Callable[[SparkSession, str], DataFrame]

KEY = "tx_id"
LABELS = ("is_fraud", "is_fraud_signal")
ANALYSED = [p.column for p in FRAUD_POLICIES]
DIGITS = 6

QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return add


# --- shared tables ---------------------------------------------------------------------------


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six digits: statistics are compared across engines."""
    return df.selectExpr(*[f"round(`{c}`, {DIGITS}) AS `{c}`" if t == "double" else f"`{c}`" for c, t in df.dtypes])


def clock(column: str = "window_start") -> Column:
    return F.col(column).cast("string").alias(column)


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tx.contract_columns(tx.transaction_table(spark, sf_dir), KEY)


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tx.with_repeated_rows(tx.dirty(clean(spark, sf_dir)))


def breached(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tx.with_breached_ceilings(clean(spark, sf_dir))


def labelled(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    """Key, the twelve features and one of the two labels."""
    table = tx.transaction_table(spark, sf_dir)
    return table.select(KEY, *[c for c in FRAUD_CONTRACT.names if c != "is_fraud"], F.col(label))


def per_label(
    build: Callable[[DataFrame, str, dict[str, str]], DataFrame], spark: SparkSession, sf_dir: str
) -> DataFrame:
    """The same check for both labels; feature roles do not depend on the label."""
    roles = signal.infer_roles(clean(spark, sf_dir).drop(KEY), "is_fraud")
    parts = [
        build(labelled(spark, sf_dir, label).drop(KEY), label, roles).select(F.lit(label).alias("label"), "*")
        for label in LABELS
    ]
    return rounded(reduce(DataFrame.unionByName, parts))


def of_role(roles: dict[str, str], role: str) -> list[str]:
    return [c for c, found in roles.items() if found == role]


def built(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], object]) -> object:
    return Workspace.of(spark).once((name, sf_dir, tx.transaction_path(spark, sf_dir)), build)


def validated(spark: SparkSession, sf_dir: str) -> validation.ValidationOutcome:
    def build() -> validation.ValidationOutcome:
        workspace = Workspace.of(spark)
        return validation.run_validation(
            clean(spark, sf_dir),
            rules.rule_book(),
            workspace.new_path("reports"),
            workspace.new_path("validated"),
            source="transactions",
            keys=[KEY],
        )

    return built(spark, sf_dir, "validated", build)


def filled_path(spark: SparkSession, sf_dir: str) -> str:
    """The filled table. The feature queries are about their operators, so they take it whether
    or not the gate passed; ``run_validation`` and ``run_preparation`` chain the stages."""

    def build() -> str:
        outcome = validated(spark, sf_dir)
        if outcome.validated_path:
            return outcome.validated_path
        path = Workspace.of(spark).new_path("filled")
        imputation.impute_guarded(clean(spark, sf_dir), FRAUD_POLICIES).write.parquet(path)
        return path

    return built(spark, sf_dir, "filled", build)


def prepared(spark: SparkSession, sf_dir: str) -> preparation.PreparedData:
    def build() -> preparation.PreparedData:
        workspace = Workspace.of(spark)
        return preparation.run_preparation(
            spark,
            filled_path(spark, sf_dir),
            workspace.new_path("processed"),
            workspace.new_path("parameters"),
            KEY,
            FRAUD_CONTRACT.label,
        )

    return built(spark, sf_dir, "prepared", build)


def trained(spark: SparkSession, sf_dir: str) -> training.TrainedModel:
    def build() -> training.TrainedModel:
        data = prepared(spark, sf_dir)
        return training.run_training(
            spark,
            data.processed_path,
            data.parameters_path,
            Workspace.of(spark).new_path("training"),
            KEY,
            FRAUD_CONTRACT.label,
        )

    return built(spark, sf_dir, "trained", build)


def split_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unfilled table with its split, so that fitted fill values matter."""
    return features.stratified_split(clean(spark, sf_dir), KEY, FRAUD_CONTRACT.label)


def text_landing(spark: SparkSession, sf_dir: str) -> str:
    """The table as delimited text, with several null tokens and some text in a number column."""

    def build() -> str:
        path = Workspace.of(spark).new_path("landing")
        token = f"element_at(array('', 'NA', 'NaN', 'null'), CAST({KEY} % 4 + 1 AS INT))"
        cells = [f"coalesce(CAST({c} AS STRING), {token}) AS {c}" for c in FRAUD_CONTRACT.names]
        text = clean(spark, sf_dir).selectExpr(KEY, *cells)
        garbled = F.when(F.col(KEY) % 1000 == 7, F.lit("bad")).otherwise(F.col("network_quality"))
        text.withColumn("network_quality", garbled).write.option("header", "true").csv(path)
        return path

    return built(spark, sf_dir, "landing", build)


def scored_table(spark: SparkSession, sf_dir: str, threshold: float = 0.5) -> DataFrame:
    """A deterministic score with many ties, next to the label."""
    score = ((F.col(KEY) * 48271 + 7) % 1009).cast("double") / F.lit(1009.0)
    return (
        clean(spark, sf_dir)
        .select(KEY, "is_fraud", score.alias("score"))
        .withColumn("prediction", (F.col("score") > threshold).cast("int"))
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.request_log(tx.read_table(spark, sf_dir, "events"))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = tx.read_table(spark, sf_dir, "events").schema
    return jobs.file_stream(spark, f"{sf_dir.rstrip('/')}/events.parque[t]", schema)


def transaction_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tx.transaction_path(spark, sf_dir)
    return jobs.file_stream(spark, path, spark.read.parquet(path).schema)


def plain_results(results: DataFrame) -> DataFrame:
    return results.select("rule_name", "passed", "n_invalid")


# --- sources, sinks --------------------------------------------------------------------------


@query("csv_scan_typed")
def csv_scan_typed(spark, sf_dir):
    return typed(scan_text(spark, text_landing(spark, sf_dir))).withColumn(KEY, F.col(KEY).cast("bigint"))


@query("type_conformance")
def type_conformance(spark, sf_dir):
    return rules.type_conformance(scan_text(spark, text_landing(spark, sf_dir)), FRAUD_CONTRACT, NULL_TOKENS)


@query("target_contract")
def target_contract(spark, sf_dir):
    documents = tx.read_table(spark, sf_dir, "documents").select("doc_id")
    labels = documents.join(tx.read_table(spark, sf_dir, "labels"), "doc_id", "left")
    sources = {
        "transactions.is_fraud": clean(spark, sf_dir).select("is_fraud"),
        "dirty.is_fraud": dirty(spark, sf_dir).select("is_fraud"),
        "documents.quality": labels.select("quality"),
        "documents.toxic": labels.select("toxic"),
    }
    parts = [
        metrics.target_contract(scan_label(df), df.columns[0]).select(F.lit(name).alias("source"), "*")
        for name, df in sources.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query("validated_table")
def validated_table(spark, sf_dir):
    """What the stage wrote; no rows if the table did not pass."""
    table = scan_trusted(spark, filled_path(spark, sf_dir), "validation")
    return table if validated(spark, sf_dir).passed else table.limit(0)


@query("validation_report")
def validation_report(spark, sf_dir):
    def build():
        workspace = Workspace.of(spark)
        path = workspace.new_path("reports")
        for source, df in (("clean", clean(spark, sf_dir)), ("dirty", dirty(spark, sf_dir))):
            validation.run_validation(
                df, rules.rule_book(), path, workspace.new_path("validated"), source=source, keys=[KEY]
            )
        return path

    path = built(spark, sf_dir, "validation_report", build)
    return sinks.read_reports(spark, path).select(
        "source", "row_count", "column_count", "report_passed", "rule_name", "category", "passed", "n_invalid"
    )


@query("processed_table")
def processed_table(spark, sf_dir):
    df = preparation.load_processed(spark, prepared(spark, sf_dir).processed_path)
    return rounded(df.toDF(*[c.replace(".", "_") for c in df.columns]))


@query("feature_metadata")
def feature_metadata(spark, sf_dir):
    return sinks.feature_metadata(spark, prepared(spark, sf_dir).fitted)


@query("evaluation_report")
def evaluation_report(spark, sf_dir):
    return spark.read.json(trained(spark, sf_dir).report_path)


def run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three recorded runs: the deterministic score cut at three thresholds."""

    def build():
        path = Workspace.of(spark).new_path("runs")
        for threshold in (0.3, 0.5, 0.7):
            found = metrics.binary_metrics(scored_table(spark, sf_dir, threshold), "is_fraud", "prediction").first()
            values = {m: round(found[m], DIGITS) for m in ("accuracy", "precision", "recall", "f1")}
            sinks.append_run(
                spark, path, f"threshold-{threshold}", {"param": {"threshold": threshold}, "metric": values}
            )
        return path

    return spark.read.schema(sinks.RUN_SCHEMA).parquet(built(spark, sf_dir, "runs", build))


@query("run_compare")
def run_compare(spark, sf_dir):
    keys = ["accuracy", "precision", "recall", "f1"]
    table = sinks.compare_runs(run_history(spark, sf_dir), keys)
    return rounded(table.select("run_id", *[F.col(k).cast("double").alias(k) for k in keys]))


@query("best_run")
def best_run(spark, sf_dir):
    return rounded(sinks.best_run(run_history(spark, sf_dir), "f1"))


@query("signal_report")
def signal_report(spark, sf_dir):
    def build():
        path = Workspace.of(spark).new_path("signal")
        label = "is_fraud_signal"
        signal.signal_report(labelled(spark, sf_dir, label), label, KEY).coalesce(1).write.json(path)
        return path

    return spark.read.json(built(spark, sf_dir, "signal_report", build))


# --- schema rules ----------------------------------------------------------------------------


def broken_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A required column gone, one column as text, and two columns the contract does not know."""
    return (
        tx.transaction_table(spark, sf_dir)
        .drop(KEY, "tx_ts", "network_quality")
        .withColumn("store_type", F.col("store_type").cast("string"))
    )


def schema_findings(spark: SparkSession, sf_dir: str, rule: str) -> DataFrame:
    """The findings of one schema rule, with the rows of the table they apply to."""
    df = broken_schema(spark, sf_dir)
    found = next(r for r in rules.schema_results(df, FRAUD_CONTRACT) if r[1] == rule)
    errors = sql.rows(sql.struct(rule_name=sql.text(rule), error=sql.text(e)) for e in found[5])
    return df.agg(F.count("*").alias("n_rows")).selectExpr("n_rows", errors)


QUERIES["schema_required"] = partial(schema_findings, rule="required_columns")
QUERIES["schema_types"] = partial(schema_findings, rule="datatypes")
QUERIES["schema_unexpected"] = partial(schema_findings, rule="no_unexpected_columns")


@query("validation_failfast")
def validation_failfast(spark, sf_dir):
    book = rules.rule_book()
    sources = {
        "broken_schema": broken_schema(spark, sf_dir),
        "clean": clean(spark, sf_dir).drop(KEY),
    }
    parts = [
        plain_results(rules.rule_results(df, book)).select(F.lit(name).alias("source"), "*")
        for name, df in sources.items()
    ]
    return reduce(DataFrame.unionByName, parts)


# --- data rules ------------------------------------------------------------------------------


@query("rule_results")
def rule_results(spark, sf_dir):
    return plain_results(rules.rule_results(clean(spark, sf_dir).drop(KEY), rules.rule_book()))


@query("rule_results_dirty")
def rule_results_dirty(spark, sf_dir):
    return plain_results(rules.rule_results(dirty(spark, sf_dir).drop(KEY), rules.rule_book()))


def single_rule(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source = breached if name.endswith("_within_ceiling") else dirty
    return plain_results(rules.data_results(source(spark, sf_dir), rules.rule_book().only(name)))


for _name in rules.rule_book().names():
    QUERIES[f"rule_{_name}"] = partial(single_rule, name=_name)


@query("rule_offenders")
def rule_offenders(spark, sf_dir):
    members = [r for r in rules.rule_book().rules if isinstance(r, rules.MemberRule)]
    return rules.offending_values(dirty(spark, sf_dir), members)


@query("rule_results_accounts")
def rule_results_accounts(spark, sf_dir):
    """The same rule compiler on tables with other columns, with rules registered by the caller."""
    checks = {
        "customer": [
            ("c_acctbal_non_negative", "c_acctbal", "c_acctbal < 0"),
            ("c_nationkey_valid", "c_nationkey", lambda c: ~c.between(0, 24)),
            ("c_name_present", "c_name", lambda c: c.isNull()),
        ],
        "supplier": [("s_acctbal_non_negative", "s_acctbal", lambda c: c < 0)],
        "part": [("p_size_valid", "p_size", lambda c: ~c.between(1, 50))],
    }
    parts = []
    for name, added in checks.items():
        book = rules.RuleBook(FRAUD_CONTRACT)
        for rule_name, column, violation in added:
            book.register_rule(rule_name, column, violation)
        table = rules.nan_to_null(tx.read_table(spark, sf_dir, name))
        results = plain_results(rules.fused_results(table, book))
        parts.append(results.select(F.lit(name).alias("source"), "*"))
    return reduce(DataFrame.unionByName, parts)


@query("quarantine_rows")
def quarantine_rows(spark, sf_dir):
    checked = rules.quarantine(tx.dirty(clean(spark, sf_dir)), rules.rule_book())
    return checked.select(
        KEY, (F.size("violations") == 0).alias("is_valid"), F.concat_ws(",", "violations").alias("violations")
    )


@query("missing_rate_guard")
def missing_rate_guard(spark, sf_dir):
    return rounded(missingness.missing_rate_guards(clean(spark, sf_dir)))


@query("missing_rate_guard_breached")
def missing_rate_guard_breached(spark, sf_dir):
    return rounded(missingness.missing_rate_guards(breached(spark, sf_dir)))


@query("missing_rate_by_batch")
def missing_rate_by_batch(spark, sf_dir):
    batch = (F.year("tx_ts") * 100 + F.month("tx_ts")).alias("batch")
    return rounded(missingness.missing_rate_guards(tx.transaction_table(spark, sf_dir), by=[batch]))


@query("ceiling_proposal")
def ceiling_proposal(spark, sf_dir):
    rates = missingness.missing_rate_guards(clean(spark, sf_dir)).select(
        "column_name", "missing_rate", F.col("ceiling").alias("current_ceiling")
    )
    return rounded(imputation.proposed_ceilings(rates, "missing_rate"))


@query("expectation_suite")
def expectation_suite(spark, sf_dir):
    return expectations.expectation_results(dirty(spark, sf_dir), expectations.FRAUD_SUITE).drop("position")


# --- imputation ------------------------------------------------------------------------------


@query("impute_indicators")
def impute_indicators(spark, sf_dir):
    return imputation.add_indicators(clean(spark, sf_dir), FRAUD_POLICIES).select(
        KEY, *[p.indicator for p in FRAUD_POLICIES]
    )


def impute_strategy(spark: SparkSession, sf_dir: str, strategy: str) -> DataFrame:
    policies = [p for p in FRAUD_POLICIES if p.strategy == strategy]
    return imputation.impute(clean(spark, sf_dir).select(KEY, *[p.column for p in policies]), policies)


QUERIES["impute_median"] = partial(impute_strategy, strategy="median")
QUERIES["impute_mode"] = partial(impute_strategy, strategy="mode")


def impute_column(spark: SparkSession, sf_dir: str, column: str) -> DataFrame:
    return imputation.impute_guarded(clean(spark, sf_dir).select(KEY, column), [policy_for(column)])


for _column in ANALYSED:
    QUERIES[f"impute_{_column}"] = partial(impute_column, column=_column)


@query("impute_all")
def impute_all(spark, sf_dir):
    return imputation.impute_guarded(clean(spark, sf_dir), FRAUD_POLICIES)


@query("impute_summary")
def impute_summary(spark, sf_dir):
    return rounded(imputation.fill_summary(clean(spark, sf_dir), FRAUD_POLICIES).drop("position"))


# --- missingness -----------------------------------------------------------------------------


def patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missingness.missing_patterns(clean(spark, sf_dir), ANALYSED, "is_fraud")


@query("missing_rate_profile")
def missing_rate_profile(spark, sf_dir):
    return rounded(missingness.missing_rates(patterns(spark, sf_dir), ANALYSED))


@query("label_rate_split")
def label_rate_split(spark, sf_dir):
    return rounded(missingness.label_rate_split(patterns(spark, sf_dir), ANALYSED))


@query("missingness_correlation")
def missingness_correlation(spark, sf_dir):
    return rounded(missingness.missingness_correlation(patterns(spark, sf_dir), ANALYSED))


@query("missing_by_category")
def missing_by_category(spark, sf_dir):
    return rounded(missingness.missing_by_category(clean(spark, sf_dir), ANALYSED))


@query("missing_by_quartile")
def missing_by_quartile(spark, sf_dir):
    return rounded(missingness.missing_by_quartile(clean(spark, sf_dir), ANALYSED))


@query("missingness_report")
def missingness_report(spark, sf_dir):
    asked = [*ANALYSED, "merchant_country"]
    return rounded(missingness.missingness_report(clean(spark, sf_dir), asked, "is_fraud"))


@query("missingness_verdict")
def missingness_verdict(spark, sf_dir):
    return missingness.verdict_hints(
        missingness.missingness_report(clean(spark, sf_dir), ANALYSED, "is_fraud")
    )


# --- signal ----------------------------------------------------------------------------------


@query("role_inference")
def role_inference(spark, sf_dir):
    return signal.role_table(clean(spark, sf_dir).drop(KEY), "is_fraud")


@query("label_correlation")
def label_correlation(spark, sf_dir):
    return per_label(lambda df, y, r: signal.label_correlation(df, y, of_role(r, "numeric")), spark, sf_dir)


@query("mutual_information")
def mutual_information(spark, sf_dir):
    return per_label(lambda df, y, r: signal.mutual_information(df, y, r), spark, sf_dir)


@query("neighbour_information")
def neighbour_information(spark, sf_dir):
    features = [c for c in FRAUD_CONTRACT.names if c != "is_fraud"]
    table = tx.transaction_table(spark, sf_dir).select(KEY, *features, *LABELS)
    found = neighbours.neighbour_information_of(table, LABELS, features, KEY)
    parts = [of_label.select(F.lit(label).alias("label"), "*") for label, of_label in zip(LABELS, found)]
    return rounded(reduce(DataFrame.unionByName, parts))


@query("decile_spread")
def decile_spread(spark, sf_dir):
    return per_label(lambda df, y, r: signal.decile_spread(df, y, of_role(r, "numeric")), spark, sf_dir)


@query("category_spread")
def category_spread(spark, sf_dir):
    def spread(df, y, roles):
        return signal.category_spread(df, y, of_role(roles, "categorical")).drop("rates_by_level")

    return per_label(spread, spark, sf_dir)


@query("category_rates")
def category_rates(spark, sf_dir):
    def rates(df, y, roles):
        found = signal.category_rates(df, y, of_role(roles, "categorical"))
        return found.selectExpr("feature", "level", "n", "positives", "positives / n AS label_rate")

    return per_label(rates, spark, sf_dir)


@query("interaction_spread")
def interaction_spread(spark, sf_dir):
    return per_label(lambda df, y, r: signal.interaction_spread(df, y, of_role(r, "categorical")), spark, sf_dir)


@query("interaction_cells")
def interaction_cells(spark, sf_dir):
    """Pairwise label rates on another table: discount level by return flag and line status."""
    items = tx.read_table(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_linestatus", (F.col("l_discount") > 0.05).cast("int").alias("high_discount")
    )
    return rounded(signal.interaction_cells(items, "high_discount", ["l_returnflag", "l_linestatus"]))


@query("row_order_gaps")
def row_order_gaps(spark, sf_dir):
    parts = [
        signal.row_order_gaps(labelled(spark, sf_dir, label), label, KEY).select(F.lit(label).alias("label"), "*")
        for label in LABELS
    ]
    return rounded(reduce(DataFrame.unionByName, parts))


@query("signal_verdict")
def signal_verdict(spark, sf_dir):
    return per_label(lambda df, y, r: signal.verdict(signal.signal_checks(df, y, r)), spark, sf_dir)


# --- features --------------------------------------------------------------------------------


@query("drop_indicators")
def drop_indicators(spark, sf_dir):
    table = scan_trusted(spark, filled_path(spark, sf_dir), "validation")
    return features.drop_indicators(table, FRAUD_POLICIES)


@query("stratified_split")
def stratified_split(spark, sf_dir):
    return split_raw(spark, sf_dir).select(KEY, "is_fraud", "split")


def train_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_raw(spark, sf_dir).where(F.col("split") == "train")


@query("fit_numeric")
def fit_numeric(spark, sf_dir):
    fitted = features.fit_numeric(train_part(spark, sf_dir))
    rows = [(p.feature, p.fill, p.mean, p.scale) for p in fitted]
    return rounded(spark.createDataFrame(rows, "feature string, fill double, mean double, scale double"))


@query("fit_categories")
def fit_categories(spark, sf_dir):
    fitted = features.fit_categories(train_part(spark, sf_dir))
    rows = [(p.feature, p.fill, level) for p in fitted for level in p.levels]
    return spark.createDataFrame(rows, "feature string, fill double, level double")


@query("scale_numeric")
def scale_numeric(spark, sf_dir):
    split = split_raw(spark, sf_dir)
    fitted = features.fit_numeric(split.where(F.col("split") == "train"))
    return rounded(split.selectExpr(KEY, "split", *features.scaled_columns(fitted)))


@query("onehot")
def onehot(spark, sf_dir):
    split = split_raw(spark, sf_dir)
    fitted = features.fit_categories(split.where(F.col("split") == "train"))
    encoded = tx.dirty(split).selectExpr(KEY, "split", *features.onehot_columns(fitted))
    return encoded.toDF(*[c.replace(".", "_") for c in encoded.columns])


@query("leakage_check")
def leakage_check(spark, sf_dir):
    split = split_raw(spark, sf_dir)
    gaps = features.parameter_gap(split.where(F.col("split") == "train"), split)
    schema = (
        "feature string, train_fill double, full_fill double, train_mean double, full_mean double, "
        "train_scale double, full_scale double"
    )
    table = spark.createDataFrame(gaps, schema)
    return rounded(table.withColumn("mean_gap", F.col("train_mean") - F.col("full_mean")))


# --- training, evaluation --------------------------------------------------------------------


@query("split_alignment")
def split_alignment(spark, sf_dir):
    processed = preparation.load_processed(spark, prepared(spark, sf_dir).processed_path)
    labels = split_raw(spark, sf_dir).select(KEY, "is_fraud", "split")
    return features.split_alignment(processed, labels, KEY)


@query("class_weights")
def class_weights(spark, sf_dir):
    return rounded(metrics.class_weights(train_part(spark, sf_dir), "is_fraud"))


def _model(spark: SparkSession, sf_dir: str) -> RandomForestClassificationModel:
    return RandomForestClassificationModel.load(trained(spark, sf_dir).model_path)


@query("train_forest")
def train_forest(spark, sf_dir):
    """One row per tree of the fitted forest."""
    model = _model(spark, sf_dir)
    rows = [(i, t.depth, t.numNodes) for i, t in enumerate(model.trees)]
    return spark.createDataFrame(rows, "tree int, depth int, n_nodes int")


@query("score_test")
def score_test(spark, sf_dir):
    data = prepared(spark, sf_dir)
    processed = preparation.load_processed(spark, data.processed_path)
    return training.score_split(processed, _model(spark, sf_dir), data.fitted, KEY, "is_fraud", "test")


@query("feature_importance")
def feature_importance(spark, sf_dir):
    return training.feature_importance(spark, _model(spark, sf_dir), prepared(spark, sf_dir).fitted)


@query("binary_metrics")
def binary_metrics(spark, sf_dir):
    return rounded(metrics.binary_metrics(scored_table(spark, sf_dir), "is_fraud", "prediction"))


@query("weighted_f1")
def weighted_f1(spark, sf_dir):
    return rounded(metrics.weighted_f1(scored_table(spark, sf_dir), "is_fraud", "prediction"))


@query("roc_auc")
def roc_auc(spark, sf_dir):
    return rounded(metrics.roc_auc(scored_table(spark, sf_dir), "is_fraud", "score"))


@query("average_precision")
def average_precision(spark, sf_dir):
    return rounded(metrics.average_precision(scored_table(spark, sf_dir), "is_fraud", "score"))


# --- governance, scoring ---------------------------------------------------------------------


@query("table_fingerprint")
def table_fingerprint(spark, sf_dir):
    table = clean(spark, sf_dir)
    cells = [F.col(KEY), F.round(F.col("transaction_amount") * 100).cast("bigint")]
    cells += [F.col(c).cast("bigint") for c in (*CATEGORICAL_FEATURES, "num_items", "is_fraud")]
    return fingerprint.portable_fingerprint(table, cells)


def contract_cells() -> list:
    """Cells of the key and of all columns of the contract."""
    doubles = [c for c in FRAUD_CONTRACT.names if c != "is_fraud"]
    cells = [cell for c in doubles for cell in fingerprint.exact_cells(c)]
    return [F.col(KEY), *cells, F.col("is_fraud").cast("bigint")]


@query("table_fingerprint_all")
def table_fingerprint_all(spark, sf_dir):
    """The columns that ``table_fingerprint`` leaves out count too."""
    return fingerprint.portable_fingerprint(clean(spark, sf_dir), contract_cells())


@query("manifest")
def manifest(spark, sf_dir):
    return training.read_manifest(spark, trained(spark, sf_dir).manifest_path)


@query("manifest_verify")
def manifest_verify(spark, sf_dir):
    model, data = trained(spark, sf_dir), prepared(spark, sf_dir)
    rows = training.verify_manifest(spark, model.model_path, data.parameters_path, model.manifest_path)
    return spark.createDataFrame(rows, "artifact string, recorded string, found string, matches boolean")


@query("score_contract")
def score_contract(spark, sf_dir):
    checked = scoring.check_requests(tx.dirty(clean(spark, sf_dir)))
    return checked.select(
        KEY, (F.size("violations") == 0).alias("accepted"), F.concat_ws(",", "violations").alias("violations")
    )


def _verified(spark: SparkSession, sf_dir: str):
    model, data = trained(spark, sf_dir), prepared(spark, sf_dir)
    return training.load_verified(spark, model.model_path, data.parameters_path, model.manifest_path)


@query("score_batch")
def score_batch(spark, sf_dir):
    model, fitted = _verified(spark, sf_dir)
    return scoring.score(tx.dirty(clean(spark, sf_dir)), fitted, model, [KEY])


@query("score_stream")
def score_stream(spark, sf_dir):
    model, fitted = _verified(spark, sf_dir)
    return jobs.score_stream(transaction_stream(spark, sf_dir), fitted, model, [KEY])


# --- monitoring ------------------------------------------------------------------------------


@query("served_counter")
def served_counter(spark, sf_dir):
    counts = monitoring.served_counter(requests(spark, sf_dir), "1 hour")
    return counts.select(clock(), "n_requests", "n_served", "served_total")


@query("latency_histogram")
def latency_histogram(spark, sf_dir):
    edge = F.when(F.col("le") == float("inf"), F.lit("+Inf")).otherwise(F.col("le").cast("string"))
    rows = monitoring.latency_histogram(requests(spark, sf_dir), "1 day")
    return rows.select(clock(), edge.alias("le"), "cumulative")


@query("bucket_quantile")
def bucket_quantile(spark, sf_dir):
    rows = monitoring.bucket_quantile(requests(spark, sf_dir), 0.5, "1 minute")
    return rows.select(clock(), "n", F.round("latency_quantile", 9).alias("latency_quantile"))


@query("rate_limit")
def rate_limit(spark, sf_dir):
    return monitoring.rate_limit(requests(spark, sf_dir)).select("event_id", "user_id", clock(), "admitted")


@query("rate_limit_summary")
def rate_limit_summary(spark, sf_dir):
    rows = monitoring.rate_limit_summary(requests(spark, sf_dir), quota=2, width="1 hour")
    return rows.select("user_id", clock(), "n_requests", "n_admitted", "n_rejected")


def anchored(rows: DataFrame) -> DataFrame:
    start = F.date_format("window_start", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("window_start")
    return rows.select("event_id", "user_id", start, "admitted")


@query("rate_limit_anchored")
def rate_limit_anchored(spark, sf_dir):
    return anchored(limits.rate_limit_anchored(requests(spark, sf_dir)))


@query("rate_limit_anchored_quota")
def rate_limit_anchored_quota(spark, sf_dir):
    return anchored(limits.rate_limit_anchored(requests(spark, sf_dir), quota=2, width="6 hours"))


@query("counter_rate")
def counter_rate(spark, sf_dir):
    samples = counters.sampled_counters(requests(spark, sf_dir)).where("series = -1")
    return rounded(counters.counter_rates(samples).select("t", "n", "rate"))


@query("rate_quantile")
def rate_quantile(spark, sf_dir):
    samples = counters.sampled_counters(requests(spark, sf_dir), scrape=60).where("series >= 0")
    return rounded(counters.rate_quantile(counters.counter_rates(samples, 3600, 3600), 0.95))


@query("rate_limit_stream")
def rate_limit_stream(spark, sf_dir):
    rows = jobs.rate_limit_stream(event_stream(spark, sf_dir), width="1 hour")
    return rows.select("user_id", clock(), "n_requests", "n_admitted", "n_rejected")


@query("admitted_stream")
def admitted_stream(spark, sf_dir):
    rows = jobs.admitted_stream(event_stream(spark, sf_dir), width="1 hour")
    return rows.select("event_id", "user_id", clock())


@query("admitted_stream_quota")
def admitted_stream_quota(spark, sf_dir):
    rows = jobs.admitted_stream(event_stream(spark, sf_dir), quota=3, width="6 hours")
    return rows.select("event_id", "user_id", clock())


@query("served_counter_stream")
def served_counter_stream(spark, sf_dir):
    rows = jobs.served_counter_stream(event_stream(spark, sf_dir), "1 hour")
    return rows.select(clock(), "n_requests", "n_served")


@query("missing_rate_stream")
def missing_rate_stream(spark, sf_dir):
    rows = jobs.missing_rate_stream(transaction_stream(spark, sf_dir))
    return rounded(rows.select(clock(), "n_rows", "rule_name", "n_missing", "missing_rate", "passed"))
