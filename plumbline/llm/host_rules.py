"""Quality rules with host verdicts: rule failures per document, shrunken failure rates per host.

Base rules look at one document. Each further rule is judged per host: its failure rate over all
of the host's documents is shrunk towards the rate of all hosts by a beta prior whose strength is
estimated from the spread between hosts (moments of the beta-binomial), so a host with three
documents is not condemned by two of them.

Defined results: null or empty text has zero words and fails the base rule; a document with a null
host has no host verdict; repeated rows count and are judged one by one; an empty table gives no
rows; extra columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.textstats import text_counts
from plumbline.workspace import Workspace

# A document fails a rule when the expression is true.
BASE_RULES = {
    "short": "n_words < 20",
    "repeats": "100 * n_repeat_words > 30 * n_words",
}
HOST_RULES = BASE_RULES | {
    "symbols": "10 * n_symbols > 3 * n_words",
    "dup_lines": "100 * n_dup_lines > 30 * n_lines",
    "word_length": "word_chars > 12 * n_words OR word_chars < 2 * n_words",
}
# A host fails when the shrunken failure rate of any rule is above this.
MAX_RATE = 0.5
# Bounds of the share of variance that lies between hosts, so that the prior is proper.
LEAST_BETWEEN, MOST_BETWEEN = 1e-4, 0.5


def host_rates(checked: DataFrame, host: str, rules: list[str]) -> DataFrame:
    """Documents and failures per rule of every host that is not null."""
    known = checked.where(F.col(host).isNotNull())
    return known.groupBy(host).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.col(f"f_{r}").cast("long")).alias(r) for r in rules]
    )


def beta_priors(rates: DataFrame, rules: list[str]) -> dict[str, tuple[float, float]]:
    """(alpha, beta) of each rule, from all hosts in one aggregation of one row."""
    totals = rates.agg(
        F.count(F.lit(1)).alias("hosts"),
        F.sum("n").alias("n"),
        F.sum(F.col("n").cast("double") * F.col("n")).alias("nn"),
        *[F.sum(r).alias(r) for r in rules],
        # sum n (f/n - p)^2 = sum f^2/n - (sum f)^2 / sum n
        *[F.sum(F.col(r).cast("double") * F.col(r) / F.col("n")).alias(f"{r}_2") for r in rules],
    ).first()
    priors = {}
    for rule in rules:
        n = float(totals["n"] or 0)
        p = (totals[rule] or 0) / n if n else 0.0
        noise = p * (1 - p)
        degrees = (totals["hosts"] or 0) - 1
        room = n - totals["nn"] / n - degrees if n else 0.0
        between = LEAST_BETWEEN
        if noise > 0 and room > 0:
            spread = totals[f"{rule}_2"] - n * p * p
            between = (spread - noise * degrees) / (noise * room)
        between = min(max(between, LEAST_BETWEEN), MOST_BETWEEN)
        strength = 1 / between - 1
        priors[rule] = (p * strength, (1 - p) * strength)
    return priors


def host_verdicts(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    host: str = "source",
    max_rate: float = MAX_RATE,
) -> DataFrame:
    """Counts, base verdict, host verdict and ``kept`` of every row of ``df``."""
    rules = list(HOST_RULES)
    counted = text_counts(df, text, [key, host])
    checked = counted.withColumns(
        {f"f_{name}": F.expr(rule) for name, rule in HOST_RULES.items()}
    ).withColumn("base_failed", F.expr(" OR ".join(f"f_{name}" for name in BASE_RULES)))
    # Read twice below: counted once, written where every executor can read it.
    checked = Workspace.of(df.sparkSession).stage(checked, "host-rules")
    rates = Workspace.of(df.sparkSession).stage(host_rates(checked, host, rules), "host-rates")
    priors = beta_priors(rates, rules)
    shrunk = [
        (F.col(r) + F.lit(a)) / (F.col("n") + F.lit(a + b)) for r, (a, b) in priors.items()
    ]
    hosts = rates.select(F.col(host).alias("_host"), F.greatest(*shrunk).alias("host_rate"))
    # The planner broadcasts hosts only below its size threshold; else a busy host's documents
    # are split by the adaptive skew join.
    judged = checked.join(hosts, F.col(host) == F.col("_host"), "left").drop("_host")
    bad_host = F.coalesce(F.col("host_rate") > max_rate, F.lit(False))
    return judged.withColumn("kept", ~F.col("base_failed") & ~bad_host)
