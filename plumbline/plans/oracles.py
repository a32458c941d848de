"""For each registered query that SQL can express, the same result as one ANSI-style statement.

The statements are written independently of the DataFrame code and only share declared constants
(contract, policies, masks). They are checks, not part of any job.
"""

from __future__ import annotations

from itertools import combinations

from plumbline.contract import (
    CATEGORICAL_DRIVERS,
    CATEGORICAL_FEATURES,
    CONTINUOUS_DRIVERS,
    FEATURE_RULE_ORDER,
    FRAUD_CONTRACT,
    FRAUD_POLICIES,
    NUMERIC_FEATURES,
    policy_for,
)
from plumbline.functions.columns import ERFC_A, ERFC_P
from plumbline.operators.expectations import FRAUD_SUITE
from plumbline.operators.monitoring import LATENCY_EDGES
from plumbline.operators.neighbours import (
    FEATURE_STEP,
    FIRST_STEP,
    GRID_BITS,
    NEIGHBOURS,
    NOISE_BITS,
    PRIME,
    SECOND_STEP,
)
from plumbline.sources.transactions import (
    DIRTY_CELLS,
    LABEL_MASK,
    LABEL_SHARE,
    MASKS,
    REPEATED_ROWS,
    SIGNAL_AMOUNT,
    SIGNAL_SHARES,
)

NAMES = FRAUD_CONTRACT.names
ANALYSED = [p.column for p in FRAUD_POLICIES]
CONTRACT = ", ".join(NAMES)
STAMP = "'%Y-%m-%d %H:%M:%S'"

VALUES = {
    "transaction_amount": "amt",
    "hour_of_day": "CAST(1 + floor((month(tx_ts) - 1) / 4) AS DOUBLE)",
    "is_weekend": "CASE WHEN day(tx_ts) % 7 IN (0, 6) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END",
    "num_items": "CAST(n_items AS DOUBLE)",
    "customer_age": "CAST(18 + ck % 63 AS DOUBLE)",
    "prev_transactions": "CAST(prev AS DOUBLE)",
    "distance_from_home": "abs(bal)",
    "device_type": "CASE st WHEN 'F' THEN 0.0::DOUBLE WHEN 'O' THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END",
    "network_quality": "CAST((k * 31 + ck * 17) % 101 AS DOUBLE)",
    "is_first_transaction": "CASE WHEN prev = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END",
    "store_type": "CAST(ck % 2 AS DOUBLE)",
    "velocity_score": "qty / 10",
}


def _mask(multiplier: int, increment: int) -> str:
    word = "(k % 4294967296)"
    return (
        f"(((({word} % 65536) * {multiplier} + ((({word} // 65536) * {multiplier}) % 65536) * 65536"
        f" + {increment}) % 4294967296) // 65536) % 1000"
    )


def _tx() -> str:
    cells = ",\n  ".join(
        f"CASE WHEN {_mask(m, a)} >= {share} THEN {VALUES[c]} END AS {c}" for c, (m, a, share) in MASKS.items()
    )
    label = _mask(*LABEL_MASK)
    return f"""li AS (
  SELECT l_orderkey, count(*) AS n_items, sum(l_quantity) AS qty FROM lineitem GROUP BY l_orderkey
), base AS (
  SELECT o.o_orderkey AS k, o.o_custkey AS ck, o.o_orderdate AS tx_ts, o.o_totalprice AS amt,
    o.o_orderstatus AS st, c.c_acctbal AS bal, coalesce(li.n_items, 0) AS n_items,
    coalesce(li.qty, 0) AS qty,
    row_number() OVER (PARTITION BY o.o_custkey ORDER BY o.o_orderdate, o.o_orderkey) - 1 AS prev
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN li ON o.o_orderkey = li.l_orderkey
), tx AS MATERIALIZED (
  SELECT k AS tx_id, ck AS customer_id, tx_ts,
  {cells},
  CASE WHEN {label} < {LABEL_SHARE} THEN 1 ELSE 0 END AS is_fraud,
  CASE WHEN {label} < (CASE WHEN amt > {SIGNAL_AMOUNT} THEN {SIGNAL_SHARES[0]} ELSE {SIGNAL_SHARES[1]} END)
    THEN 1 ELSE 0 END AS is_fraud_signal
  FROM base
)"""


TX = _tx()
_CELLS = ", ".join(f"{DIRTY_CELLS[c]} AS {c}" if c in DIRTY_CELLS else c for c in NAMES)
DIRTY_ONCE = f"dirty_once AS MATERIALIZED (SELECT tx_id, {_CELLS} FROM tx)"
DIRTY = f"""{DIRTY_ONCE}, dirty AS MATERIALIZED (
  SELECT * FROM dirty_once UNION ALL SELECT * FROM dirty_once WHERE {REPEATED_ROWS}
)"""
_BREACHED = ", ".join(
    f"CASE WHEN tx_id % 100 >= {round(100 * (policy_for(c).ceiling + 0.15))} THEN {c} END AS {c}"
    if c in ANALYSED
    else c
    for c in NAMES
)
BREACHED = f"breached AS (SELECT tx_id, {_BREACHED} FROM tx)"


def _fill(column: str, source: str = "tx") -> str:
    if policy_for(column).strategy == "median":
        return f"(SELECT median({column}) FROM {source})"
    return (
        f"(SELECT {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY {column} "
        f"ORDER BY count(*) DESC, {column} LIMIT 1)"
    )


def _imputed(columns: list[str], order: list[str] | None = None) -> str:
    cells = ", ".join(f"coalesce({c}, {_fill(c)}) AS {c}" for c in columns)
    flags = ", ".join(f"CAST({c} IS NULL AS INTEGER) AS {c}_was_missing" for c in (order or columns))
    return f"{cells}, {flags}"


IMPUTED = f"""imputed AS MATERIALIZED (
  SELECT tx_id, {_imputed(ANALYSED)}, is_fraud FROM tx
)"""


def _split(source: str, columns: str = "*") -> str:
    return f"""classes AS (
  SELECT is_fraud AS label, count(*) AS n, sum(count(*)) OVER () AS total FROM {source} GROUP BY is_fraud
), wanted AS (
  SELECT label, n, total, CAST(ceil(CAST(0.2 AS DOUBLE) * total) AS BIGINT) AS n_test FROM classes
), shares AS (
  SELECT label, CAST((n * n_test) // total AS BIGINT) AS quota, n_test,
    row_number() OVER (ORDER BY (n * n_test) % total DESC, label) AS place
  FROM wanted
), quotas AS (
  SELECT label, quota + CASE WHEN place <= n_test - sum(quota) OVER () THEN 1 ELSE 0 END AS quota FROM shares
), split AS MATERIALIZED (
  SELECT {columns}, CASE WHEN row_number() OVER (
      PARTITION BY is_fraud ORDER BY md5('42:' || CAST(tx_id AS VARCHAR)), tx_id) <= quota
    THEN 'test' ELSE 'train' END AS split
  FROM {source} JOIN quotas ON label = is_fraud
)"""


def _with(*parts: str, body: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + body


def _union(selects: list[str]) -> str:
    return "\nUNION ALL\n".join(selects)


# --- rules -----------------------------------------------------------------------------------


def _violation(column: str) -> tuple[str, str]:
    """Rule name and SQL predicate of a column's range or membership rule."""
    spec = FRAUD_CONTRACT.column(column)
    if spec.allowed is not None:
        allowed = ", ".join(f"{v:g}" for v in spec.allowed)
        return spec.rule_name, f"{column} IS NOT NULL AND {column} NOT IN ({allowed})"
    parts = [f"{column} < {spec.minimum:g}"]
    if spec.maximum is not None:
        parts.append(f"{column} > {spec.maximum:g}")
    return spec.rule_name, " OR ".join(parts)


def _rule_selects(source: str, keys: str = "") -> dict[str, str]:
    """Every data rule as a one-row select (rule_name, passed, n_invalid)."""
    selects = {
        "target_not_null": f"SELECT 'target_not_null' AS rule_name, count(*) = 0 AS passed, count(*) AS n_invalid "
        f"FROM {source} WHERE is_fraud IS NULL",
        "minimum_size": f"SELECT 'minimum_size' AS rule_name, count(*) >= 100 AS passed, "
        f"greatest(100 - count(*), 0) AS n_invalid FROM {source}",
    }
    for p in FRAUD_POLICIES:
        selects[p.guard_name] = (
            f"SELECT '{p.guard_name}' AS rule_name, "
            f"coalesce(count(*) FILTER (WHERE {p.column} IS NULL) / CAST(count(*) AS DOUBLE) <= {p.ceiling}, true) AS passed, "
            f"count(*) FILTER (WHERE {p.column} IS NULL) AS n_invalid FROM {source}"
        )
    for column in FEATURE_RULE_ORDER:
        name, predicate = _violation(column)
        selects[name] = (
            f"SELECT '{name}' AS rule_name, count(*) = 0 AS passed, count(*) AS n_invalid FROM {source} WHERE {predicate}"
        )
    selects["no_duplicate_rows"] = (
        "SELECT 'no_duplicate_rows' AS rule_name, coalesce(sum(n - 1), 0) = 0 AS passed, "
        f"CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS n_invalid FROM "
        f"(SELECT count(*) AS n FROM {source} GROUP BY {keys}{CONTRACT})"
    )
    return selects


SCHEMA_PASSED = [
    f"SELECT '{n}' AS rule_name, true AS passed, 0::BIGINT AS n_invalid"
    for n in ("required_columns", "datatypes", "no_unexpected_columns")
]


def _all_rules(source: str, keys: str = "") -> str:
    return _union(SCHEMA_PASSED + list(_rule_selects(source, keys).values()))


def _suite_select(i: int, source: str) -> str:
    e = FRAUD_SUITE[i]
    head = f"SELECT '{e.kind}' AS expectation, '{e.column}' AS column_name, "
    if e.kind == "exists":
        return head + f"true AS success, 0::BIGINT AS n_evaluated, 0::BIGINT AS n_unexpected FROM (SELECT count(*) FROM {source})"
    if e.kind == "not_null":
        bad, seen = f"count(*) FILTER (WHERE {e.column} IS NULL)", "count(*)"
    else:
        test = (
            f"{e.column} NOT IN ({', '.join(f'{v:g}' for v in e.allowed)})"
            if e.kind == "in_set"
            else f"{e.column} < {e.minimum} OR {e.column} > {e.maximum}"
        )
        bad, seen = f"count(*) FILTER (WHERE {test})", f"count({e.column})"
    return head + f"{bad} = 0 AS success, {seen} AS n_evaluated, {bad} AS n_unexpected FROM {source}"


def _violations_text(columns: list[str], required: list[str] = ()) -> str:
    cases = []
    for column in columns:
        name, predicate = _violation(column)
        cases.append(f"CASE WHEN {predicate} THEN '{name}' END")
    cases += [f"CASE WHEN {c} IS NULL THEN '{c}_required' END" for c in required]
    return f"concat_ws(',', {', '.join(cases)})"


def _guards(source: str, keys: str = "", group: str = "") -> str:
    lead = f"{keys}, " if keys else ""
    return _union(
        [
            f"SELECT {lead}count(*) AS n_rows, '{p.guard_name}' AS rule_name, '{p.column}' AS column_name, "
            f"count(*) FILTER (WHERE {p.column} IS NULL) AS n_missing, "
            f"round(count(*) FILTER (WHERE {p.column} IS NULL) / CAST(count(*) AS DOUBLE), 6) AS missing_rate, "
            f"CAST({p.ceiling} AS DOUBLE) AS ceiling, "
            f"count(*) FILTER (WHERE {p.column} IS NULL) / CAST(count(*) AS DOUBLE) <= {p.ceiling} AS passed "
            f"FROM {source} {group}"
            for p in FRAUD_POLICIES
        ]
    )


# --- missingness -----------------------------------------------------------------------------


def _p_value(z: str) -> str:
    x = f"(abs({z}) / sqrt(2.0::DOUBLE))"
    t = f"(1.0::DOUBLE / (1.0::DOUBLE + {ERFC_P}::DOUBLE * {x}))"
    poly = "0.0::DOUBLE"
    for a in reversed(ERFC_A):
        poly = f"(({poly} + {a}::DOUBLE) * {t})"
    return f"({poly} * exp(-{x} * {x}))"


def _label_split() -> str:
    counts = _union(
        [
            f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n1, "
            f"count(*) FILTER (WHERE {c} IS NOT NULL) AS n0, "
            f"CAST(coalesce(sum(is_fraud) FILTER (WHERE {c} IS NULL), 0) AS DOUBLE) AS x1, "
            f"CAST(coalesce(sum(is_fraud) FILTER (WHERE {c} IS NOT NULL), 0) AS DOUBLE) AS x0 FROM tx"
            for c in ANALYSED
        ]
    )
    return f"""label_counts AS ({counts}), label_pool AS (
  SELECT *, x1 / n1 AS r1, x0 / n0 AS r0, (x1 + x0) / (n1 + n0) AS p FROM label_counts WHERE n1 > 0
), label_z AS (
  SELECT *, CASE WHEN p * (1 - p) > 0
    THEN (r1 - r0) / sqrt(p * (1 - p) * (1.0::DOUBLE / n1 + 1.0::DOUBLE / n0)) ELSE 0 END AS z FROM label_pool
), label_split AS (
  SELECT column_name, n1 AS n_missing, n0 AS n_present, round(r1, 6) AS rate_missing, round(r0, 6) AS rate_present,
    round(z, 6) AS z, round({_p_value('z')}, 6) AS p_value, {_p_value('z')} < 0.05 AS flagged FROM label_z
)"""


def _category_rates() -> str:
    return _union(
        [
            f"SELECT '{c}' AS column_name, '{d}' AS driver, avg(CAST({c} IS NULL AS INTEGER)) AS rate "
            f"FROM tx WHERE {d} IS NOT NULL GROUP BY {d}"
            for c in ANALYSED
            for d in CATEGORICAL_DRIVERS
            if c != d
        ]
    )


def _bin(column: str, edges: str) -> str:
    """Right-closed bin of a value given its edge list; repeated edges make no bin."""
    return (
        f"len(list_filter({edges}[2:len({edges})-1], lambda e: e > {edges}[1] AND e < {column}))"
    )


def _edges(columns: list[str], source: str, bins: int, where: str = "") -> str:
    probabilities = ", ".join(str(i / bins) for i in range(bins + 1))
    return "SELECT " + ", ".join(
        f"quantile_cont({c}, [{probabilities}]) AS e_{c}" for c in columns
    ) + f" FROM {source} {where}"


def _quartile_rates() -> str:
    return _union(
        [
            f"SELECT '{c}' AS column_name, '{d}' AS driver, avg(CAST({c} IS NULL AS INTEGER)) AS rate "
            f"FROM tx, quartiles WHERE {d} IS NOT NULL AND e_{d}[1] < e_{d}[5] GROUP BY {_bin(d, f'e_{d}')}"
            for c in ANALYSED
            for d in CONTINUOUS_DRIVERS
            if c != d
        ]
    )


def _spread(source: str) -> str:
    return (
        "SELECT column_name, driver, count(*) AS n_levels, round(min(rate), 6) AS min_rate, "
        "round(max(rate), 6) AS max_rate, round(max(rate) - min(rate), 6) AS spread, "
        f"max(rate) - min(rate) > 0.05 AS flagged FROM ({source}) GROUP BY column_name, driver"
    )


def _missing_correlation() -> str:
    pairs = _union(
        [
            f"SELECT '{c}' AS column_name, abs((avg(a * b) - avg(a) * avg(b)) / "
            "nullif(sqrt(avg(a) * (1 - avg(a)) * avg(b) * (1 - avg(b))), 0)) AS r FROM "
            f"(SELECT CAST({c} IS NULL AS INTEGER) AS a, CAST({d} IS NULL AS INTEGER) AS b FROM tx)"
            for c in ANALYSED
            for d in ANALYSED
            if c != d
        ]
    )
    return (
        f"missing_correlation AS (SELECT column_name, round(max(r), 6) AS max_abs_correlation, "
        f"coalesce(max(r) > 0.1, false) AS flagged FROM ({pairs}) GROUP BY column_name)"
    )


MISSING_RATES = _union(
    [
        f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) FILTER (WHERE {c} IS NULL) AS n_missing, "
        f"round(avg(CAST({c} IS NULL AS INTEGER)), 6) AS missing_rate FROM tx"
        for c in ANALYSED
    ]
)
QUARTILES = f"quartiles AS MATERIALIZED ({_edges(list(CONTINUOUS_DRIVERS), 'tx', 4)})"
MISSING_EVIDENCE = [
    TX,
    QUARTILES,
    _label_split(),
    _missing_correlation(),
    f"by_category AS ({_spread(_category_rates())})",
    f"by_quartile AS ({_spread(_quartile_rates())})",
    f"""evidence AS (
  SELECT column_name, 'missing_rate' AS check_name, NULL::VARCHAR AS driver, missing_rate AS statistic, false AS flagged
    FROM ({MISSING_RATES})
  UNION ALL SELECT column_name, 'label_rate_p_value', NULL, p_value, flagged FROM label_split
  UNION ALL SELECT column_name, 'category_spread', driver, spread, flagged FROM by_category
  UNION ALL SELECT column_name, 'quartile_spread', driver, spread, flagged FROM by_quartile
  UNION ALL SELECT column_name, 'max_missing_correlation', NULL, max_abs_correlation, flagged FROM missing_correlation
)""",
]


# --- signal ----------------------------------------------------------------------------------

LABELS = ("is_fraud", "is_fraud_signal")
NUMERIC_BY_ROLE = [c for c in NAMES if c in NUMERIC_FEATURES]
CATEGORICAL_BY_ROLE = [c for c in NAMES if c in CATEGORICAL_FEATURES]


def _correlations() -> str:
    return _union(
        [
            f"SELECT '{y}' AS label, '{c}' AS feature, corr({c}, {y}) AS statistic FROM tx"
            for y in LABELS
            for c in NUMERIC_BY_ROLE
        ]
    )


DECILES = f"deciles AS MATERIALIZED ({_edges(NUMERIC_BY_ROLE, 'tx', 10)})"
_FILLED = ", ".join(
    f"coalesce({c}, (SELECT median({c}) FROM tx)) AS {c}" for c in NAMES if c != "is_fraud"
)
FILLED = f"filled AS MATERIALIZED (SELECT {_FILLED}, is_fraud, is_fraud_signal FROM tx)"
FILLED_DECILES = f"filled_deciles AS MATERIALIZED ({_edges(NUMERIC_BY_ROLE, 'filled', 10)})"


def _mi_cells() -> str:
    parts = []
    for y in LABELS:
        for c in NAMES:
            if c == "is_fraud":
                continue
            if c in NUMERIC_BY_ROLE:
                level, source = f"CAST({_bin(c, f'e_{c}')} AS DOUBLE)", "filled, filled_deciles"
            else:
                level, source = c, "filled"
            parts.append(
                f"SELECT '{y}' AS label, '{c}' AS feature, {level} AS level, {y} AS y, count(*) AS n FROM {source} GROUP BY 3, 4"
            )
    return _union(parts)


MI = f"""mi_cells AS ({_mi_cells()}), mi_shares AS (
  SELECT *, CAST(sum(n) OVER (PARTITION BY label, feature) AS DOUBLE) AS total,
    CAST(sum(n) OVER (PARTITION BY label, feature, level) AS DOUBLE) AS nx,
    CAST(sum(n) OVER (PARTITION BY label, feature, y) AS DOUBLE) AS ny FROM mi_cells
), mi_sums AS (
  SELECT label, feature, sum(n / total * ln(n * total / (nx * ny))) AS mi, count(DISTINCT level) AS n_bins,
    count(DISTINCT y) AS n_classes, max(total) AS total FROM mi_shares GROUP BY label, feature
), mutual AS (
  SELECT label, feature, n_bins, greatest(mi, 0) AS mutual_information,
    greatest(mi - (n_bins - 1) * (n_classes - 1) / (2 * total), 0) AS corrected FROM mi_sums
)"""


def _neighbour_parts() -> list[str]:
    """Nearest neighbours by windows over each label, nearer rows by a range frame, digamma from
    harmonic numbers. The grid and the spread of equal values are those of the operator."""
    features = [c for c in NAMES if c != "is_fraud"]
    drawn = f"((tx_id % {PRIME} * {FIRST_STEP} + i * {FEATURE_STEP}) % {PRIME} * {SECOND_STEP} % {PRIME}) >> {31 - NOISE_BITS}"
    cells = _union(
        [
            f"SELECT {i} AS i, '{c}' AS feature, tx_id, is_fraud, is_fraud_signal, coalesce({c}, (SELECT median({c}) FROM tx)) AS x FROM tx"
            for i, c in enumerate(features)
        ]
    )
    labels = _union([f"SELECT '{y}' AS label, {y} AS y, feature, place FROM placed" for y in LABELS])
    steps = ", ".join(
        f"place - lag(place, {j}) OVER w, lead(place, {j}) OVER w - place" for j in range(1, NEIGHBOURS + 1)
    )
    return [
        f"cells AS MATERIALIZED ({cells})",
        "scales AS (SELECT i, avg(x) AS m, stddev_pop(x) AS s FROM cells GROUP BY i)",
        f"""placed AS MATERIALIZED (SELECT feature, is_fraud, is_fraud_signal, CAST(round(coalesce((x - m) / nullif(s, 0), 0)
  * {1 << GRID_BITS}) AS BIGINT) * {1 << NOISE_BITS} + ({drawn}) AS place FROM cells JOIN scales USING (i))""",
        f"long AS MATERIALIZED ({labels})",
        f"""radii AS MATERIALIZED (SELECT label, feature, y, place, n, list_sort(steps, 'ASC', 'NULLS LAST')[
  CAST(least({NEIGHBOURS}, n - 1) AS BIGINT)] AS radius FROM (SELECT *, [{steps}] AS steps,
  count(*) OVER (PARTITION BY label, feature, y) AS n FROM long
  WINDOW w AS (PARTITION BY label, feature, y ORDER BY place)) WHERE n > 1)""",
        """nearer AS MATERIALIZED (SELECT label, feature, n, count(*) OVER (PARTITION BY label, feature ORDER BY place
  RANGE BETWEEN greatest(radius, 1) - 1 PRECEDING AND greatest(radius, 1) - 1 FOLLOWING) AS m FROM radii)""",
        """harmonic AS MATERIALIZED (SELECT k, coalesce(sum(1.0::DOUBLE / (k - 1)) FILTER (WHERE k > 1) OVER (ORDER BY k), 0)
  - 0.57721566490153286 AS psi FROM (SELECT unnest(range(1, (SELECT count(*) FROM tx) + 2)) AS k))""",
    ]


def _neighbours() -> str:
    """One row per label and feature."""
    return (
        "SELECT label, feature, greatest(max(p.psi) + avg(k.psi) - avg(y.psi) - avg(m.psi), 0) AS information "
        "FROM (SELECT *, count(*) OVER (PARTITION BY label, feature) AS total FROM nearer) r "
        f"JOIN harmonic p ON p.k = r.total JOIN harmonic k ON k.k = least({NEIGHBOURS}, r.n - 1) "
        "JOIN harmonic y ON y.k = r.n JOIN harmonic m ON m.k = r.m GROUP BY label, feature"
    )


def _decile_rates() -> str:
    return _union(
        [
            f"SELECT '{y}' AS label, '{c}' AS feature, avg({y}) AS rate FROM tx, deciles "
            f"WHERE {c} IS NOT NULL AND e_{c}[1] < e_{c}[11] GROUP BY {_bin(c, f'e_{c}')}"
            for y in LABELS
            for c in NUMERIC_BY_ROLE
        ]
    )


def _level_rates() -> str:
    return _union(
        [
            f"SELECT '{y}' AS label, '{c}' AS feature, avg({y}) AS rate FROM tx WHERE {c} IS NOT NULL GROUP BY {c}"
            for y in LABELS
            for c in CATEGORICAL_BY_ROLE
        ]
    )


def _pair_rates() -> str:
    return _union(
        [
            f"SELECT '{y}' AS label, '{a}' AS feature_a, '{b}' AS feature_b, avg({y}) AS rate FROM tx "
            f"WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY {a}, {b}"
            for y in LABELS
            for a, b in combinations(CATEGORICAL_BY_ROLE, 2)
        ]
    )


def _label_spread(source: str, keys: str) -> str:
    return (
        f"SELECT {keys}, count(*) AS n_levels, round(min(rate), 6) AS min_rate, round(max(rate), 6) AS max_rate, "
        f"round(max(rate) - min(rate), 6) AS spread, max(rate) - min(rate) >= 0.08 AS flagged "
        f"FROM ({source}) GROUP BY {keys}"
    )


def _row_order(y: str) -> str:
    return f"""SELECT '{y}' AS label, round(avg(y), 6) AS label_rate,
  round(avg(y) FILTER (WHERE i < total // 2), 6) AS label_rate_first_half,
  round(avg(y) FILTER (WHERE i >= total // 2), 6) AS label_rate_second_half,
  round(avg(gap), 6) AS gap_mean, round(stddev_samp(gap), 6) AS gap_std, round(1 / avg(y), 6) AS expected_gap_mean,
  abs(avg(gap) - 1 / avg(y)) < stddev_samp(gap) AS consistent_with_iid
FROM (
  SELECT i, y, total, CASE WHEN y = 1 THEN i - lag(i) OVER (PARTITION BY y ORDER BY i) END AS gap
  FROM (SELECT row_number() OVER (ORDER BY tx_id) - 1 AS i, {y} AS y, count(*) OVER () AS total FROM tx)
)"""


VERDICT = f"""checks AS (
  SELECT label, coalesce(abs(statistic) >= 0.1, false) AS flagged FROM ({_correlations()})
  UNION ALL SELECT label, corrected >= 0.01 FROM mutual
  UNION ALL SELECT label, flagged FROM ({_label_spread(_decile_rates(), 'label, feature')})
  UNION ALL SELECT label, flagged FROM ({_label_spread(_level_rates(), 'label, feature')})
)"""


# --- features --------------------------------------------------------------------------------

LEVELS = {c: FRAUD_CONTRACT.column(c).allowed for c in CATEGORICAL_FEATURES}


def _train_fill(column: str) -> str:
    if column in NUMERIC_FEATURES:
        return f"(SELECT median({column}) FROM split WHERE split = 'train')"
    return (
        f"(SELECT {column} FROM split WHERE split = 'train' AND {column} IS NOT NULL GROUP BY {column} "
        f"ORDER BY count(*) DESC, {column} LIMIT 1)"
    )


def _numeric_fit(source: str = "split", where: str = "WHERE split = 'train'") -> str:
    """One row per numeric feature: fill, mean and population deviation of the filled column."""
    return _union(
        [
            f"SELECT '{c}' AS feature, max(f) AS fill, avg(coalesce({c}, f)) AS mean, "
            f"CASE WHEN stddev_pop(coalesce({c}, f)) = 0 THEN 1 ELSE stddev_pop(coalesce({c}, f)) END AS scale "
            f"FROM {source}, (SELECT median({c}) AS f FROM {source} {where}) {where}"
            for c in NUMERIC_FEATURES
        ]
    )


NUMERIC_FIT = f"numeric_fit AS MATERIALIZED ({_numeric_fit()})"


def _scaled() -> str:
    return ", ".join(
        f"round((coalesce({c}, (SELECT fill FROM numeric_fit WHERE feature = '{c}')) "
        f"- (SELECT mean FROM numeric_fit WHERE feature = '{c}')) "
        f"/ (SELECT scale FROM numeric_fit WHERE feature = '{c}'), 6) AS numeric__{c}"
        for c in NUMERIC_FEATURES
    )


def _onehot(source: str = "") -> str:
    lead = f"{source}." if source else ""
    return ", ".join(
        f"CAST(coalesce({lead}{c}, {_train_fill(c)}) = {level} AS DOUBLE) AS categorical__{c}_{str(level).replace('.', '_')}"
        for c in CATEGORICAL_FEATURES
        for level in LEVELS[c]
    )


SLOTS = [("numeric", c, f"numeric__{c}") for c in NUMERIC_FEATURES] + [
    ("categorical", c, f"categorical__{c}_{level}") for c in CATEGORICAL_FEATURES for level in LEVELS[c]
]


# --- evaluation ------------------------------------------------------------------------------


def _scored(threshold: float = 0.5, name: str = "scored") -> str:
    return f"""{name} AS MATERIALIZED (
  SELECT tx_id, is_fraud AS y, score, CAST(score > {threshold}::DOUBLE AS INTEGER) AS p
  FROM (SELECT tx_id, is_fraud, CAST((tx_id * 48271 + 7) % 1009 AS DOUBLE) / 1009.0::DOUBLE AS score FROM tx)
)"""


def _confusion(source: str = "scored") -> str:
    return (
        "SELECT count(*) FILTER (WHERE y = 1 AND p = 1) AS tp, count(*) FILTER (WHERE y = 0 AND p = 1) AS fp, "
        "count(*) FILTER (WHERE y = 1 AND p = 0) AS fn, count(*) FILTER (WHERE y = 0 AND p = 0) AS tn "
        f"FROM {source}"
    )


METRICS = (
    "round((tp + tn) / CAST(tp + fp + fn + tn AS DOUBLE), 6) AS accuracy, "
    "round(coalesce(tp / CAST(nullif(tp + fp, 0) AS DOUBLE), 0), 6) AS precision, "
    "round(coalesce(tp / CAST(nullif(tp + fn, 0) AS DOUBLE), 0), 6) AS recall, "
    "round(coalesce(2 * tp / CAST(nullif(2 * tp + fp + fn, 0) AS DOUBLE), 0), 6) AS f1"
)
RANKED = """ranked AS (
  SELECT score, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM (
    SELECT score, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y = 0) AS neg FROM scored GROUP BY score
  ) WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)"""
RUNS = [_scored(t, f"scored_{int(t * 10)}") for t in (0.3, 0.5, 0.7)]
RUN_METRICS = "runs AS (" + _union(
    [
        f"SELECT 'threshold-{t}' AS run_id, {METRICS} FROM ({_confusion(f'scored_{int(t * 10)}')})"
        for t in (0.3, 0.5, 0.7)
    ]
) + ")"


# --- monitoring ------------------------------------------------------------------------------

LOG = """log AS MATERIALIZED (
  SELECT event_id, ts, user_id, event_type <> 'error' AS served, value / 1000 AS latency FROM events
)"""


def _start(unit: str) -> str:
    return f"strftime(date_trunc('{unit}', ts), {STAMP})"


def _served() -> str:
    return (
        f"SELECT {_start('hour')} AS window_start, count(*) AS n_requests, "
        "count(*) FILTER (WHERE served) AS n_served FROM log GROUP BY 1"
    )


def _anchored(quota: int, width: str) -> str:
    """Walks every client's chain of windows, one window at a time."""
    chain = f"""chain AS (
  SELECT user_id, min(ts) AS opened FROM log GROUP BY user_id
  UNION ALL
  SELECT c.user_id, min(l.ts) FROM chain c
  JOIN log l ON l.user_id = c.user_id AND l.ts >= c.opened + INTERVAL '{width}' GROUP BY c.user_id
)"""
    return (
        f"WITH RECURSIVE {LOG}, {chain} SELECT l.event_id, l.user_id, strftime(opened, '%Y-%m-%d %H:%M:%S.%f') AS window_start, "
        f"row_number() OVER (PARTITION BY l.user_id, opened ORDER BY l.ts, l.event_id) <= {quota} AS admitted "
        "FROM log l ASOF JOIN chain c ON l.user_id = c.user_id AND l.ts >= c.opened"
    )


def _limited(quota: int, unit: str) -> str:
    return (
        f"SELECT user_id, {_start(unit)} AS window_start, count(*) AS n_requests, "
        f"least(count(*), {quota}) AS n_admitted, greatest(count(*) - {quota}, 0) AS n_rejected "
        "FROM log GROUP BY 1, 2"
    )


def _edge_values() -> str:
    rows = ", ".join(f"({i}, {e}::DOUBLE, '{e}')" for i, e in enumerate(LATENCY_EDGES))
    return f"edges(i, le, text) AS (VALUES {rows}, ({len(LATENCY_EDGES)}, 'inf'::DOUBLE, '+Inf'))"


def _bucket_quantile() -> str:
    return f"""WITH {LOG}, {_edge_values()}, spots AS (
  SELECT {_start('minute')} AS window_start, i, le, count(*) FILTER (WHERE latency <= le) AS c, count(*) AS n
  FROM log, edges GROUP BY 1, 2, 3
), steps AS (
  SELECT *, coalesce(lag(c) OVER w, 0) AS c0, coalesce(lag(le) OVER w, 0) AS low
  FROM spots WINDOW w AS (PARTITION BY window_start ORDER BY i)
), hit AS (
  SELECT * FROM steps WHERE c >= 0.5::DOUBLE * n QUALIFY row_number() OVER (PARTITION BY window_start ORDER BY i) = 1
)
SELECT window_start, n, round(CASE WHEN i = {len(LATENCY_EDGES)} THEN low
  ELSE low + (le - low) * (0.5::DOUBLE * n - c0) / (c - c0) END, 9) AS latency_quantile FROM hit"""


def _rates(scrape: int, width: int, counted: str, key: str) -> str:
    """Samples of counters that start again each day, and their rates over ranges side by side.
    ``counted`` gives (key, slot, c); all parts are computed by windows over whole series."""
    return f"""slotted AS (
  SELECT CAST(ceil(epoch_us(ts) / CAST({scrape * 1_000_000} AS DOUBLE)) AS BIGINT) AS slot, served, latency FROM log
), counted AS ({counted}), grid AS (
  SELECT k.{key}, unnest(range(lo, hi + 1)) AS slot
  FROM (SELECT min(slot) AS lo, max(slot) AS hi FROM slotted), (SELECT DISTINCT {key} FROM counted) k
), samples AS (
  SELECT {key}, slot * {scrape} AS t, CAST(sum(coalesce(c, 0)) OVER (
    PARTITION BY {key}, slot * {scrape} // 86400 ORDER BY slot) AS DOUBLE) AS v
  FROM grid LEFT JOIN counted USING ({key}, slot)
), resets AS (
  SELECT *, CASE WHEN lag(v) OVER w > v THEN lag(v) OVER w ELSE 0 END AS lost
  FROM samples WINDOW w AS (PARTITION BY {key} ORDER BY t)
), ranges AS (
  SELECT {key}, CAST(ceil(t / {float(width)}::DOUBLE) AS BIGINT) * {width} AS due, count(*) AS n, min(t) AS t0, max(t) AS t1,
    arg_min(v, t) AS begun, arg_max(v, t) - arg_min(v, t) + sum(lost) - arg_min(lost, t) AS growth
  FROM resets GROUP BY 1, 2 HAVING count(*) > 1
), spans AS (
  SELECT {key}, due, n, growth, begun, CAST(t1 - t0 AS DOUBLE) AS covered, CAST(t0 - (due - {width}) AS DOUBLE) AS head,
    CAST(due - t1 AS DOUBLE) AS tail, CAST(t1 - t0 AS DOUBLE) / (n - 1) AS spacing FROM ranges
), ends AS (
  SELECT *, CASE WHEN head >= 1.1::DOUBLE * spacing THEN spacing / 2 ELSE head END AS h,
    CASE WHEN tail >= 1.1::DOUBLE * spacing THEN spacing / 2 ELSE tail END AS e FROM spans
), rates AS (
  SELECT {key}, due AS t, n, growth * (covered + CASE WHEN growth > 0 THEN least(h, covered * begun / growth) ELSE h END + e)
    / covered / {width} AS rate FROM ends
)"""


def _counter_rate() -> str:
    counted = "SELECT 0 AS series, slot, count(*) FILTER (WHERE served) AS c FROM slotted GROUP BY slot"
    return f"WITH {LOG}, {_rates(15, 60, counted, 'series')} SELECT t, n, round(rate, 6) AS rate FROM rates"


def _rate_quantile() -> str:
    counted = "SELECT i, slot, count(*) FILTER (WHERE latency <= le) AS c FROM slotted, edges GROUP BY i, slot"
    return f"""WITH {LOG}, {_edge_values()}, {_rates(60, 3600, counted, 'i')}, steps AS (
  SELECT t, i, le, rate AS c, max(CASE WHEN i = {len(LATENCY_EDGES)} THEN rate END) OVER (PARTITION BY t) AS total,
    coalesce(lag(rate) OVER w, 0) AS c0, coalesce(lag(le) OVER w, 0) AS low
  FROM rates JOIN edges USING (i) WINDOW w AS (PARTITION BY t ORDER BY i)
), hit AS (
  SELECT * FROM steps WHERE c >= 0.95::DOUBLE * total QUALIFY row_number() OVER (PARTITION BY t ORDER BY i) = 1
)
SELECT t, round(CASE WHEN total = 0 THEN NULL WHEN i = {len(LATENCY_EDGES)} THEN low
  ELSE low + (le - low) * (0.95::DOUBLE * total - c0) / (c - c0) END, 6) AS quantile_of_rates FROM hit"""


def _stream_guards() -> str:
    start = f"strftime(time_bucket(INTERVAL '7 days', tx_ts, TIMESTAMP '1970-01-01'), {STAMP})"
    return _union(
        [
            f"SELECT {start} AS window_start, count(*) AS n_rows, '{p.guard_name}' AS rule_name, "
            f"count(*) FILTER (WHERE {p.column} IS NULL) AS n_missing, "
            f"round(count(*) FILTER (WHERE {p.column} IS NULL) / CAST(count(*) AS DOUBLE), 6) AS missing_rate, "
            f"count(*) FILTER (WHERE {p.column} IS NULL) / CAST(count(*) AS DOUBLE) <= {p.ceiling} AS passed "
            "FROM tx GROUP BY 1"
            for p in FRAUD_POLICIES
        ]
    )


# --- the statements --------------------------------------------------------------------------


def _target(source: str, table: str, column: str) -> str:
    bad = f"count(*) FILTER (WHERE {column} NOT IN (0, 1))"
    gone = f"count(*) FILTER (WHERE {column} IS NULL)"
    return (
        f"SELECT '{source}' AS source, count(*) AS n_rows, {gone} AS n_missing, {bad} AS n_invalid, "
        f"{gone} = 0 AND {bad} = 0 AS passed FROM {table}"
    )


def _results(table: str) -> str:
    suite = _union([_suite_select(i, table) for i in range(len(FRAUD_SUITE))])
    return _union(
        [
            f"SELECT rule_name, 'core' AS category, passed, n_invalid FROM ({_all_rules(table, 'tx_id, ')})",
            "SELECT 'expectation_suite' AS rule_name, 'expectation_suite' AS category, bool_and(success) AS passed, "
            f"count(*) FILTER (WHERE NOT success) AS n_invalid FROM ({suite})",
        ]
    )


def _report(source: str, table: str) -> str:
    return (
        f"SELECT '{source}' AS source, (SELECT count(*) FROM {table}) AS row_count, CAST({len(NAMES)} AS INTEGER) AS column_count, "
        f"bool_and(passed) OVER () AS report_passed, rule_name, category, passed, n_invalid FROM ({_results(table)})"
    )


def _conformance() -> str:
    selects = []
    for spec in FRAUD_CONTRACT.columns:
        if spec.name == "network_quality":
            gone = "count(*) FILTER (WHERE network_quality IS NULL AND tx_id % 1000 <> 7)"
            bad = "count(*) FILTER (WHERE tx_id % 1000 = 7)"
        else:
            gone, bad = f"count(*) FILTER (WHERE {spec.name} IS NULL)", "0::BIGINT"
        selects.append(
            f"SELECT '{spec.name}' AS column_name, '{spec.logical_type}' AS expected_type, {gone} AS n_missing, "
            f"{bad} AS n_nonconforming, {bad} = 0 AS passed FROM tx"
        )
    return _union(selects)


def _schema_errors(rule: str, errors: list[str]) -> str:
    values = ", ".join(f"('{rule}', '{e}')" for e in errors)
    return _with(TX, body=f"SELECT (SELECT count(*) FROM tx) AS n_rows, rule_name, error FROM (VALUES {values}) v(rule_name, error)")


def statements() -> dict[str, str]:
    sql: dict[str, str] = {}

    typed = ", ".join(
        "CASE WHEN tx_id % 1000 = 7 THEN NULL ELSE network_quality END AS network_quality"
        if c == "network_quality"
        else ("CAST(is_fraud AS BIGINT) AS is_fraud" if c == "is_fraud" else c)
        for c in NAMES
    )
    sql["csv_scan_typed"] = _with(TX, body=f"SELECT tx_id, {typed} FROM tx")
    sql["type_conformance"] = _with(TX, body=_conformance())
    sql["target_contract"] = _with(
        TX,
        DIRTY,
        "doc AS (SELECT d.doc_id, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)",
        body=_union(
            [
                _target("transactions.is_fraud", "tx", "is_fraud"),
                _target("dirty.is_fraud", "dirty", "is_fraud"),
                _target("documents.quality", "doc", "quality"),
                _target("documents.toxic", "doc", "toxic"),
            ]
        ),
    )
    gate = f"(SELECT bool_and(passed) FROM ({_results('tx')}))"
    sql["validated_table"] = _with(TX, IMPUTED, body=f"SELECT * FROM imputed WHERE {gate}")
    sql["impute_all"] = _with(TX, IMPUTED, body="SELECT * FROM imputed")
    sql["validation_report"] = _with(TX, DIRTY, body=_union([_report("clean", "tx"), _report("dirty", "dirty")]))
    sql["processed_table"] = _with(
        TX, IMPUTED, _split("imputed"), NUMERIC_FIT, body=f"SELECT tx_id, is_fraud, split, {_scaled()}, {_onehot()} FROM split"
    )
    slots = ", ".join(f"({i}, '{name}', '{c}', '{block}')" for i, (block, c, name) in enumerate(SLOTS))
    sql["feature_metadata"] = (
        "SELECT CAST(slot AS INTEGER) AS slot, feature_name, feature, block, "
        f"CAST({len(SLOTS)} AS INTEGER) AS n_features_out, CAST(42 AS INTEGER) AS random_seed, "
        f"CAST(0.2 AS DOUBLE) AS test_size FROM (VALUES {slots}) v(slot, feature_name, feature, block)"
    )
    sql["run_compare"] = _with(TX, *RUNS, RUN_METRICS, body="SELECT run_id, accuracy, precision, recall, f1 FROM runs")
    sql["best_run"] = _with(
        TX, *RUNS, RUN_METRICS, body="SELECT run_id, f1 AS metric_value FROM runs ORDER BY f1 DESC, run_id LIMIT 1"
    )

    sql["schema_required"] = _schema_errors("required_columns", ["required column network_quality is missing"])
    sql["schema_types"] = _schema_errors("datatypes", ["column store_type should be float but is string"])
    sql["schema_unexpected"] = _schema_errors(
        "no_unexpected_columns",
        ["column customer_id is not in the contract", "column is_fraud_signal is not in the contract"],
    )
    broken = _union(
        [
            "SELECT 'broken_schema' AS source, 'required_columns' AS rule_name, false AS passed, 1::BIGINT AS n_invalid",
            "SELECT 'broken_schema', 'datatypes', false, 1",
            "SELECT 'broken_schema', 'no_unexpected_columns', false, 2",
        ]
    )
    sql["validation_failfast"] = _with(
        TX, body=f"{broken}\nUNION ALL\nSELECT 'clean' AS source, rule_name, passed, n_invalid FROM ({_all_rules('tx')})"
    )
    sql["rule_results"] = _with(TX, body=_all_rules("tx"))
    sql["rule_results_dirty"] = _with(TX, DIRTY, body=_all_rules("dirty"))
    on_dirty, on_breached = _rule_selects("dirty"), _rule_selects("breached")
    for name in on_dirty:
        if name.endswith("_within_ceiling"):
            sql[f"rule_{name}"] = _with(TX, BREACHED, body=on_breached[name])
        else:
            sql[f"rule_{name}"] = _with(TX, DIRTY, body=on_dirty[name])
    offenders = []
    for column in FEATURE_RULE_ORDER:
        if FRAUD_CONTRACT.column(column).allowed is not None:
            name, predicate = _violation(column)
            offenders.append(
                f"SELECT '{name}' AS rule_name, CAST({column} AS DOUBLE) AS value, count(*) AS n_rows "
                f"FROM dirty WHERE {predicate} GROUP BY {column}"
            )
    sql["rule_offenders"] = _with(TX, DIRTY, body=_union(offenders))
    sql["rule_results_accounts"] = _union(
        [
            f"SELECT '{table}' AS source, '{name}' AS rule_name, count(*) = 0 AS passed, count(*) AS n_invalid "
            f"FROM {table} WHERE {predicate}"
            for table, name, predicate in (
                ("customer", "c_acctbal_non_negative", "c_acctbal < 0"),
                ("customer", "c_nationkey_valid", "c_nationkey NOT BETWEEN 0 AND 24"),
                ("customer", "c_name_present", "c_name IS NULL"),
                ("supplier", "s_acctbal_non_negative", "s_acctbal < 0"),
                ("part", "p_size_valid", "p_size NOT BETWEEN 1 AND 50"),
            )
        ]
    )
    row_rules = f"CASE WHEN is_fraud IS NULL THEN 'target_not_null' END, "
    text = _violations_text(list(FEATURE_RULE_ORDER)).replace("concat_ws(',', ", "concat_ws(',', " + row_rules, 1)
    sql["quarantine_rows"] = _with(
        TX, DIRTY_ONCE, body=f"SELECT tx_id, violations = '' AS is_valid, violations FROM (SELECT tx_id, {text} AS violations FROM dirty_once)"
    )
    sql["missing_rate_guard"] = _with(TX, body=_guards("tx"))
    sql["missing_rate_guard_breached"] = _with(TX, BREACHED, body=_guards("breached"))
    sql["missing_rate_by_batch"] = _with(
        TX, body=_guards("tx", "CAST(year(tx_ts) * 100 + month(tx_ts) AS INTEGER) AS batch", "GROUP BY year(tx_ts) * 100 + month(tx_ts)")
    )
    sql["ceiling_proposal"] = _with(
        TX,
        body=_union(
            [
                f"SELECT '{p.column}' AS column_name, round(r, 6) AS missing_rate, CAST({p.ceiling} AS DOUBLE) AS current_ceiling, "
                "round(ceil(round(r * 200 / 5, 9)) * 5 / 100, 6) AS proposed_ceiling "
                f"FROM (SELECT avg(CAST({p.column} IS NULL AS INTEGER)) AS r FROM tx)"
                for p in FRAUD_POLICIES
            ]
        ),
    )
    sql["expectation_suite"] = _with(
        TX, DIRTY, body=_union([_suite_select(i, "dirty") for i in range(len(FRAUD_SUITE))])
    )

    sql["impute_indicators"] = _with(
        TX, body="SELECT tx_id, " + ", ".join(f"CAST({c} IS NULL AS INTEGER) AS {c}_was_missing" for c in ANALYSED) + " FROM tx"
    )
    for strategy in ("median", "mode"):
        columns = [p.column for p in FRAUD_POLICIES if p.strategy == strategy]
        sql[f"impute_{strategy}"] = _with(TX, body=f"SELECT tx_id, {_imputed(columns)} FROM tx")
    for column in ANALYSED:
        sql[f"impute_{column}"] = _with(TX, body=f"SELECT tx_id, {_imputed([column])} FROM tx")
    sql["impute_summary"] = _with(
        TX,
        body=_union(
            [
                f"SELECT '{p.column}' AS column_name, '{p.strategy}' AS strategy, count(*) AS n_rows, "
                f"count(*) FILTER (WHERE {p.column} IS NULL) AS n_filled, "
                f"round(avg(CAST({p.column} IS NULL AS INTEGER)), 6) AS missing_rate, "
                f"round({_fill(p.column)}, 6) AS fill_value FROM tx"
                for p in FRAUD_POLICIES
            ]
        ),
    )

    sql["missing_rate_profile"] = _with(TX, body=MISSING_RATES)
    sql["label_rate_split"] = _with(TX, _label_split(), body="SELECT * FROM label_split")
    sql["missingness_correlation"] = _with(TX, _missing_correlation(), body="SELECT * FROM missing_correlation")
    sql["missing_by_category"] = _with(TX, body=_spread(_category_rates()))
    sql["missing_by_quartile"] = _with(TX, QUARTILES, body=_spread(_quartile_rates()))
    sql["missingness_report"] = _with(
        *MISSING_EVIDENCE,
        body="SELECT * FROM evidence UNION ALL SELECT 'merchant_country', 'column_not_found', NULL, NULL, false",
    )
    sql["missingness_verdict"] = _with(
        *MISSING_EVIDENCE,
        body="SELECT column_name, count(*) FILTER (WHERE flagged) AS n_flags, CASE WHEN bool_or(flagged) "
        "THEN 'INVESTIGATE' ELSE 'NO_EVIDENCE_AGAINST_MCAR' END AS verdict_hint FROM evidence GROUP BY column_name",
    )

    sql["role_inference"] = _with(
        TX,
        body=_union(
            [
                f"SELECT '{c}' AS feature, CASE WHEN count(DISTINCT {c}) > 10 THEN 'numeric' ELSE 'categorical' END AS role, "
                f"CASE WHEN count(DISTINCT {c}) <= 10 THEN count(DISTINCT {c}) END AS n_levels FROM tx"
                for c in NAMES
                if c != "is_fraud"
            ]
        ),
    )
    sql["label_correlation"] = _with(
        TX,
        body="SELECT label, feature, round(statistic, 6) AS correlation, coalesce(abs(statistic) >= 0.1, false) AS flagged "
        f"FROM ({_correlations()})",
    )
    sql["mutual_information"] = _with(
        TX, FILLED, FILLED_DECILES, MI,
        body="SELECT label, feature, n_bins, round(mutual_information, 6) AS mutual_information, "
        "round(corrected, 6) AS corrected, corrected >= 0.01 AS flagged FROM mutual",
    )
    sql["neighbour_information"] = _with(
        TX, *_neighbour_parts(),
        body="SELECT label, feature, round(information, 6) AS mutual_information, information >= 0.01 AS flagged "
        f"FROM ({_neighbours()})",
    )
    sql["decile_spread"] = _with(TX, DECILES, body=_label_spread(_decile_rates(), "label, feature"))
    sql["category_spread"] = _with(TX, body=_label_spread(_level_rates(), "label, feature"))
    sql["category_rates"] = _with(
        TX,
        body=_union(
            [
                f"SELECT '{y}' AS label, '{c}' AS feature, CAST({c} AS VARCHAR) AS level, count(*) AS n, "
                f"CAST(sum({y}) AS BIGINT) AS positives, round(avg({y}), 6) AS label_rate FROM tx "
                f"WHERE {c} IS NOT NULL GROUP BY {c}"
                for y in LABELS
                for c in CATEGORICAL_BY_ROLE
            ]
        ),
    )
    sql["interaction_spread"] = _with(TX, body=_label_spread(_pair_rates(), "label, feature_a, feature_b"))
    sql["interaction_cells"] = (
        "SELECT 'l_returnflag' AS feature_a, 'l_linestatus' AS feature_b, l_returnflag AS level_a, l_linestatus AS level_b, "
        "count(*) AS n, count(*) FILTER (WHERE l_discount > 0.05::DOUBLE) AS positives, "
        "round(avg(CAST(l_discount > 0.05::DOUBLE AS INTEGER)), 6) AS label_rate FROM lineitem GROUP BY 3, 4"
    )
    sql["row_order_gaps"] = _with(TX, body=_union([_row_order(y) for y in LABELS]))
    sql["signal_verdict"] = _with(
        TX, DECILES, FILLED, FILLED_DECILES, MI, VERDICT,
        body="SELECT label, count(*) AS n_checks, count(*) FILTER (WHERE flagged) AS n_flagged, "
        "CASE WHEN bool_or(flagged) THEN 'SIGNAL_DETECTED' ELSE 'NO_SIGNAL_DETECTED' END AS verdict FROM checks GROUP BY label",
    )

    kept = ", ".join(["tx_id", *NAMES])
    sql["drop_indicators"] = _with(TX, IMPUTED, body=f"SELECT {kept} FROM imputed")
    sql["stratified_split"] = _with(TX, _split("tx"), body="SELECT tx_id, is_fraud, split FROM split")
    sql["fit_numeric"] = _with(
        TX, _split("tx"), NUMERIC_FIT,
        body="SELECT feature, round(fill, 6) AS fill, round(mean, 6) AS mean, round(scale, 6) AS scale FROM numeric_fit",
    )
    sql["fit_categories"] = _with(
        TX, _split("tx"),
        body=_union(
            [
                f"SELECT '{c}' AS feature, {_train_fill(c)} AS fill, {c} AS level FROM split "
                f"WHERE split = 'train' AND {c} IS NOT NULL GROUP BY {c}"
                for c in CATEGORICAL_FEATURES
            ]
        ),
    )
    sql["scale_numeric"] = _with(TX, _split("tx"), NUMERIC_FIT, body=f"SELECT tx_id, split, {_scaled()} FROM split")
    sql["onehot"] = _with(
        TX, DIRTY_ONCE, _split("tx"),
        body=f"SELECT split.tx_id, split.split, {_onehot('d')} FROM split JOIN dirty_once d ON d.tx_id = split.tx_id",
    )
    sql["leakage_check"] = _with(
        TX, _split("tx"), NUMERIC_FIT, f"full_fit AS MATERIALIZED ({_numeric_fit('tx', '')})",
        body="SELECT t.feature, " + ", ".join(
            f"round({side}.{v}, 6) AS {name}_{v}"
            for v in ("fill", "mean", "scale") for side, name in (("t", "train"), ("a", "full"))
        ) + ", round(t.mean - a.mean, 6) AS mean_gap FROM numeric_fit t JOIN full_fit a ON t.feature = a.feature",
    )

    sql["split_alignment"] = _with(
        TX, _split("tx"),
        body="SELECT split, count(*) AS n_features, count(*) AS n_labels, 0::BIGINT AS features_without_label, "
        "0::BIGINT AS labels_without_features FROM split GROUP BY split",
    )
    sql["class_weights"] = _with(
        TX, _split("tx"),
        body="SELECT is_fraud AS label, count(*) AS n, round(sum(count(*)) OVER () / "
        "CAST(count(*) OVER () * count(*) AS DOUBLE), 6) AS weight FROM split WHERE split = 'train' GROUP BY is_fraud",
    )
    sql["binary_metrics"] = _with(TX, _scored(), body=f"SELECT tp, fp, fn, tn, {METRICS} FROM ({_confusion()})")
    sql["weighted_f1"] = _with(
        TX, _scored(),
        body="SELECT round(a, 6) AS f1_positive, round(b, 6) AS f1_negative, "
        "round((a * (tp + fn) + b * (tn + fp)) / (tp + fp + fn + tn), 6) AS f1_weighted FROM (SELECT *, "
        "2 * tp / CAST(2 * tp + fp + fn AS DOUBLE) AS a, 2 * tn / CAST(2 * tn + fp + fn AS DOUBLE) AS b "
        f"FROM ({_confusion()}))",
    )
    sql["roc_auc"] = _with(
        TX, _scored(), RANKED,
        body="SELECT CAST(sum(pos) AS BIGINT) AS n_positive, CAST(sum(neg) AS BIGINT) AS n_negative, "
        "round(sum(neg * (tp - pos / 2.0::DOUBLE)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)), 6) AS roc_auc FROM ranked",
    )
    sql["average_precision"] = _with(
        TX, _scored(), RANKED,
        body="SELECT CAST(sum(pos) AS BIGINT) AS n_positive, "
        "round(sum(pos * tp / CAST(tp + fp AS DOUBLE)) / sum(pos), 6) AS average_precision FROM ranked",
    )

    cells = ["tx_id", "CAST(round(transaction_amount * 100) AS BIGINT)"]
    cells += [f"CAST({c} AS BIGINT)" for c in (*CATEGORICAL_FEATURES, "num_items", "is_fraud")]
    row_text = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in cells)
    sql["table_fingerprint"] = _with(
        TX,
        body="SELECT count(*) AS n_rows, CAST(sum(CAST(h AS HUGEINT)) AS VARCHAR) AS hash_sum, bit_xor(h) AS hash_xor FROM "
        f"(SELECT CAST('0x' || substr(md5({row_text}), 1, 12) AS BIGINT) AS h FROM tx)",
    )
    whole = ["tx_id"]
    for c in (c for c in NAMES if c != "is_fraud"):
        first = f"((abs({c}) - floor(abs({c}))) * 4503599627370496.0::DOUBLE)"
        second = f"(({first} - floor({first})) * 4503599627370496.0::DOUBLE)"
        whole.append(f"CASE WHEN {c} < 0 THEN 1 WHEN {c} >= 0 THEN 0 END")
        whole += [f"CAST(floor({x}) AS BIGINT)" for x in (f"abs({c})", first, second)]
    whole.append("CAST(is_fraud AS BIGINT)")
    whole_text = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in whole)
    sql["table_fingerprint_all"] = _with(
        TX,
        body="SELECT count(*) AS n_rows, CAST(sum(CAST(h AS HUGEINT)) AS VARCHAR) AS hash_sum, bit_xor(h) AS hash_xor FROM "
        f"(SELECT CAST('0x' || substr(md5({whole_text}), 1, 12) AS BIGINT) AS h FROM tx)",
    )
    bounded = [c for c in NUMERIC_FEATURES if FRAUD_CONTRACT.column(c).minimum is not None]
    fields = list(NUMERIC_FEATURES + CATEGORICAL_FEATURES)
    sql["score_contract"] = _with(
        TX, DIRTY_ONCE,
        body="SELECT tx_id, violations = '' AS accepted, violations FROM "
        f"(SELECT tx_id, {_violations_text(bounded, fields)} AS violations FROM dirty_once)",
    )

    sql["served_counter"] = _with(
        LOG, body=f"SELECT *, CAST(sum(n_served) OVER (ORDER BY window_start) AS BIGINT) AS served_total FROM ({_served()})"
    )
    sql["served_counter_stream"] = _with(LOG, body=_served())
    sql["latency_histogram"] = _with(
        LOG, _edge_values(),
        body=f"SELECT {_start('day')} AS window_start, text AS le, count(*) FILTER (WHERE latency <= le) AS cumulative "
        "FROM log, edges GROUP BY 1, 2",
    )
    sql["bucket_quantile"] = _bucket_quantile()
    sql["rate_limit"] = _with(
        LOG,
        body=f"SELECT event_id, user_id, {_start('minute')} AS window_start, row_number() OVER (PARTITION BY user_id, "
        "date_trunc('minute', ts) ORDER BY ts, event_id) <= 1 AS admitted FROM log",
    )
    sql["counter_rate"] = _counter_rate()
    sql["rate_quantile"] = _rate_quantile()
    sql["rate_limit_anchored"] = _anchored(1, "1 minute")
    sql["rate_limit_anchored_quota"] = _anchored(2, "6 hours")
    sql["admitted_stream_quota"] = _with(
        LOG,
        body="SELECT event_id, user_id, strftime(start, {0}) AS window_start FROM (SELECT *, "
        "time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '1970-01-01') AS start FROM log) QUALIFY row_number() OVER "
        "(PARTITION BY user_id, start ORDER BY ts, event_id) <= 3".format(STAMP),
    )
    sql["rate_limit_summary"] = _with(LOG, body=_limited(2, "hour"))
    sql["rate_limit_stream"] = _with(LOG, body=_limited(1, "hour"))
    sql["admitted_stream"] = _with(
        LOG,
        body=f"SELECT event_id, user_id, {_start('hour')} AS window_start FROM log QUALIFY row_number() OVER "
        "(PARTITION BY user_id, date_trunc('hour', ts) ORDER BY ts, event_id) = 1",
    )
    sql["missing_rate_stream"] = _with(TX, body=_stream_guards())
    return sql
