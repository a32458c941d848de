"""Secret scan: candidates in whole texts, judged by a random forest.

A candidate is a run of 16 or more key-like characters with a digit or with mixed case, a run of 8
or more that is assigned to a name (after = or :), or a private key block. An equals sign ends a
run (``NAME=value`` is a name and a value); only one or two as padding belong to it. The forest looks at its
length, character transitions, dictionary coverage, path signs and neighbouring words. It learns
from labelled findings; without a table of them, from the findings whose surroundings settle the
matter (named assignments and provider prefixes against numbers, words and paths).

Defined results: null or empty text has no candidates; a null key is carried through; repeated
rows are scanned one by one; without labelled findings of both kinds every score is the share of
secrets among them (0 if there are none); an empty table gives no rows.
"""

from __future__ import annotations

import re
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.textkit import Texts, row_digest, text_chunks
from plumbline.workspace import Workspace

LONG, ASSIGNED = 16, 8
# Bytes looked at around a candidate for its neighbouring words.
AROUND = 48
# Bounds of what is learned from: labelled findings, and words of the dictionary.
MAX_FINDINGS, DICTIONARY_WORDS = 20_000, 5_000
TREES, DEPTH, SEED, THRESHOLD = 24, 6, 5, 0.5
MASK = "[SECRET]"

KEY_BYTES = np.array(
    [bytes([b]).isalnum() and b < 0x80 or b in b"+/_-." for b in range(256)], dtype=bool
)
# Names that secrets are assigned to, and prefixes that providers give their keys.
NAMES = (
    "token", "secret", "password", "passwd", "pwd", "apikey", "api_key", "api-key", "auth",
    "credential", "private_key", "access_key", "client_secret",
)
PREFIXES = (
    "AKIA", "ASIA", "ghp_", "gho_", "ghs_", "github_pat_", "glpat-", "xoxb-", "xoxp-", "sk_live_",
    "rk_live_", "AIza", "eyJ", "npm_", "SG.",
)
# From the last BEGIN before an END: one without its END takes no later key with it.
BLOCK = re.compile(
    rb"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:(?!-----BEGIN ).)*?-----END [A-Z ]*PRIVATE KEY-----",
    re.S,
)
BLOCK_MARK = b"PRIVATE KEY-----"
FINDING = "start long, end long, value string, before string, after string"
FEATURES = (
    "length", "digit_share", "upper_share", "lower_share", "distinct_share", "entropy",
    "class_changes", "hex_only", "dictionary", "path_signs", "dots", "assigned", "quoted",
    "named", "name_distance", "prefix", "neighbour_words", "block",
)
KINDS = pa.struct([
    ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string()), ("before", pa.string()),
    ("after", pa.string()),
])


def _padded(data: np.ndarray, start: int, end: int, high: int) -> int:
    """Where the run ends with its padding: one or two equals signs that nothing is assigned by."""
    pad = end
    while pad < high and data[pad] == 0x3D:
        pad += 1
    if not end < pad <= end + 2:
        return end
    after = int(data[pad]) if pad < high else 0x20
    opens = after in b"\"'" and (start == 0 or int(data[start - 1]) != after)
    return end if KEY_BYTES[after] or opens else pad


def candidates(texts: Texts) -> list[list[dict]]:
    """The findings of each text, with positions in characters."""
    data = texts.data
    found: list[list[dict]] = [[] for _ in range(texts.n)]
    first_char = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=first_char[1:])
    runs = texts.words(KEY_BYTES, lower=False)

    def share(flags: np.ndarray) -> np.ndarray:
        running = np.zeros(len(data) + 1, dtype=np.int64)
        np.cumsum(flags, out=running[1:])
        return running

    size = runs.ends - runs.starts
    digit = share((data >= 0x30) & (data <= 0x39))
    upper = share((data >= 0x41) & (data <= 0x5A))
    lower = share((data >= 0x61) & (data <= 0x7A))
    digits = digit[runs.ends] - digit[runs.starts]
    # A capital first letter does not make a word mixed.
    inside = np.minimum(runs.starts + 1, runs.ends)
    mixed = (upper[runs.ends] > upper[inside]) & (lower[runs.ends] > lower[inside])
    chosen = (size >= LONG) & ((digits > 0) | mixed)
    lows = np.maximum(runs.starts - 4, texts.offsets[runs.text_of])
    signs = share((data == 0x3D) | (data == 0x3A))
    assigned = signs[runs.starts] > signs[lows]
    for i in np.flatnonzero((size >= ASSIGNED) & assigned & ~chosen):
        lead = data[lows[i] : runs.starts[i]].tobytes()
        quoted = b'"' in lead or b"'" in lead
        chosen[i] = bool(re.search(rb"[=:]\s*[\"']?$", lead)) and (digits[i] > 0 or quoted)
    spans = []
    for i in np.flatnonzero(chosen):
        owner, start, end = int(runs.text_of[i]), int(runs.starts[i]), int(runs.ends[i])
        spans.append((owner, start, _padded(data, start, end, int(texts.offsets[owner + 1]))))
    whole = data.tobytes()
    marks = [m.start() for m in re.finditer(re.escape(BLOCK_MARK), whole)]
    blocks = []
    for owner in np.unique(np.searchsorted(texts.offsets, marks, side="right") - 1).tolist():
        low, high = int(texts.offsets[owner]), int(texts.offsets[owner + 1])
        own = BLOCK.finditer(whole[low:high])
        blocks += [(owner, low + m.start(), low + m.end()) for m in own]
    if blocks:
        firsts, lasts = np.array([b[1] for b in blocks]), np.array([b[2] for b in blocks])
        at = np.array([s[1] for s in spans], dtype=np.int64)
        near = np.searchsorted(firsts, at, side="right") - 1
        inside = (near >= 0) & (at < lasts[near])
        spans = [s for s, x in zip(spans, inside) if not x] + blocks
    for owner, start, end in sorted(spans):
        # A final dot of a sentence is not part of a key.
        while end - start > ASSIGNED and data[end - 1] == 0x2E:
            end -= 1
        low, high = texts.offsets[owner], texts.offsets[owner + 1]
        found[owner].append(
            {
                "start": int(first_char[start] - first_char[low]),
                "end": int(first_char[end] - first_char[low]),
                "value": whole[start:end].decode("ascii", "replace"),
                "before": whole[max(start - AROUND, low) : start].decode("utf-8", "ignore"),
                "after": whole[end : min(end + AROUND, high)].decode("utf-8", "ignore"),
            }
        )
    return found


def find_candidates(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """A row per candidate of every whole text."""
    inner = [f"_k{i}" for i in range(len(keep))]
    narrow = df.select(
        *[df[f"`{c}`"].alias(k) for c, k in zip(keep, inner)],
        df[f"`{text}`"].cast("string").alias("_text"),
    )
    kinds = ", ".join(f"{k} {narrow.schema[k].dataType.simpleString()}" for k in inner)

    def work(batches):
        for batch in batches:
            for first, end, texts in text_chunks(batch.column("_text")):
                found = candidates(texts)
                rows = [i for i, f in enumerate(found) for _ in f]
                if not rows:
                    continue
                take = pa.array([first + i for i in rows], type=pa.int64())
                flat = pa.array([x for f in found for x in f], type=KINDS)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(k).take(take) for k in inner], *flat.flatten()],
                    names=[*inner, *[f.name for f in KINDS]],
                )

    made = narrow.mapInArrow(work, f"{kinds}, {FINDING}" if kinds else FINDING)
    return made.withColumnsRenamed(dict(zip(inner, keep)))


def dictionary(findings: DataFrame) -> list[str]:
    """The most frequent words next to candidates, over all findings."""
    words = findings.select(
        F.explode(F.split(F.lower(F.concat_ws(" ", "before", "after")), r"[^\p{L}]+")).alias("w")
    ).where(F.length("w") >= 3)
    counts = words.groupBy("w").agg(F.count(F.lit(1)).alias("n")).where("n >= 3")
    best = counts.orderBy(F.desc("n"), "w").limit(DICTIONARY_WORDS)
    return [r["w"] for r in best.collect()]


def _covered(value: str, words: set[str], longest: int) -> float:
    """Share of the value's characters inside dictionary words, longest first."""
    text, at, covered = value.lower(), 0, 0
    while at < len(text):
        for size in range(min(longest, len(text) - at), 2, -1):
            if text[at : at + size] in words:
                covered, at = covered + size, at + size
                break
        else:
            at += 1
    return covered / max(len(value), 1)


def features_of(value: str, before: str, after: str, words: set[str], longest: int) -> list[float]:
    """FEATURES of one finding."""
    n = max(len(value), 1)
    kinds = [0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3 for c in value]
    counts = np.unique(list(value) or [""], return_counts=True)[1] / n
    lead = before.lower()
    named = max((lead.rfind(name) for name in NAMES), default=-1)
    tail = re.split(r"\s", before)[-1]
    near = re.findall(r"[^\W\d_]+", before[-24:] + " " + after[:24])
    return [
        float(len(value)),
        kinds.count(0) / n,
        kinds.count(2) / n,
        kinds.count(1) / n,
        len(counts) / n,
        float(-(counts * np.log2(counts)).sum()),
        sum(a != b for a, b in zip(kinds, kinds[1:])) / n,
        float(bool(re.fullmatch(r"[0-9a-fA-F-]+", value))),
        _covered(value, words, longest),
        float((tail + value + after[:1]).count("/")),
        value.count(".") / n,
        float(bool(re.search(r"[=:]\s*[\"']?$", before))),
        float(before[-1:] in "\"'" and before[-1:] != "" and after[:1] in "\"'" and after[:1] != ""),
        float(named >= 0),
        float(len(lead) - named) if named >= 0 else float(AROUND),
        float(value.startswith(PREFIXES)),
        sum(w.lower() in words for w in near) / max(len(near), 1),
        float(value.startswith("-----BEGIN")),
    ]


def describe(findings: DataFrame, words: list[str]) -> DataFrame:
    """``findings`` with one column per feature."""
    names = findings.columns
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in findings.schema)
    made = ", ".join(f"f_{f} double" for f in FEATURES)
    known, longest = set(words), max(map(len, words), default=0)

    def work(batches):
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("value", "before", "after")]
            table = [features_of(*row, known, longest) for row in zip(*columns)]
            numbers = np.array(table, dtype=np.float64).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(c) for c in numbers.T]],
                names=[*names, *[f"f_{f}" for f in FEATURES]],
            )

    return findings.mapInArrow(work, f"{kinds}, {made}")


def settled_findings(described: DataFrame) -> DataFrame:
    """``described`` with ``_label`` where the surroundings settle it, else null."""
    sure = (
        "f_block = 1 OR (f_prefix = 1 AND f_dictionary < 0.5) OR "
        "(f_named = 1 AND f_assigned = 1 AND f_name_distance <= 24 AND f_dictionary < 0.5 "
        "AND (f_entropy >= 2.5 OR f_quoted = 1))"
    )
    false = (
        "f_named = 0 AND f_prefix = 0 AND (f_digit_share = 1 OR f_path_signs >= 2 OR "
        "f_dictionary >= 0.5 OR f_digit_share = 0 OR f_assigned = 0)"
    )
    return described.withColumn(
        "_label", F.expr(f"CASE WHEN {sure} THEN 1 WHEN {false} THEN 0 END")
    )


def judged_findings(
    df: DataFrame,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    labelled: DataFrame | None = None,
    max_findings: int = MAX_FINDINGS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Findings of every row with ``score`` and ``is_secret``. ``labelled`` has columns value,
    before, after and label (1: a secret)."""
    workspace = Workspace.of(df.sparkSession)
    names = [f"_c{i}" for i in range(len(keep))]
    plain = df.select(
        *[df[f"`{c}`"].alias(n) for c, n in zip(keep, names)], df[f"`{text}`"].alias("_body")
    )
    findings = workspace.stage(find_candidates(plain, "_body", names), "findings")
    words = dictionary(findings)
    described = workspace.stage(describe(findings, words), "findings-described")
    if labelled is None:
        train = settled_findings(described)
    else:
        train = describe(labelled.select("value", "before", "after", "label"), words)
        train = train.withColumn("_label", F.col("label").cast("int"))
    columns = [f"f_{f}" for f in FEATURES]
    train = train.where(F.col("_label").isNotNull()).select(
        F.col("_label").cast("double").alias("_label"), *columns
    )
    train = train.orderBy(F.xxhash64(*columns), *columns).limit(max_findings)
    train = workspace.stage(train, "findings-train")
    seen = train.agg(F.count(F.lit(1)).alias("n"), F.sum("_label").alias("ones")).first()
    rate = (seen["ones"] or 0.0) / seen["n"] if seen["n"] else 0.0
    if rate in (0.0, 1.0):
        scored = described.withColumn("score", F.lit(rate))
    else:
        assemble = partial(VectorAssembler, inputCols=columns, outputCol="_x")
        forest = RandomForestClassifier(
            featuresCol="_x", labelCol="_label", probabilityCol="_p", rawPredictionCol="_raw",
            predictionCol="_predicted", numTrees=TREES, maxDepth=DEPTH, seed=SEED,
        ).fit(assemble().transform(train))
        scored = forest.transform(assemble().transform(described))
        scored = scored.withColumn("score", vector_to_array("_p")[1])
    out = scored.select(
        *[F.col(n).alias(c) for n, c in zip(names, keep)],
        "start", "end", "value", "score", (F.col("score") >= threshold).alias("is_secret"),
    )
    return out


def redact_secrets(df: DataFrame, text: str = "text", **options) -> DataFrame:
    """``df`` with every secret found replaced by MASK; all rows stay, others are unchanged."""
    plain = [f"c{i}" for i in range(len(df.columns))]
    body = plain[df.columns.index(text)]
    # Equal rows have equal findings, so a row is known by the digest of all its columns.
    rows = df.toDF(*plain)
    rows = rows.withColumn("row_key", row_digest(*[rows[c] for c in plain]))
    found = judged_findings(rows, body, ("row_key",), **options).where("is_secret")
    spans = found.groupBy("row_key").agg(
        F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans")
    )
    parts = F.expr(
        f"array_join(transform(sequence(0, size(spans)), i -> substring({body}, "
        "int(if(i = 0, 0, spans[i - 1].end)) + 1, "
        f"int(if(i = size(spans), length({body}), spans[i].start)) "
        f"- int(if(i = 0, 0, spans[i - 1].end)))), '{MASK}')"
    )
    joined = rows.join(spans.withColumnRenamed("row_key", "_row"), F.expr("row_key = _row"), "left")
    clean = F.when(F.col("spans").isNotNull(), parts).otherwise(F.col(body))
    return joined.withColumn(body, clean).select(*plain).toDF(*df.columns)
