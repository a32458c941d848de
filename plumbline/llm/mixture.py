"""Languages of a document as a mixture, from n-gram likelihoods.

Per language, byte 4-grams of letters are counted over all learned texts (hashed into 2^bits
buckets, smoothed). A document's n-grams are drawn from a mixture of the languages; expectation-
maximisation finds the proportions, and the set of languages is the one with the best likelihood
after a penalty per language.

Defined results: null text or text without a letter is ``und`` with score 0 and no proportions;
equal proportions go to the smaller language name; rows with a null language or key are scored
and never learned from; repeated rows count and are scored one by one; when nothing can be
learned everything is ``und``; extra columns are ignored.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.textkit import LOWER, Texts, crc32_mod, map_texts, text_chunks

BITS, GRAM = 16, 4
ROUNDS, SMOOTHING = 8, 0.5
# Cost of one more language, in units of log(number of n-grams).
PENALTY = 2.0
LETTERS = np.array(
    [b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in LOWER.tolist()], dtype=np.uint8
)


def grams(texts: Texts, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, bucket) of every n-gram of letters, at most one space at either end."""
    data = LETTERS[texts.data]
    n = len(data) - GRAM + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    owner = np.repeat(np.arange(texts.n), np.diff(texts.offsets))
    letter = data != 0x20
    good = (owner[:n] == owner[GRAM - 1 :]) & letter[1 : n + 1] & letter[2 : n + 2]
    code = np.zeros(n, dtype=np.uint32)
    for k in range(GRAM):
        code = (code << np.uint32(8)) | data[k : n + k].astype(np.uint32)
    code = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits)
    return owner[:n][good], code[good].astype(np.int64)


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def _letters_in(texts: Texts) -> np.ndarray:
    """Whether each text has a letter; only texts without an ASCII letter are decoded."""
    data = texts.data
    ascii_letters = texts.counts_of((LETTERS[data] != 0x20) & (data < 0x80)) > 0
    for i in np.flatnonzero(~ascii_letters):
        body = data[texts.offsets[i] : texts.offsets[i + 1]]
        ascii_letters[i] = bool((body >= 0x80).any()) and has_letter(
            body.tobytes().decode("utf-8", "replace")
        )
    return ascii_letters


def gram_counts(df: DataFrame, text: str, lang: str, bits: int = BITS) -> DataFrame:
    """(lang, bucket, n) over all rows, summed within each task before the shuffle."""
    narrow = df.select(
        df[f"`{lang}`"].cast("string").alias("lang"), df[f"`{text}`"].cast("string").alias("text")
    )

    def work(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for first, end, texts in text_chunks(batch.column("text")):
                names = batch.column("lang").slice(first, end - first).to_pylist()
                owner, bucket = grams(texts, bits)
                for name in set(names):
                    mine = np.array([x == name for x in names])
                    total = np.bincount(bucket[mine[owner]], minlength=1 << bits)
                    sums[name] = sums[name] + total if name in sums else total
        for name, total in sums.items():
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(used)), pa.array(used), pa.array(total[used])],
                names=["lang", "bucket", "n"],
            )

    parts = narrow.mapInArrow(work, "lang string, bucket long, n long")
    return parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


@dataclass
class MixtureModel:
    """Log probability of each bucket in each language."""

    bits: int
    langs: list[str]
    logs: np.ndarray

    def _fit(self, owner, count, chance, n: int, allowed: np.ndarray) -> np.ndarray:
        """Proportions per text over its allowed languages."""
        share = allowed / allowed.sum(axis=1, keepdims=True)
        total = np.maximum(np.bincount(owner, weights=count, minlength=n), 1e-12)
        starts = np.searchsorted(owner, np.arange(n))
        filled = np.flatnonzero(np.bincount(owner, minlength=n))
        for _ in range(ROUNDS):
            parts = chance * share[owner]
            parts *= (count / np.maximum(parts.sum(axis=1), 1e-300))[:, None]
            share = share.copy()
            share[filled] = np.add.reduceat(parts, starts[filled], axis=0)
            share[filled] /= total[filled, None]
        return share

    def _likelihood(self, owner, count, chance, share, n: int) -> np.ndarray:
        values = count * np.log(np.maximum((chance * share[owner]).sum(axis=1), 1e-300))
        return np.bincount(owner, weights=values, minlength=n)

    def predict(self, texts: Texts) -> dict[str, pa.Array]:
        n, size = texts.n, len(self.langs)
        letters = _letters_in(texts) & (size > 0)
        if not size:
            none = pa.array([None] * n, pa.map_(pa.string(), pa.float64()))
            return {"lang_pred": pa.array(["und"] * n), "score": pa.array([0.0] * n),
                    "proportions": none}
        owner, bucket = grams(texts, self.bits)
        pairs, count = np.unique((owner << self.bits) | bucket, return_counts=True)
        owner, bucket = pairs >> self.bits, pairs & ((1 << self.bits) - 1)
        logs = self.logs[bucket]
        # Likelihood ratios within each n-gram: the largest is 1, so nothing underflows.
        chance = np.exp(logs - logs.max(axis=1, keepdims=True))
        every = np.ones((n, size))
        full = self._fit(owner, count, chance, n, every)
        order = np.argsort(-full, axis=1, kind="stable")
        cost = PENALTY * np.log(np.maximum(np.bincount(owner, weights=count, minlength=n), 2))
        best_share = np.zeros((n, size))
        best_share[np.arange(n), order[:, 0]] = 1
        best = self._likelihood(owner, count, chance, best_share, n)
        open_rows = self._likelihood(owner, count, chance, full, n) - best > cost
        for width in range(2, size + 1):
            if not open_rows.any():
                break
            # Sets of the largest proportions, one language wider each time.
            allowed = np.zeros((n, size))
            np.put_along_axis(allowed, order[:, :width], 1.0, axis=1)
            mine = open_rows[owner]
            renumber = np.cumsum(open_rows) - 1
            sub, rows = renumber[owner[mine]], np.flatnonzero(open_rows)
            share = self._fit(sub, count[mine], chance[mine], len(rows), allowed[rows])
            value = self._likelihood(sub, count[mine], chance[mine], share, len(rows))
            value -= cost[rows] * (width - 1)
            better = value > best[rows]
            best[rows[better]] = value[better]
            best_share[rows[better]] = share[better]
        top = np.argmax(best_share, axis=1)
        # With one language chosen, the free fit still says how sure that is.
        score = np.minimum(best_share[np.arange(n), top], full[np.arange(n), top])
        names = np.array(self.langs, dtype=object)
        chosen = [
            [(self.langs[j], float(row[j])) for j in np.flatnonzero(row > 0)] if ok else None
            for row, ok in zip(best_share, letters)
        ]
        return {
            "lang_pred": pa.array(np.where(letters, names[top], "und"), pa.string()),
            "score": pa.array(np.clip(np.where(letters, score, 0.0), 0.0, 1.0)),
            "proportions": pa.array(chosen, pa.map_(pa.string(), pa.float64())),
        }


def fit_mixture(counts: DataFrame, bits: int = BITS) -> MixtureModel:
    """The model has languages x 2^bits numbers, whatever the size of the corpus."""
    rows = counts.toArrow()
    langs = sorted(set(rows.column("lang").to_pylist()))
    place = {name: i for i, name in enumerate(langs)}
    table = np.full((1 << bits, len(langs)), SMOOTHING)
    column = np.array([place[x] for x in rows.column("lang").to_pylist()], dtype=np.int64)
    np.add.at(table, (rows.column("bucket").to_numpy(), column), rows.column("n").to_numpy())
    return MixtureModel(bits, langs, np.log(table / table.sum(axis=0)))


def predict_languages(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    fold: tuple[int, int] = (3, 1),
) -> DataFrame:
    """Language of every row, learned from the rows of the other folds."""
    spark = df.sparkSession
    held_out = F.coalesce(crc32_mod(key, fold[0]) == fold[1], F.lit(False))
    learned = df.where((crc32_mod(key, fold[0]) != fold[1]) & F.col(lang).isNotNull())
    model = fit_mixture(gram_counts(learned, text, lang))
    shared = spark.sparkContext.broadcast(cloudpickle.dumps(model))
    cache: dict[str, MixtureModel] = {}

    def predict(texts: Texts) -> dict[str, pa.Array]:
        if "model" not in cache:
            cache["model"] = pickle.loads(shared.value)
        return cache["model"].predict(texts)

    schema = "lang_pred string, score double, proportions map<string, double>"
    made = map_texts(df, text, [key], schema, predict)
    return made.select(key, held_out.alias("held_out"), "lang_pred", "score", "proportions")
