"""Counts and ratios of whole texts, shared by the rule operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from plumbline.llm.textkit import PLAIN, Texts, map_texts, mix

SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", dtype=np.uint8))
CAPITALS = (np.arange(256) >= 0x41) & (np.arange(256) <= 0x5A)
DIGITS = (np.arange(256) >= 0x30) & (np.arange(256) <= 0x39)
FIRST_BYTES = (np.arange(256) & 0xC0) != 0x80
STOPS = np.isin(np.arange(256), np.frombuffer(b".!?", dtype=np.uint8))

COUNTS = (
    "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, "
    "n_repeat_words long, n_distinct_words long, n_capitals long, n_digits long, "
    "n_stops long, n_shouts long, n_bars long, n_chars_all long"
)


def _distinct(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """How many different values each owner has."""
    keys, first = np.unique(mix(values + owner.astype(np.uint64)), return_index=True)
    return np.bincount(owner[first], minlength=n)


def _repeated_words(words, size: int) -> np.ndarray:
    """Per text, the words inside runs of ``size`` words that the text has at least twice."""
    hashes, first = words.windows(size)
    if not len(first):
        return np.zeros(words.texts.n, dtype=np.int64)
    keys = mix(hashes + words.text_of[first].astype(np.uint64))
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    repeated = np.zeros(len(keys), dtype=bool)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    begins = first[repeated]
    cover = np.zeros(len(words.hashes) + 1, dtype=np.int64)
    np.add.at(cover, begins, 1)
    np.add.at(cover, begins + size, -1)
    covered = np.cumsum(cover[:-1]) > 0
    return np.bincount(words.text_of[covered], minlength=words.texts.n)


def _lines(texts: Texts, words) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word per text, and those of them equal to an earlier one."""
    breaks = np.flatnonzero(texts.data == 0x0A)
    starts = np.unique(np.concatenate([texts.offsets[:-1], breaks + 1]))
    starts = starts[starts < len(texts.data)]
    if not len(starts):
        zero = np.zeros(texts.n, dtype=np.int64)
        return zero, zero
    # A line ends at the next line break, or where its text ends.
    limits = np.append(starts[1:], len(texts.data))
    is_break = texts.data[limits - 1] == 0x0A
    ends = np.maximum(limits - is_break, starts)
    owner = np.searchsorted(texts.offsets, starts, side="right") - 1
    has_word = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    starts, ends, owner = starts[has_word], ends[has_word], owner[has_word]
    n_lines = np.bincount(owner, minlength=texts.n)
    same = texts.span_hash(texts.data, starts, ends)
    return n_lines, n_lines - _distinct(same, owner, texts.n)


def count_texts(texts: Texts, repeat_words: int = 8) -> dict[str, pa.Array]:
    """All counts of COUNTS for some texts; every count is 0 for an empty or null text."""
    data = texts.data
    words = texts.words(PLAIN, lower=False)
    n_lines, n_dup_lines = _lines(texts, words)
    counts = {
        "n_words": words.per_text,
        "word_chars": texts.counts_of(PLAIN[data] & FIRST_BYTES[data]),
        "n_symbols": texts.counts_of(SYMBOLS[data]),
        "n_lines": n_lines,
        "n_dup_lines": n_dup_lines,
        "n_repeat_words": _repeated_words(words, repeat_words),
        "n_distinct_words": _distinct(words.hashes, words.text_of, texts.n),
        "n_capitals": texts.counts_of(CAPITALS[data]),
        "n_digits": texts.counts_of(DIGITS[data]),
        "n_stops": texts.counts_of(STOPS[data]),
        "n_shouts": texts.counts_of(data == 0x21),
        "n_bars": texts.counts_of(data == 0x7C),
        "n_chars_all": texts.counts_of(FIRST_BYTES[data]),
    }
    return {k: pa.array(np.asarray(v).astype(np.int64)) for k, v in counts.items()}


def text_counts(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``keep`` columns and the counts of every whole text."""
    return map_texts(df, text, keep, COUNTS, count_texts)
