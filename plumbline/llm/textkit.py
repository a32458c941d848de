"""Words, lines and shingles of whole texts, found on the bytes of Arrow batches with numpy.

A batch of texts is one byte buffer with offsets. UTF-8 keeps every separator used here in ASCII,
so words are found by looking bytes up in a table, without making one Python object per word.
A word's identity is a 64-bit polynomial hash of its bytes, mixed with its length.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Numbers of 64 bits are made per byte of a part, several at a time: what a worker holds beside its batch.
CHUNK_BYTES = 1 << 18
BASE = 0x9E3779B97F4A7C15
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)

_POWERS: dict[str, np.ndarray] = {}


def _byte_table(keep: Callable[[int], bool]) -> np.ndarray:
    return np.array([keep(b) for b in range(256)])


# Characters that end a word, as bytes: space and \t..\r for plain words; everything but 0-9, a-z
# and bytes of non-ASCII characters for plain alphanumeric words (after lower-casing A-Z).
PLAIN = _byte_table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
ALPHANUMERIC = _byte_table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], dtype=np.uint8)


def mix(values: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values so that all their bits depend on all input bits."""
    values = (values ^ (values >> np.uint64(30))) * MIX_1
    values = (values ^ (values >> np.uint64(27))) * MIX_2
    return values ^ (values >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of BASE and of its inverse, modulo 2^64."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, CHUNK_BYTES + 1)
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            factors = np.full(size, base, dtype=np.uint64)
            factors[0] = 1
            _POWERS[name] = np.cumprod(factors, dtype=np.uint64)
    return _POWERS["up"][:n], _POWERS["down"][:n]


class Texts:
    """Some texts of a batch: their bytes, and where each begins and ends."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data = data
        self.offsets = offsets
        self.n = len(offsets) - 1
        self._hashes: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _running_hash(self, data: np.ndarray) -> np.ndarray:
        key = id(data)
        if key not in self._hashes:
            up, _ = _powers(len(data) + 1)
            out = np.zeros(len(data) + 1, dtype=np.uint64)
            np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=out[1:])
            self._hashes[key] = (data, out)
        return self._hashes[key][1]

    def span_hash(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """One 64-bit identity per span of ``data``: equal for equal bytes."""
        running = self._running_hash(data)
        _, down = _powers(len(data) + 1)
        raw = (running[ends] - running[starts]) * down[starts]
        return mix(raw + (ends - starts).astype(np.uint64) * MIX_2)

    def words(self, table: np.ndarray, lower: bool) -> "Words":
        data = LOWER[self.data] if lower else self.data
        inside = table[data]
        before = np.zeros(len(data), dtype=bool)
        before[1:] = inside[:-1]
        after = np.zeros(len(data), dtype=bool)
        after[:-1] = inside[1:]
        edges = self.offsets[1:-1]
        edges = edges[(edges > 0) & (edges < len(data))]
        before[edges] = False
        after[edges - 1] = False
        starts = np.flatnonzero(inside & ~before)
        ends = np.flatnonzero(inside & ~after) + 1
        return Words(self, data, starts, ends)

    def counts_of(self, flags: np.ndarray) -> np.ndarray:
        """How many flagged bytes each text has."""
        running = np.zeros(len(flags) + 1, dtype=np.int64)
        np.cumsum(flags, out=running[1:])
        return running[self.offsets[1:]] - running[self.offsets[:-1]]


class Words:
    """The words of some texts. ``bounds[i]:bounds[i + 1]`` are the words of text i."""

    def __init__(self, texts: Texts, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        self.texts = texts
        self.data = data
        self.starts = starts
        self.ends = ends
        self.hashes = texts.span_hash(data, starts, ends)
        self.bounds = np.searchsorted(starts, texts.offsets)
        self.per_text = np.diff(self.bounds)
        self.text_of = np.repeat(np.arange(texts.n), self.per_text)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash and first word of every run of ``size`` words that stays within one text."""
        total = len(self.hashes)
        if total < size:
            return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        first = np.flatnonzero(self.text_of[: total - size + 1] == self.text_of[size - 1 :])
        value = np.zeros(len(first), dtype=np.uint64)
        for k in range(size):
            value = value * np.uint64(BASE) + self.hashes[first + k]
        return mix(value), first


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Texts]]:
    """Parts (first row, end row, texts) of a string column, of ``limit`` bytes or one row each.

    Null counts as empty. Whole texts only: a longer text is a part of its own.
    """
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        end = min(max(end, first + 1), n)
        part = offsets[first : end + 1]
        yield first, end, Texts(data[part[0] : part[-1]], part - part[0])
        first = end


def map_texts(
    df: DataFrame,
    text: str,
    keep: list[str],
    schema: str,
    make: Callable[[Texts], dict[str, pa.Array]],
) -> DataFrame:
    """``df``'s ``keep`` columns plus one row-aligned set of columns made from whole texts.

    ``make`` gets the texts of a part and returns arrays of one value per text. ``schema`` is
    the DDL of the new columns, in the order in which ``make`` returns them.
    """
    inner = [f"_k{i}" for i in range(len(keep))]
    columns = [df[f"`{c}`"].alias(k) for c, k in zip(keep, inner)]
    body = inner[keep.index(text)] if text in keep else "_text"
    if text not in keep:
        columns.append(df[f"`{text}`"].cast("string").alias(body))
    narrow = df.select(*columns)
    fields = ", ".join(
        [f"{k} {narrow.schema[k].dataType.simpleString()}" for k in inner] + [schema]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(body)
            for first, end, texts in text_chunks(column):
                kept = [batch.column(k).slice(first, end - first) for k in inner]
                made = make(texts)
                yield pa.RecordBatch.from_arrays(
                    [*kept, *made.values()], names=[*inner, *made.keys()]
                )

    out = narrow.mapInArrow(work, fields)
    return out.withColumnsRenamed(dict(zip(inner, keep)))


def lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list column from concatenated values and the bounds of each row."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values, type=kind))


def row_digest(*columns: Column) -> Column:
    """128 bits that tell different rows apart, nulls included."""
    return F.struct(
        F.xxhash64(*columns).alias("h1"),
        F.xxhash64(F.lit(12), *[c.isNull() for c in columns], *columns).alias("h2"),
    )


def crc32_mod(key: str, divisor: int):
    """crc32 of a key written as text, modulo ``divisor``; null for a null key."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % F.lit(divisor)


def prefer_labels(labels: DataFrame, key: str, label: str) -> DataFrame:
    """One row per labelled key; null keys and labels are left out, of differing labels the
    larger counts."""
    known = labels.select(
        labels[f"`{key}`"].alias("_key"), labels[f"`{label}`"].cast("int").alias("_label")
    )
    known = known.where(F.col("_key").isNotNull() & F.col("_label").isNotNull())
    return known.groupBy("_key").agg(F.max("_label").alias("_label"))


def label_sample(known: DataFrame, key: str, held_out, max_rows: int) -> DataFrame:
    """At most ``max_rows`` labelled keys outside ``held_out``, the same ones on every run: those
    with the smallest hash of the key."""
    open_rows = known.where(~held_out)
    return open_rows.orderBy(F.xxhash64(key, F.lit(17)), key).limit(max_rows)
