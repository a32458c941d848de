"""Exact order statistics and quantiles of many columns at once, by counting.

A double has an integer key of the same order: its bit pattern, negated for negative values. The
wanted ranks are located on these keys. Each round counts the values of every open range in
2^``BUCKET_BITS`` buckets of equal key width, and the bucket that holds a rank, cut to the keys
found in it, is the next range. A range of one key is an answer. Keys have 64 bits, so any data,
infinities and values hundreds of decades apart included, are done after at most six rounds. Every
round is one pass in which tasks count with numpy, the driver only sees bucket counts, every rank is
exact, and tables of all sizes take the same path.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions import sqltext as sql

BUCKET_BITS = 11


def _present(column: str) -> str:
    """The value as a double; NaN is missing."""
    value = f"CAST({sql.name(column)} AS DOUBLE)"
    return f"if(isnan({value}), NULL, {value})"


def key_of(value: float) -> int:
    bits = struct.unpack("<q", struct.pack("<d", abs(value)))[0]
    return -bits if value < 0 else bits


def value_of(key: int) -> float:
    value = struct.unpack("<d", struct.pack("<q", abs(key)))[0]
    return -value if key < 0 else value


def _keys(values: pa.Array) -> np.ndarray:
    """The keys of the values that are there: their bits."""
    x = values.drop_null().to_numpy(zero_copy_only=False)
    bits = np.abs(x).view(np.int64)
    return np.where(x < 0, -bits, bits)


def _keyed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``k0``, ``k1``, ... are the keys of ``columns``."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = []
            for values in batch.columns:
                present = values.is_valid().to_numpy(zero_copy_only=False)
                keys = np.zeros(len(values), dtype=np.int64)
                keys[present] = _keys(values)
                cells.append(pa.array(keys, mask=~present))
            yield pa.RecordBatch.from_arrays(cells, names=[f"k{i}" for i in range(len(cells))])

    values = df.selectExpr(*[f"{_present(c)} AS x{i}" for i, c in enumerate(columns)])
    return values.mapInArrow(keyed, ", ".join(f"k{i} long" for i in range(len(columns))))


@dataclass(frozen=True)
class Profile:
    """Counts and range of one column's present values."""

    rows: int
    present: int
    minimum: float | None
    maximum: float | None

    @property
    def missing(self) -> int:
        return self.rows - self.present

    @property
    def missing_rate(self) -> float | None:
        return self.missing / self.rows if self.rows else None


def profile(df: DataFrame, columns: Iterable[str]) -> dict[str, Profile]:
    """Row count, present count, minimum and maximum of every column, in one aggregation."""
    columns = list(columns)
    aggs = ["count(*) AS rows"]
    for i, c in enumerate(columns):
        value = _present(c)
        aggs += [f"count({value}) AS n{i}", f"min({value}) AS lo{i}", f"max({value}) AS hi{i}"]
    row = df.agg(*[F.expr(a) for a in aggs]).first()
    return {
        c: Profile(row["rows"], row[f"n{i}"], row[f"lo{i}"], row[f"hi{i}"])
        for i, c in enumerate(columns)
    }


@dataclass(frozen=True)
class _Range:
    """Keys of one column known to contain a wanted rank."""

    column: str
    low: int
    high: int
    below: int

    @property
    def shift(self) -> int:
        """Bits to drop for at most 2^BUCKET_BITS buckets."""
        shift = 0
        while (self.high >> shift) - (self.low >> shift) >= 1 << BUCKET_BITS:
            shift += 1
        return shift


def _tallied(ranges: Sequence[Sequence[tuple[int, _Range]]]):
    """Of a task's values, with the ranges of each column in key order: the number of those in each
    bucket, their least and greatest key."""
    tables = []
    for slots in ranges:
        low, high, shift = (np.array([getattr(r, a) for _, r in slots], dtype=np.int64) for a in ("low", "high", "shift"))
        first = low >> shift
        size = (high >> shift) - first + 1
        tables.append((low, high, shift, first, size, np.cumsum(size) - size))

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = np.iinfo(np.int64)
        held = [
            [np.full(int(size.sum()), fill, dtype=np.int64) for fill in (0, whole.max, whole.min)]
            for *_, size, _ in tables
        ]
        for batch in batches:
            for column, (low, high, shift, first, _, begin), (n, lo, hi) in zip(batch.columns, tables, held):
                keys = _keys(column)
                # The first range that does not end below a key is the only one that can hold it.
                slot = np.searchsorted(high, keys) if len(high) > 1 else np.zeros(len(keys), dtype=np.int64)
                slot = np.minimum(slot, len(high) - 1)
                inside = (keys >= low[slot]) & (keys <= high[slot])
                keys, slot = keys[inside], slot[inside]
                bucket = (keys >> shift[slot]) - first[slot] + begin[slot]
                np.add.at(n, bucket, 1)
                np.minimum.at(lo, bucket, keys)
                np.maximum.at(hi, bucket, keys)
        for slots, (*_, size, begin), (n, lo, hi) in zip(ranges, tables, held):
            some = np.flatnonzero(n)
            if not len(some):
                continue
            at = np.searchsorted(begin, some, "right") - 1
            numbers = np.array([s for s, _ in slots])
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers[at].astype(np.int32)), pa.array((some - begin[at]).astype(np.int32))]
                + [pa.array(values[some]) for values in (n, lo, hi)],
                names=["slot", "bucket", "n", "lo", "hi"],
            )

    return tally


def _histogram(df: DataFrame, ranges: Sequence[_Range]):
    """(slot, bucket, n, lo, hi) of every bucket with values, in key order, as an Arrow table.

    The ranges of a column are disjoint. A task counts its values in numpy, so only counts leave it.
    """
    by_column: dict[str, list[tuple[int, _Range]]] = {}
    for slot, r in enumerate(ranges):
        by_column.setdefault(r.column, []).append((slot, r))
    values = df.selectExpr(*[f"{_present(c)} AS x{i}" for i, c in enumerate(by_column)])
    tallied = values.mapInArrow(_tallied(list(by_column.values())), "slot int, bucket int, n long, lo long, hi long")
    counts = tallied.groupBy("slot", "bucket").agg(
        F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")
    )
    return counts.toArrow().sort_by([("slot", "ascending"), ("bucket", "ascending")])


def order_statistics(
    df: DataFrame, ranks: Mapping[str, Iterable[int]], profiles: Mapping[str, Profile]
) -> dict[tuple[str, int], float]:
    """The value at each 0-based rank of each column's sorted present values."""
    answers: dict[tuple[str, int], float] = {}
    open_ranks: dict[tuple[str, int], _Range] = {}
    for column, wanted in ranks.items():
        p = profiles[column]
        for rank in set(wanted):
            open_ranks[column, rank] = _Range(column, key_of(p.minimum), key_of(p.maximum), 0)

    while True:
        for key, r in list(open_ranks.items()):
            if r.low == r.high:
                answers[key] = value_of(r.low)
                del open_ranks[key]
        if not open_ranks:
            return answers
        ranges = sorted(set(open_ranks.values()), key=lambda r: (r.column, r.low))
        found = _histogram(df, ranges)
        slot, n, lo, hi = (found.column(c).to_numpy() for c in ("slot", "n", "lo", "hi"))
        first = np.searchsorted(slot, np.arange(len(ranges) + 1))
        slots = {r: i for i, r in enumerate(ranges)}
        for (column, rank), r in list(open_ranks.items()):
            start, end = first[slots[r]], first[slots[r] + 1]
            upto = r.below + np.cumsum(n[start:end])
            at = int(np.searchsorted(upto, rank, side="right"))
            below = int(upto[at]) - int(n[start + at])
            open_ranks[column, rank] = _Range(column, int(lo[start + at]), int(hi[start + at]), below)


def _interpolated(positions: Iterable[float], value_at) -> list[float]:
    found = []
    for x in positions:
        low, high = value_at(math.floor(x)), value_at(math.ceil(x))
        share = x - math.floor(x)
        found.append(low if low == high else (1 - share) * low + share * high)
    return found


def exact_quantiles(
    df: DataFrame,
    probabilities: Mapping[str, Sequence[float]],
    profiles: Mapping[str, Profile] | None = None,
) -> dict[str, list[float] | None]:
    """Linearly interpolated quantiles of each column's present values; None if it has none.

    Between a finite and an infinite value the interpolation is infinite, between the two
    infinities NaN.
    """
    probabilities = {c: list(ps) for c, ps in probabilities.items()}
    if not probabilities:
        return {}
    profiles = profiles or profile(df, probabilities)
    filled = [c for c in probabilities if profiles[c].present]
    result: dict[str, list[float] | None] = {c: None for c in probabilities}
    positions = {c: [(profiles[c].present - 1) * p for p in probabilities[c]] for c in filled}
    ranks = {c: {r for x in xs for r in (math.floor(x), math.ceil(x))} for c, xs in positions.items()}
    values = order_statistics(df, ranks, profiles)
    for c, xs in positions.items():
        result[c] = _interpolated(xs, lambda rank, c=c: values[c, rank])
    return result


@dataclass(frozen=True)
class Quantiles:
    """Per column, None where nothing is present: the median, quantiles of the present values, and
    quantiles of the column with its missing values filled with the median."""

    medians: dict[str, float | None]
    present: dict[str, list[float] | None]
    filled: dict[str, list[float] | None]


def _without_fill(rank: int, p: Profile) -> int | None:
    """Where the value at a rank of the filled column is among the present ones; None for the
    median. The copies of the median lie in the middle of the present values."""
    half = p.present // 2
    if rank < half:
        return rank
    copies = p.missing + p.present % 2
    return None if rank < half + copies else rank - p.missing


def quantiles_around_median(
    df: DataFrame,
    profiles: Mapping[str, Profile],
    present: Mapping[str, Sequence[float]],
    filled: Mapping[str, Sequence[float]],
) -> Quantiles:
    """Medians of all profiled columns, and the wanted quantiles of present and of filled values,
    in one search: what the filled column has at a rank, the present values have at another."""
    known = [c for c, p in profiles.items() if p.present]
    middle = {c: (profiles[c].present - 1) / 2 for c in known}
    of_present = {c: [(profiles[c].present - 1) * p for p in present[c]] for c in known if c in present}
    of_filled = {c: [(profiles[c].rows - 1) * p for p in filled[c]] for c in known if c in filled}
    ranks: dict[str, set[int]] = {}
    for c in known:
        ranks[c] = {r for x in (middle[c], *of_present.get(c, ())) for r in (math.floor(x), math.ceil(x))}
        for x in of_filled.get(c, ()):
            ranks[c] |= {_without_fill(r, profiles[c]) for r in (math.floor(x), math.ceil(x))} - {None}
    values = order_statistics(df, ranks, profiles)
    medians: dict[str, float | None] = {c: None for c in profiles}
    result = Quantiles(medians, {c: None for c in present}, {c: None for c in filled})
    for c in known:
        medians[c] = _interpolated([middle[c]], lambda rank: values[c, rank])[0]

        def filled_value(rank: int) -> float:
            place = _without_fill(rank, profiles[c])
            return medians[c] if place is None else values[c, place]

        if c in of_present:
            result.present[c] = _interpolated(of_present[c], lambda rank: values[c, rank])
        if c in of_filled:
            result.filled[c] = _interpolated(of_filled[c], filled_value)
    return result


def quantile_edges(
    df: DataFrame,
    columns: Iterable[str],
    bins: int,
    profiles: Mapping[str, Profile] | None = None,
) -> dict[str, list[float]]:
    """Distinct equal-frequency bin edges per column; fewer than two edges means unbinnable."""
    found = exact_quantiles(df, {c: [i / bins for i in range(bins + 1)] for c in columns}, profiles)
    return {c: sorted(set(edges or [])) for c, edges in found.items()}
