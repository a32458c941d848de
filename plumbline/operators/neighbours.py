"""Mutual information of continuous features with labels, from nearest neighbours.

For each row, the distance to the k-th nearest row of the same label is found, and all rows that
are nearer than that are counted. With N rows, N_y of the row's label and m nearer rows (itself
included), the information is

    digamma(N) + mean(digamma(k)) - mean(digamma(N_y)) - mean(digamma(m)).

In one dimension neighbours are neighbours in sorted order. Points are dealt to slices of the order
(feature, value) as arrays, equal points as one with their number, so a slice is sorted and looked at
once for all labels, whatever share of the rows has one value or label. The k points of a label at
either end of a slice meet those of the slices around it; all others find their neighbours inside.
What lies beyond a slice's ends, and the points near the ends of a label, is counted by running
totals over the points that any row asks for.

Values are placed on a whole-number grid of 2^-``GRID_BITS`` standard deviations, so distances
compare exactly. Equal values would all be at distance 0; they are spread inside their grid cell by
a number drawn from the row's key, the same on every run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from plumbline.contract import SEED
from plumbline.functions import sqltext as sql
from plumbline.functions.columns import nan_to_null
from plumbline.operators.ordering import running_totals
from plumbline.operators.quantiles import exact_quantiles
from plumbline.workspace import Workspace

NEIGHBOURS = 3
# Flagged from here on, like the binned estimate.
INFORMATION_FLAG = 0.01
GRID_BITS, NOISE_BITS = 28, 16
# Two multipliers of a generator modulo a prime, from which the spread is drawn.
PRIME, FIRST_STEP, SECOND_STEP, FEATURE_STEP = 2147483647, 48271, 16807, 7919
# Points that a slice has about, rows that a task sorts at once, and rows looked at per slice for
# where slices begin, which only evens them out.
SLICE, SORTED_ROWS, LOOKED_AT = 250_000, 1 << 18, 200


def digamma(n: str) -> str:
    """SQL for digamma of a whole number of at least 1, to 1e-11."""
    z = f"({n} + 6D)"
    series = (
        f"ln({z}) - 1 / (2 * {z}) - 1 / (12 * pow({z}, 2)) + 1 / (120 * pow({z}, 4)) - 1 / (252 * pow({z}, 6)) "
        f"+ 1 / (240 * pow({z}, 8)) - 1 / (132 * pow({z}, 10))"
    )
    return f"({series} - " + " - ".join(f"1 / ({n} + {j}D)" for j in range(6)) + ")"


def _spread_of(key: np.ndarray, feature: int) -> np.ndarray:
    """A number below 2^NOISE_BITS that depends on the key and the feature."""
    drawn = (key % PRIME * FIRST_STEP + feature * FEATURE_STEP) % PRIME * SECOND_STEP % PRIME
    return drawn >> (31 - NOISE_BITS)


def _placing(filled: DataFrame, columns: Sequence[str]) -> Callable[[int, np.ndarray, np.ndarray], np.ndarray]:
    """The places of a feature's values and their keys."""
    measures = [f"avg({sql.name(c)}) AS m{i}" for i, c in enumerate(columns)]
    measures += [f"stddev_pop({sql.name(c)}) AS s{i}" for i, c in enumerate(columns)]
    found = filled.agg(*[F.expr(m) for m in measures]).first().asDict()
    # Of N rows none is further than sqrt(N) deviations from the mean.
    most = float(1 << (62 - GRID_BITS - NOISE_BITS))

    def place(feature: int, values: np.ndarray, key: np.ndarray) -> np.ndarray:
        mean, deviation = found[f"m{feature}"], found[f"s{feature}"]
        scaled = np.zeros(len(values))
        if deviation:
            with np.errstate(all="ignore"):
                scaled = (values - mean) / deviation
        # What is not a number counts as the greatest one.
        scaled = np.fmax(np.fmin(scaled, most), -most) * float(1 << GRID_BITS)
        size = np.abs(scaled)
        whole = np.floor(size)
        whole = np.where(scaled < 0, -1.0, 1.0) * (whole + (size - whole >= 0.5))
        return whole.astype(np.int64) * (1 << NOISE_BITS) + _spread_of(key, feature)

    return place


def _borders(filled: DataFrame, rows: int, features: int, place) -> list[np.ndarray]:
    """Per feature the places that its second slice and those after it begin with."""
    parts = int(filled.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = max(-(-rows // SLICE), -(-parts // max(features, 1)))
    if slices < 2 or not rows:
        return [np.empty(0, dtype=np.int64)] * features
    seen = filled.sample(False, min(1.0, LOOKED_AT * slices / rows), SEED).toArrow()
    key = _column(seen, 0)
    borders = []
    for i in range(features):
        places = np.sort(place(i, _column(seen, 2 + i), key))
        at = np.arange(1, slices) * len(places) // slices
        borders.append(np.unique(places[at]) if len(places) else places)
    return borders


def _column(table: pa.Table, at: int) -> np.ndarray:
    return np.asarray(table.column(at).combine_chunks())


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin, and the end."""
    fresh = np.ones(len(keys[0]) + 1, dtype=bool)
    fresh[1:-1] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return np.flatnonzero(fresh)


def _together(place: np.ndarray, code: np.ndarray, rows: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """The points in order, equal ones as one with the sum of their rows."""
    order = np.lexsort((code, place))
    place, code = place[order], code[order]
    edges = _runs(place, code)
    counted = np.diff(edges) if rows is None else np.add.reduceat(rows[order], edges[:-1])
    return place[edges[:-1]], code[edges[:-1]], counted.astype(np.int64)


POINTS = pa.schema(
    [("part", pa.int32()), ("places", pa.binary()), ("codes", pa.binary()), ("counts", pa.binary())]
)


def _dealt(place, borders: Sequence[np.ndarray], first: Sequence[int]):
    """For each slice the points that a task has in it, as arrays."""

    def flush(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        key, code = _column(table, 0), _column(table, 1)
        for i in range(len(borders)):
            places, codes, counts = _together(place(i, _column(table, 2 + i), key), code)
            cuts = [0, *np.searchsorted(places, borders[i]).tolist(), len(places)]
            for j, (begin, end) in enumerate(zip(cuts[:-1], cuts[1:])):
                if begin < end:
                    cells = [a[begin:end].tobytes() for a in (places, codes, counts)]
                    yield pa.RecordBatch.from_pylist(
                        [dict(zip(POINTS.names, (first[i] + j, *cells)))], schema=POINTS
                    )

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            if len(batch):
                held.append(batch)
                rows += len(batch)
            if rows >= SORTED_ROWS:
                yield from flush(held)
                held, rows = [], 0
        if held:
            yield from flush(held)

    return deal


def _radius(k: int) -> Column:
    """Distance to the k-th nearest of the rows found, or to the farthest that a small label has."""
    steps = [f"place - coalesce(before{j}, before{j}_)" for j in range(1, k + 1)]
    steps += [f"coalesce(after{j}, after{j}_) - place" for j in range(1, k + 1)]
    near = f"array_sort(filter(array({', '.join(steps)}), d -> d IS NOT NULL))"
    return F.expr(f"element_at({near}, CAST(least({k}, n - 1) AS INT))").alias("radius")


ASKED = ["label", "feature", "part", "m", "rows", "up", "up_end", "low", "low_end"]


def _looked_at(
    k: int, borders: Sequence[np.ndarray], first: Sequence[int], classes: Sequence[tuple[np.ndarray, np.ndarray]]
):
    """What a slice tells: its points in order, for each label how many rows (``rows``) have ``m``
    nearer ones, and rows that must look outside. Those that know their radius leave the places from
    ``up`` to below ``up_end`` and from ``low`` to below ``low_end`` to be counted; the others, the k
    at either end of a label, have their ``place`` and the neighbours they know. ``classes`` has for
    each label the class of every code, below 0 if left out, and the rows of every class."""
    sides = [f"{side}{j}" for side in ("before", "after") for j in range(1, k + 1)]
    longs = [*ASKED[3:], "place", "n", *sides]
    schema = pa.schema(
        [(c, pa.int32()) for c in ASKED[:3]] + [(c, pa.int64()) for c in longs]
        + [("y", pa.int32())] + [(c, pa.binary()) for c in POINTS.names[1:]]
    )

    def table(size: int, **known) -> pa.Table:
        columns = []
        for field in schema:
            value = known.get(field.name)
            if value is None:
                columns.append(pa.nulls(size, field.type))
            elif isinstance(value, (int, bytes)):
                columns.append(pa.array([value] * size, field.type))
            else:
                columns.append(value if isinstance(value, pa.Array) else pa.array(value, field.type))
        return pa.table(columns, schema=schema)

    def look(points: pa.Table) -> pa.Table:
        part = points.column("part")[0].as_py()
        feature = int(np.searchsorted(first, part, "right")) - 1
        limits = borders[feature]
        at = part - first[feature]
        begin_at = int(limits[at - 1]) if at else None
        end_at = int(limits[at]) if at < len(limits) else None
        arrays = [
            np.concatenate([np.frombuffer(v.as_buffer(), dtype=kind) for v in points.column(name)])
            for name, kind in zip(POINTS.names[1:], (np.int64, np.int32, np.int64))
        ]
        place, code, rows = _together(*arrays)
        cells = dict(zip(POINTS.names[1:], (place.tobytes(), code.tobytes(), rows.tobytes())))
        found = [table(1, feature=feature, part=part, **cells)]
        for label, (class_of, size_of) in enumerate(classes):
            y = class_of[code]
            used = y >= 0
            upto = np.concatenate([[0], np.cumsum(np.where(used, rows, 0))])
            # Of many equal points k + 1 are enough to find neighbours; the first stands for the rest.
            entry = np.flatnonzero(used)
            entry = entry[np.argsort(y[entry], kind="stable")]
            copies = np.minimum(rows[entry], k + 1)
            leading = np.cumsum(copies) - copies
            weight = np.ones(int(copies.sum()), dtype=np.int64)
            weight[leading] += rows[entry] - copies
            entry = np.repeat(entry, copies)
            x, y = place[entry], y[entry]
            if not len(x):
                continue
            edges = _runs(y)
            begin, end = (np.repeat(e, np.diff(edges)) for e in (edges[:-1], edges[1:]))
            where = np.arange(len(x))
            border = (where < begin + k) | (where >= end - k)
            inner = np.flatnonzero(~border)
            steps = np.empty((len(inner), 2 * k), dtype=np.int64)
            for j in range(1, k + 1):
                steps[:, j - 1] = x[inner] - x[inner - j]
                steps[:, k + j - 1] = x[inner + j] - x[inner]
            # Among 2k + 1 rows of a label, the k-th nearest is always there.
            steps.partition(k - 1, axis=1)
            reach = np.maximum(steps[:, k - 1], 1)
            high, low, weights = x[inner] + reach, x[inner] - reach, weight[inner]
            above = np.zeros(len(inner), dtype=bool) if end_at is None else high > end_at
            below = np.zeros(len(inner), dtype=bool) if begin_at is None else low + 1 < begin_at
            # Points beyond the slice are not in it, so what it has in between is what counts here.
            m = upto[np.searchsorted(place, high)] - upto[np.searchsorted(place, low, "right")]
            out = above | below
            met, index = np.unique(m[~out], return_inverse=True)
            times = np.zeros(len(met), dtype=np.int64)
            np.add.at(times, index, weights[~out])
            found.append(table(len(met), label=label, feature=feature, part=part, m=met, rows=times))
            some = np.flatnonzero(out)
            spans = {}
            for name, side, values in (
                ("up", above, end_at), ("up_end", above, high), ("low", below, low + 1), ("low_end", below, begin_at)
            ):
                held = np.broadcast_to(0 if values is None else values, high.shape)[some]
                spans[name] = pa.array(held, pa.int64(), mask=~side[some])
            found.append(
                table(len(some), label=label, feature=feature, part=part, m=m[some], rows=weights[some], **spans)
            )
            edge = np.flatnonzero(border)
            near = {}
            for name, step in zip(sides, [-j for j in range(1, k + 1)] + list(range(1, k + 1))):
                other = edge + step
                outside = (other < begin[edge]) | (other >= end[edge])
                near[name] = pa.array(x[np.where(outside, edge, other)], pa.int64(), mask=outside)
            found.append(
                table(
                    len(edge), label=label, feature=feature, part=part, rows=weight[edge], place=x[edge],
                    y=y[edge], n=size_of[y[edge]], **near,
                )
            )
        return pa.concat_tables(found)

    return look, ", ".join(f"{f.name} {_SQL_TYPES[f.type]}" for f in schema)


_SQL_TYPES = {pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary"}


def _merged(spans: Iterable[tuple[tuple[int, int], int, int]]) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
    """Per label and feature the begins and ends of the places that lie in any span (of, begin, end)."""
    found: dict[tuple[int, int], list[list[int]]] = {}
    for of, begin, end in sorted(spans):
        known = found.setdefault(of, [])
        if known and begin <= known[-1][1]:
            known[-1][1] = max(known[-1][1], end)
        else:
            known.append([begin, end])
    return {of: tuple(np.array(v, dtype=np.int64).T) for of, v in found.items()}


def _nearer(slices: DataFrame, k: int, classes: Sequence[tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """(label, feature, m, rows): how many rows have ``m`` points nearer than their radius; from what
    the slices told."""
    workspace = Workspace.of(slices.sparkSession)
    told = slices.where("label IS NOT NULL")
    met = told.where("place IS NULL AND up IS NULL AND low IS NULL").select("label", "feature", "m", "rows")
    # At most 2k rows per slice and label; their neighbours across borders are all among them.
    across = Window.partitionBy("label", "feature", "y").orderBy("place")
    around = [F.lag("place", j).over(across).alias(f"before{j}_") for j in range(1, k + 1)]
    around += [F.lead("place", j).over(across).alias(f"after{j}_") for j in range(1, k + 1)]
    edge = told.where("place IS NOT NULL").select("*", *around).select("*", _radius(k))
    edge = edge.withColumn("reach", F.greatest("radius", F.lit(1))).selectExpr(
        "label", "feature", "part", "0L AS m", "rows", "place - reach + 1 AS up", "place + reach AS up_end",
        "CAST(NULL AS BIGINT) AS low", "CAST(NULL AS BIGINT) AS low_end",
    )
    further = told.where("up IS NOT NULL OR low IS NOT NULL").select(*ASKED)
    opened = workspace.stage(further.unionByName(edge), "neighbour-edges")
    # A few spans per slice: the places that its rows ask for, where they are close together as one.
    asked = opened.selectExpr(
        "label", "feature", sql.rows([sql.struct(begin=a, end=b) for a, b in (("up", "up_end"), ("low", "low_end"))])
    ).where("begin IS NOT NULL").distinct().collect()
    wanted = _merged(((r["label"], r["feature"]), r["begin"], r["end"]) for r in asked)

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                feature = batch.column(0)[row].as_py()
                place, code, rows = (
                    np.frombuffer(batch.column(c)[row].as_buffer(), dtype=kind)
                    for c, kind in ((1, np.int64), (2, np.int32), (3, np.int64))
                )
                for label, (class_of, _) in enumerate(classes):
                    if (label, feature) not in wanted:
                        continue
                    begins, ends = wanted[label, feature]
                    at = np.searchsorted(begins, place, "right") - 1
                    keep = (at >= 0) & (place < ends[at]) & (class_of[code] >= 0)
                    size = int(keep.sum())
                    columns = [np.full(size, label, np.int32), np.full(size, feature, np.int32), place[keep], rows[keep]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c) for c in columns], names=["label", "feature", "value", "point"]
                    )

    points = slices.where("label IS NULL").select("feature", *POINTS.names[1:]).mapInArrow(
        inside, "label int, feature int, value long, point long"
    ).selectExpr(
        "label", "feature", "value", "CAST(NULL AS BIGINT) AS row", "0L AS m", "0L AS rows", "0L AS sign", "point"
    )
    sides = [("up", -1), ("up_end", 1), ("low", -1), ("low_end", 1)]
    marks = sql.rows([sql.struct(value=c, sign=f"{sign}L", point="0L") for c, sign in sides])
    marked = opened.withColumn("row", F.monotonically_increasing_id()).selectExpr(
        "label", "feature", "row", "m", "rows", marks
    )
    # In one place, ends come before points: those from ``up`` on count, those from ``up_end`` on do not.
    below = running_totals(
        points.unionByName(marked.where("value IS NOT NULL")),
        [F.col("label"), F.col("feature"), F.col("value"), F.col("point")],
        {"below": "point"},
        "neighbour-marks",
    )
    counted = below.where("sign <> 0").groupBy("label", "feature", "row").agg(
        (F.first("m") + F.sum(F.col("sign") * F.col("below"))).alias("m"), F.first("rows").alias("rows")
    )
    return met.unionByName(counted.drop("row"))


def _of_labels(
    clean: DataFrame,
    labels: Sequence[str],
    columns: Sequence[str],
    key: str,
    k: int,
    medians: Mapping[str, float | None] | None,
) -> list[DataFrame]:
    """Information on each of the labels, of which no row misses any."""
    spark = clean.sparkSession
    if medians is None:
        middles = exact_quantiles(clean, {c: [0.5] for c in columns})
        medians = {c: q[0] if q else None for c, q in middles.items()}
    # One row per combination of labels.
    pairs = clean.groupBy(*[F.col(sql.name(y)).alias(f"y{i}") for i, y in enumerate(labels)]).agg(
        F.count(F.lit(1)).alias("n")
    )
    schema = pairs.drop("n").schema.add("code", IntegerType())
    found = [tuple(r) for r in pairs.collect()]
    classes, terms = [], []
    for i in range(len(labels)):
        values = {v: at for at, v in enumerate(dict.fromkeys(r[i] for r in found))}
        size = np.zeros(len(values), dtype=np.int64)
        for r in found:
            size[values[r[i]]] += r[-1]
        # A label with a single row has no neighbours.
        of = np.array([values[r[i]] if size[values[r[i]]] > 1 else -1 for r in found], dtype=np.int32)
        classes.append((of, size))
        known = spark.createDataFrame([(int(n),) for n in size if n > 1], "n long").agg(
            F.sum("n").alias("n"),
            F.expr(f"sum(n * ({digamma(f'least({k}, n - 1)')} - {digamma('n')})) AS labels"),
        ).first()
        terms.append((float(known["n"] or 0), known["labels"]))
    filled = clean.selectExpr(
        f"coalesce(CAST({sql.name(key)} AS BIGINT), 0L) AS _key",
        *[f"{sql.name(y)} AS _y{i}" for i, y in enumerate(labels)],
        *[f"coalesce(CAST({sql.name(c)} AS DOUBLE), {sql.number(medians[c] or 0.0)}) AS {sql.name(c)}" for c in columns],
    )
    place = _placing(filled, columns)
    codes = spark.createDataFrame([(*r[:-1], at) for at, r in enumerate(found)], schema)
    same = " AND ".join(f"_y{i} = y{i}" for i in range(len(labels)))
    coded = filled.join(codes, F.expr(same)).select("_key", "code", *[F.col(sql.name(c)) for c in columns])
    borders = _borders(coded, sum(r[-1] for r in found), len(columns), place)
    first = np.cumsum([0, *[len(b) + 1 for b in borders[:-1]]]).tolist()
    dealt = coded.mapInArrow(_dealt(place, borders, first), "part int, places binary, codes binary, counts binary")
    look, told = _looked_at(k, borders, first, classes)
    slices = Workspace.of(spark).stage(dealt.groupBy("part").applyInArrow(look, told), "neighbour-slices")
    met = _nearer(slices, k, classes).groupBy("label", "feature").agg(F.expr(f"sum(rows * {digamma('m')}) AS nearer"))
    met = Workspace.of(spark).stage(met, "neighbour-sums")
    names = spark.createDataFrame(list(enumerate(columns)), "_feature int, feature string")
    results = []
    for i, (rows, of_labels) in enumerate(terms):
        base = (
            f"{digamma(sql.number(max(rows, 1.0)))} + ({sql.number(of_labels)} - nearer) / {sql.number(max(rows, 1.0))}"
        )
        of_label = met.where(f"label = {i}").selectExpr("feature AS _at", "nearer")
        # Null without rows: greatest() would pass over the null.
        information = f"if(nearer IS NULL, NULL, greatest({base}, 0D))"
        results.append(
            names.join(of_label, F.expr("_feature = _at"), "left")
            .selectExpr("feature", f"{information} AS mutual_information")
            .withColumn("flagged", F.expr(f"coalesce(mutual_information >= {INFORMATION_FLAG}, false)"))
        )
    return results


def neighbour_information(
    df: DataFrame,
    label: str,
    columns: Sequence[str],
    key: str,
    k: int = NEIGHBOURS,
    medians: Mapping[str, float | None] | None = None,
) -> DataFrame:
    """feature, mutual_information (in nats, not below 0) and flagged. ``key`` is a whole-number
    column. Missing values are filled with the median; rows without a label and labels with one row
    are left out. Without any other row the information is null."""
    clean = nan_to_null(df.select(key, label, *columns)).where(F.col(label).isNotNull())
    return _of_labels(clean, [label], columns, key, k, medians)[0]


def neighbour_information_of(
    df: DataFrame, labels: Sequence[str], columns: Sequence[str], key: str, k: int = NEIGHBOURS
) -> list[DataFrame]:
    """``neighbour_information`` on several labels, from one pass unless some rows miss one of them."""
    clean = nan_to_null(df.select(key, *labels, *columns))
    known = clean.agg(*[F.count_if(F.col(y).isNull()).alias(f"y{i}") for i, y in enumerate(labels)]).first()
    if any(known):
        return [neighbour_information(df, y, columns, key, k) for y in labels]
    return _of_labels(clean, labels, columns, key, k, None)
