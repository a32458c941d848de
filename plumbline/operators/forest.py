"""Spark's random forest of classification trees, grown with numpy over arrays of bytes.

The trees are those that ``RandomForestClassifier`` grows from the same rows: the same sample for
thresholds, bags, features per node, sums in the same order and gains. What differs is how rows are
held and gone through. A row takes one byte a feature (its bin) and one a tree (how often it is in
the tree's bag), where Spark holds objects of about 1,000 bytes, and a task goes through its rows
tree by tree, so that the sums it adds to stay in the processor's cache. Sums are merged by tree, and
only the chosen splits reach the driver, which has all nodes as Spark's has.
"""

from __future__ import annotations

import json
import math
import sys
import weakref
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions import sqltext as sql
from plumbline.functions.draws import jumps, poisson_counts
from plumbline.workspace import Workspace

# Rows of a chunk.
CHUNK = 32768
# Fixed values of Spark: the rows that thresholds are found from, the share from which every row is
# drawn for, the least number drawn, and the seed of its hash of bytes.
SAMPLED, DRAWN_SHARE, LEAST, HASH_SEED = 10_000, 0.4, 5e-11, 0x3C074A61
INVALID = -sys.float_info.max
MASK48, MASK64 = (1 << 48) - 1, (1 << 64) - 1


class JavaRandom:
    """java.util.Random."""

    def __init__(self, seed: int):
        self.state = (seed ^ 0x5DEECE66D) & MASK48

    def _word(self) -> int:
        self.state = (self.state * 0x5DEECE66D + 0xB) & MASK48
        word = self.state >> 16
        return word - (1 << 32) if word >> 31 else word

    def long(self) -> int:
        return ((self._word() << 32) + self._word()) & MASK64


def _hashed(seeds: np.ndarray, start: np.ndarray) -> np.ndarray:
    """MurmurHash3 of the eight bytes of each number, the highest first."""
    h = start
    for word in (seeds >> np.uint64(32), seeds & np.uint64(0xFFFFFFFF)):
        k = word.astype(np.uint32).byteswap() * np.uint32(0xCC9E2D51)
        k = ((k << 15) | (k >> 17)) * np.uint32(0x1B873593)
        h = h ^ k
        h = ((h << 13) | (h >> 19)) * np.uint32(5) + np.uint32(0xE6546B64)
    h = h ^ np.uint32(8)
    h = (h ^ (h >> 16)) * np.uint32(0x85EBCA6B)
    h = (h ^ (h >> 13)) * np.uint32(0xC2B2AE35)
    return h ^ (h >> 16)


class XorShift:
    """Spark's XORShiftRandom, one per seed side by side."""

    def __init__(self, seeds: Sequence[int]):
        seeds = np.array([s & MASK64 for s in seeds], dtype=np.uint64)
        low = _hashed(seeds, np.full(len(seeds), HASH_SEED, dtype=np.uint32))
        self.state = _hashed(seeds, low).astype(np.uint64) << np.uint64(32) | low.astype(np.uint64)

    def bits(self, n: int) -> np.ndarray:
        s = self.state
        s = s ^ (s << np.uint64(21))
        s = s ^ (s >> np.uint64(35))
        self.state = s ^ (s << np.uint64(4))
        return (self.state & np.uint64((1 << n) - 1)).astype(np.int64)

    def double(self) -> np.ndarray:
        return ((self.bits(26) << 27) + self.bits(27)) * 2.0**-53


def feature_subsets(seeds: Sequence[int], features: int, size: int) -> np.ndarray:
    """For each seed the features that a reservoir of ``size`` keeps."""
    kept = np.tile(np.arange(size), (len(seeds), 1))
    drawn = XorShift(seeds)
    for item in range(size, features):
        at = (drawn.double() * (item + 1)).astype(np.int64)
        hit = np.flatnonzero(at < size)
        kept[hit, at[hit]] = item
    return kept


def _picked(fraction: float, seed: int) -> Callable[[int], np.ndarray]:
    """Which of the next rows of a part Spark's sampler takes."""
    if fraction >= 1:
        return lambda rows: np.arange(rows)
    drawn = XorShift([seed])
    if fraction > DRAWN_SHARE:
        return lambda rows: np.flatnonzero([drawn.double()[0] <= fraction for _ in range(rows)])
    skip = math.log1p(-fraction)

    def gap() -> int:
        return int(math.log(max(float(drawn.double()[0]), LEAST)) / skip)

    at = gap()

    def take(rows: int) -> np.ndarray:
        nonlocal at
        taken = []
        while at < rows:
            taken.append(at)
            at += 1 + gap()
        at -= rows
        return np.array(taken, dtype=np.int64)

    return take


def thresholds_of(values: np.ndarray, weights: np.ndarray, expected: float, most: int) -> np.ndarray:
    """Split points of a feature, at most about ``most``, from sampled values that make up
    ``expected`` with those that are zero."""
    present = values != 0
    seen, at = np.unique(values[present], return_inverse=True)
    if not len(seen):
        return np.empty(0)
    counts = np.zeros(len(seen))
    np.add.at(counts, at, weights[present])
    absent = expected - float(counts.sum())
    if absent > sys.float_info.epsilon * int(present.sum()) * 100:
        where = int(np.searchsorted(seen, 0.0))
        seen, counts = np.insert(seen, where, 0.0), np.insert(counts, where, absent)
    middles = (seen[:-1] + seen[1:]) / 2.0
    if len(middles) <= most:
        return middles
    stride = expected / (most + 1)
    found, current, target = [], float(counts[0]), stride
    for i in range(1, len(seen)):
        before = current
        current += float(counts[i])
        if abs(before - target) < abs(current - target):
            found.append(middles[i - 1])
            target += stride
    return np.array(found)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    """The rows' doubles, a row per column; what is missing or not finite is refused as Spark does."""
    columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
    values = np.array(columns, dtype=np.float64)
    if not np.isfinite(values).all():
        raise ValueError("values and labels of a forest must be present and finite")
    return values


def _sample_of(fraction: float, seed: int):
    """The sampled rows of a part, and last the number of its rows."""

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rows = TaskContext.get().partitionId(), 0
        seeds = JavaRandom(seed)
        pick = _picked(fraction, [seeds.long() for _ in range(part + 1)][-1])
        for batch in batches:
            taken = pick(len(batch))
            rows += len(batch)
            values = _matrix(batch)[:, taken]
            if len(taken):
                yield _sampled(part, None, values)
        yield _sampled(part, rows, np.empty((1, 1)))

    return sample


def _sampled(part: int, rows: int | None, values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {"part": pa.array([part], pa.int32()), "rows": pa.array([rows], pa.int64()), "cells": [values.T.tobytes()]}
    )


def _cell_type(bins: np.ndarray, classes: int) -> np.dtype:
    return np.dtype(np.uint8 if int(bins.max()) * classes <= 256 else np.uint16)


def _bagged(
    thresholds: Sequence[np.ndarray], classes: int, kind: np.dtype, trees: int, seed: int, rows_of: Mapping[int, int],
    known: dict[int, int],
):
    """Chunks of a part: for each row and feature its bin and label in one number, labels, and for
    each tree and row how often the row is in its bag."""

    def bag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        drawn = poisson_counts(seed + part + 1, rows_of.get(part, 0) * trees, known)
        held: list[np.ndarray] = []
        size, counts = 0, np.empty(0, dtype=np.uint8)

        def chunk(rows: int) -> pa.RecordBatch:
            nonlocal held, size, counts
            cells = np.concatenate(held)
            more = [counts]
            have = len(counts)
            while have < rows * trees:
                more.append(next(drawn))
                have += len(more[-1])
            counts = np.concatenate(more)
            own, counts = counts[: rows * trees], counts[rows * trees :].copy()
            taken, rest = cells[:rows], cells[rows:]
            held, size = [rest], len(rest)
            return pa.RecordBatch.from_pydict(
                {
                    "rows": pa.array([rows], pa.int32()),
                    "cells": [np.ascontiguousarray(taken[:, :-1]).tobytes()],
                    "labels": [np.ascontiguousarray(taken[:, -1]).tobytes()],
                    "counts": [np.ascontiguousarray(own.reshape(rows, trees).T).tobytes()],
                }
            )

        for batch in batches:
            if not len(batch):
                continue
            values = _matrix(batch)
            cells = np.empty((len(batch), len(values)), dtype=kind)
            for i, limits in enumerate(thresholds):
                cells[:, i] = np.searchsorted(limits, values[i]) * classes + values[-1]
            cells[:, -1] = values[-1]
            held.append(cells)
            size += len(batch)
            while size >= CHUNK:
                yield chunk(CHUNK)
        if size:
            yield chunk(size)

    return bag


@dataclass
class Node:
    """A node while its tree grows. ``stats`` are its weights per class, ``raw`` its rows in the bag."""

    id: int
    leaf: bool = False
    stats: tuple[float, ...] | None = None
    raw: int = 0
    impurity: float = math.nan
    gain: float = math.nan
    valid: bool = True
    feature: int = -1
    bin: int = -1
    left: "Node | None" = None
    right: "Node | None" = None
    # Where the tree's arrays have it.
    at: int = 0

    @property
    def level(self) -> int:
        return self.id.bit_length() - 1

    @property
    def prediction(self) -> float:
        return float(int(np.argmax(self.stats)))


@dataclass
class Tree:
    """What tasks need to lead rows through a tree: for every node its feature (below 0: none), the
    last bin that goes left, and its left child, which the right one follows."""

    root: Node
    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    depth: int = 0

    def split(self, node: Node) -> None:
        at = len(self.feature)
        self.feature[node.at], self.bin[node.at], self.left[node.at] = node.feature, node.bin, at
        node.left.at, node.right.at = at, at + 1
        for _ in range(2):
            self.feature.append(-1)
            self.bin.append(0)
            self.left.append(0)
        self.depth = max(self.depth, node.level + 1)


@dataclass(frozen=True)
class Work:
    """The nodes of one tree in a group: where the bins of each of a node's features begin."""

    nodes: np.ndarray
    subsets: np.ndarray
    offsets: np.ndarray
    size: int


def _group_of(
    stack: list[tuple[int, Node]], draws: JavaRandom, bins: np.ndarray, per_node: int, classes: int, memory: int
) -> dict[int, list[tuple[Node, np.ndarray]]]:
    """The nodes that are split together, taken off the stack, with their features."""
    features = len(bins)
    order = stack[::-1]
    if per_node < features:
        states, seeds = [], []
        for _ in order:
            seeds.append(draws.long())
            states.append(draws.state)
        subsets = feature_subsets(seeds, features, per_node)
    else:
        subsets = np.tile(np.arange(features), (len(order), 1))
    used = np.cumsum(bins[subsets].sum(axis=1) * classes * 8)
    taken = max(int(np.searchsorted(used, memory, "right")), 1)
    if per_node < features:
        # The node that found no room drew as well.
        draws.state = states[min(taken, len(order) - 1)]
    group: dict[int, list[tuple[Node, np.ndarray]]] = {}
    for (tree, node), subset in zip(order[:taken], subsets):
        group.setdefault(tree, []).append((node, subset))
    del stack[len(stack) - taken :]
    return group


def _scala_hash(key: int) -> int:
    h = (key + ~(key << 9)) & 0xFFFFFFFF
    h ^= h >> 14
    h = (h + (h << 4)) & 0xFFFFFFFF
    return h ^ h >> 10


def _map_order(keys: Iterable[int], shift: int = 0) -> list[int]:
    """The order in which Scala's immutable map of whole numbers goes through its keys: nodes are put
    on the stack in it, so it settles which features are drawn for which."""
    keys = list(keys)
    if not shift and len(keys) <= 4:
        return sorted(keys, key=lambda k: (k & 15, k))
    slots: dict[int, list[int]] = {}
    for k in keys:
        slots.setdefault(_scala_hash(k) >> shift & 31, []).append(k)
    alone = [slots[s][0] for s in sorted(slots) if len(slots[s]) == 1]
    return alone + [k for s in sorted(slots) if len(slots[s]) > 1 for k in _map_order(slots[s], shift + 5)]


def _summed(works: Mapping[int, Work], trees: Mapping[int, Tree], features: int, weights: np.ndarray, kind: np.dtype):
    """For each tree the part's sums of weights in every bin of the group's nodes, class by class;
    added row by row, as the last bits of a sum can settle which of two equal splits is taken."""
    classes = len(weights)
    tables = {}
    for t, work in works.items():
        tree = trees[t]
        slot = np.full(len(tree.feature), -1, dtype=np.int64)
        slot[work.nodes] = np.arange(len(work.nodes))
        feature = np.array(tree.feature, dtype=np.int64)
        ends = feature < 0
        # A node without children leads to itself.
        left = np.where(ends, np.arange(len(feature)), np.array(tree.left, dtype=np.int64))
        most = np.iinfo(kind).max
        last = np.where(ends, most, np.array(tree.bin, dtype=np.int64) * classes + classes - 1).astype(kind)
        steps = tree.depth
        tables[t] = (slot, np.where(ends, 0, feature), left, last, steps, work.subsets, work.offsets * classes)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        sums = {t: np.zeros(work.size * classes) for t, work in works.items()}
        for batch in batches:
            for row in range(len(batch)):
                rows = batch.column(0)[row].as_py()
                cells, labels, counts = (
                    np.frombuffer(batch.column(c)[row].as_buffer(), dtype=t) for c, t in ((1, kind), (2, kind), (3, np.uint8))
                )
                counts = counts.reshape(-1, rows)
                weight_of = weights.take(labels)
                for t, (slot, feature, left, last, steps, subsets, offsets) in tables.items():
                    count = counts[t]
                    taken = np.flatnonzero(count)
                    begin = taken * features
                    if steps:
                        node = np.zeros(len(taken), dtype=np.int64)
                        for _ in range(steps):
                            right = cells.take(begin + feature.take(node)) > last.take(node)
                            node = left.take(node) + right
                        at = slot.take(node)
                        inside = np.flatnonzero(at >= 0)
                        if not len(inside):
                            continue
                        if len(inside) < len(at):
                            taken, begin, at = taken.take(inside), begin.take(inside), at.take(inside)
                    else:
                        at = np.zeros(len(taken), dtype=np.int64)
                    weight = count.take(taken) * weight_of.take(taken)
                    of = sums[t]
                    for j in range(subsets.shape[0]):
                        np.add.at(of, offsets[j].take(at) + cells.take(begin + subsets[j].take(at)), weight)
        for t, of in sums.items():
            yield pa.RecordBatch.from_pydict(
                {"tree": pa.array([t], pa.int32()), "part": pa.array([part], pa.int32()), "sums": [of.tobytes()]}
            )

    return add


def _gini(stats: np.ndarray, total: np.ndarray) -> np.ndarray:
    impurity = np.ones(total.shape)
    with np.errstate(invalid="ignore", divide="ignore"):
        for c in range(stats.shape[-1]):
            share = stats[..., c] / total
            impurity = impurity - share * share
    return np.where(total == 0, 0.0, impurity)


def _total(stats: np.ndarray) -> np.ndarray:
    total = np.zeros(stats.shape[:-1])
    for c in range(stats.shape[-1]):
        total = total + stats[..., c]
    return total


BEST = (
    "tree int, slot int, feature int, bin int, gain double, impurity double, valid boolean, own binary, left binary, "
    "right binary, raw long, left_raw long, right_raw long"
)
BEST_SCHEMA = pa.schema(
    [(c, pa.int32()) for c in ("tree", "slot", "feature", "bin")]
    + [("gain", pa.float64()), ("impurity", pa.float64()), ("valid", pa.bool_())]
    + [(c, pa.binary()) for c in ("own", "left", "right")]
    + [(c, pa.int64()) for c in ("raw", "left_raw", "right_raw")]
)


def _best_of(works: Mapping[int, Work], bins: np.ndarray, weights: np.ndarray, known: Mapping[int, np.ndarray | None]):
    """The best split of each node of a tree. ``known`` has the weights of its nodes, which their
    parents' splits gave, or none for a root."""
    classes, widest = len(weights), int(bins.max())
    unit = np.where(weights > 0, weights, 1.0)

    def choose(table: pa.Table) -> pa.Table:
        t = table.column("tree")[0].as_py()
        work = works[t]
        merged, rows = None, None
        for at in np.argsort(np.asarray(table.column("part").combine_chunks())).tolist():
            part = np.frombuffer(table.column("sums")[at].as_buffer()).reshape(-1, classes)
            # Of rows a bag has each class once or more at its one weight.
            count = np.rint(part / unit).astype(np.int64)
            merged, rows = (part.copy(), count) if merged is None else (merged + part, rows + count)
        nodes, per_node = len(work.nodes), len(work.subsets)
        subset = work.subsets.T
        place = work.offsets.T[..., None] + np.arange(widest)
        inside = np.arange(widest) < bins[subset][..., None]
        place = np.where(inside, place, 0)
        stats = np.where(inside[..., None], merged[place], 0.0).cumsum(axis=2)
        raw = np.where(inside, rows.sum(axis=1)[place], 0).cumsum(axis=2)
        total, all_raw = stats[:, :, -1, :], raw[:, :, -1]
        left, left_raw = stats[:, :, : max(widest - 1, 1)], raw[:, :, : max(widest - 1, 1)]
        right, right_raw = total[:, :, None] - left, all_raw[..., None] - left_raw
        split = np.arange(left.shape[2]) < (bins[subset] - 1)[..., None]
        any_split = split[:, :, 0].any(axis=1)
        first = np.argmax(split[:, :, 0], axis=1)
        each = np.arange(nodes)
        own = known[t]
        own_raw = all_raw[:, 0]
        if own is None:
            own = left[each, first, 0] + right[each, first, 0]
        # Without any feature to split by, the sums themselves are the node's.
        own = np.where(any_split[:, None], own, total[:, 0])
        impurity = _gini(own, _total(own))
        left_total, right_total = _total(left), _total(right)
        both = left_total + right_total
        with np.errstate(invalid="ignore", divide="ignore"):
            gain = impurity[:, None, None] - left_total / both * _gini(left, left_total)
            gain = gain - right_total / both * _gini(right, right_total)
        good = split & (left_raw >= 1) & (right_raw >= 1) & (gain >= 0)
        gain = np.where(good, gain, INVALID).reshape(nodes, -1)
        best = np.argmax(gain, axis=1)
        j, bin = best // left.shape[2], best % left.shape[2]

        def cells(values: np.ndarray) -> list[bytes]:
            return [v.tobytes() for v in np.ascontiguousarray(values)]

        return pa.table(
            [
                pa.array(np.full(nodes, t, dtype=np.int32)), pa.array(each.astype(np.int32)),
                pa.array(subset[each, j].astype(np.int32)), pa.array(bin.astype(np.int32)),
                pa.array(gain[each, best]), pa.array(impurity), pa.array(good.reshape(nodes, -1)[each, best]),
                pa.array(cells(own)), pa.array(cells(left[each, j, bin])), pa.array(cells(right[each, j, bin])),
                pa.array(own_raw), pa.array(left_raw[each, j, bin]), pa.array(right_raw[each, j, bin]),
            ],
            schema=BEST_SCHEMA,
        )

    return choose


def _child(id: int, deepest: bool, stats: np.ndarray, raw: int) -> Node:
    impurity = float(_gini(stats, _total(stats)))
    leaf = deepest or abs(impurity) < sys.float_info.epsilon
    return Node(id, leaf, tuple(stats.tolist()), int(raw), impurity)


def _grown(
    chunks: DataFrame, bins: np.ndarray, weights: np.ndarray, trees: int, depth: int, per_node: int, memory: int, seed: int
) -> list[Node]:
    draws = JavaRandom(seed)
    grown = [Tree(Node(1)) for _ in range(trees)]
    stack = [(t, tree.root) for t, tree in enumerate(grown)]
    classes = len(weights)
    while stack:
        group = _group_of(stack, draws, bins, per_node, classes, memory)
        works, known = {}, {}
        for t, members in group.items():
            subsets = np.array([s for _, s in members]).T
            sizes = bins[subsets]
            ends = sizes.T.cumsum().reshape(-1, len(subsets)).T
            works[t] = Work(np.array([n.at for n, _ in members]), subsets, ends - sizes, int(ends[-1, -1]))
            own = [n.stats for n, _ in members]
            known[t] = None if own[0] is None else np.array(own)
        add = _summed(works, {t: grown[t] for t in works}, len(bins), weights, _cell_type(bins, classes))
        sums = chunks.mapInArrow(add, "tree int, part int, sums binary")
        best = sums.groupBy("tree").applyInArrow(_best_of(works, bins, weights, known), BEST).toArrow()
        found = {(t, s): i for i, (t, s) in enumerate(zip(best["tree"].to_pylist(), best["slot"].to_pylist()))}
        columns = {c: best[c].to_pylist() for c in best.column_names}
        for t in _map_order(group):
            tree = grown[t]
            for slot, (node, _) in enumerate(group[t]):
                i = found[t, slot]
                own, left, right = (np.frombuffer(columns[c][i]) for c in ("own", "left", "right"))
                node.stats, node.raw = tuple(own.tolist()), columns["raw"][i]
                node.impurity, node.gain, node.valid = columns["impurity"][i], columns["gain"][i], columns["valid"][i]
                node.leaf = node.gain <= 0 or node.level == depth
                if node.leaf:
                    continue
                node.feature, node.bin = columns["feature"][i], columns["bin"][i]
                deepest = node.level + 1 == depth
                node.left = _child(2 * node.id, deepest, left, columns["left_raw"][i])
                node.right = _child(2 * node.id + 1, deepest, right, columns["right_raw"][i])
                tree.split(node)
                stack += [(t, child) for child in (node.left, node.right) if not child.leaf]
    return [tree.root for tree in grown]


NODE_SCHEMA = pa.schema(
    [
        ("treeID", pa.int32()),
        (
            "nodeData",
            pa.struct(
                [
                    ("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()),
                    ("impurityStats", pa.list_(pa.float64())), ("rawCount", pa.int64()), ("gain", pa.float64()),
                    ("leftChild", pa.int32()), ("rightChild", pa.int32()),
                    (
                        "split",
                        pa.struct(
                            [
                                ("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())),
                                ("numCategories", pa.int32()),
                            ]
                        ),
                    ),
                ]
            ),
        ),
    ]
)


def _node_rows(tree: int, root: Node, thresholds: Sequence[np.ndarray]) -> list[tuple]:
    """The tree as Spark saves it: leaves of one parent that predict the same are left out."""

    def pruned(node: Node) -> bool:
        """Whether the node is a leaf in the end."""
        if node.left is None:
            return True
        ends = pruned(node.left), pruned(node.right)
        if all(ends) and node.left.prediction == node.right.prediction:
            node.left = node.right = None
            return True
        return False

    rows: list[tuple] = []

    def save(node: Node) -> int:
        id = len(rows)
        rows.append(())
        impurity = node.impurity if node.valid else -1.0
        head = (id, node.prediction, impurity, list(node.stats), node.raw)
        if node.left is None:
            rows[id] = (tree, (*head, -1.0, -1, -1, (-1, [], -1)))
        else:
            children = save(node.left), save(node.right)
            limit = float(thresholds[node.feature][node.bin])
            rows[id] = (tree, (*head, node.gain, *children, (node.feature, [limit], -1)))
        return id

    pruned(root)
    save(root)
    return rows


def _named(values: tuple, kind: pa.StructType) -> dict:
    return {f.name: _named(v, f.type) if isinstance(v, tuple) else v for f, v in zip(kind, values)}


def _as_model(
    spark: SparkSession, forest: RandomForestClassifier, rows: list[tuple], features: int, classes: int
) -> RandomForestClassificationModel:
    """A model with these nodes: what Spark saves of a tree over rows that say nothing, made as many
    trees as wanted and with the settings of ``forest``, around them."""
    frame = spark.range(0, max(classes, 2), 1, 1).select(
        F.when(F.col("id") < classes, F.col("id")).otherwise(0).cast("double").alias(forest.getLabelCol()),
        F.lit(1.0).alias(forest.getWeightCol()),
        array_to_vector(F.expr(f"array_repeat(0D, {features})")).alias(forest.getFeaturesCol()),
    )
    workspace = Workspace.of(spark)
    path, plain = workspace.new_path("forest"), workspace.new_path("forest")
    forest.fit(frame, {forest.numTrees: 1, forest.maxDepth: 0}).write().save(plain)
    wanted = {"numTrees": forest.getNumTrees(), "maxDepth": forest.getMaxDepth()}
    about = json.loads(spark.read.text(f"{plain}/metadata").first()[0])
    about["paramMap"].update(wanted)
    about["numTrees"] = wanted["numTrees"]
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    one = spark.read.parquet(f"{plain}/treesMetadata")
    _, tree, weight = one.first()
    tree = json.loads(tree)
    tree["paramMap"]["maxDepth"] = wanted["maxDepth"]
    trees = [(t, json.dumps(tree), weight) for t in range(wanted["numTrees"])]
    spark.createDataFrame(trees, one.schema).coalesce(1).write.parquet(f"{path}/treesMetadata")
    of_tree, node = NODE_SCHEMA
    columns = [
        pa.array([t for t, _ in rows], of_tree.type),
        # A struct takes tuples with names only.
        pa.array([_named(values, node.type) for _, values in rows], node.type),
    ]
    spark.createDataFrame(pa.table(columns, schema=NODE_SCHEMA)).coalesce(1).write.parquet(f"{path}/data")
    return RandomForestClassificationModel.load(path)


def fit(
    rows: DataFrame, names: Sequence[str], label: str, weight_of: Mapping[int, float], count_of: Mapping[int, int],
    forest: RandomForestClassifier,
) -> RandomForestClassificationModel:
    """The forest that ``forest`` would fit to the features ``names`` of ``rows`` in the parts and the
    order they come in. ``weight_of`` and ``count_of`` have the weight and rows of each label."""
    spark = rows.sparkSession
    if not sum(count_of.values()):
        raise ValueError("a forest needs rows")
    classes = int(max(count_of)) + 1
    weights = np.array([weight_of.get(c, 0.0) for c in range(classes)])
    n, seed, trees = sum(count_of.values()), forest.getSeed(), forest.getNumTrees()
    weighted = sum(count_of[c] * weight_of[c] for c in count_of)
    most = min(forest.getMaxBins(), n) - 1
    cells = [f"CAST({sql.name(c)} AS DOUBLE) AS c{i}" for i, c in enumerate((*names, label))]
    # Read twice: for thresholds and for bins.
    held = rows.selectExpr(*cells).persist(StorageLevel.MEMORY_AND_DISK)
    wanted = max(forest.getMaxBins() ** 2, SAMPLED)
    fraction = wanted / n if wanted < n else 1.0
    first = int(XorShift([seed]).bits(32)[0])
    first -= first >> 31 << 32
    sampled = held.mapInArrow(_sample_of(fraction, first), "part int, rows long, cells binary").collect()
    rows_of = {r["part"]: r["rows"] for r in sampled if r["rows"] is not None}
    values = np.concatenate(
        [np.empty((0, len(names) + 1))]
        + [np.frombuffer(r["cells"]).reshape(-1, len(names) + 1) for r in sampled if r["rows"] is None]
    )
    of_rows = weights[values[:, -1].astype(np.int64)]
    thresholds = [thresholds_of(values[:, i], of_rows, fraction * weighted, most) for i in range(len(names))]
    bins = np.array([len(t) + 1 for t in thresholds])
    bag = _bagged(thresholds, classes, _cell_type(bins, classes), trees, seed, rows_of, jumps())
    chunks = held.mapInArrow(bag, "rows int, cells binary, labels binary, counts binary").persist(
        StorageLevel.MEMORY_AND_DISK
    )
    chunks.count()
    held.unpersist()
    per_node = math.ceil(math.sqrt(len(names))) if trees > 1 else len(names)
    memory = forest.getMaxMemoryInMB() << 20
    roots = _grown(chunks, bins, weights, trees, forest.getMaxDepth(), per_node, memory, seed)
    chunks.unpersist()
    nodes = [row for t, root in enumerate(roots) for row in _node_rows(t, root, thresholds)]
    return _as_model(spark, forest, nodes, len(names), classes)


@dataclass(frozen=True)
class Flat:
    """A tree as arrays by node: feature, limit, left and right child, the share of each class in turn.
    A leaf leads to itself."""

    feature: np.ndarray
    limit: np.ndarray
    children: np.ndarray
    shares: np.ndarray
    depth: int


_FLAT: weakref.WeakKeyDictionary[RandomForestClassificationModel, list[Flat]] = weakref.WeakKeyDictionary()


def flat_trees(spark: SparkSession, model: RandomForestClassificationModel) -> list[Flat]:
    """The trees of a model, read from what it saves."""
    if model in _FLAT:
        return _FLAT[model]
    path = Workspace.of(spark).new_path("forest")
    model.write().save(path)
    saved = spark.read.parquet(f"{path}/data").selectExpr(
        "treeID", "nodeData.id", "nodeData.impurityStats AS stats", "nodeData.leftChild", "nodeData.rightChild",
        "nodeData.split.featureIndex", "try_element_at(nodeData.split.leftCategoriesOrThreshold, 1) AS limit",
    ).toArrow().sort_by([("treeID", "ascending"), ("id", "ascending")]).combine_chunks()
    tree, left, right, feature, limit = (
        saved[c].to_numpy() for c in ("treeID", "leftChild", "rightChild", "featureIndex", "limit")
    )
    stats = np.array(saved["stats"].to_pylist(), dtype=np.float64).reshape(len(tree), -1)
    total = _total(stats)
    shares = np.where(total[:, None] != 0, stats / np.where(total != 0, total, 1.0)[:, None], 0.0)
    edges = np.searchsorted(tree, np.arange(model.getNumTrees + 1))
    flat = []
    for begin, end in zip(edges[:-1], edges[1:]):
        at = slice(begin, end)
        own, leaf = np.arange(end - begin), left[at] < 0
        children = np.stack([np.where(leaf, own, left[at]), np.where(leaf, own, right[at])], axis=1)
        depth, level = 0, np.zeros(1, dtype=np.int64)
        while len(level := children[level[~leaf[level]]].ravel()):
            depth += 1
        flat.append(
            Flat(
                np.where(leaf, 0, feature[at]).astype(np.int64), np.where(leaf, np.inf, limit[at]),
                children.ravel().astype(np.int64), np.ascontiguousarray(shares[at].T), depth,
            )
        )
    _FLAT[model] = flat
    return flat


def votes_of(flat: Sequence[Flat], values: np.ndarray, rows: int) -> np.ndarray:
    """The summed shares of each class for rows whose features follow each other in ``values``; added
    tree by tree as Spark does."""
    begin = np.arange(rows) * (len(values) // rows if rows else 0)
    votes = np.zeros((len(flat[0].shares), rows))
    for tree in flat:
        node = np.zeros(rows, dtype=np.int64)
        for _ in range(tree.depth):
            right = ~(values.take(begin + tree.feature.take(node)) <= tree.limit.take(node))
            node = tree.children.take(2 * node + right)
        for vote, share in zip(votes, tree.shares):
            vote += share.take(node)
    return votes
