"""Connected components of a table of links, by contracting what one task can see.

1. Each task joins the links of a block in memory and writes (node, root) of what hangs together
   there.
2. A node that different blocks gave different roots links those roots. A node has at most one root
   per block, so this is a small aggregation by node, also for a hub with links in every block.
3. The same is done with the links between roots, until there are none; then every node looks up
   the root of its root, level by level.

Roots are chosen by a hash of the node that is another one on each level, so that a chain whose
links all lie in different blocks loses a constant share of its nodes on each level. A table that
fits one block is done after the first level.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.textkit import mix
from plumbline.workspace import Workspace

# Links that are joined in memory at a time.
BLOCK_LINKS = 2_000_000


def block_roots(a: np.ndarray, b: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of some links and the root of each: its component's node of the least hash."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    # Labels are ranks by hash; the least label of a component wins.
    order = np.argsort(mix(nodes.view(np.uint64) + mix(np.uint64([salt]))), kind="stable")
    label = np.empty(len(nodes), dtype=np.int64)
    label[order] = np.arange(len(nodes))
    x, y = label[place[: len(a)]], label[place[len(a) :]]
    parent = np.arange(len(nodes))
    while len(x):
        low, high = np.minimum(x, y), np.maximum(x, y)
        np.minimum.at(parent, high, low)
        while True:
            further = parent[parent]
            if np.array_equal(further, parent):
                break
            parent = further
        x, y = parent[x], parent[y]
        open_links = x != y
        x, y = x[open_links], y[open_links]
    return nodes, nodes[order[parent[label]]]


def _contracted(links: DataFrame, salt: int, block: int) -> DataFrame:
    """(node, root) of every block of links; a node is there once per block that it is in."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def joined() -> pa.RecordBatch:
            a, b = (np.concatenate([x[i] for x in held]) for i in (0, 1))
            nodes, roots = block_roots(a, b, salt)
            return pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(roots)], ["node", "root"])

        for batch in batches:
            held.append([np.asarray(batch.column(i)) for i in (0, 1)])
            rows += len(batch)
            if rows >= block:
                yield joined()
                held, rows = [], 0
        if held:
            yield joined()

    return links.select("a", "b").mapInArrow(work, "node long, root long")


def components(links: DataFrame, block: int = BLOCK_LINKS) -> DataFrame:
    """(node, root) of every node of ``links`` (long columns a and b); nodes have the same root,
    one of them, if and only if links connect them. The result is a staged table."""
    workspace = Workspace.of(links.sparkSession)
    found, left, level = None, links, 0
    while True:
        forest = workspace.stage(_contracted(left, level, block), "block-roots")
        if level:
            workspace.discard(left)
        level += 1
        several = forest.groupBy("node").agg(F.collect_set("root").alias("roots"))
        several = several.where("size(roots) > 1")
        edges = several.select(
            F.element_at("roots", 1).alias("a"), F.explode(F.expr("slice(roots, 2, size(roots))")).alias("b")
        )
        left = workspace.stage(edges.distinct(), "root-links")
        one = forest.groupBy("node").agg(F.min("root").alias("root"))
        if found is not None:
            # Roots of the level below that were linked have a root on this one.
            further = one.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
            one = found.join(further.hint("merge"), F.col("root") == F.col("_node"), "left").select(
                "node", F.coalesce("_root", "root").alias("root")
            )
        written = workspace.stage(one, "components")
        workspace.discard(forest, *([] if found is None else [found]))
        found = written
        workspace.release()
        if left.isEmpty():
            workspace.discard(left)
            return found
