"""Lines that many documents share, dropped from every document.

Lines are exploded as 128-bit hashes of their normalised form, the documents of each hash are
counted, and lines in ``LEAST_DOCUMENTS`` documents or more are dropped; what stays of a document
is put together again in its order. Texts themselves are shuffled once, to meet the list of their
dropped lines; a line never leaves its text.

A line in a third of all documents would make one huge group. Lines are therefore counted with
partial sums, and the at most ``MOST_HOT`` lines that hold at least one in ``MOST_HOT`` of all
(line, document) pairs are matched by broadcast; every other line has fewer pairs than that.

Defined results: a document is an id with its text, so a repeated row counts once and is returned
each time; rows with a null id count by their text. Null and empty texts are one empty line.
Lines of white space alone have an empty key and always stay. If every line of a text is dropped,
the empty text stays. An empty table gives no rows. Other columns are neither read nor returned,
whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.textkit import LOWER, PLAIN, Texts, lists, map_texts, mix, text_chunks
from plumbline.workspace import Workspace

LEAST_DOCUMENTS = 10
MOST_HOT = 2_000
# A second reading of the bytes, so that two hashes of a line are independent.
OTHER = np.random.default_rng(12).permutation(256).astype(np.uint8)


class Lines:
    """The lines of some texts; ``bounds[i]:bounds[i + 1]`` are the lines of text i."""

    def __init__(self, texts: Texts):
        breaks = np.flatnonzero(texts.data == 0x0A)
        # A line begins with its text and after each break; breaks belong to the line they end.
        begins = np.concatenate([texts.offsets[:-1], breaks + 1])
        ends = np.concatenate([texts.offsets[1:], breaks])
        owner = np.concatenate(
            [np.arange(texts.n), np.searchsorted(texts.offsets, breaks, side="right") - 1]
        )
        order = np.lexsort((begins, owner))
        self.starts, self.owner = begins[order], owner[order]
        self.ends = ends[np.lexsort((ends, owner))]
        self.bounds = np.searchsorted(self.owner, np.arange(texts.n + 1))
        self.texts = texts

    def keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which lines have a key, and the two hashes of those keys."""
        seen = np.flatnonzero(PLAIN[self.texts.data])
        first = np.searchsorted(seen, self.starts)
        last = np.searchsorted(seen, self.ends)
        has_key = last > first
        begin, end = seen[first[has_key]], seen[last[has_key] - 1] + 1
        lower = LOWER[self.texts.data]
        return (
            has_key,
            self.texts.span_hash(lower, begin, end),
            self.texts.span_hash(OTHER[lower], begin, end),
        )


def _line_keys(texts: Texts) -> dict[str, pa.Array]:
    found = Lines(texts)
    has_key, a, b = found.keys()
    bounds = np.searchsorted(found.owner[has_key], np.arange(texts.n + 1))
    return {
        "keys_a": lists(a.view(np.int64), bounds, pa.int64()),
        "keys_b": lists(b.view(np.int64), bounds, pa.int64()),
    }


def common_lines(pairs: DataFrame, least_documents: int) -> DataFrame:
    """(a, b, n) of the line keys that at least ``least_documents`` documents hold."""
    counted = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= least_documents)


def _matched(pairs: DataFrame, common: DataFrame) -> DataFrame:
    """The pairs whose line is common."""
    total = common.agg(F.sum("n")).first()[0] or 0
    is_hot = F.col("n") * F.lit(MOST_HOT) >= F.lit(total)
    hot = F.broadcast(common.where(is_hot).select("a", "b"))
    rest = common.where(~is_hot).select("a", "b")
    return pairs.join(hot, ["a", "b"], "left_semi").unionByName(
        pairs.join(hot, ["a", "b"], "left_anti").join(rest, ["a", "b"], "left_semi")
    )


def _without(texts: Texts, dropped: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Lines, dropped lines and remaining text of each text, given its list of dropped keys."""
    found = Lines(texts)
    has_key, a, b = found.keys()
    wanted = dropped.flatten()
    row = np.repeat(
        np.arange(texts.n, dtype=np.uint64), np.asarray(dropped.value_lengths().fill_null(0))
    )

    def named(owner, a, b):
        return mix(mix(owner.astype(np.uint64) + a) + b)

    drop = np.zeros(len(has_key), dtype=bool)
    columns = [np.asarray(wanted.field(i)).view(np.uint64) for i in (0, 1)]
    drop[has_key] = np.isin(named(found.owner[has_key], a, b), named(row, *columns))

    # Bytes of kept lines stay with the break that ends them, but for the last kept one of a text.
    length = np.diff(np.append(found.starts, len(texts.data)))
    stays = np.repeat(~drop, length)
    kept = np.flatnonzero(~drop)
    last = np.append(found.owner[kept][1:] != found.owner[kept][:-1], True) if len(kept) else kept
    final = kept[last] if len(kept) else kept
    breaks = found.ends[final]
    stays[breaks[breaks < texts.offsets[found.owner[final] + 1]]] = False
    before = np.zeros(len(stays) + 1, dtype=np.int64)
    np.cumsum(stays, out=before[1:])
    text = pa.StringArray.from_buffers(
        texts.n,
        pa.py_buffer(before[texts.offsets].astype(np.int32)),
        pa.py_buffer(texts.data[stays].tobytes()),
    )
    return np.diff(found.bounds), np.bincount(found.owner[drop], minlength=texts.n), text


def drop_common_lines(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least_documents: int = LEAST_DOCUMENTS,
) -> DataFrame:
    """The key, ``n_lines``, ``n_dropped`` and the ``kept`` text of every row of ``df``."""
    workspace = Workspace.of(df.sparkSession)
    rows = df.select(df[f"`{key}`"].alias("id"), df[f"`{text}`"].cast("string").alias("text"))
    rows = rows.withColumns(
        {
            "row_a": F.xxhash64("id", "text"),
            "row_b": F.xxhash64(F.lit(12), F.col("id").isNull(), "id", "text"),
        }
    )
    keyed = map_texts(
        rows, "text", ["row_a", "row_b"], "keys_a array<long>, keys_b array<long>", _line_keys
    )
    each = keyed.select("row_a", "row_b", F.explode(F.arrays_zip("keys_a", "keys_b")).alias("k"))
    pairs = workspace.stage(
        each.select(F.col("k.keys_a").alias("a"), F.col("k.keys_b").alias("b"), "row_a", "row_b")
        .distinct(),
        "line-pairs",
    )
    common = workspace.stage(common_lines(pairs, least_documents), "common-lines")
    drops = _matched(pairs, common).groupBy("row_a", "row_b").agg(
        F.collect_list(F.struct("a", "b")).alias("dropped")
    )
    # One list per document; a document that is repeated very often is split by the skew join.
    met = rows.join(drops, ["row_a", "row_b"], "left").select("id", "text", "dropped")
    return _reassembled(met, key)


def _reassembled(met: DataFrame, key: str) -> DataFrame:
    kind = met.schema["id"].dataType.simpleString()

    def work(batches):
        for batch in batches:
            for first, end, texts in text_chunks(batch.column(1)):
                n = end - first
                n_lines, n_dropped, kept = _without(texts, batch.column(2).slice(first, n))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, n),
                        pa.array(n_lines.astype(np.int64)),
                        pa.array(n_dropped.astype(np.int64)),
                        kept,
                    ],
                    names=["id", "n_lines", "n_dropped", "kept"],
                )

    out = met.mapInArrow(work, f"id {kind}, n_lines long, n_dropped long, kept string")
    return out.withColumnRenamed("id", key)
