"""Benchmark decontamination with a generalised suffix automaton over the words of test items.

The automaton of all items knows every run of words that occurs in any item. Documents stream
through it word by word; the state says how long the longest run is that ends at this word and
occurs in some item. A run of ``window`` words marks those words as hit. An item shorter than the
window is one window of its own length.

Items are looked up by block: a block holds at most ``block_words`` words, its automaton is built
once and broadcast (bounded by that parameter), and documents pass all blocks one after the other.

Defined results: null or empty text has no words and no hits; null or word-free items match
nothing; repeated documents are reported one by one; repeated items count once per item key;
an empty benchmark hits nothing; extra columns are ignored.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.textkit import ALPHANUMERIC, lists, text_chunks
from plumbline.workspace import Workspace

WINDOW = 10
BLOCK_WORDS = 200_000


class SuffixAutomaton:
    """All runs of words of the items given, each item a list of word numbers."""

    def __init__(self, window: int):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link: list[int] = [-1]
        self.length: list[int] = [0]
        self.items: dict[int, set[str]] = {}
        self.short: dict[int, dict[int, set[str]]] = {}
        self.anchor: dict[int, int] = {}

    def _new(self, length: int, link: int, step: dict[int, int]) -> int:
        self.next.append(step)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, state: int, target: int, word: int) -> int:
        """A state for the shorter runs of ``target`` that end in ``word`` after ``state``."""
        copy = self._new(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = copy
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: int) -> int:
        known = self.next[last].get(word)
        if known is not None:
            if self.length[known] == self.length[last] + 1:
                return known
            return self._split(last, known, word)
        new = self._new(self.length[last] + 1, 0, {})
        state = last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            target = self.next[state][word]
            exact = self.length[target] == self.length[state] + 1
            self.link[new] = target if exact else self._split(state, target, word)
        return new

    def add(self, words: list[int]) -> None:
        last = 0
        for word in words:
            last = self._extend(last, word)

    def mark(self, item: str, words: list[int]) -> None:
        """Note the item at the states of its windows; call when all items are added."""
        if len(words) < self.window:
            state = 0
            for word in words:
                state = self.next[state][word]
            self.short.setdefault(state, {}).setdefault(len(words), set()).add(item)
            return
        for _, state, length in self.walk(words):
            if length >= self.window:
                self.items.setdefault(self.window_state(state), set()).add(item)

    def walk(self, words):
        """(position, state, length of the longest known run ending here) for each word."""
        follow, link, length = self.next, self.link, self.length
        state = size = 0
        for at, word in enumerate(words):
            while word not in follow[state] and state:
                state = link[state]
                size = length[state]
            state = follow[state].get(word, 0)
            size = size + 1 if state else 0
            yield at, state, size

    def window_state(self, state: int) -> int:
        """The state of the last ``window`` words of a longer run."""
        found = self.anchor.get(state)
        if found is None:
            found = state
            while self.length[self.link[found]] >= self.window:
                found = self.link[found]
            self.anchor[state] = found
        return found

    def short_items(self, state: int, size: int):
        """(length, items) of whole short items that end a run of ``size`` words at ``state``."""
        while state > 0:
            for length, items in self.short.get(state, {}).items():
                if length <= size:
                    yield length, items
            state = self.link[state]


class ItemBlock:
    """One block's automaton and the sorted hashes of its words."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        column = pa.array([text for _, text in items], type=pa.large_string())
        hashed = []
        for _, _, texts in text_chunks(column):
            words = texts.words(ALPHANUMERIC, lower=True)
            hashed += np.split(words.hashes, words.bounds[1:-1])
        self.vocabulary = np.unique(np.concatenate(hashed)) if hashed else np.zeros(0, np.uint64)
        self.automaton = SuffixAutomaton(window)
        numbered = [
            (item, np.searchsorted(self.vocabulary, h).tolist())
            for (item, _), h in zip(items, hashed)
        ]
        numbered = [(item, words) for item, words in numbered if words]
        for _, words in numbered:
            self.automaton.add(words)
        for item, words in numbered:
            self.automaton.mark(item, words)
        self.shortest = min((min(len(w), window) for _, w in numbered), default=0)

    def hits(self, hashes: np.ndarray, bounds: np.ndarray, text_of: np.ndarray):
        """(word flags, items found per text number) for the words of some texts."""
        flags = np.zeros(len(hashes) + 1, dtype=np.int64)
        found: dict[int, set[str]] = {}
        if not len(self.vocabulary) or not len(hashes):
            return flags[:-1] > 0, found
        number = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        known = self.vocabulary[number] == hashes
        # Only runs of known words, at least as long as the shortest window, can hold a hit.
        breaks = np.zeros(len(hashes) + 1, dtype=bool)
        breaks[bounds] = True
        opens = np.flatnonzero(known & (breaks[:-1] | ~np.r_[False, known[:-1]]))
        closes = np.flatnonzero(known & (breaks[1:] | ~np.r_[known[1:], False])) + 1
        long_enough = closes - opens >= self.shortest
        automaton, window = self.automaton, self.automaton.window
        for start, end in zip(opens[long_enough].tolist(), closes[long_enough].tolist()):
            for at, state, size in automaton.walk(number[start:end].tolist()):
                if size >= window:
                    flags[start + at - window + 1] += 1
                    flags[start + at + 1] -= 1
                    owner = found.setdefault(int(text_of[start]), set())
                    owner |= automaton.items.get(automaton.window_state(state), set())
                if automaton.short and size:
                    for length, items in automaton.short_items(state, size):
                        flags[start + at - length + 1] += 1
                        flags[start + at + 1] -= 1
                        found.setdefault(int(text_of[start]), set()).update(items)
        return np.cumsum(flags[:-1]) > 0, found


def item_blocks(
    benchmark: DataFrame, item: str, text: str, window: int, block_words: int
) -> list[ItemBlock]:
    """The items' automata, by blocks of bounded size; one block is in the driver at a time."""
    items = benchmark.select(
        benchmark[f"`{item}`"].cast("string").alias("item"),
        benchmark[f"`{text}`"].cast("string").alias("text"),
    ).where("text IS NOT NULL")
    # Two bytes hold at most one word and its separator.
    sized = items.withColumn("words", (F.octet_length("text") + 1) / 2)
    total = sized.agg(F.sum("words")).first()[0] or 0
    count = max(1, int(np.ceil(total / (block_words / 2))))
    if count == 1:
        rows = items.collect()
        return [ItemBlock([(r["item"], r["text"]) for r in rows], window)]
    blocks = []
    for block in range(count):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == block).collect()
        blocks.append(ItemBlock([(r["item"], r["text"]) for r in part], window))
    return blocks


HITS = (
    "n_words long, n_hit long, items array<string>, "
    "spans array<struct<start: long, end: long>>"
)
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _spans(texts, words, number: int, at: np.ndarray, first_char: np.ndarray) -> list[dict]:
    """Runs of hit words of text ``number`` as character positions within it."""
    cut = np.flatnonzero(np.diff(at) > 1)
    base = words.bounds[number]
    opens = words.starts[base + at[np.r_[0, cut + 1]]]
    closes = words.ends[base + at[np.r_[cut, len(at) - 1]]]
    zero = first_char[texts.offsets[number]]
    return [
        {"start": int(s), "end": int(e)}
        for s, e in zip(first_char[opens] - zero, first_char[closes] - zero)
    ]


def _block_pass(df: DataFrame, keep: list[str], text: str, block: ItemBlock, last: bool):
    """One block over all rows of ``df`` (``keep`` columns, and after a former block its
    ``_items`` and ``_flags``). The last block's pass yields HITS."""
    shared = df.sparkSession.sparkContext.broadcast(cloudpickle.dumps(block))
    resumed = "_flags" in df.columns
    kinds = [f"{k} {df.schema[k].dataType.simpleString()}" for k in keep]
    schema = ", ".join([*kinds, HITS if last else "_items array<string>, _flags array<long>"])

    def work(batches):
        block = pickle.loads(shared.value)
        for batch in batches:
            for begin, end, texts in text_chunks(batch.column(text)):
                rows = batch.slice(begin, end - begin)
                words = texts.words(ALPHANUMERIC, lower=True)
                hit, found = block.hits(words.hashes, words.bounds, words.text_of)
                before = [[]] * texts.n
                if resumed:
                    before = rows.column("_items").to_pylist()
                    for number, at in enumerate(rows.column("_flags").to_pylist()):
                        hit[words.bounds[number] + np.array(at, dtype=np.int64)] = True
                places = np.flatnonzero(hit)
                bounds = np.searchsorted(places, words.bounds)
                items = pa.array(
                    [sorted({*found.get(i, ()), *before[i]} - {None}) for i in range(texts.n)],
                    type=pa.list_(pa.string()),
                )
                kept = [rows.column(k) for k in keep]
                if not last:
                    places = places - words.bounds[words.text_of[places]]
                    flags = lists(places, bounds, pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [*kept, items, flags], names=[*keep, "_items", "_flags"]
                    )
                    continue
                first_char = np.zeros(len(texts.data) + 1, dtype=np.int64)
                np.cumsum((texts.data & 0xC0) != 0x80, out=first_char[1:])
                spans = [
                    _spans(texts, words, i, places[a:b] - words.bounds[i], first_char)
                    if b > a
                    else []
                    for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist()))
                ]
                made = [
                    pa.array(words.per_text.astype(np.int64)),
                    pa.array(np.diff(bounds).astype(np.int64)),
                    items,
                    pa.array(spans, type=SPANS),
                ]
                yield pa.RecordBatch.from_arrays(
                    [*kept, *made], names=[*keep, "n_words", "n_hit", "items", "spans"]
                )

    return df.mapInArrow(work, schema)


def contaminated_spans(
    df: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``keep`` columns and HITS of every row: words, hit words, items found, and the hit spans
    as character positions (first character, first character after)."""
    spark = df.sparkSession
    wanted = [c for c in keep if c != text]
    inner = [f"_k{i}" for i in range(len(wanted))]
    current = df.select(
        *[df[f"`{c}`"].alias(k) for c, k in zip(wanted, inner)],
        df[f"`{text}`"].cast("string").alias("_text"),
    )
    blocks = item_blocks(benchmark, item, item_text, window, block_words)
    written = None
    for block in blocks[:-1]:
        # One automaton in a worker at a time: between blocks the rows are written.
        current = _block_pass(current, [*inner, "_text"], "_text", block, last=False)
        passed = Workspace.of(spark).stage(current, "decontaminate")
        if written is not None:
            Workspace.of(spark).discard(written)
        current = written = passed
    carried = [*inner, "_text"] if text in keep else inner
    out = _block_pass(current, carried, "_text", blocks[-1], last=True)
    return out.withColumnsRenamed({**dict(zip(inner, wanted)), "_text": text})


def items_digest(items):
    """Lower-case hex SHA-256 of the sorted item keys, joined by commas."""
    return F.sha2(F.array_join(F.array_sort(items), ",").cast("binary"), 256)


def remove_spans(
    df: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    window: int = WINDOW,
    max_coverage: float = 0.5,
) -> DataFrame:
    """``df`` without the hit spans. A row of which more than ``max_coverage`` of the words are
    hit is removed as a whole. Rows without hits come back unchanged; so does a null text."""
    plain = [f"c{i}" for i in range(len(df.columns))]
    body = plain[df.columns.index(text)]
    hit = contaminated_spans(df.toDF(*plain), benchmark, body, tuple(plain), window=window)
    kept = hit.where(F.col("n_hit") <= F.col("n_words") * F.lit(max_coverage))
    parts = F.expr(
        f"array_join(transform(sequence(0, size(spans)), i -> substring({body}, "
        "int(if(i = 0, 0, spans[i - 1].end)) + 1, "
        f"int(if(i = size(spans), length({body}), spans[i].start)) "
        "- int(if(i = 0, 0, spans[i - 1].end)))), '')"
    )
    clean = kept.withColumn(body, F.when(F.col("n_hit") > 0, parts).otherwise(F.col(body)))
    return clean.select(*plain).toDF(*df.columns)
