"""Spelling variants: words at one edit from each other, found through a variable-length gram index.

The work is done on the vocabulary, which is counted from whole texts first.

1. **Gram dictionary.** Grams of 2 to ``LONGEST`` code points, pruned by frequency: a gram is an
   entry if at least one in ``DICTIONARY_SHARE`` gram places of the vocabulary holds it, so there are
   at most ``DICTIONARY_SHARE`` entries of each length, however large the vocabulary is.
2. **Decomposition.** At each place of a word the longest entry that begins there is taken (any two
   code points if there is none), and left out if it lies inside an earlier one. Frequent grams grow
   longer, rare ones stay short.
3. **Affected grams.** For each word and each place of an edit, the grams that the edit may change
   are bounded: those that hold the place; those before it from the first place on where an entry
   could now reach over the edit; those after it that an entry reaching over the edit could now
   cover. All other grams are the same in both words of a near pair, and which ones these are follows
   from the text before and after the edit, so both words find the same ones.
4. **List merging.** A word is listed under the unaffected grams of each edit place, taken together
   with the number of code points that both words share. Near words meet in at least one list: a
   replaced code point in lists of edited places, an inserted one in a list of the longer word's
   edited place and the shorter word's gap.
5. **Verification.** Words that meet are compared by edit distance.

A list of more than ``BLOCK`` words is dealt out in blocks, each compared with the whole list by
another task.

Defined results: null, empty and word-free texts add no words. A null key is the empty text in the
hash that decides on deletions. Repeated rows count each time. Words seen less than
``LEAST_SEEN`` times are no words here and nobody's neighbours. An empty table gives no rows; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.workspace import Workspace

RUNS = "[a-zÀ-ÿ]"
LEAST_LENGTH, LEAST_SEEN = 7, 2
DELETED = 31
FORM_RATIO = 10
SHORTEST, LONGEST = 2, 3
DICTIONARY_SHARE = 2_000
BLOCK = 1_000
# A Python worker hands on its counts when it holds this many words.
HELD_WORDS = 200_000


def _raw(column: pa.Array) -> Iterator[bytes]:
    """The bytes of each string; null is empty."""
    for value in column.cast(pa.binary()):
        yield value.as_py() or b""


def count_words(df: DataFrame, key: str, text: str, least_length: int = LEAST_LENGTH) -> DataFrame:
    """(word, n): runs of letters, one code point deleted from those whose hash says so."""
    runs = re.compile(RUNS + "{%d,}" % least_length)
    narrow = df.select(
        F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("k"),
        F.col(f"`{text}`").cast("string").alias("t"),
    ).where("t IS NOT NULL")

    def batch_of(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts.keys()), pa.string()), pa.array(list(counts.values()), pa.int64())],
            names=["word", "n"],
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        crc32 = zlib.crc32
        for batch in batches:
            for name, raw in zip(_raw(batch.column(0)), _raw(batch.column(1))):
                # On bytes, lower() changes A-Z only.
                found = Counter(runs.findall(raw.lower().decode("utf-8", "replace")))
                start = crc32(name + b":")
                for word, n in found.items():
                    h = crc32(word.encode(), start)
                    if h % DELETED == 0:
                        if len(word) == least_length:
                            continue
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                    counts[word] += n
                if len(counts) > HELD_WORDS:
                    yield batch_of(counts)
                    counts = Counter()
        yield batch_of(counts)

    partial = narrow.mapInArrow(work, "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


def gram_dictionary(words: DataFrame) -> frozenset[str]:
    """The frequent grams of the vocabulary: at most DICTIONARY_SHARE of each length."""
    sizes = range(SHORTEST, LONGEST + 1)
    places = words.agg(F.sum(F.length("word") - F.lit(SHORTEST - 1))).first()[0] or 0
    each = ", ".join(
        f"transform(sequence(1, length(word) - {q - 1}), i -> substring(word, i, {q}))" for q in sizes
    )
    grams = words.select(F.explode(F.expr(f"concat({each})")).alias("gram"))
    counted = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    frequent = counted.where(F.col("n") * DICTIONARY_SHARE >= places)
    return frozenset(r["gram"] for r in frequent.select("gram").collect())


class GramIndex:
    """Decomposition of words by a gram dictionary, and what an edit leaves of it."""

    BASE, MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1

    def __init__(self, dictionary: frozenset[str]):
        self.dictionary = dictionary
        # What an entry can begin with, and what it can go on with after its first code point.
        self.begun = {g[:m] for g in dictionary for m in range(SHORTEST, len(g))}
        self.inner = {
            g[j : j + m]
            for g in dictionary
            for j in range(1, len(g))
            for m in range(SHORTEST, len(g) - j + 1)
        }
        self.names: dict[str, int] = {}

    def grams(self, word: str) -> list[tuple[int, int]]:
        """(start, end) of the grams of a word; both rise from gram to gram."""
        out, reached, size = [], 0, len(word)
        for p in range(size - SHORTEST + 1):
            for q in range(min(LONGEST, size - p), SHORTEST - 1, -1):
                if q == SHORTEST or word[p : p + q] in self.dictionary:
                    break
            if p + q > reached:
                reached = p + q
                out.append((p, reached))
        return out

    def unaffected(self, word: str) -> tuple[list[tuple[int, int]], list[int], list[int]]:
        """The grams; and for each i, how many first ones cannot change with what follows
        word[:i], and from which one on they cannot change with what precedes word[i:]."""
        size, grams = len(word), self.grams(word)
        begun_before, ended_by = [0] * (size + 2), [0] * (size + LONGEST + 1)
        for start, end in grams:
            begun_before[start + 1] += 1
            ended_by[end] += 1
        for i in range(1, size + 2):
            begun_before[i] += begun_before[i - 1]
        for i in range(1, len(ended_by)):
            ended_by[i] += ended_by[i - 1]
        before, after = [0] * (size + 1), [0] * (size + 1)
        for i in range(size + 1):
            open_at = max(0, i - SHORTEST + 1)
            for p in range(max(0, i - LONGEST + 1), open_at):
                if word[p:i] in self.begun:
                    open_at = p
                    break
            before[i] = begun_before[open_at]
            covered = 0
            for m in range(SHORTEST, min(LONGEST, size - i + 1)):
                if word[i : i + m] not in self.inner:
                    break
                covered = m
            after[i] = max(begun_before[i], ended_by[i + covered])
        return grams, before, after

    def _name(self, gram: str) -> int:
        name = self.names.get(gram)
        if name is None:
            digest = hashlib.blake2b(gram.encode(), digest_size=8).digest()
            name = self.names[gram] = int.from_bytes(digest, "little")
        return name

    def lists(self, word: str) -> tuple[set[int], set[int]]:
        """The lists that the word is in: by the place that is edited, and by the gap that is
        filled. Lists are named by 64-bit hashes; equal names only add words to compare."""
        grams, before, after = self.unaffected(word)
        names = [self._name(word[a:b]) for a, b in grams]
        first, last = [1], [2]
        for name in names:
            first.append((first[-1] * self.BASE + name) & self.MASK)
        for name in reversed(names):
            last.append((last[-1] * self.BASE + name) & self.MASK)
        n, size, base, mask = len(names), len(word), self.BASE, self.MASK

        def listed(i: int, r: int, common: int) -> int:
            return ((first[before[i]] * base ^ last[n - after[r]]) * base + common) & mask

        edited = {listed(i, i + 1, size - 1) for i in range(size)}
        filled = {listed(i, i, size) for i in range(size + 1)}
        return edited, filled


def listed_words(words: DataFrame, dictionary: frozenset[str]) -> DataFrame:
    """(list, gap, word, n): one row per word and list that it is in."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = GramIndex(dictionary)
        for batch in batches:
            values, bounds, edited_lists = [], [0], []
            for word in batch.column(0).to_pylist():
                edited, filled = index.lists(word)
                values.extend(edited)
                values.extend(filled)
                bounds.append(len(values))
                edited_lists.append(len(edited))
            lists = pa.ListArray.from_arrays(
                pa.array(bounds, pa.int32()), pa.array(np.array(values, np.uint64).view(np.int64))
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), lists, pa.array(edited_lists, pa.int32())],
                names=["word", "n", "lists", "edited"],
            )

    made = words.select("word", "n").mapInArrow(
        work, "word string, n long, lists array<long>, edited int"
    )
    each = made.select("word", "n", "edited", F.posexplode("lists").alias("at", "list"))
    return each.select("list", (F.col("at") >= F.col("edited")).alias("gap"), "word", "n")


def near_pairs(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(a, n_a, b, n_b), each pair of words at one edit once."""
    listed = listed_words(words, gram_dictionary(words)).repartition("list")
    sizes = listed.groupBy("list").agg(
        F.count(F.lit(1)).alias("size"), F.count(F.expr("CASE WHEN NOT gap THEN 1 END")).alias("open")
    )
    # Same partitioning on both sides: the lists are shuffled once.
    useful = listed.join(sizes.where("size > 1 AND open > 0"), "list")
    useful = Workspace.of(words.sparkSession).stage(
        useful.withColumn("blocks", F.ceil(F.col("size") / F.lit(block)).cast("int")), "gram-lists"
    )
    own = useful.where("NOT gap").select(
        "list",
        F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int").alias("block"),
        F.col("word").alias("a"),
        F.col("n").alias("n_a"),
    )
    others = useful.select(
        "list",
        F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"),
        F.col("word").alias("b"),
        F.col("n").alias("n_b"),
        "gap",
    )
    met = own.join(others, ["list", "block"]).where(
        "(gap OR a < b) AND levenshtein(a, b, 1) = 1"
    )
    return met.select("a", "n_a", "b", "n_b").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where the chain of forms that begins at each word ends. Each round doubles the
    steps taken; counts grow from step to step, so chains have ends."""
    workspace = Workspace.of(forms.sparkSession)
    reached = workspace.stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = reached.select(F.col("word").alias("_at"), F.col("root").alias("_further"))
        step = reached.join(further, F.col("root") == F.col("_at"), "left")
        moved = workspace.stage(
            step.select(
                "word",
                F.coalesce("_further", "root").alias("root"),
                F.col("_further").isNotNull().alias("moved"),
            ),
            "roots",
        )
        workspace.discard(reached)
        reached = moved
        if reached.where("moved").isEmpty():
            return reached.select("word", "root")


def spelling_variants(
    df: DataFrame, key: str = "doc_id", text: str = "text", ratio: int = FORM_RATIO
) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the vocabulary."""
    workspace = Workspace.of(df.sparkSession)
    words = workspace.stage(count_words(df, key, text).where(F.col("n") >= LEAST_SEEN), "words")
    pairs = near_pairs(words)
    both = pairs.select(
        F.explode(
            F.expr(
                "array(struct(a AS word, n_a AS n, b AS near, n_b AS near_n),"
                " struct(b AS word, n_b AS n, a AS near, n_a AS near_n))"
            )
        ).alias("p")
    ).select("p.*")
    # The largest count first, then the smallest word in code-point order (that of the bytes).
    near = both.groupBy("word", "n").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"),
    )
    fits = -F.col("best.less") >= F.lit(ratio) * F.col("n")
    near = workspace.stage(
        near.select(
            "word",
            "n_near",
            F.when(fits, F.col("best.near")).alias("form"),
            F.when(fits, -F.col("best.less")).alias("form_n"),
        ),
        "near-words",
    )
    ends = roots(near.where("form IS NOT NULL"))
    out = words.join(near, "word", "left").join(ends, "word", "left")
    return out.select(
        "word",
        "form",
        F.coalesce("root", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        "form_n",
    )
