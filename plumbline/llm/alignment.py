"""Two tokenizers of the same text, aligned through the byte places where both end a token.

Work on a part of the documents is done on flat Arrow arrays: the token lists are flattened with
their parent indices, byte ends are cumulative sums that begin anew with each document, ends that
both tokenizers share come from a hash join on (document, end), and a document's pairs of linked
ids from a grouped table. What the parts hold is merged by Spark: counts of id pairs are partial
sums, and each document gets the counts of its pairs back.

Few pairs make most links, so the at most ``MOST_HOT`` pairs that hold at least one in ``MOST_HOT``
of all (document, pair) rows are looked up from a broadcast of that bounded size; only the rows of
rarer pairs are shuffled, and each of those pairs has few of them.

Tokenizer files are read by the driver and sent along with the code. Tokenizer A is the byte-level
vocabulary of a tokenizers file, whose merge order is its id order; it is run by tiktoken, which
gives the same ids several times faster, but for texts with runs of white space so long that its
pattern would exhaust the stack: those are left to the tokenizers library.

Defined results: null and empty texts, and texts that a tokenizer's pieces do not give back byte
for byte, have no tokens, zero counts and an empty digest. Every row is a document: repeated rows
are counted and returned one by one, whatever their ids. A table without rows gives none. Other
columns are neither read nor returned, whatever their names. Strings of special tokens inside a
text are plain text.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.workspace import Workspace

TOKENIZERS = "/opt/tokenizers"
# Texts are handled in parts of this many bytes, or one text if it is longer.
PART_BYTES = 1 << 20
# A group with more links than this is first reduced to its different ids.
LARGE_GROUP = 1 << 12
MOST_HOT = 1 << 20
# How the byte-level vocabulary splits a text before merging (fixed value of that vocabulary).
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it is
    printable Latin-1, else the next unused one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


# From this length on a run of white space is left to the slower library.
LONG_SPACE = re.compile(r"\s{2000}")


@dataclass(frozen=True)
class TokenizerPair:
    """What executors need: ranks of A's tokens by their bytes, and both files."""

    ranks: dict[bytes, int]
    stored: str
    model: bytes

    @classmethod
    def read(cls, byte_bpe: str, piece_bpe: str) -> "TokenizerPair":
        with open(byte_bpe, encoding="utf-8") as file:
            text = file.read()
        stored = json.loads(text)
        special = {t["content"] for t in stored["added_tokens"]}
        vocabulary = {t: i for t, i in stored["model"]["vocab"].items() if t not in special}
        # A merge's priority must be the id of what it makes, or ids as ranks would differ.
        made = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))]
                for m in stored["model"]["merges"]]
        if made != sorted(made):
            raise ValueError(f"{byte_bpe}: ids do not follow the order of merges")
        alphabet = byte_alphabet()
        ranks = {bytes(alphabet[c] for c in t): i for t, i in vocabulary.items()}
        with open(piece_bpe, "rb") as file:
            return cls(ranks, text, file.read())


def _binary(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.large_binary())


class Aligner:
    """Both tokenizers, and the tables that the alignment looks up by token id."""

    def __init__(self, pair: TokenizerPair):
        import sentencepiece
        import tiktoken

        self.a = tiktoken.Encoding(
            "a", pat_str=PATTERN, mergeable_ranks=pair.ranks, special_tokens={}
        )
        self.stored, self.slow_a = pair.stored, None
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pair.model)
        self.n_a, self.n_b = max(pair.ranks.values()) + 1, self.b.vocab_size()
        bytes_a = [b""] * self.n_a
        for value, i in pair.ranks.items():
            bytes_a[i] = value
        self.bytes_a = _binary(bytes_a)
        self.bytes_b = _binary([self._piece(i) for i in range(self.n_b)])
        self.size_a = pc.cast(pc.binary_length(self.bytes_a), pa.int64())
        self.size_b = pc.cast(pc.binary_length(self.bytes_b), pa.int64())
        # Each id as it is written inside a side, and where a side, a group or the text ends.
        ids_a = [str(i).encode() for i in range(self.n_a)]
        ids_b = [str(i).encode() for i in range(self.n_b)]
        self.written = _binary(
            [x + b"," for x in ids_a] + [x + b"|" for x in ids_a]
            + [x + b"," for x in ids_b] + [x + b";" for x in ids_b] + ids_b
        )

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def _encode_a(self, text: str) -> list[int]:
        if not LONG_SPACE.search(text):
            return self.a.encode_ordinary(text)
        if self.slow_a is None:
            import tokenizers

            self.slow_a = tokenizers.Tokenizer.from_str(self.stored)
            self.slow_a.encode_special_tokens = True
        return self.slow_a.encode(text, add_special_tokens=False).ids

    def encode(self, raws: list[bytes]) -> tuple[pa.ListArray, pa.ListArray]:
        """Token ids of both; none for texts that are empty or not given back byte for byte."""
        texts = [raw.decode("utf-8", "replace") for raw in raws]
        lists_a = [self._encode_a(" " + t) if t else [] for t in texts]
        lists_b = [self.b.encode(t, num_threads=1) if t else [] for t in texts]
        made = [pa.array(x, pa.list_(pa.int32())) for x in (lists_a, lists_b)]
        same = np.array([bool(raw) for raw in raws], dtype=bool)
        for ids, pieces in zip(made, (self.bytes_a, self.bytes_b)):
            same &= self._gives_back(ids, pieces, raws)
        return tuple(self._only(ids, same) for ids in made)

    @staticmethod
    def _gives_back(ids: pa.ListArray, pieces: pa.Array, raws: list[bytes]) -> np.ndarray:
        joined = pieces.take(ids.flatten())
        _, offsets, data = joined.buffers()
        ends = np.frombuffer(offsets, np.int64)[: len(joined) + 1][np.asarray(ids.offsets)]
        data = memoryview(data or b"").cast("B")
        return np.array(
            [
                ends[i + 1] - ends[i] == len(raw) + 1 and data[ends[i] : ends[i + 1]] == b" " + raw
                for i, raw in enumerate(raws)
            ],
            dtype=bool,
        )

    @staticmethod
    def _only(ids: pa.ListArray, same: np.ndarray) -> pa.ListArray:
        if same.all():
            return ids
        return pc.fill_null(pc.if_else(pa.array(same), ids, None), pa.scalar([], ids.type))

    @staticmethod
    def _ends(ids: pa.ListArray, sizes: pa.Array, name: str) -> tuple[pa.Table, np.ndarray]:
        """(doc, end, token number) of all tokens, and the flat ids."""
        flat = pc.list_flatten(ids)
        doc = pc.cast(pc.list_parent_indices(ids), pa.int32())
        total = np.concatenate([[0], np.asarray(pc.cumulative_sum(sizes.take(flat)))])
        # The running sum begins anew with each document.
        before = total[np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(ids)))])[:-1]]
        end = total[1:] - before[np.asarray(doc)]
        at = pa.array(np.arange(len(flat), dtype=np.int32))
        return pa.table({"doc": doc, "end": pa.array(end), name: at}), np.asarray(flat)

    def align(self, raws: list[bytes]) -> dict[str, pa.Array]:
        """Counts, digest and linked id pairs, one row per text."""
        n = len(raws)
        ids_a, ids_b = self.encode(raws)
        table_a, flat_a = self._ends(ids_a, self.size_a, "at_a")
        table_b, flat_b = self._ends(ids_b, self.size_b, "at_b")
        shared = table_a.join(table_b, ["doc", "end"], join_type="inner", use_threads=False)
        # Ends rise within a document, so both sides of the shared ends rise together.
        last_a = np.sort(np.asarray(shared["at_a"]))
        last_b = np.sort(np.asarray(shared["at_b"]))
        n_a, n_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        doc = np.asarray(table_a["doc"])[last_a]
        counts = [np.asarray(pc.list_value_length(x)).astype(np.int64) for x in (ids_a, ids_b)]
        links = np.concatenate([[0], np.cumsum(n_a.astype(np.int64) * n_b)])
        groups = np.searchsorted(doc, np.arange(n + 1))
        pairs, uses, bounds = self._pairs(
            flat_a, flat_b, last_a - n_a + 1, last_b - n_b + 1, n_a, n_b, doc, n
        )
        return {
            "n_a": pa.array(counts[0]),
            "n_b": pa.array(counts[1]),
            "n_groups": pa.array(np.diff(groups)),
            "n_links": pa.array(links[groups[1:]] - links[groups[:-1]]),
            "groups_sha256": pa.array(
                self._digests(flat_a, flat_b, last_a, last_b, n_a, n_b, groups), pa.string()
            ),
            "pairs": pa.ListArray.from_arrays(bounds, pairs),
            "uses": pa.ListArray.from_arrays(bounds, uses),
        }

    def _pairs(self, flat_a, flat_b, first_a, first_b, n_a, n_b, doc, n):
        """The different (a, b) of each document as a * n_b + b, and how often each is linked."""
        size = n_a.astype(np.int64) * n_b
        small = np.flatnonzero(size <= LARGE_GROUP)
        group = np.repeat(small, size[small])
        starts = np.cumsum(size[small]) - size[small]
        place = np.arange(len(group)) - np.repeat(starts, size[small])
        across = n_b[group]
        step = place // across
        a = flat_a[first_a[group] + step].astype(np.int64)
        b = flat_b[first_b[group] + place - step * across]
        parts = [(doc[group], a * self.n_b + b, np.ones(len(group), dtype=np.int64))]
        for g in np.flatnonzero(size > LARGE_GROUP):
            x, times_x = np.unique(flat_a[first_a[g] : first_a[g] + n_a[g]], return_counts=True)
            y, times_y = np.unique(flat_b[first_b[g] : first_b[g] + n_b[g]], return_counts=True)
            both = (x[:, None].astype(np.int64) * self.n_b + y).ravel()
            times = (times_x[:, None] * times_y).ravel()
            parts.append((np.full(len(both), doc[g], dtype=doc.dtype), both, times))
        doc, pair, uses = (np.concatenate(x) for x in zip(*parts))
        table = pa.table({"doc": doc, "pair": pair, "uses": uses})
        table = table.group_by(["doc", "pair"], use_threads=False).aggregate([("uses", "sum")])
        # Groups come out nearly, but not quite, in the order of their documents.
        order = np.argsort(np.asarray(table["doc"]), kind="stable")
        owner = np.asarray(table["doc"])[order]
        table = table.take(pa.array(order))
        bounds = pa.array(np.searchsorted(owner, np.arange(n + 1)).astype(np.int32))
        pair, uses = table["pair"].combine_chunks(), table["uses_sum"].combine_chunks()
        return pair, uses, bounds

    def _digests(self, flat_a, flat_b, last_a, last_b, n_a, n_b, groups) -> list[str]:
        total = len(flat_a) + len(flat_b)
        order = np.empty(total, dtype=np.int64)
        code_a = flat_a.astype(np.int64)
        code_a[last_a] += self.n_a
        code_b = flat_b.astype(np.int64) + 2 * self.n_a
        code_b[last_b] += self.n_b
        final = groups[1:][groups[1:] > groups[:-1]] - 1
        code_b[last_b[final]] += self.n_b
        # Of each group A's tokens come first: they follow B's of earlier groups.
        order[np.arange(len(flat_a)) + np.repeat(last_b - n_b + 1, n_a)] = code_a
        order[np.arange(len(flat_b)) + np.repeat(last_a + 1, n_b)] = code_b
        text = self.written.take(pa.array(order))
        _, offsets, data = text.buffers()
        offsets = np.frombuffer(offsets, np.int64)[: total + 1]
        through = np.concatenate([[0], last_a + last_b + 2])
        ends = offsets[through[groups]]
        data = memoryview(data or b"").cast("B")
        return [
            hashlib.sha256(data[x:y]).hexdigest() if y > x else ""
            for x, y in zip(ends[:-1], ends[1:])
        ]


ALIGNED = (
    "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pairs array<long>, uses array<long>"
)


def aligned_texts(df: DataFrame, key: str, text: str, pair: TokenizerPair) -> DataFrame:
    """Counts, digest and linked id pairs of every row of ``df``, after its ``id``."""
    narrow = df.select(df[f"`{key}`"].alias("id"), df[f"`{text}`"].cast("string").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(pair)
        for batch in batches:
            column = pc.fill_null(batch.column(1).cast(pa.large_binary()), b"")
            reached = np.cumsum(np.asarray(pc.binary_length(column)))
            first = 0
            while first < len(column):
                start = reached[first - 1] if first else 0
                end = max(int(np.searchsorted(reached, start + PART_BYTES, "right")), first + 1)
                made = aligner.align(column.slice(first, end - first).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), *made.values()],
                    names=["id", *made],
                )
                first = end

    kind = narrow.schema["id"].dataType.simpleString()
    return narrow.mapInArrow(work, f"id {kind}, {ALIGNED}")


def pair_counts(aligned: DataFrame, n_b: int) -> DataFrame:
    """(pair, n, best): documents that hold each id pair linked, and whether no other pair of its
    A id is in more documents."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def counted() -> pa.RecordBatch:
            table = pa.table({"pair": pa.chunked_array(held, pa.int64())})
            table = table.group_by("pair", use_threads=False).aggregate([([], "count_all")])
            return pa.RecordBatch.from_arrays(
                [table["pair"].combine_chunks(), table["count_all"].combine_chunks()],
                names=["pair", "n"],
            )

        for batch in batches:
            held.append(pc.list_flatten(batch.column(0)))
            rows += len(held[-1])
            if rows >= 1 << 22:
                yield counted()
                held, rows = [], 0
        if held:
            yield counted()

    counts = aligned.select("pairs").mapInArrow(partial, "pair long, n long")
    counts = counts.groupBy("pair").agg(F.sum("n").alias("n"))
    counts = Workspace.of(aligned.sparkSession).stage(counts, "pair-counts")
    id_a = F.floor(F.col("pair") / F.lit(n_b))
    # One row per id of A's vocabulary.
    highest = counts.groupBy(id_a.alias("id_a")).agg(F.max("n").alias("highest"))
    met = counts.withColumn("id_a", id_a).join(F.broadcast(highest), "id_a")
    return met.select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))


def _scored(aligned: DataFrame, hot: pa.Table) -> DataFrame:
    """Per row the sums over its hot pairs, and the other pairs."""
    order = np.argsort(np.asarray(hot["pair"]))
    hot_pair = np.asarray(hot["pair"])[order]
    hot_n = np.asarray(hot["n"])[order]
    hot_best = np.asarray(hot["best"])[order]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs, uses = batch.column(1), batch.column(2)
            bounds = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(pairs)))])
            pair, use = np.asarray(pairs.flatten()), np.asarray(uses.flatten())
            at = np.minimum(np.searchsorted(hot_pair, pair), max(len(hot_pair) - 1, 0))
            known = hot_pair[at] == pair if len(hot_pair) else np.zeros(len(pair), dtype=bool)
            n, best = np.zeros(len(pair), np.int64), np.zeros(len(pair), np.int64)
            n[known] = hot_n[at[known]] * use[known]
            best[known] = hot_best[at[known]] * use[known]
            sums = [np.concatenate([[0], np.cumsum(x)])[bounds] for x in (n, best)]
            rest = np.concatenate([[0], np.cumsum(~known)])[bounds].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.diff(sums[0])),
                    pa.array(np.diff(sums[1])),
                    pa.ListArray.from_arrays(pa.array(rest), pa.array(pair[~known])),
                    pa.ListArray.from_arrays(pa.array(rest), pa.array(use[~known])),
                ],
                names=["row", "count_sum", "n_best", "pairs", "uses"],
            )

    return aligned.select("row", "pairs", "uses").mapInArrow(
        work, "row long, count_sum long, n_best long, pairs array<long>, uses array<long>"
    )


def align_tokenizers(
    df: DataFrame, key: str = "doc_id", text: str = "text", folder: str = TOKENIZERS,
    byte_bpe: str = "byte_bpe_50k.json", piece_bpe: str = "piece_bpe_32k.model",
) -> DataFrame:
    """The key, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row."""
    import sentencepiece

    workspace = Workspace.of(df.sparkSession)
    pair = TokenizerPair.read(f"{folder}/{byte_bpe}", f"{folder}/{piece_bpe}")
    n_b = sentencepiece.SentencePieceProcessor(model_proto=pair.model).vocab_size()
    aligned = aligned_texts(df, key, text, pair)
    # Numbered as they are written, so that a row keeps its number when it is read again.
    aligned = workspace.stage(
        aligned.withColumn("row", F.monotonically_increasing_id()), "aligned-texts"
    )
    counts = workspace.stage(pair_counts(aligned, n_b), "ranked-pairs")
    total = counts.agg(F.sum("n")).first()[0] or 0
    is_hot = F.col("n") * F.lit(MOST_HOT) >= F.lit(total)
    scored = workspace.stage(_scored(aligned, counts.where(is_hot).toArrow()), "scored-texts")
    rare = scored.select("row", F.explode(F.arrays_zip("pairs", "uses")).alias("p")).select(
        "row", F.col("p.pairs").alias("pair"), F.col("p.uses").alias("uses")
    )
    rare = rare.join(counts.where(~is_hot), "pair").groupBy("row").agg(
        F.sum(F.col("n") * F.col("uses")).alias("rare_sum"),
        F.sum(F.col("uses") * F.col("best").cast("long")).alias("rare_best"),
    )
    out = (
        aligned.drop("pairs", "uses")
        .join(scored.select("row", "count_sum", "n_best"), "row")
        .join(rare, "row", "left")
    )

    def added(a: str, b: str):
        return (F.col(a) + F.coalesce(b, F.lit(0).cast("long"))).alias(a)

    return out.select(
        F.col("id").alias(key), "n_a", "n_b", "n_groups", "n_links",
        added("n_best", "rare_best"), added("count_sum", "rare_sum"), "groups_sha256",
    )
