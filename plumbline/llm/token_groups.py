"""Near-duplicate join on word shingles with a token-group matrix.

A text is the set of its distinct shingles of ``size`` words; texts of fewer words are one
shingle. Two texts link when 100 * |A n B| >= percent * |A u B|.

1. Equal sets become one node. Tokens get one order for the whole corpus: tokens that a sketch over
   all texts finds frequent come last. Texts that link share a token among their first
   |A| - ceil(t |A|) + 1 tokens (the prefix).
2. Nodes that share prefix tokens with the smallest or largest node of a token, and pass an exact
   comparison, form groups. In further rounds nodes are compared with other leaders of their
   tokens, drawn by hash, as long as that joins many groups: a family of many near copies becomes one
   group with work in proportion to its members.
3. The token-group matrix has a row for each token and group whose union of prefixes holds it. The
   tokens that a node shares with a group's union bound the overlap with each of its members; only
   other groups whose bound reaches the threshold are opened, by nodes of the smaller of two
   groups, and their members that may still link are compared exactly.
4. Components of all links. A link between nodes that are in one group already cannot change them.

Only sets of nodes that are compared are ever moved as a whole; copies are never paired.

Defined results: null or word-free text has 0 shingles, links with nothing and is its own
component; repeated rows and equal texts share a component; a null key takes part (its links
count) but never names a component that has another key; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.components import components
from plumbline.llm.textkit import BASE, PLAIN, Texts, lists, map_texts, mix, row_digest, text_chunks
from plumbline.workspace import Workspace

SKETCH_BITS = 22
# A task reports a sketch cell that holds so many of its texts, and so many times the mean.
SKETCH_LEAST, SKETCH_TIMES = 6, 3
# Leaders drawn for each node in a round of grouping, and rounds at most before the exact pass. A
# further round must be worth its jobs: the last one found a link for every so many nodes at least.
LOOKS, ROUNDS, WORTH = 16, 4, 50
# Members of an opened group that one task compares with a node.
GROUP_PART = 256
# Words of 64 bits of the sketch of rows whose texts are looked up.
LOOKUP_BITS = 18


def shingle_sets(texts: Texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of all texts, sorted within each text, and the bounds of each text."""
    words = texts.words(PLAIN, lower=True)
    values, first = words.windows(size)
    owner = words.text_of[first]
    few = np.flatnonzero((words.per_text > 0) & (words.per_text < size))
    if len(few):
        whole = np.zeros(len(few), dtype=np.uint64)
        for k in range(size - 1):
            more = words.per_text[few] > k
            at = words.bounds[few[more]] + k
            whole[more] = whole[more] * np.uint64(BASE) + words.hashes[at]
        whole = mix(whole ^ mix(words.per_text[few].astype(np.uint64)))
        values, owner = np.concatenate([values, whole]), np.concatenate([owner, few])
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    fresh = np.ones(len(values), dtype=bool)
    fresh[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[fresh], owner[fresh]
    return values, np.searchsorted(owner, np.arange(texts.n + 1))


def frequent_cells(df: DataFrame, text: str, size: int) -> np.ndarray:
    """A rank per sketch cell, 0 for ordinary ones and higher the more texts hold its tokens.

    Each task counts all of its texts in an array of 2^SKETCH_BITS cells and reports the cells
    that stand out. The order made from this is the same for all texts whatever is reported, so
    results never depend on it; only the work does.
    """
    narrow = df.select(df[f"`{text}`"].cast("string").alias("_text"))

    def count(batches):
        cells = np.zeros(1 << SKETCH_BITS, dtype=np.int32)
        for batch in batches:
            for _, _, texts in text_chunks(batch.column("_text")):
                values, _ = shingle_sets(texts, size)
                np.add.at(cells, (values >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
        least = max(SKETCH_LEAST, SKETCH_TIMES * cells.mean())
        found = np.flatnonzero(cells >= least)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found), pa.array(cells[found].astype(np.int64))], names=["cell", "n"]
        )

    found = narrow.mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    # At most one row per cell of the sketch, whatever the size of the corpus.
    rows = found.toArrow()
    ranks = np.zeros(1 << SKETCH_BITS, dtype=np.uint8)
    counts = rows.column("n").to_numpy().astype(np.float64)
    ranks[rows.column("cell").to_numpy()] = np.minimum(np.log2(np.maximum(counts, 2)), 30) + 1
    return ranks


def described_rows(df: DataFrame, text: str, keep: list[str], size: int, percent: int):
    """``keep`` columns, set size, a 128-bit digest of the set and its prefix of every row."""
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(frequent_cells(df, text, size).tobytes())

    def make(texts: Texts) -> dict[str, pa.Array]:
        ranks = np.frombuffer(shared.value, dtype=np.uint8)
        values, bounds = shingle_sets(texts, size)
        n = np.diff(bounds)
        owner = np.repeat(np.arange(texts.n), n)
        rank = ranks[(values >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.uint64)
        order = np.lexsort((values, rank, owner))
        prefix = n - -(-n * percent // 100) + (n > 0)
        place = np.arange(len(values)) - np.repeat(bounds[:-1], n)
        chosen = order[place < np.repeat(prefix, n)]
        sums = []
        for salt in (MIX_A, MIX_B):
            running = np.zeros(len(values) + 1, dtype=np.uint64)
            np.cumsum(mix(values ^ salt), out=running[1:])
            sums.append(mix(running[bounds[1:]] - running[bounds[:-1]] + n.astype(np.uint64)))
        ends = np.concatenate([[0], np.cumsum(prefix)])
        return {
            "n": pa.array(n.astype(np.int64)),
            "d1": pa.array(sums[0].view(np.int64)),
            "d2": pa.array(sums[1].view(np.int64)),
            "prefix": lists(values[chosen].view(np.int64), ends, pa.int64()),
        }

    return map_texts(df, text, keep, "n long, d1 long, d2 long, prefix array<long>", make)


MIX_A, MIX_B = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)


def possible_rows(df: DataFrame, digest: str, wanted: DataFrame) -> DataFrame:
    """``df`` without most rows whose ``digest`` (64 bits) is not in ``wanted``'s only column.

    The few texts that a round compares would otherwise bring all texts into a shuffle. The digests
    are marked in a sketch of 2^LOOKUP_BITS words of 64 bits whatever their number, which is sent to
    all tasks; rows that it lets through by chance are left to the join that follows.
    """
    word = f"shiftrightunsigned({{}}, {64 - LOOKUP_BITS})"
    (held,) = wanted.columns
    marks = wanted.selectExpr(f"{word.format(held)} AS _word", f"CAST({held} & 63 AS INT) AS _bit")
    marks = marks.groupBy("_word").agg(F.expr("bit_or(shiftleft(1L, _bit))").alias("_bits"))
    near = df.join(F.broadcast(marks), F.expr(f"{word.format(digest)} = _word"))
    return near.where(f"bit_get(_bits, CAST({digest} & 63 AS INT)) = 1").select(*df.columns)


def _merged(df: DataFrame) -> DataFrame:
    """The side of a join that is to be merged, not broadcast: one more small table in the driver
    for each of very many joins costs it more than the shuffle costs the executors."""
    return df.hint("merge")


def _needed(n: str, m: str, percent: int) -> str:
    """Overlap that two sets of these sizes need, as SQL."""
    return f"ceil({percent} * ({n} + {m}) / {100 + percent}D)"


def _rest(n: str, percent: int) -> str:
    """Tokens after the prefix, as SQL."""
    return f"(ceil({percent} * {n} / 100D) - 1)"


def _may_link(n: str, m: str, shared: str, percent: int) -> str:
    """Whether sets that share so many prefix tokens can reach the threshold: whichever prefix
    ends first, all common tokens up to there are shared prefix tokens."""
    rest = f"greatest({_rest(n, percent)}, {_rest(m, percent)})"
    return (
        f"least({n}, {m}) * 100 >= {percent} * greatest({n}, {m}) "
        f"AND {shared} + {rest} >= {_needed(n, m, percent)}"
    )


def _may_reach(n: str, least: str, most: str, shared: str, percent: int) -> str:
    """Whether a set of ``n`` may link with one of ``least`` to ``most`` tokens that shares so many
    prefix tokens. The bound is weakest at the smallest or the largest size that may link; rounding
    moves it by one token at most between them."""
    lo = f"greatest({least}, ceil({percent} * {n} / 100D))"
    hi = f"least({most}, floor(100 * {n} / {percent}D))"
    shared = f"{shared} + if({lo} < {hi}, 1, 0)"
    ends = " OR ".join(f"({_may_link(n, end, shared, percent)})" for end in (lo, hi))
    return f"({lo} <= {hi} AND ({ends}))"


class _Job:
    """Tables of one run."""

    def __init__(self, df: DataFrame, key: str, text: str, size: int, percent: int):
        self.workspace = Workspace.of(df.sparkSession)
        self.size, self.percent = size, percent
        # Equal rows are interchangeable: a row is known by the digest of all its columns.
        self.rows_in = df.select(
            df[f"`{key}`"].alias("key"),
            df[f"`{text}`"].cast("string").alias("text"),
            row_digest(*[df[f"`{c}`"] for c in df.columns]).alias("row_key"),
        )
        rows = described_rows(self.rows_in, "text", ["key", "row_key"], size, percent)
        self.rows = self.stage(rows, "shingle-rows")
        nodes = self.rows.where("n > 0").groupBy("d1", "d2").agg(
            F.first("n").alias("n"),
            F.min("key").alias("key"),
            F.min("row_key").alias("row_key"),
            F.first("prefix").alias("prefix"),
        )
        # Numbered when written: everything later reads these numbers.
        nodes = nodes.withColumn("node", F.monotonically_increasing_id())
        self.nodes = self.stage(nodes, "shingle-nodes")
        postings = self.nodes.select("node", F.explode("prefix").alias("token"))
        spans = postings.groupBy("token").agg(F.min("node").alias("lo"), F.max("node").alias("hi"))
        spans = spans.where("lo < hi").withColumnRenamed("token", "_token")
        # Most tokens belong to one node; the others are all that is looked at from here.
        live = postings.join(_merged(spans), F.col("token") == F.col("_token")).drop("_token")
        self.live = self.stage(live, "live-postings")
        # A node shares at most its live tokens with any other.
        counts = self.live.groupBy("node").agg(F.count(F.lit(1)).alias("live"))
        counts = counts.join(_merged(self.nodes.select("node", "n")), "node")
        self.known = self.stage(counts, "live-nodes")
        self.live_nodes = self.known.count()

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """Write a table of this run. Its plans, shuffles and broadcasts are done with, and there
        are many such tables: what they hold in the driver goes before the next one is made."""
        staged = self.workspace.stage(df, name)
        self.workspace.release()
        return staged

    def _bounded(self, pairs: DataFrame, shared: str) -> DataFrame:
        """Of pairs (a, b), those that can reach the threshold; ``shared`` is SQL over a column
        of the pairs or over la and lb, the live tokens of either."""
        left = self.known.select(
            F.col("node").alias("_a"), F.col("n").alias("na"), F.col("live").alias("la")
        )
        right = self.known.select(
            F.col("node").alias("_b"), F.col("n").alias("nb"), F.col("live").alias("lb")
        )
        sized = pairs.join(_merged(left), F.col("a") == F.col("_a")).join(_merged(right), F.col("b") == F.col("_b"))
        return sized.where(_may_link("na", "nb", shared, self.percent)).select("a", "b")

    def leader_pairs(self) -> DataFrame:
        """(a, b): nodes that share enough prefix tokens with the first or last node of those."""
        met = self.live.select("token", "node", F.explode(F.array("lo", "hi")).alias("lead"))
        met = met.where("node <> lead").select(
            "token", F.least("node", "lead").alias("a"), F.greatest("node", "lead").alias("b")
        )
        # The first and the last node of a token meet twice.
        counted = met.distinct().groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"))
        return self._bounded(counted, "shared")

    def drawn_pairs(self, groups: DataFrame, number: int) -> DataFrame:
        """(a, b) of different groups: nodes and leaders of their tokens drawn by hash, LOOKS per
        node where a family shares its tokens."""
        look = F.pmod("token", F.lit(LOOKS))
        draw = F.struct(F.xxhash64("node", look, F.lit(number)).alias("draw"), "node")
        leads = self.live.groupBy("token").agg(F.min(draw).alias("lead"))
        leads = leads.select(F.col("token").alias("_token"), F.col("lead.node").alias("lead"))
        met = self.live.select("token", "node").join(_merged(leads), F.col("token") == F.col("_token"))
        pairs = met.where("node <> lead").select(
            F.least("node", "lead").alias("a"), F.greatest("node", "lead").alias("b")
        ).distinct()
        roots = groups.select("node", "root")
        left = roots.select(F.col("node").alias("_na"), F.col("root").alias("_ra"))
        right = roots.select(F.col("node").alias("_nb"), F.col("root").alias("_rb"))
        apart = self._bounded(pairs, "least(la, lb)")
        apart = apart.join(_merged(left), F.col("a") == F.col("_na"), "left")
        apart = apart.join(_merged(right), F.col("b") == F.col("_nb"), "left")
        return apart.where("coalesce(_ra, a) <> coalesce(_rb, b)").select("a", "b")

    def links(self, pairs: DataFrame) -> tuple[DataFrame, int]:
        """The pairs whose whole sets reach the threshold, and their number. Sets are made anew
        from the texts of the nodes in question."""
        wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        wanted = self.nodes.join(_merged(wanted), "node").select("node", F.col("row_key").alias("_row"))
        wanted = self.stage(wanted, "wanted-rows")
        # Texts are looked up as they come, not sorted; a row has one node.
        texts = possible_rows(self.rows_in, "row_key.h1", wanted.select("_row.h1"))
        texts = texts.join(wanted.hint("shuffle_hash"), F.col("row_key") == F.col("_row"))
        texts = texts.dropDuplicates(["row_key"]).select("node", "text")

        def make(texts: Texts, size: int) -> dict[str, pa.Array]:
            values, bounds = shingle_sets(texts, size)
            return {"tokens": lists(values.view(np.int64), bounds, pa.int64())}

        sets = map_texts(texts, "text", ["node"], "tokens array<long>", partial(make, size=self.size))
        sets = self.stage(sets, "shingle-sets")
        left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("left"))
        right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("right"))
        both = pairs.join(_merged(left), "a").join(_merged(right), "b")
        common = both.select(
            "a", "b", (F.size("left") + F.size("right")).alias("total"),
            F.size(F.array_intersect("left", "right")).alias("common"),
        )
        linked = common.where(f"100 * common >= {self.percent} * (total - common)")
        links = self.stage(linked.select("a", "b"), "shingle-links")
        # The sets are the largest scratch table, and the links are written.
        self.workspace.discard(sets, wanted)
        return links, links.count()

    def opened_pairs(self, groups: DataFrame) -> DataFrame:
        """(a, b) of different groups that the token-group matrix cannot rule out; staged."""
        p = self.percent
        roots = groups.select(F.col("node").alias("_node"), "root")
        placed = self.known.join(_merged(roots), F.col("node") == F.col("_node"), "left")
        placed = placed.select("node", "n", "live", F.coalesce("root", "node").alias("group"))
        sizes = placed.groupBy("group").agg(F.count(F.lit(1)).alias("members"))
        placed = self.stage(placed.join(_merged(sizes), "group"), "placed-nodes")
        live = self.live.select("token", "node").join(_merged(placed), "node")
        # Tokens of one group only say nothing about other groups.
        several = live.groupBy("token").agg(F.min("group").alias("g"), F.max("group").alias("h"))
        several = several.where("g < h").select(F.col("token").alias("_token"))
        live = live.join(_merged(several), F.col("token") == F.col("_token"), "left_semi")
        live = self.stage(live, "open-postings")
        matrix = live.groupBy("token", "group", "members").agg(
            F.min("n").alias("least"), F.max("n").alias("most"), F.max("live").alias("reach")
        )
        matrix = matrix.select(
            F.col("token").alias("_token"), F.col("group").alias("other"),
            F.col("members").alias("others"), "least", "most", "reach",
        )
        # Before tokens are counted, a node and a member share no more than either has live.
        met = live.join(
            matrix,
            F.expr(
                "token = _token AND (members < others OR members = others AND group < other) AND "
                + _may_reach("n", "least", "most", "least(live, reach)", p)
            ),
        )
        bounded = met.groupBy("node", "n", "live", "other", "others").agg(
            F.count(F.lit(1)).alias("shared"), F.min("least").alias("lo"), F.max("most").alias("hi")
        )
        qualified = bounded.where(_may_reach("n", "lo", "hi", "shared", p))
        qualified = self.stage(
            qualified.select("node", "n", "live", "other", "others", "shared"), "open-groups"
        )
        # A group of one node was compared with the whole bound already.
        single = qualified.where("others = 1").select(
            F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")
        )
        # Members of a large group are dealt to parts, and what opens the group goes to each part.
        parts = f"CAST(ceil(%s / {GROUP_PART}D) AS INT)"
        members = placed.select(
            F.col("node").alias("member"), F.col("group").alias("_group"),
            F.col("n").alias("m"), F.col("live").alias("reach"),
            F.expr(f"pmod(xxhash64(node), {parts % 'members'})").alias("_part"),
        )
        several = qualified.where("others > 1").withColumn(
            "part", F.explode(F.expr(f"sequence(0, {parts % 'others'} - 1)"))
        )
        opened = several.join(
            members,
            F.expr(
                "other = _group AND part = _part AND "
                + _may_link("n", "m", "least(live, reach, shared)", p)
            ),
        )
        pairs = opened.select(
            F.least("node", "member").alias("a"), F.greatest("node", "member").alias("b")
        ).union(single)
        pairs = self.stage(pairs, "pairs")
        self.workspace.discard(placed, live, qualified)
        return pairs


def _classes(job: _Job) -> DataFrame:
    """(node, root) of all nodes in links, by way of groups and opened groups."""
    workspace = job.workspace

    def joined(pairs: DataFrame, groups: DataFrame | None) -> tuple[DataFrame, int]:
        """The groups that the links among staged ``pairs`` make of ``groups``, and how many links
        these are; all else that was staged for them is deleted."""
        more, found = job.links(pairs)
        workspace.discard(pairs)
        if groups is not None and not found:
            workspace.discard(more)
            return groups, 0
        edges = more
        if groups is not None:
            # A group is a component so far: joining roots is enough.
            tree = groups.select(F.col("node").alias("a"), F.col("root").alias("b"))
            edges = more.unionByName(tree)
        wider = components(edges)
        workspace.discard(more, *([] if groups is None else [groups]))
        workspace.release(executors=True)
        return wider, found

    groups, _ = joined(job.stage(job.leader_pairs(), "pairs"), None)
    for number in range(ROUNDS):
        pairs = job.stage(job.drawn_pairs(groups, number), "pairs")
        groups, found = joined(pairs, groups)
        if found * WORTH < job.live_nodes:
            break
    groups, _ = joined(job.opened_pairs(groups), groups)
    workspace.discard(job.live, job.known)
    return groups


def near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80
) -> DataFrame:
    """(key, n_shingles, component_id) of every row; component_id is the smallest key among all
    rows reachable by links."""
    job = _Job(df, key, text, size, percent)
    placed = job.nodes.join(_merged(_classes(job)), "node", "left").select(
        "d1", "d2", "key", F.coalesce("root", "node").alias("root")
    )
    names = placed.groupBy("root").agg(F.min("key").alias("component_id"))
    classes = placed.join(_merged(names), "root").select("d1", "d2", "component_id")
    out = job.rows.where("n > 0").join(_merged(classes), ["d1", "d2"])
    out = out.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), "component_id")
    empty = job.rows.where("n = 0").select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), F.col("key").alias("component_id")
    )
    return out.unionByName(empty)


def one_of_each(
    df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80
) -> DataFrame:
    """``df`` with one row of each component: that of the smallest key (null last), of equal keys
    the one with the smallest row hash. Rows without words are linked with nothing and stay."""
    job = _Job(df, key, text, size, percent)
    placed = job.nodes.join(_merged(_classes(job)), "node", "left").select(
        "d1", "d2", F.coalesce("root", "node").alias("root")
    )
    rows = job.rows.where("n > 0").join(_merged(placed), ["d1", "d2"])
    first = rows.groupBy("root").agg(
        F.min(F.struct(F.col("key").isNull().alias("none"), "key", "row_key")).alias("first")
    )
    kept = first.select(F.col("first.row_key").alias("_row"))
    plain = [f"c{i}" for i in range(len(df.columns))]
    whole = df.toDF(*plain)
    whole = whole.withColumn("row_key", row_digest(*[whole[c] for c in plain]))
    body = F.col(plain[df.columns.index(text)])
    wordless = body.isNull() | ~body.rlike(r"[^\x20\x09-\x0D]")
    chosen = whole.join(kept.hint("shuffle_hash"), F.col("row_key") == F.col("_row"), "left_semi")
    chosen = chosen.where(~wordless).dropDuplicates(["row_key"])
    return chosen.unionByName(whole.where(wordless)).select(*plain).toDF(*df.columns)
