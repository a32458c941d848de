"""Main text of pages by wrapper induction per host.

A page is a tree of blocks. The trees of a host's pages are aligned by simple tree matching into
one wrapper: a tree of slots, each with the number of pages that have it, whether its text is the
same on all of them, and how much of it is text or links. Neighbouring leaves of one label are one
repeating slot, so the wrapper grows with the templates of a host, not with its pages; texts that
it begins or ends with on every page are kept apart. A slot with
constant text is template; a varying one is content, unless its tag or class says what else it is
(menu, footer, advert, comments and so on) or it is mostly links. Where a page marks its article,
text outside is left out, and the wrapper decides inside, with a higher bar: a slot is template
if most of the host's pages with that article element repeat it, and only as long as a fifth of
the text stays.

Wrappers are merged within each task, then per host in two steps (a busy host has at most one
partial wrapper for each task), and joined back to the pages.

Defined results: null or empty html has no text; a null or unparsable URL belongs to the host "";
a host with fewer than three different pages has no constant slots; repeated rows are extracted
one by one and count as one page for the wrapper; unclosed and stray tags are repaired as browsers
do; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import html
import math
import pickle
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.workspace import Workspace

# A slot is template when its text was the same on this many different pages of the host.
LEAST_PAGES = 3
# Slots of one parent that are aligned in order; with more, blocks of one label form one slot.
MOST_SLOTS = 48
LINK_SHARE = 0.6
# In a marked article: the share of the host's pages with it that have to repeat a slot, and the
# share of its text that has to stay.
MAIN_PAGES, LEAST_LEFT = 0.5, 0.2
SALTS = 32

# Blocks are nested as deep as this, like in browsers; text of deeper ones belongs to the last.
MOST_DEPTH = 256
# What follows a listed word in the class of a part that it names, as in comments-area.
CONTAINERS = frozenset(
    "area bar block body box button buttons container content form group holder inner item items "
    "link links list menu outer panel post posts row section slot text title unit widget wrap "
    "wrapper".split()
)

# What HTML tags mean for the text of an article.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset(
    "script style noscript template svg iframe textarea object math xmp noembed noframes select".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby "
    "s samp small span strike strong sub sup time tt u var wbr nobr".split()
)
SKIPPED_TAGS = frozenset(
    "head title nav footer aside form button menu dialog iframe audio video canvas map "
    "fieldset legend datalist option".split()
)
CLOSED_BY_BLOCK = frozenset(["p"])
SAME_CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
}
SCOPES = frozenset("ul ol dl table div article section main body aside td".split())
MAIN_TAGS = frozenset(["article", "main"])
SKIPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu "
    "menubar toolbar".split()
)
SKIPPED_WORDS = frozenset(
    "nav navbar navigation menu sidebar footer masthead ad ads advert adverts advertisement "
    "advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
    "notices popup modal overlay comment comments disqus respond replies reply social share "
    "sharing related recommended breadcrumb breadcrumbs pagination pager subscribe subscription "
    "newsletter signup login search widget toolbar skip alert paywall".split()
)

NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
# A tag as most are written, found or not before the next < or >.
SIMPLE = re.compile(
    r"<(/?)([a-zA-Z][^\s/<>]*)((?:[^<>=]|=(?!\s*[\"'])|=\s*\"[^\"<>]*\"|=\s*'[^'<>]*')*+)>"
)
# What ends a tag, or begins a quoted value inside which nothing does.
TAG_MARK = re.compile(r">|=\s*[\"']")
ATTRIBUTE = re.compile(r"(?<![a-zA-Z-])([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
SPACE = re.compile(r"\s+")
LONG_REFERENCE = re.compile(r"&#(?:([0-9]{8,})|[xX]([0-9a-fA-F]{8,}));?")


class Block:
    """A block element: its label, and in page order its pieces of text and inner blocks. It is
    skipped for its tag, role or style, or only named like parts that are not of the article."""

    __slots__ = ("label", "tag", "skipped", "named", "parts", "links")

    def __init__(self, label: str, tag: str, skipped: bool, named: bool):
        self.label, self.tag, self.skipped, self.named = label, tag, skipped, named
        self.parts: list = []
        self.links = 0

    def text(self) -> str:
        return SPACE.sub(" ", "".join(p for p in self.parts if isinstance(p, str))).strip()

    def blocks(self) -> list["Block"]:
        return [p for p in self.parts if isinstance(p, Block)]


def _named(tokens: list[str], tag: str, in_main: bool) -> bool:
    """Whether class and id name a part that is not of the article. Around and inside a marked
    article only names that say so plainly count: a listed word alone, and inside it also one at
    the end, or at the beginning before the word for a container."""
    for token in tokens:
        words = re.findall(r"[a-z]+", token)
        if not words or SKIPPED_WORDS.isdisjoint(words):
            continue
        if len(words) == 1:
            return True
        if tag == "article":
            continue
        if not in_main or words[-1] in SKIPPED_WORDS:
            return True
        if words[0] in SKIPPED_WORDS and words[1] in CONTAINERS | SKIPPED_WORDS:
            return True
    return False


def _label(tag: str, attrs: str, in_main: bool) -> tuple[str, bool, bool]:
    """The block's label for alignment, whether tag, role or style take it out, and whether its
    class or id does."""
    skipped = tag in SKIPPED_TAGS or (tag == "header" and not in_main)
    if not attrs.strip():
        return tag, skipped, False
    values = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attrs)}
    names = f"{values.get('class', '')} {values.get('id', '')}".lower()
    named = tag not in ("html", "body", "main") and _named(names.split(), tag, in_main)
    hidden = "display:none" in values.get("style", "").replace(" ", "").lower()
    hidden = hidden or bool(re.search(r"(?:^|\s)hidden(?:\s|=|/|$)", ATTRIBUTE.sub(" ", attrs)))
    skipped = skipped or hidden or values.get("role", "").lower() in SKIPPED_ROLES
    return ".".join([tag, *sorted(set(re.findall(r"[a-z]+", names)))]), skipped, named


class Scanner:
    """The texts and tags of a page, in one pass: what is scanned is either used or not scanned
    again."""

    def __init__(self, page: str):
        self.page, self.last_end, self.quotes = page, page.rfind(">"), True

    def _tag_end(self, at: int) -> int:
        """Where the tag that is open at ``at`` ends. A tag that never ends shows that quotes are
        broken, so they mean nothing from there on."""
        at_first = at
        while self.quotes:
            mark = TAG_MARK.search(self.page, at)
            if mark is None:
                self.quotes = False
            elif mark.group() == ">":
                return mark.start()
            else:
                close = self.page.find(mark.group()[-1], mark.end())
                if close < 0:
                    self.quotes = False
                at = close + 1
        return self.page.find(">", at_first)

    def __iter__(self):
        """(text, None, None, None) or (None, closing, tag, attributes)."""
        page, at, size = self.page, 0, len(self.page)
        while at < size:
            start = page.find("<", at)
            if start < 0:
                start = size
            if start > at:
                yield page[at:start], None, None, None
            if start == size:
                return
            simple = SIMPLE.match(page, start) if self.quotes else None
            if simple is not None and (simple[1] or simple[2].lower() not in RAW):
                yield None, simple[1], simple[2].lower(), simple[3]
                at = simple.end()
                continue
            if page.startswith("<!--", start):
                close = page.find("-->", start + 4)
                at = size if close < 0 else close + 3
                continue
            if start > self.last_end:
                # No tag ends from here on.
                yield "<", None, None, None
                at = start + 1
                continue
            if page[start + 1 : start + 2] in ("!", "?"):
                at = page.find(">", start) + 1
                continue
            name = NAME.match(page, start)
            if name is None:
                if page[start + 1 : start + 2] == "/":
                    at = page.find(">", start) + 1
                else:
                    yield "<", None, None, None
                    at = start + 1
                continue
            end = self._tag_end(name.end())
            if end < 0:
                yield "<", None, None, None
                at = start + 1
                continue
            tag, at = name[2].lower(), end + 1
            if tag in RAW and not name[1]:
                close = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                at = close.end() if close else size
                continue
            yield None, name[1], tag, page[name.end() : end]


def _unescaped(text: str) -> str:
    """Character references decoded; numbers beyond any character are one replacement each."""

    def short(match: re.Match) -> str:
        digits = (match[1] or match[2]).lstrip("0")
        if len(digits) > 7:
            return "\ufffd"
        return f"&#{'x' if match[2] else ''}{digits or '0'};"

    return html.unescape(LONG_REFERENCE.sub(short, text))


class OpenBlocks:
    """The blocks that are open, and where each tag is among them."""

    def __init__(self, root: Block):
        self.stack = [(root.tag, root)]
        self.places: dict[str, list[int]] = {}
        self.scopes: list[int] = []

    def last(self, *tags: str) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def push(self, tag: str, block: Block) -> None:
        self.places.setdefault(tag, []).append(len(self.stack))
        if tag in SCOPES:
            self.scopes.append(len(self.stack))
        self.stack.append((tag, block))

    def close(self, depth: int) -> None:
        """Close the block at ``depth`` and all inside it."""
        while len(self.stack) > depth:
            tag, block = self.stack.pop()
            self.places[tag].pop()
            if tag in SCOPES:
                self.scopes.pop()
            if len(self.stack) >= MOST_DEPTH:
                block.parts.append(" ")


def parse(page: str) -> Block:
    """The page's tree of blocks. Inline elements are text of their block; a line break is white
    space, so is a block border."""
    root = Block("#", "#", False, False)
    opened = OpenBlocks(root)
    inline_links = 0
    for text, closing, tag, attrs in Scanner(page):
        block = opened.stack[-1][1]
        if text is not None:
            text = _unescaped(text)
            block.parts.append(text)
            if inline_links:
                block.links += len(text.strip())
            continue
        if tag in INLINE:
            if tag == "a":
                inline_links = 0 if closing else 1
            continue
        if tag in VOID:
            block.parts.append(" ")
            continue
        inline_links = 0
        if closing:
            # A stray end tag closes nothing.
            if opened.last(tag):
                opened.close(opened.last(tag))
            continue
        if opened.stack[-1][0] in CLOSED_BY_BLOCK:
            opened.close(len(opened.stack) - 1)
        same = opened.last(*SAME_CLOSES.get(tag, ()))
        # Up to the next scope, which may itself be what is closed.
        if same and same >= (opened.scopes[-1] if opened.scopes else 0):
            opened.close(same)
        if tag in ("html", "body") and opened.last(tag):
            continue
        if tag == "body" and opened.stack[-1][0] == "head":
            opened.close(len(opened.stack) - 1)
        label, skipped, named = _label(tag, attrs, bool(opened.last(*MAIN_TAGS)))
        parent = opened.stack[-1][1]
        made = Block(label, tag, skipped, named)
        if len(opened.stack) < MOST_DEPTH:
            parent.parts.append(made)
        else:
            # Too deep for a block of its own: its text goes on in the parent's, or nowhere.
            parent.parts.append(" ")
            made = made if skipped or named else parent
        if not attrs.rstrip().endswith("/") or tag in MAIN_TAGS:
            opened.push(tag, made)
    return root


class Slot:
    """What the wrapper knows about the blocks of one place."""

    __slots__ = ("label", "pages", "value", "constant", "chars", "links", "head", "tail", "slots")

    def __init__(self, label, pages, value, constant, chars, links, head, tail, slots):
        self.label, self.pages, self.value, self.constant = label, pages, value, constant
        self.chars, self.links, self.slots = chars, links, slots
        # Of a run of leaves: the texts that it begins and ends with on all pages.
        self.head, self.tail = head, tail


def _runs(blocks: list[Block]) -> list[list[Block]]:
    """Neighbouring blocks of one label without inner blocks together; where that leaves very
    many, all of one label together."""
    runs: list[list[Block]] = []
    leaf = False
    for block in blocks:
        was_leaf, leaf = leaf, not any(isinstance(p, Block) for p in block.parts)
        if was_leaf and leaf and runs[-1][0].label == block.label:
            runs[-1].append(block)
        else:
            runs.append([block])
    if len(runs) <= MOST_SLOTS:
        return runs
    by_label: dict[str, list[Block]] = {}
    for block in blocks:
        by_label.setdefault(block.label, []).append(block)
    return list(by_label.values())


def slot_of(blocks: list[Block]) -> Slot:
    """The slot that one page's blocks of one place make."""
    texts = [b.text() for b in blocks]
    value = hash_text("\n".join(texts))
    inner = [x for b in blocks for x in b.blocks()]
    leaves = tuple(map(hash_text, texts)) if not inner else ()
    return Slot(
        blocks[0].label, 1, value, True, sum(map(len, texts)), sum(b.links for b in blocks),
        leaves, leaves, [slot_of(run) for run in _runs(inner)],
    )


def _common(left: tuple, right: tuple) -> tuple:
    """What both begin with."""
    n = next((i for i, (a, b) in enumerate(zip(left, right)) if a != b), min(len(left), len(right)))
    return left[:n]


def hash_text(text: str) -> int:
    """A 64-bit value that is the same in every process."""
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "big")


def align(left: list, right: list, label=lambda x: x.label, inner=lambda x: x.slots):
    """Simple tree matching: the order-keeping pairs of equal label that match most nodes.

    Returns (size of the match, pairs of indices)."""
    if len(left) == len(right) and all(label(a) == label(b) for a, b in zip(left, right)):
        # Same labels in the same order: no other pairing matches more.
        return len(left), [(i, i) for i in range(len(left))]
    n, m = len(left), len(right)
    best = np.zeros((n + 1, m + 1), dtype=np.int64)
    take = np.zeros((n + 1, m + 1), dtype=np.int8)
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            score, how = (best[i - 1, j], 1) if best[i - 1, j] >= best[i, j - 1] else (best[i, j - 1], 2)
            if label(left[i - 1]) == label(right[j - 1]):
                below, _ = align(inner(left[i - 1]), inner(right[j - 1]), label, inner)
                if best[i - 1, j - 1] + 1 + below > score:
                    score, how = best[i - 1, j - 1] + 1 + below, 3
            best[i, j], take[i, j] = score, how
    pairs, i, j = [], n, m
    while i and j:
        if take[i, j] == 3:
            pairs.append((i - 1, j - 1))
            i, j = i - 1, j - 1
        elif take[i, j] == 1:
            i -= 1
        else:
            j -= 1
    return int(best[n, m]), pairs[::-1]


def merge(left: Slot, right: Slot) -> Slot:
    """One slot from two of the same label; what only one of them has is kept."""
    _, pairs = align(left.slots, right.slots)
    slots, i, j = [], 0, 0
    for a, b in [*pairs, (len(left.slots), len(right.slots))]:
        slots += left.slots[i:a] + right.slots[j:b]
        if a < len(left.slots):
            slots.append(merge(left.slots[a], right.slots[b]))
        i, j = a + 1, b + 1
    return Slot(
        left.label, left.pages + right.pages, left.value,
        left.constant and right.constant and left.value == right.value,
        left.chars + right.chars, left.links + right.links, _common(left.head, right.head),
        _common(left.tail[::-1], right.tail[::-1])[::-1], slots,
    )


def _plain(slot: Slot) -> tuple:
    own = (slot.label, slot.pages, slot.value, slot.constant, slot.chars, slot.links)
    return (*own, slot.head, slot.tail, [_plain(s) for s in slot.slots])


def _slot(plain: tuple) -> Slot:
    return Slot(*plain[:-1], [_slot(s) for s in plain[-1]])


def pack(wrapper: Slot) -> bytes:
    """A wrapper, the slot of whole pages, as bytes that any process can read."""
    return pickle.dumps(_plain(wrapper))


def unpack(data: bytes) -> Slot:
    return _slot(pickle.loads(data))


def page_wrapper(page: str) -> Slot:
    return slot_of([parse(page)])


def _chars(slot: Slot, own) -> int:
    return own(slot) + sum(_chars(s, own) for s in slot.slots)


def _is_link_list(slot: Slot) -> bool:
    """Menus without a telling name."""
    chars = _chars(slot, lambda s: s.chars)
    return bool(chars) and _chars(slot, lambda s: s.links) > LINK_SHARE * chars


def _inner_main(block: Block, through_named: bool) -> list[Block]:
    """The articles of a page, or its main element where no article is marked."""
    found = []
    for b in block.blocks():
        if b.skipped or (b.named and not (through_named and b.tag not in MAIN_TAGS)):
            continue
        if b.tag == "article":
            found.append(b)
            continue
        inner = _inner_main(b, through_named)
        found += [b] if b.tag == "main" and not any(x.tag == "article" for x in inner) else inner
    return found


def _places(block: Block, slot: Slot, into: dict[int, tuple[Slot, int, int]]) -> None:
    """The slot of every block below ``block``, its place in its run, and the size of the run."""
    runs = _runs(block.blocks())
    _, pairs = align(
        runs, slot.slots,
        lambda x: x[0].label if isinstance(x, list) else x.label,
        lambda x: _runs([k for b in x for k in b.blocks()]) if isinstance(x, list) else x.slots,
    )
    for i, j in pairs:
        for at, b in enumerate(runs[i]):
            into[id(b)] = slot.slots[j], at, len(runs[i])
            if not b.skipped:
                _places(b, slot.slots[j], into)


def _repeated(slot: Slot, at: int, size: int, least: int) -> bool:
    """Whether the own text of a block of the slot is template: constant on ``least`` pages, or one of the texts
    that its run begins or ends with on them."""
    if slot.pages < least or not slot.chars:
        return False
    return slot.constant or at < len(slot.head) or size - at <= len(slot.tail)


def _emit(
    block: Block, out: list[str], places: dict, least: int = LEAST_PAGES, links: bool = True,
    names: bool = True,
) -> None:
    """The block's text in page order. Without places, everything that is not skipped counts;
    with ``links``, lists of links are template too; with ``names``, what class and id say counts."""
    place = places.get(id(block))
    own = place is None or not _repeated(*place, least)
    piece: list[str] = []
    for part in block.parts:
        if isinstance(part, str):
            if own:
                piece.append(part)
            continue
        out.append("".join(piece))
        piece = []
        if part.skipped or (names and part.named):
            continue
        inner = places.get(id(part))
        if links and inner is not None and _is_link_list(inner[0]):
            continue
        _emit(part, out, places, least, links, names)
    out.append("".join(piece))


def _joined(pieces: list[str]) -> str:
    return " ".join(p for p in (SPACE.sub(" ", t).strip() for t in pieces) if p)


def _marked_text(block: Block, places: dict) -> str:
    """The text of a marked article or main element. The mark raises the bar: template is what
    most of the host's pages with that element repeat, and never nearly all of its text (then
    the pages are copies of one text)."""
    whole: list[str] = []
    _emit(block, whole, {})
    place = places.get(id(block))
    if place is None:
        return _joined(whole)
    out: list[str] = []
    least = max(LEAST_PAGES, math.ceil(MAIN_PAGES * place[0].pages))
    _emit(block, out, places, least, links=False)
    text, full = _joined(out), _joined(whole)
    return text if len(text) >= LEAST_LEFT * len(full) else full


def extract(page: str, wrapper: Slot | None) -> str:
    """The main text of a page, given its host's wrapper."""
    root = parse(page)
    # Constant slots are only told apart where the host's pages differ.
    places: dict[int, tuple[Slot, int, int]] = {}
    if wrapper is not None and wrapper.pages >= LEAST_PAGES:
        places[id(root)] = wrapper, 0, 1
        _places(root, wrapper, places)
    # A block's name does not take out the article that it is around, if there is no other.
    main = _inner_main(root, False) or _inner_main(root, True)
    if main:
        return _joined([_marked_text(block, places) for block in main])
    # Nor does it take out all the text that there is.
    for names in (True, False):
        out: list[str] = []
        _emit(root, out, places, names=names)
        if text := _joined(out):
            return text
    return ""


def host_column(url) -> F.Column:
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    return F.coalesce(host, F.lit(""))


def _combined(parts) -> Slot | None:
    whole = None
    for part in parts:
        whole = part if whole is None else merge(whole, part)
    return whole


def induce(pages: DataFrame) -> DataFrame:
    """(host, wrapper) from a table of host and html. Of equal pages of a host one counts: trees
    of single pages, without their texts, are told apart by the digest of the page."""

    def trees(batches):
        for batch in batches:
            made = [pack(page_wrapper(page.as_py())) for page in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("host"), batch.column("digest"), pa.array(made, type=pa.binary())],
                names=["host", "digest", "wrapper"],
            )

    def partial_wrappers(batches):
        wrappers: dict[str, Slot] = {}
        for batch in batches:
            for host, packed in zip(batch.column("host"), batch.column("wrapper")):
                name, made = host.as_py(), unpack(packed.as_py())
                wrappers[name] = merge(wrappers[name], made) if name in wrappers else made
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(wrappers), type=pa.string()),
                pa.array([pack(w) for w in wrappers.values()], type=pa.binary()),
            ],
            names=["host", "wrapper"],
        )

    def merged(table: pa.Table) -> pa.Table:
        # In the order of their bytes, so that the result does not depend on arrival.
        parts = sorted(table.column("wrapper").to_pylist())
        whole = pack(_combined(unpack(p) for p in parts))
        return pa.table(
            {"host": table.column("host").slice(0, 1), "wrapper": pa.array([whole], pa.binary())}
        )

    schema = "host string, wrapper binary"
    known = pages.select("host", "html", F.sha2(F.col("html").cast("binary"), 256).alias("digest"))
    single = known.mapInArrow(trees, "host string, digest string, wrapper binary")
    single = single.groupBy("host", "digest").agg(F.first("wrapper").alias("wrapper"))
    parts = single.select("host", "wrapper").mapInArrow(partial_wrappers, schema).withColumn(
        "salt", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS))
    )
    once = parts.groupBy("host", "salt").applyInArrow(merged, schema)
    return once.groupBy("host").applyInArrow(merged, schema)


def main_text(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html"):
    """key, url and text of every page."""
    spark = pages.sparkSession
    rows = pages.select(
        pages[f"`{key}`"].alias("key"),
        pages[f"`{url}`"].cast("string").alias("url"),
        F.coalesce(pages[f"`{html}`"].cast("string"), F.lit("")).alias("html"),
        host_column(pages[f"`{url}`"].cast("string")).alias("host"),
    )
    wrappers = Workspace.of(spark).stage(induce(rows.select("host", "html")), "wrappers")
    joined = rows.join(wrappers.withColumnRenamed("host", "_host"), F.expr("host = _host"), "left")
    kind = rows.schema["key"].dataType.simpleString()

    def work(batches):
        known: dict[bytes, Slot] = {}
        for batch in batches:
            texts = []
            for page, wrapper in zip(batch.column("html"), batch.column("wrapper")):
                packed = wrapper.as_py()
                if packed is not None and packed not in known:
                    if len(known) > 256:
                        known.clear()
                    known[packed] = unpack(packed)
                texts.append(extract(page.as_py(), known.get(packed)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("url"), pa.array(texts, type=pa.string())],
                names=["key", "url", "text"],
            )

    made = joined.select("key", "url", "html", "wrapper").mapInArrow(
        work, f"key {kind}, url string, text string"
    )
    return made.select(F.col("key").alias(key), F.col("url").alias(url), "text")
