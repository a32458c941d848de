"""Spelling variants, line dedup and tokenizer alignment against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from llm_helpers import ascii_lower, odd_documents  # noqa: F401

from plumbline.llm import alignment, line_dedup, variants
from plumbline.llm.variants import GramIndex

# --- spelling variants ---


def brute_words(rows) -> dict[str, int]:
    n = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = ascii_lower(run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                n[run] += 1
    return {w: c for w, c in n.items() if c >= 2}


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def brute_variants(rows) -> set:
    n = brute_words(rows)
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= 10 * n[w]:
            form[w] = best
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n[w], len(near[w]), n.get(form.get(w))))
    return out


def found_variants(df) -> set:
    out = variants.spelling_variants(df)
    return {tuple(r) for r in out.select("word", "form", "root", "n", "n_near", "form_n").collect()}


def edited(word: str, rng) -> str:
    at, letter = rng.randrange(len(word) + 1), rng.choice("aeinéÀ×stz")
    return rng.choice([word[:at] + letter + word[at:], word[:at] + word[at + 1 :], word[:at] + letter + word[at + 1 :]])


def test_spelling_variants_equal_brute_force(spark):
    rng = random.Random(3)
    parts = "tion ment ant er in al eux schaft lich ña çon üt".split()
    words = ["".join(rng.choice(parts) for _ in range(rng.randrange(2, 5))) for _ in range(60)]
    words += [edited(w, rng) for w in words for _ in range(4)]
    # Chains of forms: 2, 20 and 200 occurrences at one edit from each other.
    chain = ["plumbline"] * 200 + ["plumblime"] * 20 + ["plumglime"] * 2 + ["plümglime"] * 2
    rows = [(i, " ".join(rng.choice([str.title, str.upper, str])(w) for w in rng.choices(words, k=60)) + " " + " ".join(chain[i::20])) for i in range(20)]
    rows += [(None, "Plumbline plumbline-plumbline"), (3, None), (4, ""), (5, "short 123 words ab"), (3, rows[3][1])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id int, text string, word string, n int")
    expected = brute_variants(rows)
    assert found_variants(df) == expected
    assert any(r[2] == "plumbline" and r[1] == "plumblime" for r in expected)


def test_spelling_variants_of_hot_lists_in_blocks(spark):
    rows = [(1, " ".join(f"{a}{b}tention {a}{b}tention" for a in "abcdefghij" for b in "klmnopqrst"))]
    words = spark.createDataFrame([(w, n) for w, n in brute_words(rows).items()], "word string, n long")
    pairs = {(r["a"], r["b"]) for r in variants.near_pairs(words, block=3).collect()}
    known = sorted(brute_words(rows))
    assert {tuple(sorted(p)) for p in pairs} == {(a, b) for a in known for b in known if a < b and one_edit(a, b)}
    assert len(pairs) == len({tuple(sorted(p)) for p in pairs})


def test_near_words_meet_for_any_dictionary():
    rng = random.Random(5)
    for _ in range(300):
        entries = {"".join(rng.choices("abc", k=rng.choice([2, 3, 3]))) for _ in range(rng.randrange(30))}
        index = GramIndex(frozenset(entries))
        for _ in range(20):
            word = "".join(rng.choices("abcd", k=rng.randrange(7, 12)))
            at = rng.randrange(len(word))
            replaced = word[:at] + rng.choice("abcdx") + word[at + 1 :]
            shorter = word[:at] + word[at + 1 :]
            assert index.lists(word)[0] & index.lists(replaced)[0]
            assert index.lists(word)[0] & index.lists(shorter)[1]


def test_spelling_variants_of_nothing(spark):
    assert found_variants(spark.createDataFrame([], "doc_id int, text string")) == set()


# --- line dedup ---


def key_of(line: str) -> str:
    return ascii_lower(line.strip(" \t\n\x0b\x0c\r"))


def brute_lines(rows, least: int) -> list:
    held = defaultdict(set)
    for key, text in rows:
        for line in (text or "").split("\n"):
            held[key_of(line)].add((key, text))
    out = []
    for key, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not key_of(x) or len(held[key_of(x)]) < least]
        out.append((key, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


LINES = [
    "Share this page", " share THIS page\t", "ÜBER uns", "über uns", "a", "", "  ", "\x0bx\x0c", "x",
    "Subscribe now", " ", "last\r",
]


@pytest.mark.parametrize("least", [2, 3, 10])
def test_line_dedup_equals_brute_force(spark, least):
    rng = random.Random(least)
    rows = [(i, "\n".join(rng.choices(LINES + [f"own {i}", f"own {i % 7}"], k=rng.randrange(1, 9)))) for i in range(40)]
    rows += [(None, "x\nown"), (None, None), (50, None), (51, ""), (52, "\n"), (53, "x\n"), (54, "\n\nx"), rows[0], rows[0]]
    rows += [(60, "\n".join(f"long {i}" for i in range(20_000)) + "\nx")]
    df = spark.createDataFrame([(*r, 0, "b") for r in rows], "doc_id int, text string, a int, n_lines string")
    found = line_dedup.drop_common_lines(df, least_documents=least)
    assert found.columns == ["doc_id", "n_lines", "n_dropped", "kept"]
    assert sorted(map(tuple, found.collect()), key=str) == brute_lines(rows, least)


def test_line_dedup_counts_a_repeated_row_once(spark):
    df = spark.createDataFrame([(1, "same\nline")] * 30 + [(2, "same")], "doc_id int, text string")
    assert line_dedup.drop_common_lines(df, least_documents=3).agg({"n_dropped": "sum"}).first()[0] == 0
    assert line_dedup.drop_common_lines(df, least_documents=2).agg({"n_dropped": "sum"}).first()[0] == 31


def test_line_dedup_matches_hot_and_other_lines(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "MOST_HOT", 3)
    rows = [(i, "\n".join(["hot", f"warm {i % 5}", f"own {i}"])) for i in range(60)]
    found = line_dedup.drop_common_lines(spark.createDataFrame(rows, "doc_id int, text string"))
    assert sorted(map(tuple, found.collect()), key=str) == brute_lines(rows, 10)


def test_line_dedup_of_nothing(spark):
    assert line_dedup.drop_common_lines(spark.createDataFrame([], "doc_id int, text string")).count() == 0


# --- tokenizer alignment ---


class Plain:
    """Both tokenizers, run by their own libraries, one text at a time."""

    def __init__(self):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(f"{alignment.TOKENIZERS}/byte_bpe_50k.json")
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=f"{alignment.TOKENIZERS}/piece_bpe_32k.model")
        alphabet = alignment.byte_alphabet()
        self.bytes_a = {i: bytes(alphabet[c] for c in t) for t, i in self.a.get_vocab().items() if i < 50256}

    def bytes_b(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def groups(self, text) -> list:
        if not text:
            return []
        a = [(i, self.bytes_a[i]) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, self.bytes_b(i)) for i in self.b.encode(text)]
        whole = (" " + text).encode()
        if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            return []
        ends = [set(), set()]
        for side, tokens in zip(ends, (a, b)):
            at = 0
            for _, x in tokens:
                at += len(x)
                side.add(at)
        out, at_a, at_b = [], 0, 0
        for end in sorted(ends[0] & ends[1]):
            group = ([], [])
            while a and at_a + len(a[0][1]) <= end:
                at_a += len(a[0][1])
                group[0].append(a.pop(0)[0])
            while b and at_b + len(b[0][1]) <= end:
                at_b += len(b[0][1])
                group[1].append(b.pop(0)[0])
            out.append(group)
        return out


def brute_alignment(rows) -> list:
    plain = Plain()
    groups = [plain.groups(text) for _, text in rows]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in groups]
    count = Counter(p for one in links for p in one)
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for (key, _), g, one in zip(rows, groups, links):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append((
            key, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(one.values()),
            sum(n for p, n in one.items() if count[p] == best[p[0]]),
            sum(n * count[p] for p, n in one.items()),
            hashlib.sha256(text.encode()).hexdigest() if g else "",
        ))
    return sorted(out, key=str)


ALIGNED = [
    (1, "The quick brown fox, the lazy dog."), (2, "the quick"), (2, "the quick"), (None, "the quick"),
    (3, None), (4, ""), (5, " "), (6, "  two  spaces\n\n\tand tabs\r\n"), (7, "naïve Öl façade 中文字 😀👍🏽"),
    (8, "a ▁ literal piece mark"), (9, "<|endoftext|> </s> <unk> <0x41>"), (10, "\x00\x01 control"),
    (11, "ﬁ ① ½ é"), (12, "=" * 5_000 + "-=" * 3_000), (13, "xyz " * 20_000), (14, " " * 30_000 + "x"),
    (15, "q" * 3_000), (16, "don't we'll I'm 12345 1,000.50"),
]


@pytest.mark.parametrize("hot", [1 << 20, 5])
def test_alignment_equals_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(alignment, "MOST_HOT", hot)
    df = spark.createDataFrame([(*r, 0, "x") for r in ALIGNED], "doc_id long, text string, n_a int, pairs string")
    found = sorted(map(tuple, alignment.align_tokenizers(df).collect()), key=str)
    assert found == brute_alignment(ALIGNED)
    assert [r for r in found if r[0] == 8] == [(8, 0, 0, 0, 0, 0, 0, "")]


def test_alignment_reduces_large_groups(monkeypatch):
    aligner = alignment.Aligner(alignment.TokenizerPair.read(
        f"{alignment.TOKENIZERS}/byte_bpe_50k.json", f"{alignment.TOKENIZERS}/piece_bpe_32k.model"))
    raws = [(text or "").encode() for _, text in ALIGNED]
    plain = aligner.align(raws)
    monkeypatch.setattr(alignment, "LARGE_GROUP", 1)
    reduced = aligner.align(raws)
    for one, other in zip(zip(plain["pairs"], plain["uses"]), zip(reduced["pairs"], reduced["uses"])):
        assert dict(zip(one[0].as_py(), one[1].as_py())) == dict(zip(other[0].as_py(), other[1].as_py()))


def test_alignment_does_not_depend_on_parts(spark, monkeypatch):
    df = spark.createDataFrame(ALIGNED, "doc_id long, text string")
    whole = sorted(map(tuple, alignment.align_tokenizers(df).collect()), key=str)
    monkeypatch.setattr(alignment, "PART_BYTES", 10)
    assert sorted(map(tuple, alignment.align_tokenizers(df.repartition(5)).collect()), key=str) == whole


def test_alignment_of_nothing(spark):
    assert alignment.align_tokenizers(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_fast_and_slow_tokenizer_agree():
    aligner = alignment.Aligner(alignment.TokenizerPair.read(
        f"{alignment.TOKENIZERS}/byte_bpe_50k.json", f"{alignment.TOKENIZERS}/piece_bpe_32k.model"))
    plain, rng = Plain(), random.Random(2)
    pools = ["abcdeft ion ing the", "àéîöñçß", "0123.,;:!?'\"", " \t\n\r 　", "你好世界", "😀👍🏽", "'s 'll 're"]
    for _ in range(2_000):
        text = "".join(rng.choice(rng.choice(pools)) for _ in range(rng.randrange(1, 40)))
        assert aligner.a.encode_ordinary(text) == plain.a.encode(text, add_special_tokens=False).ids
