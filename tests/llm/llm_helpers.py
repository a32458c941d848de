"""Inputs and brute-force versions for the tests of the corpus operators."""

import re
from collections import defaultdict

import pytest

FILLER = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omicron pi".split()


def sentence(seed: int, n: int) -> str:
    """Words that differ from seed to seed."""
    return " ".join(f"{FILLER[(seed * 7 + i * i) % len(FILLER)]}{(seed * 31 + i) % 97}" for i in range(n))


def ascii_lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def plain_words(text) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text, size: int) -> frozenset:
    words = plain_words(ascii_lower(text or ""))
    if len(words) < size:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def brute_components(sets: dict, percent: int) -> dict:
    """Smallest key reachable by links, over all pairs."""
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    holders = defaultdict(list)
    for key, values in sets.items():
        for value in values:
            holders[value].append(key)
    pairs = {(a, b) for keys in holders.values() for a in keys for b in keys if a < b}
    for a, b in pairs:
        common = len(sets[a] & sets[b])
        if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {k: find(k) for k in sets}


@pytest.fixture(scope="module")
def odd_documents(spark):
    """Nulls in any column, empty and long texts, repeated rows, and columns with clashing names."""
    base = sentence(1, 60)
    rows = [
        (1, base, "en", "s1"),
        (2, base, "en", "s1"),
        (2, base, "en", "s1"),
        (3, base.upper() + "\n", "en", None),
        (4, None, "en", "s1"),
        (5, "", None, "s1"),
        (6, " \t\n ", "en", "s2"),
        (7, sentence(2, 30) + " " + sentence(2, 30), "de", "s2"),
        (8, "one two", "de", "s2"),
        (9, "One  two", "de", "s2"),
        (None, sentence(3, 40), "de", "s2"),
        (10, " ".join(sentence(k, 50) for k in range(200)), "fr", "s3"),
        (11, "…—…", "fr", "s3"),
        (12, "same line\nsame line\nother ### line\n\nsame line ", "fr", "s3"),
        (13, sentence(2, 30) + " " + sentence(2, 30) + " tail", "de", "s2"),
    ]
    rows = [(*r, 0, "x", 1.0) for r in rows]
    return spark.createDataFrame(
        rows,
        "doc_id long, text string, lang string, source string, n_words int, spans string, score double",
    )
