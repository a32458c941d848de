import re
from collections import Counter

import pytest
from llm_helpers import (  # noqa: F401
    ascii_lower,
    brute_components,
    odd_documents,
    plain_words,
    sentence,
    shingles,
)

from plumbline.llm import host_rules, mixture, suffix, token_groups
from plumbline.llm.queries import QUERIES


def base_counts(text):
    words = plain_words(text)
    seen = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = {
        j for i in range(len(words) - 7) if seen[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)
    }
    earlier, dup = set(), 0
    for line in (text or "").split("\n"):
        if plain_words(line):
            dup += line in earlier
            earlier.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, dup, len(inside)


def test_host_rules_count_like_brute_force(odd_documents):
    rows = host_rules.host_verdicts(odd_documents).collect()
    texts = {(r["doc_id"]): r["text"] for r in odd_documents.collect()}
    assert len(rows) == odd_documents.count()
    for r in rows:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert got == base_counts(texts[r.doc_id]), r
        failed = r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words
        assert r.base_failed == failed
        assert not (r.kept and failed)


def test_a_bad_host_fails_and_a_small_one_is_not_condemned(spark):
    good = [(i, sentence(i, 40), f"h{i % 10}") for i in range(200)]
    bad = [(1000 + i, sentence(i, 40).replace(" ", "### "), "bad") for i in range(60)]
    small = [(2000, sentence(5, 40).replace(" ", "### "), "h3")]
    df = spark.createDataFrame(good + bad + small, "doc_id long, text string, source string")
    kept = {r.doc_id: r.kept for r in host_rules.host_verdicts(df).collect()}
    assert all(kept[i] for i in range(200)) and kept[2000]
    assert not any(kept[1000 + i] for i in range(60))


@pytest.mark.parametrize("block_words", [20, suffix.BLOCK_WORDS])
def test_decontamination_equals_brute_force(spark, odd_documents, block_words):
    items = [
        (1, sentence(1, 25)), (2, "One two"), (3, None), (4, ""), (5, sentence(2, 12)),
        (1, sentence(1, 25)),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    windows = {}
    for item, text in items:
        words = re.findall(pattern, ascii_lower(text or ""))
        size = min(len(words), 10)
        for i in range(len(words) - size + 1) if size else ():
            windows.setdefault(tuple(words[i : i + size]), set()).add(str(item))
    rows = suffix.contaminated_spans(odd_documents, benchmark, block_words=block_words).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in odd_documents.collect()}
    assert len(rows) == len(odd_documents.collect())
    for r in rows:
        words = re.findall(pattern, ascii_lower(texts[r.doc_id]))
        hit, found = set(), set()
        for window, names in windows.items():
            for i in range(len(words) - len(window) + 1):
                if tuple(words[i : i + len(window)]) == window:
                    hit |= set(range(i, i + len(window)))
                    found |= names
        assert (r.n_words, r.n_hit, r["items"]) == (len(words), len(hit), sorted(found)), r
        inside = " ".join(texts[r.doc_id][s.start : s.end] for s in r.spans)
        assert len(re.findall(pattern, ascii_lower(inside))) == len(hit)


def test_removed_spans_leave_the_rest(spark, odd_documents):
    benchmark = spark.createDataFrame([(5, sentence(2, 12))], "item_id long, text string")
    clean = suffix.remove_spans(odd_documents, benchmark)
    assert clean.columns == odd_documents.columns
    before = {r.doc_id: r.text for r in odd_documents.collect()}
    after = {r.doc_id: r.text for r in clean.collect()}
    assert sentence(2, 12) not in after[7]
    assert all(sentence(2, 12) not in (text or "") for text in after.values())
    holds = {k for k, text in before.items() if sentence(2, 12) in (text or "")}
    assert holds == {7, 10, 13}
    assert all(after[k] == before[k] for k in before if k not in holds)


def test_empty_tables(spark, odd_documents):
    none = odd_documents.limit(0)
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert suffix.contaminated_spans(none, benchmark).count() == 0
    assert all(r.n_hit == 0 for r in suffix.contaminated_spans(odd_documents, benchmark).collect())
    assert host_rules.host_verdicts(none).count() == 0
    assert token_groups.near_duplicates(none).count() == 0
    assert mixture.predict_languages(none).count() == 0


@pytest.mark.parametrize("size, percent", [(4, 85), (5, 80)])
def test_near_duplicates_equal_brute_force(spark, size, percent):
    rows = []
    for family in range(12):
        words = sentence(family, 60).split()
        for copy in range(8):
            edited = list(words)
            for k in range(copy % 4):
                edited[(copy * 13 + k * 29) % 60] = f"edit{family}x{copy}x{k}"
            rows.append((family * 100 + copy, " ".join(edited)))
    rows += [(5000, None), (5001, ""), (5002, "a b"), (5003, "A  b"), (5004, "a c")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {k: shingles(t, size) for k, t in rows}
    wanted = brute_components(sets, percent)
    got = token_groups.near_duplicates(df, size=size, percent=percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {
        k: (len(sets[k]), wanted[k]) for k in sets
    }


@pytest.mark.parametrize("percent", [80, 85])
def test_group_bound_holds_for_every_size_in_it(spark, percent):
    """Whenever a set of some size in the range may link, the bound of the range says so."""
    may_reach, may_link = token_groups._may_reach, token_groups._may_link
    ranges = spark.sql(
        "SELECT n.id AS n, l.id AS least, l.id + w.id AS most, s.id AS shared "
        "FROM range(1, 41) n, range(1, 46) l, range(0, 9, 2) w, range(1, 9) s"
    )
    sizes = ranges.selectExpr("*", "explode(sequence(least, most)) AS m")
    lost = sizes.where(may_link("n", "m", "shared", percent)).where(
        f"NOT {may_reach('n', 'least', 'most', 'shared', percent)}"
    )
    assert lost.isEmpty()


def test_lookup_lets_wanted_rows_through_and_few_others(spark):
    """Only rows that may be wanted reach the shuffle, whatever the sign of their digest."""
    rows = spark.range(200_000).selectExpr("id", "struct(xxhash64(id) AS h1, id AS h2) AS row_key")
    wanted = rows.where("id % 1000 = 0 OR row_key.h1 = -1").select("row_key.h1")
    found = {r.id for r in token_groups.possible_rows(rows, "row_key.h1", wanted).collect()}
    assert found >= set(range(0, 200_000, 1000)) and len(found) < 250
    edge = spark.createDataFrame([(k,) for k in (0, 63, 64, -1, -64, 2**63 - 1, -(2**63))], "h long")
    assert token_groups.possible_rows(edge, "h", edge.select("h")).count() == 7
    assert token_groups.possible_rows(edge, "h", edge.where("h = -1").select("h")).collect()[0].h == -1
    assert token_groups.possible_rows(rows, "row_key.h1", wanted.limit(0)).isEmpty()


def test_one_row_of_each_group_stays(odd_documents):
    kept = token_groups.one_of_each(odd_documents)
    assert kept.columns == odd_documents.columns
    ids = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect())
    # 1, 2 (twice) and 3 are one group, 7 and 13 another, 8 and 9 a third; texts without words stay.
    assert [i for none, i in ids if not none] == [1, 4, 5, 6, 7, 8, 10, 11, 12]
    assert ids[-1][0]


def test_language_needs_letters_and_ignores_the_given_language(odd_documents):
    rows = {r.doc_id: r for r in mixture.predict_languages(odd_documents).collect()}
    assert all(rows[i].lang_pred == "und" and rows[i].score == 0 for i in (4, 5, 6, 11))
    assert all(0 <= r.score <= 1 for r in rows.values())


def test_language_accuracy_on_held_out_texts(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r.doc_id: r.lang for r in documents.select("doc_id", "lang").collect()}
    rows = [r for r in QUERIES["op3_language_mixture"](spark, "/root/testdata/sf0.01").collect()]
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(truth) and len(held) > 200
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)


def test_all_queries_run_on_the_smallest_tables(spark):
    for name in ("op4_benchmark_decontamination", "op10_host_rules"):
        assert QUERIES[name](spark, "/root/testdata/sf0.001").count() == 200
