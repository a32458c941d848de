"""Cases at borders: balanced sources, equal keys, items without an id, long values, equal hashes."""

from collections import Counter

import duckdb
import pytest
from llm_helpers import sentence
from plumbline.llm import components, mixing, queries, secrets, suffix
from plumbline.llm.sql import STATEMENTS


@pytest.mark.parametrize("sources", [3, 7, 10])
def test_balanced_sources_give_each_text_once(spark, sources):
    rows = [(i, f"{i} " * 10, f"s{i % sources}") for i in range(20 * sources)]
    rows += [(1000 + i, "", f"s{i % sources}") for i in range(sources)]
    df = spark.createDataFrame(rows, "doc_id int, text string, source string")
    out = mixing.mix_sources(df, block_tokens=50).collect()
    assert Counter(r["doc_id"] for r in out) == Counter(r[0] for r in rows)


def test_texts_with_null_keys_are_spread_over_blocks(spark):
    rows = [(None, sentence(i, 10), "s") for i in range(2_000)]
    df = spark.createDataFrame(rows, "doc_id int, text string, source string")
    out = mixing.mix_sources(df, block_tokens=200)
    sizes = [r["count"] for r in out.groupBy("block").count().collect()]
    assert sum(sizes) == 2_000 and max(sizes) < 100


def test_items_without_an_id_are_hit_but_not_named(spark, tmp_path):
    words = [sentence(i, 14) for i in range(6)]
    documents = [(1, "a b c " + words[0] + " d"), (2, words[1]), (3, words[2] + " " + words[0]), (4, "clean text")]
    items = [(None, words[0]), (7, words[1]), (None, words[2]), (8, None), (9, words[5])]
    spark.createDataFrame(documents, "doc_id int, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id int, text string").coalesce(1).write.parquet(f"{tmp_path}/benchmark.parquet")
    found = {tuple(sorted(r.asDict().items())) for r in queries.benchmark_decontamination(spark, str(tmp_path)).collect()}
    duck = duckdb.connect()
    for table in ("documents", "benchmark"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    expected = duck.execute(STATEMENTS["op4_benchmark_decontamination"]).df().to_dict("records")
    assert found == {tuple(sorted(r.items())) for r in expected}
    hits = {r["doc_id"]: r["n_hit"] for r in expected}
    assert hits == {1: 14, 2: 14, 3: 28, 4: 0}
    # The same over several blocks of items, each written and discarded in turn.
    df, benchmark = (spark.read.parquet(f"{tmp_path}/{t}.parquet") for t in ("documents", "benchmark"))
    by_blocks = suffix.contaminated_spans(df, benchmark, block_words=20).collect()
    assert {r["doc_id"]: r["n_hit"] for r in by_blocks} == hits
    assert all(None not in r["items"] for r in by_blocks)


def test_dictionary_coverage_of_any_length():
    words = {"correct", "horse"}
    short, long = ("correcthorse" * n for n in (2, 500))
    at = secrets.FEATURES.index("dictionary")
    assert secrets.features_of(short, "", "", words, 7)[at] == secrets.features_of(long, "", "", words, 7)[at] == 1.0


def test_components_over_blocks_and_chains(spark):
    links = [(i, i + 1) for i in range(150)] + [(500, 500 + i) for i in range(40)] + [(900, 901), (901, 900), (7, 7)]
    df = spark.createDataFrame(links, "a long, b long").repartition(7)
    for block in (2, 1_000):
        found = {r["node"]: r["root"] for r in components.components(df, block).collect()}
        assert found.keys() == {x for link in links for x in link}
        groups = {}
        for node, root in found.items():
            groups.setdefault(root, set()).add(node)
        assert sorted(map(sorted, groups.values())) == [list(range(151)), list(range(500, 540)), [900, 901]]
        assert all(root in members for root, members in groups.items())
    assert components.components(df.limit(0)).count() == 0
