import hashlib
import math
from collections import Counter, defaultdict

import pytest
from llm_helpers import odd_documents, plain_words, sentence  # noqa: F401

from plumbline.llm import factorization, mixing, rule_ensemble, secrets, warc, wrapper
from plumbline.llm.queries import QUERIES

MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def learned(spark):
    return {
        name: QUERIES[name](spark, MEDIUM).collect()
        for name in ("op8_toxicity", "op9_quality_classifier")
    }


@pytest.mark.parametrize(
    "name, label, accuracy", [("op8_toxicity", "toxic", 0.9), ("op9_quality_classifier", "quality", 0.95)]
)
def test_held_out_accuracy(spark, learned, name, label, accuracy):
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    rows = learned[name]
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert len(rows) == 1000 and len(held) > 50
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= accuracy * len(held)


def test_classifiers_without_usable_labels(spark, odd_documents):
    none = spark.createDataFrame([(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    for scores in (rule_ensemble.quality_scores, factorization.toxicity_scores):
        rows = scores(odd_documents, none).collect()
        assert len(rows) == odd_documents.count()
        assert {round(r.score, 6) for r in rows} == {0.5}
        assert scores(odd_documents.limit(0), none).count() == 0


def test_accepted_keeps_columns(spark, odd_documents):
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    kept = rule_ensemble.accepted(odd_documents, labels)
    assert kept.columns == odd_documents.columns
    assert kept.count() == odd_documents.count()


def test_secrets_are_found_and_redacted(spark, odd_documents):
    key = "9f8e7d6c5b4a39281706f5e4d3c2b1a0ffeeddcc"
    rows = [(100 + i, f'{sentence(i, 12)} token = "{key[:-2]}{i:02d}" {sentence(i, 9)}') for i in range(30)]
    rows += [(200 + i, f"{sentence(i, 12)} 48451681144{i:05d} {sentence(i, 9)}") for i in range(30)]
    rows += [(300, None), (301, ""), (302, "password: hunter2hunter2 x"), (100, rows[0][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = secrets.judged_findings(df).collect()
    flagged = Counter(r.doc_id for r in found if r.is_secret)
    assert all(flagged[100 + i] == 1 + (i == 0) for i in range(30))
    assert not any(200 <= d < 300 for d in flagged)
    texts = dict(rows)
    assert all(texts[r.doc_id][r.start : r.end] == r.value for r in found)
    clean = {r.doc_id: r.text for r in secrets.redact_secrets(df).collect()}
    assert clean[105] == texts[105].replace(f"{key[:-2]}05", secrets.MASK)
    assert clean[205] == texts[205] and clean[300] is None and clean[301] == ""
    assert secrets.redact_secrets(odd_documents).count() == odd_documents.count()
    assert secrets.judged_findings(odd_documents.limit(0)).count() == 0


def test_secrets_learn_from_given_labels(spark):
    labelled = spark.createDataFrame(
        [(f"{i:02d}aa11bb22cc33dd44", "key ", " x", 1) for i in range(20)]
        + [(f"{i:02d}34567890123456", "call ", " now", 0) for i in range(20)],
        "value string, before string, after string, label int",
    )
    df = spark.createDataFrame(
        [(1, "key 77aa11bb22cc33dd44 x"), (2, "call 7734567890123456 now")], "doc_id long, text string"
    )
    found = {r.doc_id: r.is_secret for r in secrets.judged_findings(df, labelled=labelled).collect()}
    assert found == {1: True, 2: False}


def test_loser_tree_merges_any_number_of_runs():
    for k in range(9):
        runs = [sorted((i * 37 + j * 11) % 50 for i in range(j % 4 * 3)) for j in range(k)]
        assert list(warc.LoserTree(runs)) == sorted(x for run in runs for x in run)


def test_archives_round_trip_in_global_order(spark):
    long = "<p>" + "ä\r\n\r\nWARC/1.1\r\n" * 20
    rows = [(i, f"http://b.example/{i % 5}", long) for i in range(40)]
    rows += [(100, None, None), (101, "no url", ""), (None, "http://a.example/", long), (3, "x\r\ny", long)]
    rows += [(200 + i, "https://A.example/p?q#r", f"short {i % 2}") for i in range(6)]
    rows = [(*r, 1) for r in rows]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload_digest int")
    got = warc.merge_runs(
        warc.sorted_runs(spark, _archives(pages)), rows_per_merge=7
    ).collect()
    assert len(got) == len(rows)
    order = [warc.order_of(tuple(r)) for r in got]
    assert order == sorted(order)
    wanted = Counter()
    first = defaultdict(lambda: None)
    for page, _, html, _ in rows:
        if page is not None and len((html or "").encode()) >= 100:
            first[html] = page if first[html] is None else min(first[html], page)
    for page, _, html, _ in rows:
        body = (html or "").encode()
        keeper = first[html] if len(body) >= 100 else None
        revisit = keeper is not None and (page is None or page > keeper)
        wanted[(page, len(body), hashlib.sha256(body).hexdigest(),
                "revisit" if revisit else "response", keeper if revisit else None)] += 1
    assert Counter(tuple(r)[2:7] for r in got) == wanted
    assert warc.capture_history(pages.limit(0)).count() == 0


def _archives(pages):
    from plumbline.workspace import Workspace

    path = Workspace.of(pages.sparkSession).new_path("test-archives")
    warc.write_archives(warc.described_payloads(pages.repartition(5)), path)
    return path


PAGE = (
    '<html><head><title>T {0}</title></head><body><div class="top">Site name</div><ul><li><a href=1>'
    "Home</a></li><li><a href=2>About us</a></li></ul><div><h2>Title {0}</h2><p>one &amp; {0} "
    "<b>bo</b>ld<br>x<p>two\n  {1}</div><div><p>Copyright always same</p></div>"
    '<div id="cookie-notice">We use cookies</div><section class="comments"><p>first! {0}</p></section>'
    "<script>var a = '<p>no</p>';</script></body></html>"
)


def test_wrapper_drops_template_and_keeps_slots(spark):
    rows = [(i, f"http://h.example/{i}", PAGE.format(i, i * 7)) for i in range(8)]
    rows += [(50, "http://h.example/0", rows[0][2]), (60, None, None), (61, "", "")]
    rows += [(70, "http://one.example/", "<p>only one <b>pa</b>ge<p>two<!-- c --><br>br")]
    marked = "<nav>m</nav><article><h1>Same</h1><aside>s</aside><p>Same text</p></article><footer>f</footer>"
    rows += [(80 + i, "http://m.example/x", marked + f"<!-- {i} -->") for i in range(5)]
    rows = [(*r, "extra") for r in rows]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = {r.page_id: r.text for r in wrapper.main_text(pages).collect()}
    for i in range(8):
        assert got[i] == f"Title {i} one & {i} bold x two {i * 7}"
    assert got[50] == got[0] and got[60] == "" and got[61] == ""
    assert got[70] == "only one page two br"
    assert all(got[80 + i] == "Same Same text" for i in range(5))
    assert wrapper.main_text(pages.limit(0)).count() == 0


def test_mixing_keeps_quotas_and_whole_passes(spark):
    rows = [(i, sentence(i, 50), "big") for i in range(300)]
    rows += [(1000 + i, sentence(i, 50), "small") for i in range(30)]
    rows += [(2000 + i, sentence(i, 50), None) for i in range(60)]
    rows += [(3000, None, "small"), (3001, "", "void")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix_sources(df, entropy=0.97, block_tokens=500).collect()
    tokens = Counter()
    for _, text, source in rows:
        tokens[source] += len(plain_words(text))
    total = sum(tokens.values())
    shares = {s: t / total for s, t in tokens.items() if t}

    def weights(alpha):
        powers = {s: p**alpha for s, p in shares.items()}
        return {s: p / sum(powers.values()) for s, p in powers.items()}

    def entropy(alpha):
        return -sum(w * math.log(w) for w in weights(alpha).values())

    low, high = 0.0, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if entropy(middle) >= 0.97 * math.log(3) else (low, middle)
    quota = {s: w * total for s, w in weights(low).items()}
    passes = defaultdict(Counter)
    for r in out:
        passes[(r.source, r.epoch)][r.doc_id] += 1
    for source, amount in quota.items():
        mine = [r for r in out if r.source == source]
        assert abs(sum(r.n_tokens for r in mine) - amount) <= 51
        ids = {k for k, t, s in rows if s == source}
        whole = int(amount // tokens[source])
        for epoch in range(whole):
            assert set(passes[(source, epoch)]) == ids
        assert all(n == 1 for (s, _), c in passes.items() if s == source for n in c.values())
        starts = sorted((r.start_token, r.n_tokens) for r in mine if r.n_tokens)
        assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))
    limited = mixing.mix_sources(df, entropy=1.0, repeats=1.5).collect()
    used = Counter()
    for r in limited:
        used[r.source] += r.n_tokens
    assert all(used[s] <= 1.5 * tokens[s] + 51 for s in quota)
    assert mixing.mix_sources(df.limit(0)).count() == 0


def test_pipeline_stages_chain(spark):
    import corpus_pipeline

    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert len(out) > 50 and {r.doc_id for r in out} <= {r.doc_id for r in documents.collect()}
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "quality_classifier"
