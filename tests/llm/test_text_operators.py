"""Scans of single rows: pages, secrets, licences, toxicity, leaks."""

import time

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from snaptrend.llm import leaks, licenses, pages, secret_scan, toxicity

SMALL = "/root/testdata/sf0.001"

TREE = pages.trained_tree()


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, and columns whose names operators use inside."""
    rows = [
        (1, None, "x"), (None, "token = abcdefghijkl1234", "x"), (2, "", "x"), (3, "word " * 60_000, "x"),
        (3, "word " * 60_000, "x"), (None, None, "x"),
    ]
    return spark.createDataFrame(rows, "doc_id bigint, text string, _id string").selectExpr(
        "*", "1 as _hash", "2 as n", "'y' as label", "'z' as html", "3 as _text", "4 as page_id", "5 as url"
    )


# --- pages ----------------------------------------------------------------------------------

PAGE = """<html><head><title>T</title><style>p{a:b}</style></head><body><header><h1>Site</h1></header>
<nav><ul><li><a href="/a">A</a></li><li><a>B</a></li></ul></nav><div class="cookie-notice">We use cookies, many.</div>
<article><h1>Head &amp; tail</h1><p>First <b>bold</b>  text
&nbsp;of&#32;it.<br>more<p>Short.</p><script>var t="</p>";</script><div class="ad">Buy!</div><!-- <p>no</p> -->
<section class="comments"><article class="comment"><p>I liked it a lot, thank you for all of these words.</p></article></section>
</article><aside><p>Side text with quite a number of words in it, as it goes.</p></aside>
<form><label>Name</label><input></form><footer>&copy; foot</footer></body></html>"""


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (PAGE, "Head & tail\nFirst bold text of it. more\nShort."),
        (None, ""),
        ("", ""),
        ("no markup, just a sentence that stands for itself", "no markup, just a sentence that stands for itself"),
        ("<article><p>cut off in the mid", "cut off in the mid"),
        ("<nav><a>x</a></nav>", ""),
        ("<article><p>a &lt; b &amp;amp; c</article>", "a < b &amp; c"),
        ('<div class="ad">open<article><p>kept</p></article>', "kept"),
        ("<article><p title='a>b'>quoted</p></article><!-- never closed", "quoted"),
        ("<article><p title=don't>one</p><p>two isn't lost</p><p>three</p></article>", "one\ntwo isn't lost\nthree"),
        ('<article><p>see <a title="x>link</a> here</p></article>', "see link here"),
        ("<article><p data-x=5' class=b>one</p><p title = 'a > b' id=c>two</p></article>", "one\ntwo"),
        ('<div class="post"><div class="entry-header"><h1>Heading of it</h1></div><p>Body text of it.</p></div>', "Heading of it\nBody text of it."),
        ('<div class="main-header"><h1>Site</h1></div><article><p>Body text of it.</p></article>', "Body text of it."),
    ],
)
def test_main_text(page, text):
    assert pages.main_text(page, TREE) == text


def test_tree_fits_its_table():
    assert all(pages.is_main(TREE, row[:-1]) == bool(row[-1]) for row in pages.LABELLED)


def test_pages_table(spark):
    rows = spark.createDataFrame([(1, "u", None), (None, None, PAGE), (1, "u", None)], "page_id bigint, url string, html string")
    got = pages.extract(rows.selectExpr("*", "'x' as text", "1 as n_chars")).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in got) == [(0, 46), (1, 0), (1, 0)]
    assert pages.extract(rows.limit(0)).count() == 0


# --- secrets --------------------------------------------------------------------------------

PIECES = [
    "password", " = ", "'", ":", "token=", "API_KEY", "secret: ", "AKIA", "ABCDEFGH12345678", "deadbeef", "0123456789abcdef",
    "q8Zr2LmX0vTn5KcWb7Yd", "-", " ", "\n", "é", "😀", "xxxxxxxxxxxxxxxxxxxx1", "aGVsbG8gd29ybGQhIQ0x", "3f2504e0-4f89-11d3-9a0c-0305e82c3301",
]


def _scanned(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = {r[0]: tuple(r[1:]) for r in _secret_rows(rows)}
    return [found[i] for i in range(len(texts))]


def _secret_rows(rows):
    from pyspark.sql import functions as F

    found = secret_scan.scan(rows)
    count = lambda kind: F.size(kind).cast("bigint")
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"), F.sha2(secret_scan._listed(secret_scan.KINDS[:3]), 256),
        secret_scan._listed(secret_scan.KINDS), count("entropy"),
    ).collect()


@settings(max_examples=4, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=14).map("".join), min_size=30, max_size=60))
def test_secrets_like_brute_force(spark, texts):
    assert _scanned(spark, texts) == [brute.secrets(t, secret_scan.ALLOWED) for t in texts]


def test_secrets_on_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = dict(docs.select("doc_id", "text").collect())
    for row in secret_scan.query(spark, SMALL).collect():
        assert tuple(row[1:]) == brute.secrets(texts[row[0]], secret_scan.ALLOWED)


def test_secrets_odd_rows(spark, odd):
    rows = _secret_rows(odd)
    assert sorted((r[0] is None, r[1]) for r in rows) == [(False, 0)] * 4 + [(True, 0), (True, 1)]
    assert secret_scan.scan(odd.limit(0)).count() == 0


def test_a_text_full_of_secrets(spark):
    """Time grows with the matches, not with their square."""
    text = "token = abcdefghijkl1234 deadbeefdeadbeef " * 24_000
    rows = spark.createDataFrame([(1, text)], "doc_id int, text string")
    start = time.time()
    row = secret_scan.scan(rows).selectExpr("size(assign) n", "size(hex) m", "assign[23999] last", "hex[23999] end").first()
    assert (row.n, row.m) == (24_000, 24_000) and time.time() - start < 12
    at = 42 * 23_999
    assert (row.last.start, row.last.stop, row.last.value) == (at, at + 24, "abcdefghijkl1234") and row.end.start == at + 25


def test_secrets_run_no_python(spark):
    plan = secret_scan.query(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Exchange" not in plan


# --- licences -------------------------------------------------------------------------------


def test_phrases_and_notices():
    search = licenses.NoticeSearch()
    n, base, fuzzy = licenses.scan_text("Released under the MIT-License. mit license; MIT LICENSES", search)
    assert n == 9 and base == [("mit", 3), ("mit", 5)]
    assert ("mit", 0, 4, 0, 1.0) in fuzzy
    text = "x " * 500 + "Permision is herby granted, free of charge, to any person obtaning a copy" + " y" * 500
    (label, first, last, edits, score), *_ = licenses.scan_text(text, search)[2]
    assert (label, first, last, edits) == ("mit", 500, 512, 3) and 0.9 < score < 1
    assert licenses.scan_text("Permision is hereby grnted fee of chrge to no persn obtning copies", search)[2] == []


@settings(max_examples=60, deadline=None)
@given(st.data())
def test_every_bounded_edit_is_found(data):
    notice, label = data.draw(st.sampled_from(licenses.NOTICES))
    edits = data.draw(st.integers(0, int(len(notice) * licenses.RATE)))
    text = notice
    for _ in range(edits):
        at = data.draw(st.integers(1, len(text) - 2))
        text = text[:at] + data.draw(st.sampled_from(["", "q", text[at] + "z"])) + text[at + 1 :]
    found = licenses.NoticeSearch().find(f"some words {' '.join(text.split())} and more")
    assert label in {f[0] for f in found}


def test_licences_odd_rows(spark, odd):
    rows = licenses.scan(odd).collect()
    assert sorted(r.n_words for r in rows) == [0, 0, 0, 2, 60_000, 60_000]
    assert licenses.scan(odd.limit(0)).count() == 0


# --- toxicity -------------------------------------------------------------------------------


def test_ordinal_regression_orders_grades():
    rng = np.random.default_rng(0)
    grades = rng.integers(0, 3, 600)
    rows, cols, values = np.arange(600), np.zeros(600, int), grades + rng.normal(0, 0.1, 600)
    weights, bars = toxicity.fit_ordinal(rows, cols, values, grades, 1)
    assert weights[0] > 0 and bars[0] < bars[1]
    model = toxicity.Severity({"w": float(weights[0])}, [float(b) for b in bars])
    means = [model.grades("w " * n) @ np.arange(3) for n in (0, 1, 3)]
    assert means == sorted(means) and abs(model.grades("w").sum() - 1) < 1e-9


def test_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = toxicity.fit(docs, labels.where("doc_id % 4 <> 0"))
    rated = toxicity.rate(docs, model).join(labels.where("doc_id % 4 = 0"), "doc_id").toPandas()
    assert not rated[rated.toxic == 0].rejected.any()
    # Toxic rows in languages with too few examples, and those whose text shows nothing, are missed.
    assert rated[rated.toxic == 1].rejected.mean() > 0.4
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == docs.count() - toxicity.rate(docs, model).where("rejected").count()


def test_toxicity_odd_rows(spark, odd):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    model = toxicity.fit(odd, labels)
    assert toxicity.rate(odd, model).where("not rejected and grade = 0").count() == 6
    assert toxicity.rate(odd.limit(0), model).count() == 0
    one = spark.createDataFrame([(1, 1, 1), (None, 1, 0), (2, 0, None)], "doc_id bigint, quality int, toxic int")
    assert toxicity.without_toxic(odd, toxicity.fit(odd, one)).count() == 6


# --- leaks ----------------------------------------------------------------------------------


def test_block_max_wand_like_brute_force(spark):
    docs = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    index = leaks.Index(items)
    texts = [leaks.words_of(t) for t in docs]
    for threshold in (0.3, 0.5):
        found = {(s, at, i): x for s, at, i, x in index.passages(texts, threshold)}
        want = {}
        for s, words in enumerate(texts):
            for k in range(max(1, -(-len(words) // index.stride) - 1)):
                here = {index.terms[w] for w in words[k * index.stride : (k + 2) * index.stride] if w in index.terms}
                for i in range(len(index.items)):
                    score = sum(x for t in here for at, x in zip(index.postings[t], index.impacts[t], strict=True) if at == i)
                    if score >= threshold:
                        want[s, k * index.stride, i] = score
        assert found.keys() == want.keys() and all(abs(found[k] - want[k]) < 1e-9 for k in want)


def test_leaks_of_documents(spark):
    found = {(r.doc_id, r.item_id) for r in leaks.query(spark, "/root/testdata/sf0.01").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()
    verbatim = {(d.doc_id, i.item_id) for d in docs for i in items if i.text in d.text}
    assert verbatim and verbatim <= found and len(found) <= 1.1 * len(verbatim) + 1


def test_cuts_of_the_benchmark_change_no_score(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text")
    whole = leaks.contaminated(docs, items).collect()
    near = lambda rows: sorted((r.doc_id, r.item_id, r.first_word, round(r.score, 9)) for r in rows)
    monkeypatch.setattr(leaks, "SHARDS_A_PASS", 2)
    monkeypatch.setattr(leaks.indexes, "__defaults__", (leaks.THRESHOLD, 9))
    assert whole and near(leaks.contaminated(docs, items).collect()) == near(whole)
    monkeypatch.undo()
    # A long item has passages of its own length and leaves those of the others alone.
    longer = items.unionByName(spark.createDataFrame([(10**6, " ".join(f"zz{i}" for i in range(3_000)))], "item_id bigint, text string"))
    got = [r for r in leaks.contaminated(docs, longer).collect() if r.item_id != 10**6]
    assert [r[:3] for r in near(got)] == [r[:3] for r in near(whole)]


def test_question_without_its_heavy_answer(spark):
    """The answer carries most of the score, and the text holds the question only."""
    common = "what is the name of the long river in the north of the old land"
    answer = " ".join(f"rare{i}" for i in range(30))
    rows = [(1, f"{common}? {answer}.")] + [(k, f"{common}, part {k}? It is number {k}.") for k in range(2, 40)]
    items = spark.createDataFrame(rows, "item_id bigint, text string")
    docs = spark.createDataFrame([(1, f"So {common}? Nobody knows."), (2, "Nothing of that kind is here.")], "doc_id bigint, text string")
    assert (1, 1) in {(r.doc_id, r.item_id) for r in leaks.contaminated(docs, items).collect()}
    assert [r.doc_id for r in leaks.without_leaks(docs, items).collect()] == [2]


def test_leaks_odd_rows(spark, odd):
    items = spark.createDataFrame([(1, None), (2, ""), (None, "token abcdefghijkl1234 is it. Yes")], "item_id bigint, text string")
    assert [r.item_id for r in leaks.contaminated(odd, items).collect()] == []
    assert leaks.without_leaks(odd, items).count() == 6
    assert leaks.contaminated(odd, items.limit(0)).count() == 0
    assert leaks.contaminated(odd.limit(0), items).count() == 0
    held = spark.createDataFrame([(7, "so: token ABCDEFGHIJKL1234 is it. Yes!")] * 2, "doc_id int, text string")
    assert [(r.doc_id, r.item_id) for r in leaks.contaminated(held, items).collect()] == [(7, None)]
    assert leaks.without_leaks(held, items).count() == 0
